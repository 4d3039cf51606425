"""Cost-balanced packing of tokenised documents into sequences of fixed length.

The work of a sequence is estimated as ``linear * length + quadratic * length ** 2`` summed over its
pieces, as attention stays inside a piece.  Whole sequences are cut off a document first.  What is
left goes, longest first, to the sequence of lowest cost that still has room for it; a piece that
fits nowhere is cut.  Packing runs inside a task over bounded groups of documents in reading order,
so there is no shuffle, and each group leaves less than one sequence of padding.
"""

from __future__ import annotations

import heapq
import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Texts, WordStore, map_texts, slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 2048
#: Documents packed together.
GROUP = 4096
#: Sequence numbers of a task start at its partition number times this.
PER_TASK = 1 << 40
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, cost double"


@dataclass(frozen=True)
class Cost:
    """Work of a piece: projections grow with its length, attention with the square."""

    linear: float = 1.0
    quadratic: float = 1.0 / 4096

    def of(self, length: int) -> float:
        return self.linear * length + self.quadratic * length * length


def assign(lengths: list[int], capacity: int = CAPACITY, cost: Cost = Cost()) -> list[tuple[int, int, int, int, int]]:
    """``(item, start in the item, length, sequence, offset)`` of every piece.

    As many sequences as the tokens need, none fuller than ``capacity``; ties go to the earlier item
    and the earlier sequence.
    """
    total = sum(lengths)
    if not total:
        return []
    n = -(-total // capacity)
    room, load = np.full(n, capacity, np.int64), np.zeros(n)
    heap = [(-length, item, 0) for item, length in enumerate(lengths) if length]
    heapq.heapify(heap)
    out = []
    while heap:
        minus, item, start = heapq.heappop(heap)
        length = -minus
        fits = room >= length
        target = int(np.where(fits, load, np.inf).argmin()) if fits.any() else int(room.argmax())
        taken = min(length, int(room[target]))
        out.append((item, start, taken, target, capacity - int(room[target])))
        room[target] -= taken
        load[target] += cost.of(taken)
        if taken < length:
            heapq.heappush(heap, (taken - length, item, start + taken))
    return out


@lru_cache(maxsize=2)
def word_store(path: str) -> WordStore:
    """Ids by word, one store per worker process.  No id of this vocabulary spans a blank, or a letter and a mark."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(words: list[bytes]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]

    return WordStore(encode, most=2_000_000)


def document_ids(texts: list[bytes], store: WordStore, end_id: int) -> list[np.ndarray]:
    """The ids of every text, ``end_id`` last."""
    # The vocabulary is lower case, so words can be looked up without case and marks; but a special
    # token is a word of its own and is only known as it is written.
    special = any(b"<|" in text for text in texts)
    read = Texts(texts, lower=not special, cut=not special)
    values, sizes = store.lookup(read)
    ends = np.concatenate(([0], np.cumsum(sizes)))[read.first_word]
    return [np.append(values[a:b], end_id).astype("<u4") for a, b in zip(ends[:-1], ends[1:])]


class Packer:
    """Rows of the pieces of one task."""

    def __init__(self, first_sequence: int, capacity: int, cost: Cost):
        self.next, self.capacity, self.cost = first_sequence, capacity, cost
        self.rows: list[tuple] = []
        self.waiting: list[tuple[int, int, np.ndarray, int]] = []

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            part = ids[start : start + self.capacity]
            self.rows.append((doc_id, start, len(part), part.tobytes(), len(ids), self.next, 0, self.cost.of(len(part))))
            self.next += 1
        if whole < len(ids):
            self.waiting.append((doc_id, whole, ids[whole:], len(ids)))

    def pack(self) -> None:
        used = 0
        for item, start, length, sequence, offset in assign([len(ids) for _, _, ids, _ in self.waiting], self.capacity, self.cost):
            doc_id, before, ids, n = self.waiting[item]
            part = ids[start : start + length].tobytes()
            self.rows.append((doc_id, before + start, length, part, n, self.next + sequence, offset, self.cost.of(length)))
            used = max(used, sequence + 1)
        self.next += used
        self.waiting = []

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * 8
        self.rows = []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "cost"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    group: int = GROUP,
    cost: Cost = Cost(),
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``, ``ids`` (little-endian
    unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id``, ``offset`` (in the sequence, gapless from 0), ``cost``.

    A null or empty text is one piece with ``end_id`` alone.  Repeated rows are packed each on their own; a null
    ``doc_id`` stays null; an empty table gives no row; other columns are not read.  A text of any length is cut into
    whole sequences and a rest.  Sequence numbers hold the partition number, so a task that runs again gives the same.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        store = word_store(path)
        packer = Packer(TaskContext.get().partitionId() * PER_TASK, capacity, cost)
        for batch, texts in slices(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), document_ids(texts, store, end_id)):
                packer.add(doc_id, ids)
                if len(packer.waiting) >= group:
                    packer.pack()
            if packer.rows:
                yield packer.take()
        packer.pack()
        if packer.rows:
            yield packer.take()

    return map_texts(docs, run, SCHEMA)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "cost")
