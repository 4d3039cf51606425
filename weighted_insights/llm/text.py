"""Texts as byte arrays: words, lines and their 64-bit hashes for a bounded slice of rows at a time.

A word is a run of bytes other than the six ASCII blanks (space, \\t, \\n, \\v, \\f, \\r).  UTF-8
never uses those bytes inside a character, so byte positions cut texts exactly where
``[^\\x20\\x09-\\x0D]+`` cuts them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

#: Bytes of text that a task holds as arrays at once (one longer text is a slice of its own).
SLICE_BYTES = 1_000_000
#: Rows of an Arrow batch; bounds what a Python worker receives at once.
BATCH_ROWS = 1000

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUES = np.zeros(256, bool)
CONTINUES[0x80:0xC0] = True

#: Blanks, ASCII letters and digits, the apostrophe, other ASCII marks, and the rest.
CLASS = np.full(256, 4, np.uint8)
CLASS[:128] = 3
CLASS[BLANK] = 0
CLASS[48:58] = CLASS[65:91] = CLASS[97:123] = 1
CLASS[39] = 2
#: Whether a word can be cut between bytes of two classes: between letters and marks, but not after an apostrophe.
CUT = np.zeros((5, 5), bool)
CUT[1, 2] = CUT[1, 3] = CUT[3, 1] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_CODES = np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def prepare(spark: SparkSession) -> None:
    """Let executors import the package, and bound the Arrow batches of the session."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def map_texts(docs: DataFrame, function: Callable, schema: str, columns: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``mapInArrow`` over the named columns only, so that other columns cannot clash with the output."""
    prepare(docs.sparkSession)
    return docs.select(*columns).mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Consecutive rows with at most ``limit`` bytes of text (one row at least); a null text is empty."""
    for batch in batches:
        column = batch.column(text).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)) if len(column) else np.zeros(0, np.int64)
        start = 0
        while start < len(column):
            taken = np.searchsorted(np.cumsum(sizes[start:]), limit, side="right")
            stop = min(len(column), start + max(1, int(taken)))
            yield batch.slice(start, stop - start), [t or b"" for t in column.slice(start, stop - start).to_pylist()]
            start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        if n > 1 << 22:  # only for one very long text; not kept
            return np.multiply.accumulate(out)
        _powers[name] = np.multiply.accumulate(out)
    return _powers[name][:n]


class Texts:
    """The words and lines of some texts, laid end to end with a newline after each.

    ``lower`` hashes A-Z as a-z; ``cut`` also cuts words between ASCII letters or digits and ASCII marks.
    """

    def __init__(self, texts: list[bytes], lower: bool = False, cut: bool = False):
        self.cut = cut
        self.n = len(texts)
        self.raw = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(self.raw, np.uint8)
        self.coded = LOWER[self.data] if lower else self.data
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, self.n)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    @cached_property
    def _spans(self) -> tuple[np.ndarray, np.ndarray]:
        blank = BLANK[self.data]
        edges = np.flatnonzero(np.diff(blank, prepend=True))
        if not self.cut:
            return edges[0::2], edges[1::2]
        kind = CLASS[self.data]
        inner = np.flatnonzero(CUT[kind[:-1], kind[1:]]) + 1
        return np.sort(np.append(edges[0::2], inner)), np.sort(np.append(edges[1::2], inner))

    @property
    def word_start(self) -> np.ndarray:
        return self._spans[0]

    @property
    def word_end(self) -> np.ndarray:
        return self._spans[1]

    @cached_property
    def first_word(self) -> np.ndarray:
        """Number of words before each text, and the number of all words at the end."""
        return np.append(np.searchsorted(self.word_start, self.starts), len(self.word_start))

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first_word)

    @cached_property
    def word_doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    @cached_property
    def _sums(self) -> np.ndarray:
        terms = _BYTE_CODES[self.coded]
        terms *= _power("up", _ODD, len(terms))
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte span, equal for equal bytes."""
        part = (self._sums[end] - self._sums[start]) * _power("down", _ODD_INVERSE, len(self.data))[start]
        return mix(part ^ mix((end - start).astype(np.uint64)))

    @cached_property
    def words(self) -> np.ndarray:
        return self.hashes(*self._spans)

    def word(self, i: int) -> bytes:
        return self.raw[self.word_start[i] : self.word_end[i]]

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of every run of ``size`` words inside one text."""
        n = len(self.words) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        mixed = self.words[:n].copy()
        for k in range(1, size):
            mixed *= _ODD
            mixed += self.words[k : n + k]
            mixed ^= mixed >> np.uint64(29)
        at = np.flatnonzero(self.word_doc[:n] == self.word_doc[size - 1 :])
        return mix(mixed[at]), at

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """The sum of a per-byte measure over each text."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.ends] - sums[self.starts]

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of every line; texts split at newlines only."""
        ends = np.flatnonzero(self.data == 0x0A)
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        return starts, ends, np.searchsorted(self.ends, starts, side="right")


def repeats(group: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per item: how often its key occurs in its group, and whether an equal one stands before it."""
    order = np.argsort(mix(keys ^ mix(group.astype(np.uint64) + np.uint64(1))), kind="stable")
    g, k = group[order], keys[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
    run = np.cumsum(new) - 1
    count, later = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
    count[order] = np.bincount(run, minlength=1)[run] if len(run) else 0
    later[order] = ~new
    return count, later


class WordStore:
    """Number lists by word hash, kept between slices; begins anew when ``most`` words are held.

    A worker process that goes on to another job keeps its stores; only the one that was asked last holds words.
    """

    #: Slots for the words that were looked up last (a power of two).
    SLOTS = 1 << 20

    _asked: WordStore | None = None

    def __init__(self, encode: Callable[[list[bytes]], list], most: int = 600_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        # All words held, ascending, and the number of each; the lists stand in the order of the numbers.
        self.words, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)
        self.values = np.zeros(0, np.int32)
        self.slot_word, self.slot_row = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    @property
    def at(self) -> memoryview:
        """The words held."""
        return memoryview(self.words)

    def lookup(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The lists of all words of ``texts`` end to end, and the length of each word's list."""
        if WordStore._asked is not self:
            if WordStore._asked is not None:
                WordStore._asked._clear()
            WordStore._asked = self
        rows = self._slotted(texts.words)
        open_ = np.flatnonzero(rows < 0)
        keys, first, back = np.unique(texts.words[open_], return_index=True, return_inverse=True)
        place = np.searchsorted(self.words, keys)
        known = np.zeros(len(keys), bool)
        inside = np.flatnonzero(place < len(self.words))
        known[inside] = self.words[place[inside]] == keys[inside]
        found_rows = np.empty(len(keys), np.int32)
        found_rows[known] = self.numbers[place[known]]
        missing = np.flatnonzero(~known)
        if len(self.words) and len(self.words) + len(missing) > self.most:
            self._clear()
            return self.lookup(texts)
        if len(missing):
            found = self.encode([texts.word(i) for i in open_[first[missing]].tolist()])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            found_rows[missing] = np.arange(len(self.words), len(self.words) + len(missing))
            self.words = np.insert(self.words, place[missing], keys[missing])
            self.numbers = np.insert(self.numbers, place[missing], found_rows[missing])
            self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(sizes)))
            self.values = np.concatenate((self.values, np.fromiter(chain.from_iterable(found), np.int32, sizes.sum())))
        slot = keys & np.uint64(self.SLOTS - 1)
        self.slot_row[slot] = found_rows
        # Of words that share a slot the last stays in both arrays.
        self.slot_word[slot] = keys
        rows[open_] = found_rows[back]
        sizes = self.start[rows + 1] - self.start[rows]
        return self.values[spread(self.start[rows], sizes)], sizes

    def _slotted(self, words: np.ndarray) -> np.ndarray:
        """Rows of the words that stand in their slots, found without sorting; -1 for the others."""
        if not len(self.slot_word):
            self.slot_word, self.slot_row = np.zeros(self.SLOTS, np.uint64), np.full(self.SLOTS, -1, np.int32)
        slot = words & np.uint64(self.SLOTS - 1)
        return np.where(self.slot_word[slot] == words, self.slot_row[slot], -1).astype(np.int64)


def spread(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions ``start[i] .. start[i] + sizes[i] - 1``, end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + sizes, sizes)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc_mod(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``: the fixed folds."""
    return F.crc32(F.col(column).cast("string")) % modulus
