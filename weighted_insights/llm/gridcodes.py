"""Vector codes by product quantisation, with nearest entries looked up in memoised grid cells.

Components become integers and a vector is cut into equal parts; each part position has a codebook, refined by rounds of
assignment and means in whole numbers, so that every result is exact and depends on no order.  The nearest entry of a
part is found through the coarse grid cell that the part lies in: the first part that falls into a cell leaves the entries that are
not dominated across the cell's box (an entry is, if its least distance to the box exceeds the largest distance of some other
one), and every part of that cell is compared with these alone, exactly.

Rounds are scans with map-side sums; what reaches the driver is the codebooks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import settle
from .text import mix, prepare

_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Factor from numbers to integers, parts of a vector, entries of a codebook, rounds, and the grid.

    ``splits`` is the number of cells that the range of a codebook's components is cut into per component; cells go on
    beyond the range.  ``most`` bounds the cells that a task remembers per part; then it begins anew.
    """

    factor: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    splits: int = 6
    most: int = 50_000

    def __post_init__(self) -> None:
        if not 1 <= self.entries <= 256:
            raise ValueError("an index has two hex digits: 1 to 256 entries")


class GridMemo:
    """The nearest entry of one codebook (``entries``: one row of integers each)."""

    def __init__(self, entries: np.ndarray, splits: int = 6, most: int = 50_000):
        self.entries, self.most = entries, most
        span = int(entries.max() - entries.min()) if entries.size else 0
        self.step = max(1, span // splits)
        self._clear()

    def _clear(self) -> None:
        self.at: dict[int, int] = {}
        self._reserve(1024)

    def _reserve(self, n: int) -> None:
        """Room for ``n`` cells; those that are known stay."""
        cells, near = np.zeros((n, self.entries.shape[1]), np.int64), np.zeros((n, len(self.entries)), bool)
        if self.at:
            cells[: len(self.at)], near[: len(self.at)] = self.cells[: len(self.at)], self.near[: len(self.at)]
        self.cells, self.near = cells, near

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """Per cell, which entries no other one dominates across its box."""
        low = (cells * self.step)[:, None, :]
        high = low + (self.step - 1)
        below, above = low - self.entries, self.entries - high
        gap = np.maximum(np.maximum(below, above), 0)
        # The farthest corner of the box, component by component.
        reach = np.maximum(-below, -above)
        least, most = (gap * gap).sum(2), (reach * reach).sum(2)
        return least <= most.min(1)[:, None]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index (of equally near ones the lowest) and squared distance for each row of integers."""
        cells = parts // self.step
        key = np.zeros(len(cells), np.uint64)
        for column in cells.T:
            key = mix(key * _STEP ^ column.astype(np.uint64))
        keys, first, back = np.unique(key, return_index=True, return_inverse=True)
        if len(self.at) + len(keys) > self.most:
            self._clear()
        found = np.fromiter((self.at.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(found < 0)
        if len(new):
            end = len(self.at) + len(new)
            if end > len(self.cells):
                self._reserve(2 * end)
            found[new] = np.arange(len(self.at), end)
            fresh = cells[first[new]]
            self.cells[len(self.at) : end], self.near[len(self.at) : end] = fresh, self.candidates(fresh)
            self.at.update(zip(keys[new].tolist(), found[new].tolist()))
        cell = found[back]
        near = self.near[cell]
        # Two cells of one hash: a part of the other one is compared with all entries.
        near[(self.cells[cell] != cells).any(1)] = True
        row, entry = np.nonzero(near)
        off = parts[row] - self.entries[entry]
        distance = np.full(near.shape, np.iinfo(np.int64).max)
        distance[row, entry] = (off * off).sum(1)
        best = distance.argmin(1)
        return best, distance[np.arange(len(best)), best]


def largest(width: int) -> int:
    """Integers beyond this count as it, so that every squared distance of ``width`` components fits 64 bits."""
    return math.isqrt((1 << 60) // max(width, 1))


def integers(batch: pa.RecordBatch, width: int, factor: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of ``embedding`` are kept, and these as integers, with zeros up to ``width``."""
    column = batch.column("embedding")
    sizes = np.diff(column.offsets.to_numpy())
    numbers = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: NaN
    # A null row has no components in the flat array, whatever its offsets say.
    present = ~column.is_null().to_numpy(zero_copy_only=False)
    sizes = np.where(present, sizes, 0)
    row = np.repeat(np.arange(len(sizes)), sizes)
    kept = present & (np.bincount(row[~np.isfinite(numbers)], minlength=len(sizes)) == 0)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = np.zeros((len(sizes), width), np.int64)
    used = kept[row]
    most = largest(width)
    whole[row[used], place[used]] = np.floor(np.clip(numbers[used] * factor, -most, most)).astype(np.int64)
    return kept, whole[kept]


def usable():
    """Whether a vector is there and all of its components are finite numbers."""
    return F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))


def first_codebooks(vectors: DataFrame, settings: Settings) -> np.ndarray | None:
    """``parts x entries x width`` integers: the parts of the rows of smallest id (null ids last, equal ids by vector)."""
    kept = vectors.select("vec_id", "embedding").where(usable())
    order = F.col("vec_id").asc_nulls_last()
    # Ids first: of every task only as many ids as there are entries reach the driver, then the rows that have them.
    ids = [r["vec_id"] for r in kept.select("vec_id").orderBy(order).limit(settings.entries).collect()]
    if not ids:
        return None
    chosen = F.col("vec_id").isin([i for i in ids if i is not None])
    chosen = chosen | F.col("vec_id").isNull() if None in ids else chosen
    rows = kept.where(chosen).orderBy(order, "embedding").limit(settings.entries).collect()
    longest = kept.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    width = max(1, -(-longest // settings.parts)) * settings.parts
    table = pa.RecordBatch.from_arrays([pa.array([r["embedding"] for r in rows], pa.list_(pa.float64()))], ["embedding"])
    return np.ascontiguousarray(integers(table, width, settings.factor)[1].reshape(len(rows), settings.parts, -1).transpose(1, 0, 2))


def coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, settings: Settings):
    """Per batch: which rows are kept, and the parts, indexes and squared distances of these (rows x parts)."""
    parts, _, width = books.shape
    memos = [GridMemo(book, settings.splits, settings.most) for book in books]
    for batch in batches:
        kept, whole = integers(batch, parts * width, settings.factor)
        whole = whole.reshape(len(whole), parts, width)
        found = [memo.nearest(whole[:, i]) for i, memo in enumerate(memos)]
        yield batch, kept, whole, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def refined(vectors: DataFrame, books: np.ndarray, settings: Settings) -> np.ndarray:
    """The codebooks after one round: entries are the whole-number means of their parts, unused ones stay."""

    def run(batches):
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for _, _, whole, index, _ in coded(batches, books, settings):
            for part, entry in zip(*np.nonzero(np.stack([np.bincount(index[:, p], minlength=books.shape[1]) for p in range(len(books))]))):
                mine = index[:, part] == entry
                sums[part, entry] += whole[mine, part].sum(0)
                counts[part, entry] += mine.sum()
        part, entry = np.nonzero(counts)
        if len(part):
            columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()), pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

    partial = vectors.select("embedding").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    # The means of all entries: as many rows as the codebooks have numbers, whatever the table.
    spread = partial.select("part", "entry", "n", F.posexplode("sums").alias("place", "s"))
    total = F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    out = books.copy()
    for r in spread.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), total).collect():
        out[r["part"], r["entry"], r["place"]] = int(r["s"]) // r["n"]
    return out


def fit_codebooks(vectors: DataFrame, settings: Settings = Settings()) -> np.ndarray | None:
    """``parts x entries x width`` integers after all rounds; None without a usable vector."""
    prepare(vectors.sparkSession)
    books = first_codebooks(vectors, settings)
    for _ in range(settings.rounds if books is not None else 0):
        books = refined(vectors, books, settings)
    return books


def encode(vectors: DataFrame, books: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, label, code, error`` of every usable row: indexes in part order (two hex digits each), squared distance."""
    prepare(vectors.sparkSession)

    def run(batches):
        for batch, kept, _, index, distance in coded(batches, books, settings):
            held = pa.array(kept)
            text, width = index.astype(np.uint8).tobytes().hex(), 2 * index.shape[1]
            codes = [text[i : i + width] for i in range(0, len(text), width)]
            arrays = [batch.column(c).filter(held).cast(pa.int64()) for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(codes, pa.string()), pa.array(distance.sum(1), pa.int64())], ["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "embedding").mapInArrow(run, "vec_id long, label long, code string, error long")


def digest(books: np.ndarray) -> str:
    """The hash of all integers by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


#: A label with more than this share of the rows counts as heavy; there are fewer heavy labels than its inverse.
HEAVY = 1000


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add the errors summed over rows of equal label (null ones together).

    Labels of more than a thousandth of the rows, of which there are fewer than a thousand, are broadcast; the rest has
    no group that could burden a task of the join.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    sums = settle(codes.groupBy("label").agg(total.alias("label_error"), F.count("*").alias("n")), "label-errors")
    rows = codes.count()
    named = sums.withColumnRenamed("label", "of")
    heavy = F.broadcast(named.where(F.col("n") * HEAVY > rows).drop("n"))
    light = named.where(F.col("n") * HEAVY <= rows).drop("n")
    same = codes["label"].eqNullSafe(named["of"])
    rest = codes.join(heavy.select("of"), same, "left_anti")
    return codes.join(heavy, same).drop("of").unionByName(rest.join(light, same).drop("of"))


def compress_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per usable vector: ``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    Columns read: ``vec_id``, ``label``, ``embedding``.  Rows whose vector is null or holds null or non-finite numbers are left
    out, as the codes have no value for them.  Vectors are padded with zeros to the longest width of the table, rounded up
    to a multiple of the parts; an empty vector is all zeros.  Integers beyond ``largest(width)`` (1.3e8 at 64 components) count as
    it.  Fewer rows than entries give smaller codebooks.  Repeated rows and ids are rows of their own; null ids come last
    when the first entries are chosen and stay null.  An empty table, or one without a usable vector, gives no row.
    """
    books = fit_codebooks(vectors, settings)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    made = with_label_error(settle(encode(vectors, books, settings), "codes"))
    return made.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def sql(settings: Settings = Settings()) -> str:
    """The same rows in SQL, for vectors of one width that the parts divide: a step per round."""
    parts, rounds = settings.parts, settings.rounds
    assigned = """
  SELECT id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT id, part, entry, sum((q - c) * (q - c)) AS d FROM numbers JOIN book{0} USING (part, place) GROUP BY id, part, entry)
  GROUP BY id, part"""
    steps = []
    for i in range(rounds):
        steps.append(f"near{i} AS MATERIALIZED ({assigned.format(i)})")
        steps.append(f"""mean{i} AS (
  SELECT part, entry, place, CAST(floor(sum(q) / count(*)) AS BIGINT) AS c FROM numbers JOIN near{i} USING (id, part) GROUP BY part, entry, place)""")
        steps.append(f"""book{i + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN mean{i} m USING (part, entry, place))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbers AS MATERIALIZED (
  SELECT id, (pos - 1) * {parts} // width AS part, (pos - 1) % (width // {parts}) AS place, q FROM (
    SELECT id, len(embedding) AS width, generate_subscripts(embedding, 1) AS pos,
           unnest(list_transform(embedding, lambda x: CAST(floor({settings.factor} * CAST(x AS DOUBLE)) AS BIGINT))) AS q FROM kept)),
book0 AS MATERIALIZED (SELECT part, id - 1 AS entry, place, q AS c FROM numbers WHERE id <= {settings.entries}),
{", ".join(steps)},
near{rounds} AS MATERIALIZED ({assigned.format(rounds)}),
codes AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY id),
digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (id), digest
"""
