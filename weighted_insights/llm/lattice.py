"""Near-duplicate vectors by lattice hashing.

In every table, random projections take a vector to a few blocks of eight numbers, and each block is
decoded to its nearest point of the lattice E8; the points together are the vector's cell.  A vector is
filed under its own cell and looks into the cells next to it, those across the nearest walls first.
Vectors that meet are compared by cosine.

Equal vectors are one class.  Cells are compared in blocks of bounded size, and what leaves a block is
one row per vector and link of a spanning forest, not the pairs.  A pair that meets in several cells
counts in the first one only, which both vectors can tell from their own cells.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import scratch, settle
from .components import components
from .text import mix, prepare

#: Members of a cell, and vectors looking into it, that are compared at once.
BLOCK = 512
#: Pairs whose cosines are computed at once.
PAIRS = 32_768


@dataclass(frozen=True)
class Lattice:
    """Tables, E8 blocks per cell, size of the projections, and cells looked into per block besides the own one."""

    tables: int = 6
    blocks: int = 2
    scale: float = 0.6
    probes: int = 4
    seed: int = 7


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum (D8)."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(-1).astype(np.int64) & 1)
    gap = (x - near)[odd]
    worst = np.abs(gap).argmax(-1)
    near[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of every row: of the even integer points or those moved by one half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(-1) <= ((x - half) ** 2).sum(-1)
    return np.where(closer[:, None], whole, half)


@lru_cache(maxsize=1)
def shortest_vectors() -> np.ndarray:
    """The 240 steps from an E8 point to its nearest neighbours."""
    steps = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1, -1), repeat=2):
            step = np.zeros(8)
            step[i], step[j] = s, t
            steps.append(step)
    steps += [np.array(signs) for signs in product((0.5, -0.5), repeat=8) if np.prod(signs) > 0]
    return np.stack(steps)


@lru_cache(maxsize=8)
def projections(width: int, lattice: Lattice) -> np.ndarray:
    """One ``width`` x 8 matrix per table and block, the same in every process."""
    random = np.random.Generator(np.random.PCG64([lattice.seed, width]))
    return random.standard_normal((lattice.tables, lattice.blocks, width, 8)) * lattice.scale


def _hash_points(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hash of lattice points; doubled coordinates are integers."""
    coordinates = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    code = np.full(points.shape[:-1], salt + 1, np.uint64)
    for k in range(8):
        code = mix(code * np.uint64(31) + coordinates[..., k])
    return code


def cells(vectors: np.ndarray, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """Own cell per table (n x tables), and all cells looked into per table, the own one first (n x tables x looks)."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    matrices, steps = projections(vectors.shape[1], lattice), shortest_vectors()
    n = len(vectors)
    looks = 1 + lattice.blocks * lattice.probes
    out = np.zeros((n, lattice.tables, looks), np.uint64)
    for t in range(lattice.tables):
        own, beside = [], []
        for k in range(lattice.blocks):
            x = unit @ matrices[t, k]
            point = nearest_e8(x)
            toward = np.argsort(-((x - point) @ steps.T), axis=1, kind="stable")[:, : lattice.probes]
            own.append(_hash_points(point, 2 * t + 1000 * k))
            beside.append(_hash_points(point[:, None, :] + steps[toward], 2 * t + 1000 * k))
        whole = np.zeros(n, np.uint64)
        for code in own:
            whole = whole + code
        out[:, t, 0] = mix(whole)
        for k in range(lattice.blocks):
            at = 1 + k * lattice.probes
            out[:, t, at : at + lattice.probes] = mix((whole - own[k])[:, None] + beside[k])
    return out[:, :, 0], out


def _vectors(column: pa.Array) -> np.ndarray:
    """Equal-width float64 vectors from their bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def prepare_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, digest, vector``: the digest names label and vector; null for what links with nothing."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches):
        for batch in batches:
            digests, packed = [], []
            column = batch.column("embedding")
            for vec_id, label, values in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), column):
                kept = None
                if vec_id is not None and label is not None and values.is_valid and len(values.values) and not values.values.null_count:
                    vector = values.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
                    if np.isfinite(vector).all() and 0 < np.linalg.norm(vector) < np.inf:
                        kept = vector.tobytes()
                packed.append(kept)
                digests.append(None if kept is None else hashlib.blake2b(kept + label.to_bytes(8, "little", signed=True), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())],
                ["vec_id", "label", "digest", "vector"],
            )

    return rows.mapInArrow(run, "vec_id long, label long, digest binary, vector binary")


def _looks(classes: DataFrame, lattice: Lattice) -> DataFrame:
    """``key, rep, tab, home``: one row per class and table for its own cell, and one for every cell it looks into."""

    def run(batches):
        for batch in batches:
            widths = np.array([len(v) for v in batch.column("vector").to_pylist()])
            reps, labels = batch.column("rep").to_numpy(), batch.column("label").to_numpy().astype(np.uint64)
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                own, looks = cells(_vectors(batch.column("vector").take(pa.array(at))), lattice)
                # Only equal labels, widths and tables share a key.
                salt = mix(labels[at, None] * np.uint64(64) + np.arange(lattice.tables, dtype=np.uint64) + np.uint64(width << 20))
                homes, probes = mix(own ^ salt), mix(looks ^ salt[:, :, None])
                keys = np.concatenate([homes.ravel(), probes.ravel()]).view(np.int64)
                rep = np.concatenate([np.repeat(reps[at], lattice.tables), np.repeat(reps[at], probes[0].size)])
                tables = np.arange(lattice.tables, dtype=np.int32)
                tab = np.concatenate([np.tile(tables, len(at)), np.tile(np.repeat(tables, probes.shape[2]), len(at))])
                home = np.arange(len(keys)) < homes.size
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(rep), pa.array(tab), pa.array(home)], ["key", "rep", "tab", "home"])

    return classes.select("rep", "label", "vector").mapInArrow(run, "key long, rep long, tab int, home boolean")


def _first_meeting(own_a, looks_a, own_b, looks_b, swap: np.ndarray) -> np.ndarray:
    """Number of the first place where each pair meets: twice the table, one more if only the larger id looks.

    ``swap``: whether ``a`` has the larger id.
    """
    hit_ab = (looks_a == own_b[:, :, None]).any(2)
    hit_ba = (looks_b == own_a[:, :, None]).any(2)
    low, high = np.where(swap[:, None], hit_ba, hit_ab), np.where(swap[:, None], hit_ab, hit_ba)
    order = np.stack([low, high], axis=2).reshape(len(swap), 2 * low.shape[1])
    return order.argmax(1)


class _Forest:
    """Union-find over the few vectors of a block."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while self.parent.setdefault(x, x) != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _compare(table: pa.Table, lattice: Lattice, threshold: float) -> pa.RecordBatch:
    """Links of the whole groups in a sorted table: rows ``rep, links, other``."""
    group = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
    new = np.concatenate(([True], (group[:, 1:] != group[:, :-1]).any(0)))
    number = np.cumsum(new) - 1
    home = table.column("home").to_numpy(zero_copy_only=False)
    reps, sizes = table.column("rep").to_numpy(), table.column("n").to_numpy()
    packed = table.column("vector").combine_chunks()
    unique, first, back = np.unique(reps, return_index=True, return_inverse=True)
    vectors = _vectors(packed.take(pa.array(first)))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    own, looks = cells(vectors, lattice)
    table_of = table.column("tab").to_numpy()

    homes, seekers = np.flatnonzero(home), np.flatnonzero(~home)
    # Every seeker meets the run of homes of its group.
    low, high = np.searchsorted(number[homes], number[seekers], "left"), np.searchsorted(number[homes], number[seekers], "right")
    counts = high - low
    links: dict[int, int] = {}
    forest, edges = _Forest(), []
    start = 0
    while start < len(seekers):
        stop = start + max(1, int(np.searchsorted(np.cumsum(counts[start:]), PAIRS, "right")))
        c = counts[start:stop]
        a = np.repeat(seekers[start:stop], c)
        offset = np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c)
        b = homes[np.repeat(low[start:stop], c) + offset]
        start = stop
        ua, ub = back[a], back[b]
        kept = ua != ub
        a, ua, ub = a[kept], ua[kept], ub[kept]
        close = np.einsum("ij,ij->i", unit[ua], unit[ub]) >= threshold
        a, ua, ub = a[close], ua[close], ub[close]
        swap = unique[ua] > unique[ub]
        counted = _first_meeting(own[ua], looks[ua], own[ub], looks[ub], swap) == 2 * table_of[a] + swap
        for x, y in zip(ua[counted].tolist(), ub[counted].tolist()):
            links[x] = links.get(x, 0) + int(sizes[first[y]])
            links[y] = links.get(y, 0) + int(sizes[first[x]])
            if forest.join(x, y):
                edges.append((x, y))
    rep = [unique[x] for x in links] + [unique[x] for x, _ in edges]
    count = [*links.values(), *[0] * len(edges)]
    other = [None] * len(links) + [int(unique[y]) for _, y in edges]
    return pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(count, pa.int64()), pa.array(other, pa.int64())], ["rep", "links", "other"])


def class_links(classes: DataFrame, threshold: float, lattice: Lattice, block: int = BLOCK) -> DataFrame:
    """``rep, links, other``: counts to add up per class, and links that connect what is linked."""
    looks = settle(_looks(classes, lattice), "looks")
    # Cells that someone other than their only member looks into.
    busy = (
        looks.groupBy("key")
        .agg(F.count(F.when(F.col("home"), 1)).alias("homes"), F.count(F.when(~F.col("home"), 1)).alias("seekers"))
        .where("homes > 0 and seekers > 0 and homes + seekers > 2")
        .select("key", F.ceil(F.col("homes") / block).cast("int").alias("across"), F.ceil(F.col("seekers") / block).cast("int").alias("down"))
    )
    chunk = F.xxhash64("rep", F.lit("chunk"))
    # A member goes to its chunk of members and every chunk of seekers; a seeker the other way round.
    placed = looks.join(busy, "key").select(
        "key", "rep", "tab", "home",
        F.when(F.col("home"), F.pmod(chunk, "across")).alias("own_i"), F.when(~F.col("home"), F.pmod(chunk, "down")).alias("own_j"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("home"), F.col("down")).otherwise(F.col("across")) - 1)).alias("k"),
    )
    placed = placed.select("key", F.coalesce("own_i", "k").cast("int").alias("i"), F.coalesce("own_j", "k").cast("int").alias("j"), "rep", "tab", "home")
    full = placed.join(classes.select("rep", "n", "vector"), "rep")
    parts = int(full.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = full.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            if table.num_rows < 4 * block:
                continue
            group = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
            starts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(0)) + 1
            if len(starts):
                cut = int(starts[-1])
                yield compare(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield compare(pa.Table.from_batches(held))

    def compare(table: pa.Table) -> pa.RecordBatch:
        # All vectors of a key have one width.
        widths = np.array([len(v) for v in table.column("vector").to_pylist()])
        found = [_compare(table.filter(pa.array(widths == w)), lattice, threshold) for w in np.unique(widths)]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([f.column(c) for f in found]) for c in range(3)], ["rep", "links", "other"])

    return rows.mapInArrow(run, "rep long, links long, other long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, lattice: Lattice = Lattice()) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``, ``class_id``, ``class_size``.

    Columns read: ``vec_id``, ``label``, ``embedding``.  Only vectors of equal label and width are compared.  Vectors
    that are null, empty, zero or hold null or non-finite numbers, and rows with a null label or id, link with nothing;
    their component is their own id.  Equal vectors link with each other; a repeated row is one more copy.  An empty
    table gives no row.
    """
    prepared = settle(prepare_vectors(vectors), "vectors")
    classes = settle(
        prepared.where(F.col("digest").isNotNull())
        .groupBy("digest", "label")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")),
        "classes",
    )
    with scratch():
        found = settle(class_links(classes, threshold, lattice), "class-links", keep=True)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    with scratch():
        groups = settle(components(found.where("other is not null"), "rep", "other"), "groups", keep=True).withColumnRenamed("id", "rep")
    known = (
        classes.select("digest", "rep", "n")
        .join(counts, "rep", "left")
        .join(groups, "rep", "left")
        .select(
            "digest",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
            F.col("rep").alias("class_id"),
            F.col("n").alias("class_size"),
        )
    )
    out = prepared.select("vec_id", "digest").join(known, "digest", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
        F.coalesce("class_id", "vec_id").alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )
