"""Weighted k-means for many values of k and many restarts at once.

An elbow sweep fits one model per k and restart.  Fitted one after the other, each
would scan the data once per iteration; here every scan advances all of them.
Spark partitions the rows and adds up the partial sums; inside a task the
distances of a few thousand rows to all centres are one matrix product.  Vectors travel
as their non-zero entries.  Random draws depend on the row, not on where it lies.  The
driver holds the centres only.

Seeding is greedy k-means++: of several drawn rows the one that lowers the cost most becomes a centre.  A centre that no
row chooses moves to the row that is farthest from its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from ..storage import settle
from .merging import reduced

T = TypeVar("T")

#: Coordinates that a task holds at once.
MOST_HELD = 50_000
#: Rows that a part is made for, and the number of parts up to which a table is dealt out.
PART_ROWS = 1 << 14
MOST_PARTS = 512


@dataclass
class Trial:
    """One restart for one k: its centres, one per row, and its weighted inertia."""

    k: int
    attempt: int
    centres: np.ndarray
    inertia: float = float("inf")


@dataclass
class Block:
    """Some rows: the non-zero entries of their vectors end to end, weights and keys."""

    counts: np.ndarray
    at: np.ndarray
    x: np.ndarray
    w: np.ndarray
    key: np.ndarray


def read_blocks(vectors: DataFrame, weight: str, features: str, row_id: str | None, n: int) -> RDD:
    """The rows with a weight as persisted blocks, made from a settled table, so that a lost one is read again."""
    ship_package(vectors.sparkSession)
    v = vector_to_array(features)
    entries = F.filter(F.transform(v, lambda x, i: F.struct(i.alias("at"), x.alias("x"))), lambda e: e["x"] != 0)
    rows = vectors.select(entries.alias("e"), F.col(weight).cast("double").alias("w"), F.xxhash64(row_id or v).alias("key"))
    rows = _spread(rows.where("w > 0").select("e.at", "e.x", "w", "key"), n, row_id is not None)

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            places, numbers = part.column("at"), part.column("x")
            arrays = (
                np.diff(places.offsets.to_numpy()).astype(np.int32),
                places.flatten().to_numpy().astype(np.int32),
                numbers.flatten().to_numpy(),
                part.column("w").to_numpy(),
                part.column("key").to_numpy(),
            )
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], names)

    names = ["counts", "at", "x", "w", "key"]
    kinds = (np.int32, np.int32, np.float64, np.float64, np.int64)
    packed = settle(rows.mapInArrow(pack, ", ".join(f"{name} binary" for name in names)), "vectors")
    return packed.rdd.map(lambda row: Block(*(np.frombuffer(raw, kind) for raw, kind in zip(row, kinds)))).persist(StorageLevel.MEMORY_AND_DISK)


def _batches(blocks: Iterator[Block], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Vectors (one per row), weights and row keys of a bounded number of rows at a time."""
    step = max(1, MOST_HELD // max(width, 1))
    for block in blocks:
        ends = np.concatenate(([0], np.cumsum(block.counts, dtype=np.int64)))
        for start in range(0, len(block.w), step):
            stop = min(start + step, len(block.w))
            inside = slice(ends[start], ends[stop])
            dense = np.zeros((stop - start, width))
            dense[np.repeat(np.arange(stop - start), block.counts[start:stop]), block.at[inside]] = block.x[inside]
            yield dense, block.w[start:stop], block.key[start:stop]


def _over(blocks: RDD, measure: Callable[[Iterator[Block]], T], merge: Callable[[T, T], T]) -> T:
    """One value per partition, merged by executors."""
    return reduced(blocks.mapPartitions(lambda held: [measure(held)]), merge)


def _exponential(keys: np.ndarray, salt: int) -> np.ndarray:
    """A draw from the exponential distribution for every row, the same wherever the row lies."""
    x = keys.view(np.uint64) ^ np.uint64(salt)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return -np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53)


def _salt(*parts: int) -> int:
    return int.from_bytes(hashlib.blake2b("|".join(map(str, parts)).encode(), digest_size=8).digest(), "little")


def _squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every centre."""
    # Stored by centres, so that the nearest one is found by comparing whole rows of numbers.
    out = centres @ x.T
    out *= -2
    out += np.einsum("ij,ij->i", x, x)
    out += np.einsum("ij,ij->i", centres, centres)[:, None]
    return np.maximum(out, 0.0, out=out).T


def _offsets(trials: Sequence[Trial]) -> np.ndarray:
    return np.cumsum([0] + [len(t.centres) for t in trials])


def _candidates(k: int, step: int) -> int:
    """Rows drawn for the next centre; the first one is drawn alone."""
    return 2 + int(np.log(k)) if step else 1


def _draw_centres(rows: RDD, trials: Sequence[Trial], seed: int, step: int) -> None:
    """Give every trial one more centre: of several drawn rows, the one that leaves the lowest cost."""
    drawn = _drawn(rows, trials, seed, step)
    several = [i for i, found in drawn.items() if len(found) > 1]
    costs = _costs(rows, {i: (trials[i].centres, drawn[i]) for i in several}) if several else {}
    for i, found in drawn.items():
        chosen = found[int(np.argmin(costs[i])) if i in costs else 0]
        trials[i].centres = np.vstack([trials[i].centres, chosen[None, :]])


def _drawn(blocks: RDD, trials: Sequence[Trial], seed: int, step: int) -> dict[int, np.ndarray]:
    """Rows drawn with probability w * (squared distance to the trial's centres), some per trial.

    A draw is the row of smallest ``exponential / mass``, which can be found per task and then among the tasks'
    winners; with no centre yet the mass is w.
    """
    width = trials[0].centres.shape[1]
    salts = [[_salt(seed, step, t.k, t.attempt, c) for c in range(_candidates(t.k, step))] for t in trials]
    places = [t.centres for t in trials]

    def winners(held: Iterator[Block]) -> dict[tuple[int, int], tuple[float, np.ndarray]]:
        best: dict[tuple[int, int], tuple[float, np.ndarray]] = {}
        for x, w, keys in _batches(held, width):
            for i, chosen in enumerate(places):
                mass = w * _squared_distances(x, chosen).min(1) if len(chosen) else w
                for c, salt in enumerate(salts[i]):
                    with np.errstate(divide="ignore"):
                        key = np.where(mass > 0, _exponential(keys, salt) / mass, np.inf)
                    at = int(key.argmin())
                    if key[at] < best.get((i, c), (np.inf,))[0]:
                        best[i, c] = (float(key[at]), x[at].copy())
        return best

    def merge(one: dict, two: dict) -> dict:
        return one | {draw: found for draw, found in two.items() if draw not in one or found[0] < one[draw][0]}

    out: dict[int, list] = {}
    for (i, _), (_, vector) in sorted(_over(blocks, winners, merge).items(), key=lambda found: found[0]):
        out.setdefault(i, []).append(vector)
    return {i: np.array(vectors) for i, vectors in out.items()}


def _costs(blocks: RDD, offers: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, np.ndarray]:
    """Per trial, the weighted cost with each of its candidates (second) added to its centres (first)."""
    width = next(iter(offers.values()))[0].shape[1]

    def run(held: Iterator[Block]) -> dict[int, np.ndarray]:
        costs = {i: np.zeros(len(drawn)) for i, (_, drawn) in offers.items()}
        for x, w, _ in _batches(held, width):
            for i, (centres, drawn) in offers.items():
                now = _squared_distances(x, centres).min(1)[:, None]
                costs[i] += w @ np.minimum(_squared_distances(x, drawn), now)
        return costs

    return _over(blocks, run, lambda one, two: {i: one[i] + two[i] for i in one})


Far = tuple[float, bytes, int, float]  # less its distance, vector, centre, weight


def _farthest(blocks: RDD, trials: Sequence[Trial], wanted: Sequence[int]) -> list[list[tuple[int, float, np.ndarray]]]:
    """Per trial the ``wanted`` different rows that are farthest from their centre: ``(centre, weight, vector)``, farthest first.

    Every task keeps as many as are wanted; so do the tasks together.
    """
    width, places = trials[0].centres.shape[1], [t.centres for t in trials]

    def kept(rows: Iterable[Far], n: int) -> list[Far]:
        # Equal rows count once, whatever their number.
        different: dict[bytes, Far] = {}
        for row in sorted(rows):
            different.setdefault(row[1], row)
            if len(different) == n:
                break
        return list(different.values())

    def run(held: Iterator[Block]) -> list[list[Far]]:
        out: list[list[Far]] = [[] for _ in wanted]
        for x, w, _ in _batches(held, width):
            for i, centres in enumerate(places):
                distances = _squared_distances(x, centres)
                nearest = distances.argmin(1)
                far = distances[np.arange(len(x)), nearest]
                least = -out[i][-1][0] if len(out[i]) == wanted[i] else 0.0
                fresh: dict[bytes, Far] = {}
                some = np.flatnonzero(far > least)
                for at in some[np.argsort(-far[some], kind="stable")].tolist():
                    vector = x[at].tobytes()
                    fresh.setdefault(vector, (-float(far[at]), vector, int(nearest[at]), float(w[at])))
                    if len(fresh) == wanted[i]:
                        break
                out[i] = kept([*out[i], *fresh.values()], wanted[i])
        return out

    found = _over(blocks, run, lambda one, two: [kept([*a, *b], n) for a, b, n in zip(one, two, wanted)])
    return [[(centre, w, np.frombuffer(vector)) for _, vector, centre, w in rows] for rows in found]


def _moved(rows: RDD, trials: Sequence[Trial]) -> list[np.ndarray]:
    """The centres of every trial after one step: means of their rows, and far rows for those that have none."""
    found, offsets = _assign_and_sum(rows, trials), _offsets(trials)
    new, empty = [], []
    for trial, low in zip(trials, offsets):
        new.append(np.array([found[low + j][2] if low + j in found else c for j, c in enumerate(trial.centres)]))
        empty.append([j for j in range(len(trial.centres)) if low + j not in found])
    short = [i for i, places in enumerate(empty) if places]
    if short:
        for i, far in zip(short, _farthest(rows, [trials[i] for i in short], [len(empty[i]) for i in short])):
            for j, (source, w, vector) in zip(empty[i], far):
                # The row leaves the centre that it was with, unless it is all that this one has.
                whole = found[offsets[i] + source][0]
                if whole - w > 1e-12 * whole:
                    new[i][source] = (new[i][source] * whole - w * vector) / (whole - w)
                    found[offsets[i] + source] = (whole - w, *found[offsets[i] + source][1:])
                new[i][j] = vector
    return new


def _assign_and_sum(blocks: RDD, trials: Sequence[Trial]) -> dict[int, tuple[float, float, np.ndarray]]:
    """Per centre (numbered through all trials): assigned weight, weighted cost, weighted mean vector."""
    offsets, width = _offsets(trials), trials[0].centres.shape[1]
    centres = np.vstack([t.centres for t in trials])

    def partial_sums(held: Iterator[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sums, weights, costs = np.zeros_like(centres), np.zeros(len(centres)), np.zeros(len(centres))
        for x, w, _ in _batches(held, width):
            # Centres by rows: a trial's nearest centre is found by comparing whole rows of numbers.
            distances = _squared_distances(x, centres).T
            share = np.empty_like(distances)
            for low, high in zip(offsets[:-1], offsets[1:]):
                least = distances[low:high].min(0)
                nearest = distances[low:high] == least
                if np.count_nonzero(nearest) > len(w):
                    # The first of equals.
                    nearest &= np.cumsum(nearest, 0) == 1
                np.multiply(nearest, w, out=share[low:high])
                costs[low:high] += share[low:high] @ least
            sums += share @ x
            weights += share.sum(1)
        return sums, weights, costs

    sums, weights, costs = _over(blocks, partial_sums, lambda one, two: tuple(a + b for a, b in zip(one, two)))
    return {int(j): (float(weights[j]), float(costs[j]), sums[j] / weights[j]) for j in np.flatnonzero(weights > 0)}


def _spread(rows: DataFrame, n: int, by_key: bool) -> DataFrame:
    """Rows of a table that came in few parts, dealt to enough of them to keep a cluster busy; larger tables stay as they lie.

    Rows are dealt by their key, or in turn where equal rows share a key.
    """
    parts = min(MOST_PARTS, 1 + n // PART_ROWS)
    if rows.rdd.getNumPartitions() >= parts:
        return rows
    return rows.repartition(parts, "key") if by_key else rows.repartition(parts)


def still_shift(vectors: DataFrame, features: str, tol: float) -> tuple[float, int]:
    """Sum of squared centre moves that counts as standing still, ``tol`` times the mean variance of the features; and the rows."""
    summary = vectors.select(Summarizer.metrics("variance", "count").summary(F.col(features)).alias("s"))
    found = summary.select("s.variance", "s.count").first()
    sample_variance = float(np.mean(found["variance"].toArray()))
    return tol * sample_variance * (found["count"] - 1) / max(found["count"], 1), found["count"]


def fit_trials(
    vectors: DataFrame,
    ks: Sequence[int],
    restarts: int = 10,
    weight: str = "w",
    features: str = "features",
    seed: int = 42,
    max_iter: int = 300,
    tol: float = 1e-4,
    row_id: str | None = None,
) -> list[Trial]:
    """Every restart of every k, seeded by greedy k-means++ and iterated until the centres stop (see ``still_shift``).

    Draws are keyed by ``row_id``; without one by the vector itself, so that equal rows share a draw.
    """
    first = vectors.select(F.size(vector_to_array(features)).alias("n")).first()
    width = first["n"] if first else 0
    still_moving, n = still_shift(vectors, features, tol)
    rows = read_blocks(vectors, weight, features, row_id, n)
    trials = [Trial(k, attempt, np.empty((0, width))) for k in ks for attempt in range(restarts)]
    for step in range(max(ks)):
        _draw_centres(rows, [t for t in trials if t.k > step], seed, step)

    moving = list(trials)
    for _ in range(max_iter):
        if not moving:
            break
        still = []
        for trial, new in zip(moving, _moved(rows, moving)):
            shift = ((new - trial.centres) ** 2).sum()
            trial.centres = new
            if shift > still_moving:
                still.append(trial)
        moving = still

    found, offsets = _assign_and_sum(rows, trials), _offsets(trials)
    for trial, low in zip(trials, offsets):
        trial.inertia = sum(found[low + j][1] for j in range(len(trial.centres)) if low + j in found)
    rows.unpersist()
    return trials


def best_per_k(trials: Sequence[Trial]) -> dict[int, Trial]:
    """The restart of lowest inertia for every k."""
    best: dict[int, Trial] = {}
    for trial in trials:
        if trial.k not in best or trial.inertia < best[trial.k].inertia:
            best[trial.k] = trial
    return best
