"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its evidence is what it and its two neighbours look like; neighbouring
lines tend to share a label, and the chain learns how much.  Forward-backward gives every line its
probability of being good, and a document's score is their mean, weighted by line length.  Only
documents are labelled, so a line is taught with the label of its document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import BLANK, Texts, crc_mod, map_texts, mix, repeats, slices

#: Bounds of the labelled sample that the model is fitted on: documents, and first lines of each.
TRAIN_DOCUMENTS = 2000
TRAIN_LINES = 200
THRESHOLD = 0.7
SCHEMA = "doc_id long, score double, predicted int, n_lines long, n_bad_lines long"


def _bytes(chosen: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(chosen)] = True
    return flags


UPPER = _bytes(bytes(range(65, 91)))
LETTER = UPPER | _bytes(bytes(range(97, 123)))
DIGIT = _bytes(b"0123456789")
MARKS = _bytes(b"#*$%&<>@^~_=+\\{}[]")
PIPE = _bytes(b"|")
SHOUT = _bytes(b"!?")
STOPS = _bytes(b".,;:")
FOREIGN = np.arange(256) >= 0x80
OWN = 15
WIDTH = 3 * OWN + 1


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (own, line before, line after, position) and length of every line with a word, and lines per text.

    A text without words has one line without evidence.
    """
    read = Texts(texts)
    start, end, doc = read.lines
    first, last = np.searchsorted(read.word_start, start), np.searchsorted(read.word_start, end)
    # One line without words stands for a text that has none.
    empty = read.n_words == 0
    opening = np.diff(doc, prepend=-1) > 0
    kept = np.flatnonzero((last > first) | (empty[doc] & opening))
    start, end, doc, first, last = start[kept], end[kept], doc[kept], first[kept], last[kept]
    words = np.maximum(last - first, 1)

    def counted(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags[read.data])))
        return sums[end] - sums[start]

    line_of = np.repeat(np.arange(len(kept)), last - first)
    same_line = repeats(line_of, read.words)[1] if len(read.words) else np.zeros(0, bool)
    follows = np.zeros(len(read.words), bool)
    follows[1:] = (read.words[1:] == read.words[:-1]) & (line_of[1:] == line_of[:-1])
    copies, _ = repeats(doc, read.hashes(start, end))
    letters = np.maximum(counted(LETTER), 1)
    size = np.maximum(end - start, 1)
    filled = np.maximum(size - counted(BLANK), 1)
    own = np.stack(
        [
            last > first,
            np.log1p(last - first) / 4,
            counted(UPPER) / letters,
            np.minimum(counted(MARKS) / words, 3) / 3,
            np.minimum(counted(PIPE) / words, 1),
            np.minimum(counted(SHOUT) / words, 2) / 2,
            counted(DIGIT) / filled,
            counted(FOREIGN) / filled,
            np.minimum(counted(STOPS) / words, 2),
            filled / words / 10,
            np.bincount(line_of[same_line], minlength=len(kept)) / words,
            np.bincount(line_of[follows], minlength=len(kept)) / words,
            (copies > 1) & (last > first),
            UPPER[read.data[start]],
            STOPS[read.data[np.maximum(end - 1, start)]],
        ],
        axis=1,
    ).astype(np.float32)
    same = doc[1:] == doc[:-1] if len(doc) else np.zeros(0, bool)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    opens = np.ones(len(doc), np.float32)
    opens[1:] = ~same
    features = np.concatenate([own, before, after, opens[:, None]], axis=1)
    return features, size.astype(np.float64), np.bincount(doc, minlength=read.n)


@dataclass
class Model:
    """Weights of the evidence for a good line, and of the four (line, next line) label pairs."""

    weights: np.ndarray
    bias: float
    pairs: np.ndarray

    def evidence(self, features: np.ndarray) -> np.ndarray:
        return features @ self.weights + self.bias


def _steps(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Order of chains by falling length, their first lines in that order, and how many chains have a line t."""
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    longest = int(counts.max()) if len(counts) else 0
    falling = -counts[order]
    return order, starts, [int(np.searchsorted(falling, -t, side="left")) for t in range(longest)]


def forward_backward(evidence: np.ndarray, pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of ``good`` per line, expected label pairs (2 x 2), and the log partition sum over all chains.

    All chains advance together, one line at a time; messages are scaled, so long chains lose no precision.
    """
    _, starts, active = _steps(counts)
    local = np.stack([np.zeros(len(evidence)), evidence], axis=1)
    peak = local.max(1)
    local = np.exp(local - peak[:, None])
    top = pairs.max()
    step = np.exp(pairs - top)
    ahead, scale = np.zeros((len(evidence), 2)), np.ones(len(evidence))
    state = None
    for t, n in enumerate(active):
        at = starts[:n] + t
        state = local[at] if t == 0 else (state[:n] @ step) * local[at]
        scale[at] = state.sum(1)
        state = state / scale[at][:, None]
        ahead[at] = state
    back = np.ones((len(evidence), 2))
    expected = np.zeros((2, 2))
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        at, after = starts[:n] + t, starts[:n] + t + 1
        message = local[after] * back[after] / scale[after][:, None]
        back[at] = message @ step.T
        expected += step * (ahead[at].T @ message)
    log_sum = float(np.log(scale).sum() + peak.sum() + top * (len(evidence) - np.count_nonzero(counts)))
    return ahead[:, 1] * back[:, 1], expected, log_sum


def fit(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = 150, rate: float = 0.1, penalty: float = 1e-3) -> Model:
    """Maximum conditional likelihood by Adam; ``labels`` has one label per chain, taught to each of its lines.

    Pair weights are held to at most one, so that lines keep a say of their own.
    """
    line_labels = np.repeat(labels, counts)
    chain = np.repeat(np.arange(len(counts)), counts)
    same = chain[1:] == chain[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (line_labels[:-1][same], line_labels[1:][same]), 1)
    x = np.concatenate([features, np.ones((len(features), 1), features.dtype)], axis=1).astype(np.float64)
    w, pairs = np.zeros(x.shape[1]), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(pairs), np.zeros_like(pairs)]
    n = max(len(x), 1)
    for i in range(1, steps + 1):
        good, expected, _ = forward_backward(x @ w, pairs, counts)
        slopes = [x.T @ (line_labels - good) / n - penalty * w, (seen - expected) / n - penalty * pairs]
        for k, (target, slope) in enumerate(zip((w, pairs), slopes)):
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            target += rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8)
        np.clip(pairs, -1, 1, out=pairs)
    return Model(w[:-1].copy(), float(w[-1]), pairs)


def score_texts(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, lines and bad lines of every text."""
    features, size, counts = line_features(texts)
    good, _, _ = forward_backward(model.evidence(features), model.pairs, counts)
    doc = np.repeat(np.arange(len(texts)), counts)
    whole = np.bincount(doc, size, len(texts))
    score = np.clip(np.bincount(doc, size * good, len(texts)) / whole, 0, 1)
    return score, counts, np.bincount(doc[good < 0.5], minlength=len(texts))


#: Lines of a stretch that is drawn from a long document.
STRETCH = 20


def stretches(doc_id: int, count: int, most: int) -> list[tuple[int, int]]:
    """Ranges of lines of a document, all of them or as many stretches as ``most`` lines allow."""
    if count <= most:
        return [(0, count)]
    first = np.arange(0, count, STRETCH)
    drawn = np.argsort(mix(first.astype(np.uint64) ^ mix(np.array([doc_id], np.int64).view(np.uint64))), kind="stable")
    return [(a, min(a + STRETCH, count)) for a in np.sort(first[drawn[: max(1, most // STRETCH)]]).tolist()]


def train(docs: DataFrame, labels: DataFrame, most_documents: int = TRAIN_DOCUMENTS, most_lines: int = TRAIN_LINES) -> Model:
    """Fit on at most ``most_documents`` labelled documents (those of smallest id hash) and ``most_lines`` lines of each.

    Of a longer document, stretches of ``STRETCH`` lines are drawn by a hash of document and place over all of it; each is a chain
    of its own.  ``labels``: ``doc_id`` and ``quality`` (0 or 1).  Null labels and ids are left out; a document labelled twice takes
    the smaller label, and one of several rows of an id is taken.  With one class or no label at all, every line gets the share of good labels (one half without any).
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    chosen = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_documents)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def measured(batches):
        for batch, texts in slices(batches):
            features, _, counts = line_features(texts)
            ids, ends = batch.column("doc_id").to_pylist(), np.cumsum(counts)
            rows = [
                [features[end - count + a : end - count + b].astype("<f4").tobytes() for a, b in stretches(i, int(count), most_lines)]
                for i, end, count in zip(ids, ends, counts)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("quality").cast(pa.int32()), pa.array(rows, pa.list_(pa.binary()))],
                ["doc_id", "quality", "lines"],
            )

    found = map_texts(sample, measured, "doc_id long, quality int, lines array<binary>", ("doc_id", "text", "quality"))
    # At most most_documents x most_lines lines reach the driver.
    one_each = found.groupBy("doc_id").agg(F.min(F.struct("quality", "lines")).alias("of")).orderBy("doc_id")
    rows = [{"quality": r["quality"], "lines": part} for r in one_each.select("of.*").toArrow().to_pylist() for part in r["lines"]]
    quality = np.array([r["quality"] for r in rows], np.int64)
    if len(set(quality.tolist())) < 2:
        share = float(np.clip(quality.mean(), 0.01, 0.99)) if len(quality) else 0.5
        return Model(np.zeros(WIDTH), float(np.log(share / (1 - share))), np.zeros((2, 2)))
    parts = [np.frombuffer(r["lines"], "<f4").reshape(-1, WIDTH) for r in rows]
    return fit(np.concatenate(parts), np.array([len(p) for p in parts]), quality)


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``score`` (0 to 1), ``predicted``, ``n_lines``, ``n_bad_lines``.

    Lines without words are skipped; a null or empty text counts as one line without evidence.  Repeated rows are scored
    each on their own; a null ``doc_id`` stays null; an empty table gives no row; other columns are not read.
    """

    def run(batches):
        for batch, texts in slices(batches):
            score, lines, bad = score_texts(texts, model)
            arrays = [batch.column("doc_id").cast(pa.int64()), score, (score >= threshold).astype(np.int32), lines.astype(np.int64), bad.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["doc_id", "score", "predicted", "n_lines", "n_bad_lines"])

    return map_texts(docs, run, SCHEMA)


def keep_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more, with all their columns, in one pass."""

    def run(batches):
        for batch, texts in slices(batches):
            yield batch.filter(pa.array(score_texts(texts, model)[0] >= threshold))

    return map_texts(docs, run, docs.schema, tuple(docs.columns))


def quality_scores(docs: DataFrame, labels: DataFrame, fold: int = 4, held_out: int = 2) -> DataFrame:
    """Fit on the labels outside the held-out fold of ids and score all documents."""
    model = train(docs, labels.where(crc_mod("doc_id", fold) != held_out))
    scored = score_documents(docs, model)
    mine = F.coalesce(crc_mod("doc_id", fold) == held_out, F.lit(False))
    return scored.select("doc_id", mine.alias("held_out"), "score", "predicted", "n_lines", "n_bad_lines")
