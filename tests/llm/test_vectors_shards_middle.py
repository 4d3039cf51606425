"""Vector codes, byte shards and fill-in-the-middle against plain versions, and on odd input."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from weighted_insights.llm import gridcodes, middle, sharding

VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, id int, of int, n int"
DOCUMENTS = "doc_id long, text string, size string, shard string, at string, block int, output string, form int"


# Vector codes -----------------------------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """``rows``: (vec_id, vector, label).  All distances, one by one, in whole numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max([1, *(-(-len(r[1]) // parts) for r in kept)])
    numbers = [[math.floor(4096 * x) for x in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in numbers]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((x - c) ** 2 for x, c in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for v in cut:
                groups[nearest(v[p], books[p])[1]].append(v[p])
            books[p] = [tuple(sum(c) // len(groups[i]) for c in zip(*groups[i])) if i in groups else e for i, e in enumerate(books[p])]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    by_label = collections.Counter()
    for r, f in zip(kept, found):
        by_label[r[2]] += sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(r[0], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f), by_label[r[2]], sha) for r, f in zip(kept, found)]


def codes(table):
    return sorted((tuple(r) for r in gridcodes.compress_vectors(table).collect()), key=str)


def single(values):
    """As the table holds them: numbers of 32 bits."""
    return None if values is None else [None if v is None else float(np.float32(v)) for v in values]


@pytest.mark.parametrize("width", [8, 16, 24])
def test_codes_are_those_of_all_distances(spark, width):
    draw = random.Random(width)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = [(i, single([c + draw.gauss(0, 0.2) for c in draw.choice(centres)]), draw.choice([None, 1, 2])) for i in range(0, 900, 3)]
    rows += [(1000 + i, rows[7][1], 3) for i in range(150)]  # a third of all rows
    draw.shuffle(rows)
    table = spark.createDataFrame([(*r, "x", 1, 1, 1, 1) for r in rows], VECTORS).repartition(5)
    assert codes(table) == sorted(plain_codes(rows), key=str)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, None, 1), (1, [], 1), (2, [0.0] * 8, None), (3, [nan] * 8, 1), (4, [1.0, -inf], 1), (5, [None, 1.0], 1), (6, [-0.0001] * 8, None),
        (6, [0.5] * 9, 2), (6, [0.5] * 9, 2), (7, [100.0] * 16, 2), (None, [0.25] * 3, 1), (-5, [-3.5] * 8, 1),
    ]
    rows = [(i, single(v), label) for i, v, label in rows]
    table = spark.createDataFrame([(*r, "x", 1, 1, 1, 1) for r in rows], VECTORS).repartition(3)
    got = codes(table)
    assert got == sorted(plain_codes(rows), key=str) and len(got) == 8
    assert codes(table.limit(0)) == [] and codes(table.where("vec_id = 3")) == []
    huge = spark.createDataFrame([(1, [3e38] * 8, 1, "x", 1, 1, 1, 1), (2, [-3e38] * 8, 1, "x", 1, 1, 1, 1)], VECTORS)
    assert [r[2:4] for r in codes(huge)] == [(0, 0), (0, 0)]


def test_sums_of_single_entry_and_the_largest_distance():
    most = gridcodes.largest(8)
    memo = gridcodes.GridMemo(np.array([[most] * 8]), 4)
    index, distance = memo.nearest(np.array([[-most] * 8]))
    assert index[0] == 0 and distance[0] == 8 * (2 * most) ** 2 > 0


@pytest.mark.parametrize("splits", [1, 4, 9, 64])
def test_cells_never_lose_the_nearest_entry(splits):
    draw = np.random.default_rng(splits)
    for width in (1, 2, 8):
        entries = draw.integers(-40, 40, (16, width))
        entries[5] = entries[3]  # a tie goes to the lower index
        memo = gridcodes.GridMemo(entries, splits, most=50)
        for _ in range(5):
            parts = draw.integers(-90, 90, (200, width))
            index, distance = memo.nearest(parts)
            every = ((parts[:, None, :] - entries) ** 2).sum(2)
            assert (index == every.argmin(1)).all() and (distance == every.min(1)).all()
        assert len(memo.at) <= 200


def test_cells_leave_out_dominated_entries():
    memo = gridcodes.GridMemo(np.array([[0, 0], [1000, 0], [0, 1000], [1000, 1000]]), 8)
    assert memo.candidates(np.array([[0, 0], [7, 0]])).tolist() == [[True, False, False, False], [False, True, False, False]]


def test_hash_collision_of_cells(monkeypatch):
    monkeypatch.setattr(gridcodes, "mix", lambda x: x * np.uint64(0))
    entries = np.array([[0, 0], [100, 100], [50, 0]])
    parts = np.random.default_rng(1).integers(-20, 120, (300, 2))
    index, _ = gridcodes.GridMemo(entries, 6).nearest(parts)
    assert (index == ((parts[:, None, :] - entries) ** 2).sum(2).argmin(1)).all()


# Shards -----------------------------------------------------------------------------------------


def plain_shards(rows, shards=24):
    known = sorted((doc_id is not None, doc_id or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8, doc_id) for doc_id, t in rows)
    total, before, out, slots = sum(r[3] for r in known), 0, [], collections.Counter()
    for _, _, crc, size, doc_id in known:
        shard = min((2 * before + size) * shards // (2 * total), shards - 1)
        out.append((doc_id, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += size
    return sorted(out, key=str)


def shards_of(table, **settings):
    return sorted((tuple(r) for r in sharding.shard_documents(table, **settings).collect()), key=str)


def test_shards(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(i, "é漢x" * draw.randrange(200)) for i in range(2000)] + [(7, "copy" * 50)] * 900 + [(None, None), (3, ""), (3, None), (9, "w" * 40_000)]
    draw.shuffle(rows)
    table = spark.createDataFrame([(*r, "x", "x", "x", 1, "x", 1) for r in rows], DOCUMENTS).repartition(7)
    want = plain_shards(rows)
    assert shards_of(table) == want
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 100)
    assert shards_of(table) == want
    sums = collections.Counter()
    for r in want:
        sums[r[4]] += r[1]
    target = sum(sums.values()) / 24
    assert len(sums) == 24 and all(abs(s - target) <= 40_008 for s in sums.values())
    assert shards_of(table, shards=1) == plain_shards(rows, 1)
    assert shards_of(table, shards=5000) == plain_shards(rows, 5000)


def test_shards_of_little(spark):
    table = spark.createDataFrame([(1, None, "x", "x", "x", 1, "x", 1)], DOCUMENTS)
    assert shards_of(table) == [(1, 8, 0, "bytes", 12, 0, None)]
    assert shards_of(table.limit(0)) == []


def test_written_shards(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    back = sharding.write_shards(docs, str(tmp_path / "shards"), 5)
    assert sorted(map(tuple, back.select("document.*").collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    ranges = back.groupBy("shard").agg(F.min("document.doc_id").alias("low"), F.max("document.doc_id").alias("high")).orderBy("shard").collect()
    assert len(ranges) == 5 and all(a["high"] < b["low"] for a, b in zip(ranges, ranges[1:]))


def test_sharding_stays_in_the_jvm(spark, folder):
    made = sharding.shard_documents(spark.read.parquet(f"{folder}/documents.parquet"))
    plan = made._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


# Fill in the middle -----------------------------------------------------------------------------


def plain_middle(doc_id, text, salt=7, unit="line", fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    name = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(name[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    head, body, tail = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc_id, len(units), "spm", len(head), len(body), f"<S>{tail}<P>{head}<M>{body}"
    return doc_id, len(units), "psm", len(head), len(body), f"<P>{head}<S>{tail}<M>{body}"


def made_texts():
    draw = random.Random(11)
    pieces = ["a", "é", "漢", "😀", "\n", "\n", " ", "<", "<P", "S>", "\r\n", "\x1c", "word "]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randrange(60))) for _ in range(400)]
    texts += [None, "", "\n", "\n\n\n", "no newline", "one\n", "x<P>y\nz", "<S>", "a<M>", "😀\n" * 30_000, "z" * 1_500_000, "é漢\n" * 200_000 + "end"]
    return list(enumerate(texts)) + [(3, "again\nand again"), (3, "again\nand again"), (None, "no\nid\nhere"), (-4, "below\nzero\n")]


@pytest.mark.parametrize("unit, fim, spm", [("line", 100, 50), ("char", 100, 50), ("line", 60, 0), ("char", 30, 100)])
def test_middle(spark, unit, fim, spm):
    rows = made_texts()
    table = spark.createDataFrame([(*r, "x", "x", "x", 1, "x", 1) for r in rows], DOCUMENTS).repartition(4)
    settings = middle.Settings(unit=unit, fim_percent=fim, spm_percent=spm)
    made = middle.fill_in_middle(table, settings)
    assert sorted((tuple(r) for r in made.collect()), key=str) == sorted((plain_middle(*r, 7, unit, fim, spm) for r in rows), key=str)
    back = collections.Counter(r[0] for r in made.select(middle.restored(settings)).collect())
    assert back == collections.Counter(t or "" for _, t in rows)


def test_exceptions_convert_both_ways():
    for _, text in made_texts()[:400]:
        data = np.frombuffer((text or "").encode(), np.uint8)
        index = middle.Exceptions(data)
        chars = np.arange(len(text or "") + 1)
        cuts = np.array([len((text or "")[:i].encode()) for i in chars])
        assert (index.to_bytes(chars) == cuts).all() and (index.to_chars(cuts) == chars).all()
        assert len(index.byte_at) == sum(ord(c) > 127 for c in text or "")


def test_middle_of_an_empty_table(spark):
    assert middle.round_trip(middle.fill_in_middle(spark.createDataFrame([], DOCUMENTS))).count() == 0


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("P", "<S>", "<M>"), ("<<P>", "<S>", "<M>")])
def test_marks_that_could_be_misread(marks):
    with pytest.raises(ValueError):
        middle.Settings(prefix=marks[0], suffix=marks[1], middle=marks[2])


# Registered -------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_grid_codes", "op12_byte_shards", "op13_fill_in_middle"])
def test_equal_to_sql(spark, folder, name):
    from compare import connect, difference

    assert difference(entry.queries()[name](spark, folder), connect(folder), entry.oracle_sql()[name]) is None
