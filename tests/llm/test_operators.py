"""Every operator against a plain version, an exact round trip or held-out labels."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import math
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F
from plain import Groups, base_counts, base_spans, lower, luhn, near_duplicates, shingles
from tokenizers import Tokenizer

import __spark_entry__ as entry
from weighted_insights.llm import bpe, fertility, hyperminhash, lattice, licenses, linecrf, lm, packing, pii, text, warc


@pytest.fixture(scope="module")
def documents(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def result(spark, folder, prefix):
    name = next(n for n in entry.queries() if n.startswith(prefix))
    return entry.queries()[name](spark, folder)


# Personal data ----------------------------------------------------------------------------------


def test_base_patterns():
    draw = random.Random(3)
    for _ in range(20_000):
        line = "".join(draw.choice("a@.-+ 01259()é\n%") for _ in range(draw.randint(0, 40)))
        assert pii.base_spans(line) == base_spans(line)


LONG_RUNS = ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "1." * 50_000, "+1" * 50_000, "a1@b" + "dotx" * 50_000 + "~", "a1 " + "x" * 200_000 + " @", "(at)" * 50_000 + "1", "a." * 100_000 + "@" + "b." * 100_000)


@pytest.mark.parametrize("run", LONG_RUNS)
def test_long_runs_take_no_time(run):
    model = pii.train()
    pii.find_spans("warm up 1", model)
    start = time.perf_counter()
    pii.find_spans(run, model)
    assert time.perf_counter() - start < 1


def test_many_chunks_take_time_in_proportion():
    model, seconds = pii.train(), []
    for n in (2_000, 16_000):
        start = time.perf_counter()
        pii.find_spans("a1@b " + "dot " * n, model)
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 24 * seconds[0]


@pytest.mark.parametrize(
    "line, found",
    [
        ("john smith at example dot com is here", "smith at example dot com"),
        ("write to ann(at)corp(dot)org now", "ann(at)corp(dot)org"),
        ("mail bob [AT] site [DOT] net", "bob [AT] site [DOT] net"),
        ("look at the dot matrix printer", None),
        ("a dot here and a dot there at noon", None),
    ],
)
def test_spelt_addresses(line, found):
    assert [(line[a:b], k) for a, b, k in pii.find_spans(line, pii.train())[1]] == ([(found, "email")] if found else [])


def test_held_out_lines():
    """At least 97 percent of the spans of lines that the model has not seen, and 95 percent of what it finds is one."""
    random_, model = np.random.Generator(np.random.PCG64(4242)), pii.train()
    hit, missed, wrong = collections.Counter(), collections.Counter(), collections.Counter()
    for _ in range(1500):
        line, segments = pii._generated_line(random_)
        read = pii.chunks(line, 0, len(line))
        truth = [(read[i].start, read[j].end, pii.LABELS[label]) for i, j, label in segments]
        found = pii.find_spans(line, model)[1]
        for spans, others, yes, no in ((truth, found, hit, missed), (found, truth, collections.Counter(), wrong)):
            for a, b, kind in spans:
                (yes if any(x < b and a < y and kind == k for x, y, k in others) else no)[kind] += 1
    for kind in pii.KINDS:
        assert hit[kind] >= 0.97 * (hit[kind] + missed[kind]) and hit[kind] >= 0.95 * (hit[kind] + wrong[kind]), kind


@pytest.mark.parametrize(
    "line, kind, found",
    [
        ("call 212-555-0199 now", "phone", "212-555-0199"),
        ("card 4111.1111.1111.1111 ok", "card", "4111.1111.1111.1111"),
        ('token = "dafbac99949115180e7593de87b4492bcef9890b" x', "secret", "dafbac99949115180e7593de87b4492bcef9890b"),
    ],
)
def test_added_spans(line, kind, found):
    base, spans = pii.find_spans(line, pii.train())
    assert base == [] and [(line[a:b], k) for a, b, k in spans] == [(found, kind)]


@pytest.mark.parametrize("line", ["in 2021 we had 1,234 items", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "at 12:30 on 2021-05-04"])
def test_numbers_that_stay(line):
    assert pii.find_spans(line, pii.train()) == ([], [])


def test_semi_markov_expectations():
    random_ = np.random.default_rng(0)
    scores, follow = random_.normal(size=(1, 4, 2, 3)), random_.normal(size=(3, 3))
    scores[0, 0, 1] = -np.inf
    chance, pairs, total = pii.expectations(scores, follow)
    whole, counted, paired, best = 0.0, np.zeros((4, 2, 3)), np.zeros((3, 3)), (-np.inf, None)

    def readings(at):
        if at == 4:
            yield []
        for length in (1, 2):
            if at + length <= 4:
                for label, rest in itertools.product(range(3), readings(at + length)):
                    yield [(at, at + length - 1, label), *rest]

    for reading in readings(0):
        score = sum(scores[0, j, j - i, y] for i, j, y in reading) + sum(follow[a[2], b[2]] for a, b in zip(reading, reading[1:]))
        whole += math.exp(score)
        best = max(best, (score, reading), key=lambda b: b[0])
        for i, j, y in reading:
            counted[j, j - i, y] += math.exp(score)
        for a, b in zip(reading, reading[1:]):
            paired[a[2], b[2]] += math.exp(score)
    assert np.allclose(chance[0], counted / whole) and np.allclose(pairs, paired / whole) and total[0] == pytest.approx(math.log(whole))
    assert pii.best_reading(scores[0], follow) == [s for s in best[1] if s[2]]


def test_pii_query(spark, folder, documents):
    texts = dict(documents)
    for r in result(spark, folder, "op1_").collect():
        spans = base_spans(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[2] == k for s in spans) for k in ("email", "ip", "card", "phone")]


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and luhn("4111111111111111")


# Quality ----------------------------------------------------------------------------------------


def test_fertility_query(spark, folder, documents):
    texts = dict(documents)
    rows = result(spark, folder, "op2_").collect()
    for r in rows:
        counts = base_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["base_failed"] and r["kept"])
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r["kept"] for r in rows if quality.get(r["doc_id"]) == 1 and not r["base_failed"])
    assert not any(r["kept"] for r in rows if quality.get(r["doc_id"]) == 0)


def test_repeated_lines_on_both_sides_of_the_bound():
    words = [w for t in licenses.TEMPLATES.values() for w in t.split()]
    lines = [" ".join(words[k : k + 9]).encode() for k in range(0, 90, 9)]
    path = public_tokenizers.path(fertility.VOCABULARY)
    three, four = (b"\n\n".join([*lines[: 10 - n], *[lines[0]] * n]) for n in (3, 4))
    got = fertility.measure([three, four], path)
    assert list(got["n_dup_lines"]) == [3, 4] and list(got["base_failed"]) == [False, False]
    assert got["reason"] == [None, "dup_lines"] and "n_lines" not in got


def test_token_measures():
    import sentencepiece

    path = public_tokenizers.path(fertility.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    lines = ["the cat sat on the mat", "漢字 and 𐍈 in one text", "a a a a"]
    got = fertility.measure([line.encode() for line in lines], path)
    for i, line in enumerate(lines):
        tokens = [t for word in line.split() for t in model.encode(word)]
        counts = collections.Counter(tokens)
        bits = -sum(c / len(tokens) * math.log2(c / len(tokens)) for c in counts.values())
        assert got["n_tokens"][i] == len(tokens) and got["token_entropy"][i] == pytest.approx(bits)
        assert got["byte_share"][i] == pytest.approx(sum(model.is_byte(t) for t in tokens) / len(tokens))
    assert got["script"] == ["latin", "latin", "latin"]
    assert fertility.measure(["Привет как дела".encode()], path)["script"] == ["cyrillic"]


def test_chain_marginals():
    random_ = np.random.default_rng(0)
    evidence, pairs = 2 * random_.normal(size=7), random_.normal(size=(2, 2))
    good, expected, total = linecrf.forward_backward(evidence, pairs, np.array([4, 0, 3]))
    counted, paired, log_sum = np.zeros(7), np.zeros((2, 2)), 0.0
    for a, b in ((0, 4), (4, 7)):
        whole, mine, steps = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            weight = math.exp(sum(evidence[a + i] * v for i, v in enumerate(y)) + sum(pairs[v, w] for v, w in zip(y, y[1:])))
            whole += weight
            mine += weight * np.array(y)
            for v, w in zip(y, y[1:]):
                steps[v, w] += weight
        counted[a:b], paired, log_sum = mine / whole, paired + steps / whole, log_sum + math.log(whole)
    assert np.allclose(good, counted) and np.allclose(expected, paired) and total == pytest.approx(log_sum)


def test_line_crf_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    scores = {r["doc_id"]: r for r in result(spark, folder, "op4_").collect()}
    labels = [(r["quality"], scores[r["doc_id"]]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    held = [(q, r["score"], r["predicted"]) for q, r in labels if r["held_out"]]
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == r["held_out"] for i, r in scores.items())
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in scores.values())
    pairs = [(good > bad) + (good == bad) / 2 for q, good, _ in held if q == 1 for p, bad, _ in held if p == 0]
    assert np.mean(pairs) > 0.98 and np.mean([q == p for q, _, p in held]) > 0.93


# Tokens -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def public():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_on_random_texts(public):
    coder, split = bpe.transducer(public_tokenizers.path(bpe.VOCABULARY)), bpe.splitter(public_tokenizers.PATTERN)
    draw = random.Random(1)
    for _ in range(5_000):
        line = "".join(draw.choice("aeinrst éßñ\n.,!THE0123漢字😀\t\r'") for _ in range(draw.randint(0, 80)))
        assert bpe.encode_text(coder, split, line) == public.encode_ordinary(line)
    coder._forget()
    assert bpe.encode_text(coder, split, "forgotten transitions are made anew") == public.encode_ordinary("forgotten transitions are made anew")


def test_bpe_query(spark, folder, documents, public):
    got = {r["doc_id"]: r for r in result(spark, folder, "op5_").collect()}
    for doc_id, content in documents:
        ids = public.encode_ordinary(content)
        r = got[doc_id]
        assert r["n_tokens"] == len(ids) and r["valid_utf8"] and r["n_chars"] == len(content)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(content.encode()).hexdigest()


def test_utf8_stream():
    whole = "aé漢😀z".encode()
    for cuts in itertools.combinations(range(1, len(whole)), 3):
        stream = bpe.Utf8Stream()
        parts = [whole[a:b] for a, b in zip((0, *cuts), (*cuts, len(whole)))]
        assert "".join(stream.push(p) for p in parts) + stream.close() == whole.decode() and stream.valid
    broken = bpe.Utf8Stream()
    broken.push(b"a\xe6\xbc")
    broken.close()
    assert not broken.valid


def test_packing_query(spark, folder, documents):
    rows = packing.pack_documents(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc_id, content in documents:
        pieces = sorted(by_doc[doc_id], key=lambda r: r["start"])
        ids = tokenizer.encode(content, add_special_tokens=False).ids + [1]
        assert b"".join(bytes(p["ids"]) for p in pieces) == np.array(ids, "<u4").tobytes()
        assert [p["start"] for p in pieces] == list(np.cumsum([0, *[p["length"] for p in pieces]])[:-1])
        assert {p["doc_tokens"] for p in pieces} == {len(ids)}
    lengths = []
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == list(np.cumsum([0, *[p["length"] for p in pieces]])[:-1])
        lengths.append(sum(p["length"] for p in pieces))
    assert max(lengths) <= packing.CAPACITY and sum(lengths) > 0.95 * packing.CAPACITY * len(lengths)
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in result(spark, folder, "op3_").collect()}
    assert digests == {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in rows}


def test_word_lookup_equals_the_tokenizer():
    store, tokenizer = packing.word_store(public_tokenizers.path(packing.VOCABULARY)), Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    for line in ("It's DON'T we'LL.x's a.b,c--d \"q\" İ É. x́.y 3.14 é,x ’s a b .́a \x1c. 漢字.", "a <|endoftext|>x <|EndOfText|> B.", ""):
        assert packing.document_ids([line.encode()], store, 1)[0].tolist() == [*tokenizer.encode(line, add_special_tokens=False).ids, 1]


def test_assign_balances_cost():
    lengths = [900, 800, 700, 600, 500, 400, 60, 50]
    pieces = packing.assign(lengths, 2048)
    assert sorted((i, s, n) for i, s, n, _, _ in pieces) == sorted((i, 0, n) for i, n in enumerate(lengths))
    loads = collections.Counter()
    for _, _, n, sequence, _ in pieces:
        loads[sequence] += packing.Cost().of(n)
    assert max(loads.values()) < 1.15 * min(loads.values())
    assert packing.assign([], 8) == [] and sum(n for _, _, n, _, _ in packing.assign([5, 5, 5], 8)) == 15


# Near duplicates --------------------------------------------------------------------------------


def test_hyperminhash_query(spark, folder, documents):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result(spark, folder, "op6_").collect()}
    assert got == near_duplicates(documents, 3, 85)


@pytest.mark.parametrize("group", [500_000, 300])
def test_large_families(spark, monkeypatch, group):
    """Copies of copies, truncations and shared edits in buckets that are far over the limits, ordered in one group or in several."""
    monkeypatch.setattr(hyperminhash, "GROUP", group)
    draw = random.Random(5)
    word = lambda: "w" + str(draw.randrange(10**9))
    rows = []
    for size in (120, 60):
        original = [word() for _ in range(size)]
        shared = list(original)
        shared[10:14] = [word() for _ in range(4)]
        for k in range(90):
            copy = list(shared if k % 3 == 0 else original)
            for _ in range(draw.randrange(10)):
                copy[draw.randrange(size)] = word()
            if k % 5 == 0:
                copy = copy[: int(size * draw.uniform(0.6, 1))]
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + k, " ".join(word() for _ in range(80))) for k in range(20)]
    settings = hyperminhash.Settings(shingle=3, percent=85, small=4, later=8)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()}
    want = near_duplicates(rows, 3, 85)
    assert got == want and len({c for _, c in want.values()}) > 30


def test_full_sets_without_a_shuffle_of_texts(spark):
    """The sets of the asked ids are those of a plain reading, few others come along, and texts stay where they are read."""
    draw = random.Random(9)
    texts = [" ".join(f"W{draw.randrange(40)}" for _ in range(draw.choice((0, 1, 2, 30)))) for _ in range(3000)]
    rows = [*((i % 2900, t) for i, t in enumerate(texts)), (None, "a b c d"), (5, None)]
    asked = [i for i in range(2900) if i % 7 == 0]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.createDataFrame([(i,) for i in asked * 2], "id long")
        sets = hyperminhash._sets(docs, ids, hyperminhash.Settings(shingle=3))
        plan = sets._jdf.queryExecution().executedPlan().toString()
        got = collections.Counter((r["id"], len(r["shingles"]) // 8, r["shingles"]) for r in sets.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(doc_id" not in plan and "SortMergeJoin" not in plan
    held = {i for i, _, _ in got}
    assert set(asked) <= held <= set(range(2900)) and len(held) < len(asked) + 150
    want = collections.Counter((i, len(shingles(t, 3))) for i, t in rows if i in held)
    assert want == collections.Counter((i, n) for i, n, _ in got.elements())
    assert all((np.diff(np.frombuffer(s, "<u8").astype(object)) > 0).all() for _, _, s in got)


@pytest.mark.parametrize("percent", [60, 70, 80, 85, 90])
def test_bands_miss_one_pair_in_100000(percent):
    settings = hyperminhash.Settings(percent=percent)
    assert (1 - (percent / 100) ** settings.rows) ** settings.bands <= 1e-5
    assert settings.rows * settings.bands <= settings.registers


def test_register_and_estimate():
    values = np.array([0, 1, 2**63, 2**63 + 2**53, 3 << 40], np.uint64)
    assert [int(v) >> 10 for v in hyperminhash.compress(values)] == [53, 53, 0, 0, 22]
    assert int(hyperminhash.compress(values)[4]) & 1023 == 512
    draw = np.random.default_rng(2)
    shared, a, b = (draw.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    regs = [hyperminhash.registers(np.concatenate([shared, x]), np.array([0]), 1024)[0] for x in (a, b)]
    assert hyperminhash.estimate((regs[0] == regs[1]).mean()[None], np.array([900]), np.array([900]))[0] == pytest.approx(0.8, abs=0.05)


def test_nearest_lattice_point():
    steps = lattice.shortest_vectors()
    assert len(steps) == 240 and np.allclose((steps**2).sum(1), 2) and len(np.unique(steps, axis=0)) == 240
    points = np.random.default_rng(0).normal(size=(300, 8)) * 2
    near = lattice.nearest_e8(points)
    assert np.allclose(lattice.nearest_e8(near), near)
    gap = ((points - near) ** 2).sum(1)
    assert (gap[:, None] <= ((points[:, None] - near[:, None] - steps) ** 2).sum(2) + 1e-9).all()


def test_vectors_against_all_pairs(spark):
    draw = np.random.default_rng(4)
    rows, centres = [], draw.normal(size=(6, 24))
    for k in range(600):
        v = centres[k % 6] + draw.normal(size=24) * draw.choice([0.05, 0.1, 0.2]) if k < 420 else draw.normal(size=24)
        rows.append((k, [float(x) for x in (v if k % 17 else centres[0])], int(k % 2)))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    units = np.array([r[1] for r in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    close = units @ units.T >= 0.98
    np.fill_diagonal(close, False)
    labels = np.array([r[2] for r in rows])
    close &= labels[:, None] == labels[None, :]
    groups = Groups(range(len(rows)))
    for x, y in zip(*np.nonzero(close)):
        groups.join(int(x), int(y))
    prepared = {r["vec_id"]: r for r in lattice.near_duplicates(table).collect()}
    found = sum(r["n_links"] for r in prepared.values())
    assert 0.99 * close.sum() <= found <= close.sum()
    assert all(r["n_links"] <= close[i].sum() for i, r in prepared.items())
    assert np.mean([r["component_id"] == groups.find(i) for i, r in prepared.items()]) > 0.99


def test_blocks_do_not_change_links(spark, monkeypatch):
    draw = np.random.default_rng(8)
    rows = [(k, [float(x) for x in 1 + 0.05 * draw.normal(size=8)], 0) for k in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    whole = sorted(lattice.near_duplicates(table).collect())
    links = lattice.class_links
    monkeypatch.setattr(lattice, "class_links", lambda c, t, lat: links(c, t, lat, block=7))
    assert sorted(lattice.near_duplicates(table).collect()) == whole and whole[0]["n_links"] > 20


# Language model ---------------------------------------------------------------------------------


def test_lm_base(spark, folder, documents):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in documents}
    counts, closed = collections.Counter(), sum(not h for h in held.values())
    for i, content in documents:
        if not held[i]:
            counts.update(lower(content))
    n, v = sum(counts.values()) + closed, len(counts) + 1
    floor = math.log10(n + 0.5 * (v + 1))
    store = packing.word_store(public_tokenizers.path(lm.VOCABULARY))
    frequency = np.full(lm.VOCABULARY_SIZE, 0.5)
    for ids in lm.text_ids([t.encode() for i, t in documents if not held[i]], store):
        frequency += np.bincount(ids[1:], minlength=lm.VOCABULARY_SIZE)
    model = unigram = 0.0
    for r in result(spark, folder, "op7_").collect():
        content = lower(dict(documents)[r["doc_id"]])
        want = sum(math.log10(counts[w] + 0.5) - floor for w in content) + math.log10(closed + 0.5) - floor
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(content) + 1, sum(w in counts for w in content) + 1, n)
        assert r["base_score"] == pytest.approx(want)
        if r["held_out"]:
            (ids,) = lm.text_ids([dict(documents)[r["doc_id"]].encode()], store)
            model, unigram = model + r["score"], unigram + np.log10(frequency[ids[1:]] / frequency.sum()).sum()
    # The table is tiny; the next test compares with the base on a larger one.
    assert model > 0.75 * unigram


def test_lm_beats_the_base_on_held_out_texts(spark):
    rows = lm.folded_scores(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    sums = {r["held_out"]: r for r in rows.groupBy("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).collect()}
    assert sums[True]["score"] > sums[True]["base"] and sums[False]["score"] > sums[False]["base"]


@pytest.fixture(scope="module")
def small_model(documents):
    shape = lm.Shape(width=8, head=4, classes=6, window=12, overlap=4, start_windows=40, start_rounds=3)
    store = packing.word_store(public_tokenizers.path(lm.VOCABULARY))
    texts = [t.encode() for _, t in documents]
    windows = np.concatenate([lm.spread_windows(ids, i, shape) for i, ids in enumerate(lm.text_ids(texts[:80], store))])
    return shape, store, texts, lm.train_start(windows, shape)


def test_lm_sums_to_one(small_model):
    _, _, _, p = small_model
    table = lm.distributions(p.stats)
    rest = lm.VOCABULARY_SIZE - (len(table) - 1)
    assert np.allclose(table[1:].sum(0) + rest * table[0], 1, atol=1e-4)


def test_lm_windows_against_one_token_at_a_time(small_model):
    shape, store, texts, p = small_model
    tokens, stops = lm.token_stream([texts[3][:600], b"", b"zzz qqq"], store)
    table, got, begin = lm.distributions(p.stats), lm.Scorer(p, shape).log10(tokens, stops), 0
    step = shape.window - shape.overlap
    for text_number, stop in enumerate(stops):
        rows, total = p.rows(tokens[begin:stop]), 0.0
        for i in range(len(rows) - 1):
            low = max(0, i // step * step - shape.overlap)
            keys = rows[low : i + 1]
            score = p.embed[rows[i]] @ p.query @ (p.embed[keys] @ p.key).T / math.sqrt(shape.head) + p.distance[i - np.arange(low, i + 1)]
            attend = np.exp(score) / np.exp(score).sum()
            logits = p.embed[rows[i]] @ p.direct + p.bias + attend @ (p.embed[keys] @ p.value)
            weight = np.exp(logits) / np.exp(logits).sum()
            total += math.log10(weight @ table[rows[i + 1]])
        assert got[text_number] == pytest.approx(total, rel=1e-4)
        begin = stop


def test_lm_gradient(small_model):
    """A step of the trainer against differences of the loss."""
    shape, store, texts, p = small_model
    rows = p.rows(lm.windows_of(lm.text_ids(texts[:4], store), shape.window + 1))[:4]

    def loss(q):
        probe = lm.Trainer(q, shape, 1)
        probe._adam = lambda *a: None
        probe.step(rows)
        return probe.loss * math.log(10) / probe.tokens

    found = {}
    trainer = lm.Trainer(p.extended(p.ids), shape, 1)
    trainer._adam = lambda name, slope, at: found.__setitem__(name, slope)
    trainer.step(rows)
    for name, place in (("query", (1, 2)), ("key", (3, 1)), ("value", (2, 4)), ("direct", (5, 3)), ("bias", (2,)), ("distance", (1,))):
        up, down = p.extended(p.ids), p.extended(p.ids)
        getattr(up, name)[place] += 1e-2
        getattr(down, name)[place] -= 1e-2
        assert found[name][place] == pytest.approx((loss(down) - loss(up)) / 2e-2, rel=0.05, abs=2e-4)


def test_lm_learns(small_model):
    shape, store, texts, p = small_model
    held = lm.token_stream(texts[100:140], store)
    untrained = lm.fresh(p.ids[1:], shape)
    counts = lm.expected_counts([texts[:60], texts[60:100]], p, store, shape)
    met = np.flatnonzero(counts.sum(1))
    scores = [lm.Scorer(q, shape).log10(*held).sum() for q in (untrained, p, lm.with_counts(p, met, counts[met]))]
    assert scores[0] < scores[1] < scores[2]


def test_lm_windows_are_spread_over_the_text():
    shape = lm.Shape(window=8, start_windows=5)
    ids = np.arange(1000)
    some = [lm.spread_windows(ids, i, shape) for i in range(30)]
    assert all(s.shape == (5, 9) and (np.diff(s[:, 0]) > 0).all() for s in some)
    first = np.concatenate(some)[:, 0]
    assert (np.histogram(first, 4, (0, 1000))[0] > 20).all() and len(lm.spread_windows(ids[:3], 1, shape)) == 1


def test_lm_pairs():
    a, b, start, end = 5, 6, lm.START_ID, lm.END_ID
    tokens = np.array([start, a, b, a, end, start, end, start, b, end])
    pairs = lm.pairs_of(tokens)
    assert [None if p < 0 else (p >> 16, p & 65535) for p in pairs.tolist()] == [None, (start, a), (a, b), (b, a), (a, end), None, (start, end), None, (start, b), (b, end)]


def test_lm_tokens_belong_to_words():
    store = packing.word_store(public_tokenizers.path(lm.VOCABULARY))
    texts = ["Hello, wörld! it's <b>x</b>", "", " \n", "one two\tthree", "<|odd|> text"]
    for some in (texts[:4], texts[4:], texts[2:]):
        tokens, stops, owner = lm.owned_stream([t.encode() for t in some], store)
        words, sizes = lm.word_rows([t.encode() for t in some])
        assert (np.diff(owner[owner >= 0]) >= 0).all() and set(owner[owner >= 0].tolist()) == set(range(len(words)))
        assert (owner[tokens == lm.START_ID] == -1).all() and owner[stops - 1].tolist() == (np.cumsum(sizes) - 1).tolist()


def test_lm_back_off_sums_to_one():
    draw = np.random.default_rng(0)
    counts = draw.integers(0, 3, 200).astype(float)
    lower = draw.dirichlet(np.ones(200))
    for held in (counts, np.zeros(200)):
        assert lm.backed_off(held, held.sum(), (held > 0).sum(), lower).sum() == pytest.approx(1)


def plain_scores(docs, held, scorer, store):
    """By dictionaries, one token and one word after the other."""
    pairs, words, closed = collections.Counter(), collections.Counter(), 0
    for i, t in docs:
        if not held[i]:
            ids = lm.text_ids([(t or "").encode()], store)[0].tolist()
            pairs.update(zip(ids, ids[1:]))
            words.update(lower(t))
            closed += 1
    n, after = sum(words.values()) + closed, collections.defaultdict(list)
    for (x, _), count in pairs.items():
        after[x].append(count)
    for i, t in docs:
        tokens, stops, owner = lm.owned_stream([(t or "").encode()], store)
        model, ids, spelt = scorer.chances(tokens, stops), tokens.tolist(), collections.defaultdict(lambda: 1.0)
        for k in range(1, len(ids)):
            p, known = model[k], after[ids[k - 1]]
            if known:
                p = (pairs[ids[k - 1], ids[k]] + len(known) * p) / (sum(known) + len(known))
            spelt[owner[k]] *= p
        found = lower(t)
        counts = [words[w] for w in found] + [closed]
        yield i, sum(math.log10((spelt[j] + c / n) / 2) for j, c in enumerate(counts))


def test_lm_scores_against_a_plain_version(spark, documents, monkeypatch):
    docs = [(i, t[:1500]) for i, t in documents[:60]] + [(1000, None), (1001, "zzz"), (1002, "")]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    table = spark.createDataFrame(docs, "doc_id long, text string")
    shape, path = lm.Shape(classes=6, start_rounds=2), public_tokenizers.path(lm.VOCABULARY)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm, "ASKING", 2)
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    found = [{r["doc_id"]: r["score"] for r in lm.score_documents(table.repartition(n), fold, shape=shape).collect()} for n in (2, 16)]
    assert found[0] == pytest.approx(found[1], rel=1e-6)
    taught = table.where(~fold)
    start = lm.train_start(lm.start_windows(taught, path, shape), shape)
    scorer = lm.Scorer(lm.count_everywhere(taught, start, path, shape), shape)
    assert found[0] == pytest.approx(dict(plain_scores(docs, held, scorer, packing.word_store(path))), rel=1e-4)


def test_lm_windows_hold_every_token():
    texts = [np.arange(10, 10 + n) for n in (2, 5, 12, 13, 40)]
    windows = lm.windows_of(texts, 5)
    wanted = windows[:, 1:][windows[:, 1:] >= 0]
    assert sorted(wanted.tolist()) == sorted(np.concatenate([t[1:] for t in texts]).tolist())
    assert ((windows[:, 1:] < 0) | (windows[:, 1:] == windows[:, :-1] + 1)).all()
    assert lm.windows_of([], 5).shape == (0, 5)


def test_lm_statistics_count_every_token(spark, small_model):
    """The token statistics are those of all texts, ends included, however long a text is."""
    shape, store, texts, p = small_model
    chosen = [*texts[:60], b" ".join(texts[60:100]), b""]
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(chosen)], "doc_id long, text string").repartition(3)
    trained = lm.count_everywhere(docs, p, public_tokenizers.path(lm.VOCABULARY), shape)
    want = np.zeros(lm.VOCABULARY_SIZE)
    for ids in lm.text_ids(chosen, store):
        want += np.bincount(ids[1:], minlength=lm.VOCABULARY_SIZE)
    got = np.zeros(lm.VOCABULARY_SIZE)
    got[trained.ids[1:]] = trained.stats[1:].sum(1)
    assert want[lm.END_ID] == len(chosen) and np.allclose(got, want, rtol=1e-3, atol=1e-2)


def test_only_one_word_store_holds_words():
    """The stages of the pipeline share worker processes; the words of an earlier one are not kept beside those of the next."""
    first, second = (text.WordStore(lambda words, k=k: [[k, len(w)] for w in words]) for k in (1, 2))
    some = text.Texts([b"one three one", b"seven"])
    for _ in range(2):
        assert first.lookup(some)[0].tolist() == [1, 3, 1, 5, 1, 3, 1, 5] and len(first.at) == 3 and not second.at
        assert second.lookup(some)[0].tolist() == [2, 3, 2, 5, 2, 3, 2, 5] and len(second.at) == 3 and not first.at


def test_word_store_finds_every_word_whatever_shares_its_slot(monkeypatch):
    """Words that share a slot, that were met before, and a store that begins anew give the lists that they are encoded to."""
    monkeypatch.setattr(text.WordStore, "SLOTS", 4)
    asked = []
    store = text.WordStore(lambda words: [asked.append(w) or [*w] for w in words], most=60)
    draw = np.random.default_rng(3)
    for k in range(40):
        words = [b"w%d" % n for n in draw.integers(0, 40 if k < 20 else 90, 30)]
        values, sizes = store.lookup(text.Texts([b" ".join(words[:9]), b"", b" ".join(words[9:])]))
        assert values.tolist() == [b for w in words for b in w] and sizes.tolist() == [len(w) for w in words] and len(store.at) <= 60
        # Nothing that is held is encoded again.
        assert k != 19 or len(asked) == len(set(asked)) <= 40


def test_lm_fading_counts_give_the_rows_of_the_distributions():
    """Rows on demand, without a pass over the vocabulary, against the whole table; also after a very long run."""
    draw = np.random.default_rng(4)
    whole = draw.gamma(0.3, 5, (60, 6))
    kept = lm.Statistics(whole)
    for k in range(4000):
        factor, rows, sums = draw.choice([0.9, 0.95]), np.sort(draw.choice(np.arange(1, 60), 20, False)), draw.gamma(1, 1, (20, 6)).astype(np.float32)
        whole *= factor
        whole[rows] += sums
        kept.fade(factor)
        kept.add(rows, sums)
        if k in (0, 7, 3999):
            some = np.array([0, 1, 17, 59])
            assert np.allclose(kept.table(some, vocabulary=80), lm.distributions(whole, vocabulary=80)[some], rtol=1e-5)


def test_lm_trainer_works_on_the_tokens_of_a_batch_alone(small_model):
    """A step and its share of the upkeep must not pass over the vocabulary: rows that a batch lacks are neither read nor written."""
    shape, store, texts, p = small_model
    trainer = lm.Trainer(p.extended(np.arange(lm.VOCABULARY_SIZE)), shape)
    rows = lm.windows_of(lm.text_ids(texts[:4], store), shape.window + 1) + 1
    absent = np.setdiff1d(np.arange(1, lm.VOCABULARY_SIZE + 1), rows)
    for a in (trainer.p.embed, *trainer.moments["embed"], trainer.running.counts):
        a[absent] = np.nan
    for _ in range(20):
        trainer.step(rows[:40])
    assert trainer.refreshed == 1 and np.isfinite(trainer.loss)
    met = np.unique(rows[:40])
    assert all(np.isfinite(a[met]).all() for a in (trainer.p.embed, trainer.running.counts, trainer.total))


def test_lm_attention_learns_from_every_document(spark, small_model, monkeypatch):
    """A document beyond those of the start changes the attention, not only the counts; groups are weighed by what they read."""
    shape, store, texts, p = small_model
    path, some = public_tokenizers.path(lm.VOCABULARY), [t.decode() for t in texts[:12]]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    one, more = (lm.count_everywhere(d, p, path, shape) for d in (docs.where("doc_id < 11"), docs))
    assert all(not np.allclose(getattr(one, m), getattr(p, m), atol=1e-5) for m in lm.MATRICES)
    assert all(not np.allclose(getattr(one, m), getattr(more, m), atol=1e-6) for m in lm.MATRICES)
    odd = lm.count_everywhere(docs.union(spark.createDataFrame([(99, "xylophone walrus " * 9)], docs.schema)), p, path, shape)
    new = np.setdiff1d(lm.text_ids([b"xylophone walrus"], store)[0][1:-1], more.ids)
    assert len(new) and not np.isclose(odd.embed[odd.rows(new)], p.embed[0]).all()
    trainer, read = lm.trained_on([texts[:1]], p, store, shape)
    alone = lm.count_everywhere(docs.where("doc_id = 0"), p, path, shape)
    assert np.allclose(alone.query, trainer.p.query, atol=1e-6) and read[1 + lm.START_ID] == 1
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2_000)
    found = [lm.count_everywhere(docs.repartition(n), p, path, shape) for n in (1, 5)]
    assert all(np.allclose(getattr(found[0], m), getattr(found[1], m), atol=1e-6) for m in ("embed", "stats", *lm.MATRICES))


# Licenses ---------------------------------------------------------------------------------------


def test_license_query(spark, folder, documents):
    got = collections.Counter((r["doc_id"], r["license"]) for r in result(spark, folder, "op8_").collect())
    notices = {n: t for n, t in licenses.TEMPLATES.items() if n.endswith("-notice")}
    want = collections.Counter((i, n) for i, content in documents for n, t in notices.items() for _ in range(content.count(t)))
    assert got == want and want


def test_edited_license():
    settings = licenses.Settings()
    index = licenses.build_index(licenses.TEMPLATES, settings)
    edited = licenses.TEMPLATES["isc"].replace("purpose", "great purpose").replace("without", "w/o").replace("hereby ", "")
    line = f"é before. {edited.upper()} after"
    (match,) = licenses.scan([line.encode()], index, settings)[0]
    assert match.license == "isc" and 0.85 < match.coverage < 1
    assert line[match.start : match.end].lower() == edited.lower().rstrip(".")
    half = " ".join(licenses.TEMPLATES["isc"].split()[:15])
    assert licenses.scan([half.encode(), b"the"], index, settings) == [[], []]


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_license_is_not_taken_for_another(name):
    settings = licenses.Settings()
    index = licenses.build_index(licenses.TEMPLATES, settings)
    line = f"This work: {licenses.TEMPLATES[name]} More words follow."
    (match,) = licenses.scan([line.encode()], index, settings)[0]
    assert (match.license, match.coverage) == (name, 1.0)


def test_near_notices_and_insertions():
    settings = licenses.Settings()
    index = licenses.build_index(licenses.TEMPLATES, settings)
    others = (
        "Licensed under CC BY-XX 4.0.",
        "Licensed under CC BY 3.0.",
        "This work is licensed under the GNU Other General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 1.",
        "Released under the old MIT License.",
    )
    assert licenses.scan([t.encode() for t in others], index, settings) == [[]] * len(others)
    isc = licenses.TEMPLATES["isc"].split()
    (match,) = licenses.scan([" ".join([*isc[:12], "really", "really", *isc[12:]]).encode()], index, settings)[0]
    assert match.license == "isc" and match.matched == len(index.words[index.names.index("isc")]) and match.coverage < 1


def test_versions_are_told_apart():
    settings = licenses.Settings()
    index = licenses.build_index(licenses.TEMPLATES, settings)
    gpl, epl = licenses.TEMPLATES["gpl-3.0"], licenses.TEMPLATES["epl-1.0"]
    found = {v: [m.license for m in licenses.scan([gpl.replace("version 3", f"version {v}").encode()], index, settings)[0]] for v in "1234"}
    assert found == {"1": [], "2": ["gpl-2.0"], "3": ["gpl-3.0"], "4": []}
    assert licenses.scan([epl.replace("v1.0", "v3.0").replace("v10", "v30").encode()], index, settings) == [[]]
    numbered = gpl.replace("either", "see line 17 either")
    assert [m.license for m in licenses.scan([numbered.encode()], index, settings)[0]] == ["gpl-3.0"]


@pytest.mark.parametrize(
    "line, name",
    [
        ("Licensed under the MIT license", "mit-licensed-notice"),
        ("# The MIT License (MIT)", "mit-title"),
        ("// SPDX-License-Identifier: Apache-2.0", "spdx-apache-2.0"),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "spdx-gpl-2.0-or-later"),
    ],
)
def test_short_forms(line, name):
    settings = licenses.Settings()
    found = licenses.scan([line.encode()], licenses.build_index(licenses.TEMPLATES, settings), settings)[0]
    assert [m.license for m in found] == [name]


def test_alignment_against_a_plain_one():
    draw = random.Random(8)
    for _ in range(300):
        text, template = ([draw.randrange(4) for _ in range(draw.randrange(1, 14))] for _ in range(2))
        table = [[0] * (len(template) + 1) for _ in range(len(text) + 1)]
        for i, a in enumerate(text):
            for j, b in enumerate(template):
                table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
        matched, first, last = licenses.align(np.array(text), np.array(template), 0, 30)
        assert matched == table[-1][-1]
        if matched:
            inner = text[first : last + 1]
            assert text[first] in template and text[last] in template and len(inner) >= matched
            narrow = licenses.align(np.array(text), np.array(template), 0, 1)[0]
            assert narrow <= matched


def test_winnowing_guarantee():
    hashes = np.random.default_rng(1).integers(0, 2**60, 200).astype(np.uint64)
    chosen = set(licenses.winnow(hashes, 4).tolist())
    assert all(chosen & set(range(i, i + 4)) for i in range(197))


# Archives ---------------------------------------------------------------------------------------


def test_warc_query(spark, folder):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    first: dict[bytes, int] = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    rows = result(spark, folder, "op9_").collect()
    assert len(rows) == len(pages)
    for r in rows:
        payload = pages[r["page_id"]]
        source = first[payload]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if source == r["page_id"] else ("revisit", source))


def test_bundles_are_seekable(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    place, index = warc.write_archives(pages, frame_bytes=4096, bundle_bytes=40_000)
    rows = index.collect()
    fs, path = warc.open_folder(place)
    bundles = {r["bundle"] for r in rows}
    assert len(bundles) > 1
    for bundle in bundles:
        with fs.open_input_file(f"{path}/{bundle}") as file:
            whole = file.read()
        frames = warc.seek_table(fs, f"{path}/{bundle}")
        # Any reader sees one stream: frames end to end, the seek table skipped.
        stream = zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read()
        assert len(frames) > 1 and len(stream) == sum(f.full for f in frames)
    one = rows[len(rows) // 2]
    frame = warc.read_frame(fs, f"{path}/{one['bundle']}", one["frame_start"], one["frame_bytes"])
    headers, _ = next(warc.parse(frame, one["offset"]))
    assert headers["WARC-Record-ID"] == one["record_id"] and headers["X-Page-ID"] == str(one["page_id"])
    chosen = spark.createDataFrame([(3,), (7,)], "page_id long")
    assert sorted(r["page_id"] for r in warc.read_records(place, index, chosen).collect()) == [3, 7]


# Texts and the pipeline -------------------------------------------------------------------------


def test_word_hashes():
    lines = [b"a b\tc\x0bd\x0ce\rf\ng", b"", b"  ", "é\x85ü\xa0k a".encode(), b"A a"]
    read = text.Texts(lines, lower=True)
    assert [read.word(i) for i in range(len(read.words))] == [w for line in lines for w in line.split()]
    assert read.n_words.tolist() == [len(line.split()) for line in lines]
    assert read.words[0] == read.words[-1] == read.words[-2] and len(set(read.words.tolist())) == len({w.lower() for line in lines for w in line.split()})


def test_pipeline(spark, folder, documents):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_dedup", "personal_data", "pack"]
    raw = spark.read.parquet(f"{folder}/documents.parquet")
    rated = {r["doc_id"]: r["kept"] for r in fertility.rate_documents(raw).collect()}
    docs, texts = raw, dict(documents)
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), raw.schema)
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality_rules":
            assert set(rows) == {i for i, kept in rated.items() if kept}
        if name == "quality_classifier":
            assert all(i in rows for i, kept in rated.items() if kept and quality.get(i) == 1)
            scored = rows
        if name == "near_dedup":
            groups = near_duplicates(sorted(scored.items()), 5, 80)
            assert set(rows) == {i for i, (_, c) in groups.items() if i == c}
        if name == "personal_data":
            assert all(not base_spans(t) for t in rows.values())
            assert all(rows[i] == texts[i] for i in rows if not pii.TRIGGERS.search(texts[i]))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {p["doc_id"] for p in pieces} == set(rows)
    assert {p["doc_id"] for p in corpus_pipeline.run(spark, folder).select("doc_id").collect()} == set(rows)
