"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import pytest
from plain import base_counts, near_duplicates

from weighted_insights.llm import bpe, fertility, hyperminhash, lattice, licenses, linecrf, lm, packing, pii, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, ids string, label int"
LONG = "the quick brown fox jumps over one lazy dog " * 4000 + "x" * 100_000


@pytest.fixture(scope="module")
def odd(spark):
    texts = [None, "", "   \n\t\n", "one", "two words", LONG, "é 漢字 😀\x1c y", "same line\nsame line\nsame line", "same line\nsame line\nsame line"]
    rows = [(i, t, "en", "s", None, 1.0, True, "clash", 1) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "no id here", None, None, 3, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


OPERATORS = {
    "pii": pii.find_personal_data,
    "fertility": fertility.rate_documents,
    "packing": packing.pack_documents,
    "line_crf": lambda d: linecrf.score_documents(d, linecrf.Model(linecrf.np.zeros(linecrf.WIDTH), 1.0, linecrf.np.zeros((2, 2)))),
    "bpe": bpe.bpe_round_trip,
    "encoded": bpe.encoded,
    "hyperminhash": hyperminhash.near_duplicates,
    "lm": lm.folded_scores,
    "licenses": licenses.find_licenses,
    "redact": pii.redact,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"licenses", "packing"}))
def test_one_row_each(odd, name):
    found = [r["doc_id"] for r in OPERATORS[name](odd).select("doc_id").collect()]
    assert sorted(found, key=str) == sorted([r["doc_id"] for r in odd.collect()], key=str)


def test_pii(odd):
    found = by_id(pii.find_personal_data(odd))
    assert all(not r["base"] and not r["spans"] for r in found.values())


def test_redact_keeps_other_columns(spark):
    rows = [(1, "write to ann@corp.example.com now", "en", "s", 33, 2.0, True, "x", 1), (2, None, None, None, None, None, None, None, None)]
    got = by_id(pii.redact(spark.createDataFrame(rows, SCHEMA)))
    assert got[1]["text"] == "write to [EMAIL] now" and got[1]["n_chars"] == 20 and got[1]["score"] == 2.0
    assert got[2]["text"] is None and got[2]["n_chars"] is None


def test_fertility(odd):
    got = by_id(fertility.rate_documents(odd))
    for r in odd.collect():
        g = got[r["doc_id"]]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == base_counts(r["text"])
        assert g["base_failed"] and not g["kept"]


def test_packing(odd):
    rows = packing.pack_documents(odd).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 0) == 1
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) == 2 * rows_of(rows, 3)[0]["doc_tokens"]
    assert sum(r["length"] for r in rows if r["doc_id"] == 5) == rows_of(rows, 5)[0]["doc_tokens"]
    assert any(r["doc_id"] is None for r in rows)


def rows_of(rows, doc_id):
    return [r for r in rows if r["doc_id"] == doc_id]


def test_line_crf(odd):
    model = linecrf.Model(linecrf.np.zeros(linecrf.WIDTH), 1.0, linecrf.np.zeros((2, 2)))
    got = by_id(linecrf.score_documents(odd, model))
    assert all(0 <= r["score"] <= 1 and r["n_lines"] >= 1 for r in got.values())
    assert got[0]["score"] == got[1]["score"] == got[2]["score"]


def test_line_crf_without_labels(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert by_id(linecrf.quality_scores(odd, labels))[1]["score"] == pytest.approx(0.5)
    one = spark.createDataFrame([(3, 1, 0), (4, None, 0), (None, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert by_id(linecrf.quality_scores(odd, one))[1]["score"] > 0.9


def test_hyperminhash(odd):
    got = by_id(hyperminhash.near_duplicates(odd))
    want = near_duplicates([(r["doc_id"], r["text"]) for r in odd.collect() if r["doc_id"] is not None], 5, 80)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items() if i is not None} == want
    assert got[8]["component_id"] == 7 and not got[8]["kept"]
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_keep_one_of_each(odd):
    left = sorted((r["doc_id"] for r in hyperminhash.keep_one_of_each(odd).collect()), key=str)
    assert left == sorted([0, 1, 2, 3, 3, 4, 5, 6, 7, None], key=str)


def test_lm(odd):
    got = by_id(lm.folded_scores(odd))
    assert got[0]["n_tokens"] == 1 and got[0]["score"] == pytest.approx(got[1]["score"])
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in got.values())


VECTORS = "vec_id long, embedding array<float>, label int, rep long, key long, n int"


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, None, 1), (1, [], 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (6, [1.0, 0.0], None),
        (7, [1.0, 0.0], 1), (8, [2.0, 0.0], 1), (9, [1.0, 0.0], 2), (9, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [0.0, 1.0], 1), (None, [1.0, 0.0], 1),
    ]
    table = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], VECTORS)
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in lattice.near_duplicates(table).collect()]
    alone = [(i, 0, i, True) for i in (0, 1, 2, 3, 4, 5, 6, 10, 11)] + [(None, 0, None, True)]
    linked = [(7, 2, 7, True), (8, 2, 7, False), (9, 2, 7, False), (9, 0, 9, True)]
    assert sorted(got, key=str) == sorted(alone + linked, key=str)
    assert lattice.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_pages(spark):
    schema = "page_id long, url string, html string, digest string, length int"
    rows = [(1, "u\n", "x"), (2, None, "x"), (3, "a", None), (4, "b", ""), (None, "c", "x"), (1, "u", "x"), (5, "q", "é" * 300_000)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], schema)
    got = warc.read_archives(*warc.write_archives(pages)).collect()
    kinds = sorted([(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got], key=str)
    want = [(1, 1, "response", None)] * 2 + [(2, 1, "revisit", 1), (3, 0, "response", None), (4, 0, "revisit", 3), (None, 1, "revisit", 1), (5, 600_000, "response", None)]
    assert kinds == sorted(want, key=str)
    assert warc.read_archives(*warc.write_archives(pages.limit(0))).count() == 0
    large = warc.read_archives(*warc.write_archives(pages, min_revisit_bytes=1)).collect()
    assert {r["page_id"]: r["record_type"] for r in large}[4] == "response"


def test_licenses(spark):
    mit = licenses.TEMPLATES["mit"]
    texts = [None, "", "  \n", mit, LONG + " " + mit, "漢字 é " + mit, "mit", mit + "\n" + mit]
    rows = [(i, t, "en", "s", 1, 1.0, True, "x", 1) for i, t in enumerate(texts)]
    rows += [rows[3], (None, mit, None, None, None, None, None, None, None)]
    found = licenses.find_licenses(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    counts = sorted(((r["doc_id"], r["license"], r["coverage"]) for r in found), key=str)
    assert counts == sorted([(i, "mit", 1.0) for i in (3, 3, 4, 5, 7, 7, None)], key=str)
    by = {r["doc_id"]: r for r in found}
    assert texts[4][by[4]["start"] : by[4]["end"]] == mit.rstrip(".") and texts[5][by[5]["start"] : by[5]["end"]] == mit.rstrip(".")


def test_lines_are_drawn_from_the_whole_document():
    assert linecrf.stretches(1, 200, 200) == [(0, 200)] and linecrf.stretches(1, 0, 200) == [(0, 0)]
    found = [linecrf.stretches(i, 3005, 200) for i in range(50)]
    assert all(len(f) == 10 and all(b <= c for (_, b), (c, _) in zip(f, f[1:])) and f[-1][1] <= 3005 for f in found)
    starts = [a for f in found for a, _ in f]
    assert all(sum(low <= a < low + 601 for a in starts) > 50 for low in range(0, 3005, 601))


def test_repeated_documents_are_taught_once(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    rows = [(1, "a good line of words\nand another one"), (2, "## $$ ## $$")]
    once, often = (linecrf.train(spark.createDataFrame(rows * n, "doc_id long, text string"), labels) for n in (1, 30))
    assert (once.weights == often.weights).all() and once.bias == often.bias and (once.pairs == often.pairs).all()
