"""Every registered query: equal to its SQL twin where it has one, else it gives rows."""

from __future__ import annotations

import re

import pytest
from compare import connect, difference

import __spark_entry__ as entry

# Hundreds of rounds with several jobs each: minutes per query.  test_jobs.py fits each of them for a few rounds.
BOOSTED = {"train_boosted_xgb", "train_boosted_lgbm", "train_boosted_cat"}
# The corpus operators have tests of their own.
CORPUS = {name for name in entry.queries() if re.match(r"op\d+_|pipeline$", name)}


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - BOOSTED - CORPUS))
def test_query(spark, folder, connection, name):
    assert difference(entry.queries()[name](spark, folder), connection, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_but_the_corpus_ones_has_a_twin():
    assert set(entry.queries()) - CORPUS <= set(entry.oracle_sql())
