"""Every registered query against its SQL, on the smallest tables.

Candidates are fitted at their small sizes here; ``python tools/compare.py`` runs the stated ones.
"""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as registry
from furrow.operators import training as ml
from furrow.plans import queries
from furrow.plans.oracles import ORACLES, ROWS_TO_FIT, SIZES, holdout
from tests.conftest import DATA
from tools.compare import compare, oracle_connection

@pytest.fixture(scope="module")
def connection():
    return oracle_connection(DATA)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(queries, "PROFILE", "smoke")
    for name, (_, depth) in SIZES.items():
        size = ml.ROUNDS["smoke"].get(name, 10)
        sql = holdout(name, size, depth)
        # A few trees do not order the rows as well as the stated ones.
        monkeypatch.setitem(ORACLES, f"train_{name}", sql)
    monkeypatch.setattr(queries, "AUC_FLOOR", 0.85)
    for name in ("cv_summary", "best_model"):
        monkeypatch.setitem(ORACLES, name, ORACLES[name].replace("'reference'", "'smoke'"))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_sql(spark, connection, name, small):
    good, note = compare(spark, connection, name, DATA)
    assert good, note


def test_stated_sizes():
    for name, model in ml.candidates("reference").items():
        assert (model.trees if hasattr(model, "trees") else model.rounds, model.depth) == SIZES[name]
        assert model.rows_to_fit == ROWS_TO_FIT
    net = ml.network()
    assert (net.passes, len(net.layers) + 1) == SIZES["mlp"]
    assert queries.PROFILE == "reference"


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(ORACLES) == set(queries.QUERIES)
    assert not [sql for sql in ORACLES.values() if re.search(r"(?i)using sample|tablesample", sql)]


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0
