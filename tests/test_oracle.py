"""Every registered query against its DuckDB statement on the driver tables."""

from __future__ import annotations

import importlib.util
import math
import os

import duckdb
import pytest

from tests.conftest import sf_dir
from tillroll.oracle import oracle_sql
from tillroll.plans.registry import queries

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = os.environ.get("TILLROLL_ORACLE_SF", "0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


ENTRY = _entry()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir(SF)}/{t}.parquet'")
    return con


def _normalise(rows, columns):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "None"
        if isinstance(v, float):
            return repr(v)          # exact: both engines divide identical doubles
        if hasattr(v, "item"):
            v = v.item()
        return str(v)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(ENTRY.queries()) and set(oracle_sql()) <= set(ENTRY.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, sf_dir(SF))
    got = df.collect()
    cur = duck.execute(oracle_sql()[name])
    expected = cur.fetchall()
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(expected)
    assert _normalise([tuple(r) for r in got], df.columns) == _normalise(expected, cols)


def test_entry_runs(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
    assert "total_orders" in df.columns


def test_a_wrong_rule_value_turns_rows_red(spark, duck):
    from tillroll.plans import silver
    from tillroll.plans.registry import comparable, warehouse_for
    from tillroll.sources.adapter import FIXTURE_RULES

    wrong = FIXTURE_RULES.extended(order_date_overrides={"O-100": __import__("datetime").date(1999, 1, 1)})
    bronze = warehouse_for(spark, sf_dir(SF)).bronze
    got = comparable(silver.silver_orders(bronze["orders"], wrong, load_stamp=False))
    cur = duck.execute(oracle_sql()["silver_orders_clean"])
    expected, cols = cur.fetchall(), [d[0] for d in cur.description]
    assert _normalise([tuple(r) for r in got.collect()], got.columns) != _normalise(expected, cols)


def test_a_wrong_dimension_column_or_attribute_turns_rows_red(spark, duck, monkeypatch):
    """The statements state the dimensions and the relationships on their own."""
    from tillroll.plans import gold, measures
    from tillroll.plans.registry import warehouse_for

    wh = warehouse_for(spark, sf_dir(SF))

    def red(got, name):
        cur = duck.execute(oracle_sql()[name])
        expected, cols = cur.fetchall(), [d[0] for d in cur.description]
        return _normalise([tuple(r) for r in got.collect()], got.columns) != _normalise(expected, cols)
    spec = dict(gold.DIMENSIONS["dim_customer"], columns=["customer_id", "segment"])
    monkeypatch.setitem(gold.DIMENSIONS, "dim_customer", spec)
    assert red(gold.dimension(wh.silver["orders"], "dim_customer"), "dim_customer")
    monkeypatch.undo()
    wrong = {**measures.RELATIONSHIPS, "location_key": ("dim_location", {"state": "region"})}
    monkeypatch.setattr(measures, "RELATIONSHIPS", wrong)
    assert red(measures.measures(wh.gold, by=["region"], names=["total_sales", "total_quantity", "average_discount"], numeric="double"), "measures_additive")
    monkeypatch.undo()
    assert not red(gold.dimension(wh.silver["orders"], "dim_customer"), "dim_customer")


def test_planted_cases_are_there(spark):
    wh = {n: queries()[n](spark, sf_dir(SF)).collect() for n in (
        "fact_quarantine", "dq_duplicate_natural_keys", "dq_text_lengths", "dq_key_uniqueness", "dq_unmatched_keys", "dq_optional_keys")}
    assert wh["fact_quarantine"] and wh["dq_unmatched_keys"][0].null_location_key > 0
    assert {r.dim_name for r in wh["dq_duplicate_natural_keys"]} >= {"dim_customer", "dim_location", "dim_sales_person"}
    assert any(r.n_too_long for r in wh["dq_text_lengths"]) and any(r.n_duplicate_keys for r in wh["dq_key_uniqueness"])
    assert wh["dq_optional_keys"][0].null_sales_person_key > 0
