"""A run that failed goes on where it stopped."""

from __future__ import annotations

import os

import pytest

from tests.conftest import bronze_frames, order_row
from tillroll.plans import gold as gold_plan
from tillroll.plans import pipeline
from tillroll.plans.pipeline import run_pipeline
from tillroll.rules import SilverRules


def stored(spark, root, orders):
    """The landing tables as files, which give a run its identity."""
    out = {}
    for name, df in bronze_frames(spark, orders, returns=[("Yes", "O-2")]).items():
        df.write.mode("overwrite").parquet(f"{root}/in/{name}")
        out[name] = spark.read.parquet(f"{root}/in/{name}")
    return out


def rows(df):
    return sorted(map(str, df.drop("dw_load_date", "fact_key").collect()))


def test_a_failed_fact_resumes_after_the_dimensions(spark, tmp_root, monkeypatch):
    bronze = stored(spark, tmp_root, [order_row(1), order_row(2, order_id="O-2"), order_row(3, order_id="O-3", customer_id="C-2")])
    root = os.path.join(tmp_root, "wh")
    real = gold_plan.fact_sales

    def broken(*a, **k):
        raise RuntimeError("planted")
    monkeypatch.setattr(pipeline.gold_plan, "fact_sales", broken)
    with pytest.raises(RuntimeError, match="planted"):
        run_pipeline(spark, bronze, root=root, date_range="data", resume=True)
    monkeypatch.setattr(pipeline.gold_plan, "fact_sales", real)
    again = run_pipeline(spark, bronze, root=root, date_range="data", resume=True)
    status = {s.step: s.status for s in again.steps}
    assert status.pop("gold.fact_sales") == "ok" and set(status.values()) == {"resumed"} and len(status) == 12
    assert len([d for d in os.listdir(root) if d.startswith("run-")]) == 1
    whole = run_pipeline(spark, bronze, root=os.path.join(tmp_root, "other"), date_range="data")
    assert {s.status for s in whole.steps} == {"ok"}
    for name, df in whole.gold.tables().items():
        assert rows(df) == rows(again.gold.tables()[name]), name
    assert again.gold.rows == whole.gold.rows
    third = run_pipeline(spark, bronze, root=root, date_range="data", resume=True)
    assert {s.status for s in third.steps} == {"resumed"} and rows(third.gold.fact_sales) == rows(whole.gold.fact_sales)


def test_other_inputs_rules_or_options_start_anew(spark, tmp_root):
    bronze = stored(spark, tmp_root, [order_row(1)])
    root = os.path.join(tmp_root, "wh")

    def statuses(b, **kw):
        return {s.status for s in run_pipeline(spark, b, root=root, resume=True, **{"date_range": "data", **kw}).steps}
    assert statuses(bronze) == {"ok"} and statuses(bronze) == {"resumed"}
    assert statuses(bronze, rules=SilverRules().extended(order_date_overrides={"O-1": __import__("datetime").date(1998, 2, 2)})) == {"ok"}
    assert statuses(bronze, on_unmatched="quarantine") == {"ok"}
    assert statuses({**bronze, "orders": bronze["orders"].where("row_id > 0")}) == {"ok"}
    changed = stored(spark, tmp_root, [order_row(1), order_row(2, order_id="O-2")])
    assert statuses(changed) == {"ok"} and statuses(changed) == {"resumed"}
    memory = bronze_frames(spark, [order_row(1)])
    assert statuses(memory) == {"ok"} and statuses(memory) == {"ok"}
