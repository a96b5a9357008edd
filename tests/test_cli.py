"""The command line runs every layer from landing files and publishes the run."""

from __future__ import annotations

import os

from tillroll.__main__ import main
from tillroll.plans.pipeline import open_published

HEADER = ("Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country/Region,"
          "City,State,Postal Code,Region,Product ID,Category,Sub-Category,Product Name,Sales,Quantity,"
          "Discount,Profit")


def _write(root, name, lines):
    path = os.path.join(root, name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_cli_run_tolerant(spark, tmp_root):
    orders = _write(tmp_root, "orders.csv", [
        HEADER,
        "1,CA-1,2016-01-02,2016-01-05,null,C-1,Ann,Consumer,123,Burlington,Vermont,,East,P-1,Office,Paper,a  b,10.5,2,0.2,1.25",
        "2,CA-2,2016-02-02,2016-02-03,Second Class,C-2,Bob,Corporate,United States,Austin,Texas,73301,Central,"
        "P-2,Office,Paper,c d,5,1,0,0.5",
        "3,CA-3,not a date,2016-02-03,Second Class,C-2,Bob,Corporate,United States,Austin,Texas,73301,Central,"
        "P-2,Office,Paper,c d,5,1,0,0.5",
    ])
    people = _write(tmp_root, "people.csv", ["Person,Region", "Ann Rep,East", "Bob Rep,Central"])
    returns = _write(tmp_root, "returns.csv", ["Returned,Order ID", "Yes,CA-2"])
    root = os.path.join(tmp_root, "wh")
    code = main(["run", "--orders", orders, "--people", people, "--returns", returns, "--root", root,
                 "--tolerant"])
    assert code == 0
    gold = open_published(spark, root)
    facts = {r.order_id: r for r in gold.fact_sales.collect()}
    assert set(facts) == {"CA-1", "CA-2"} and facts["CA-2"].is_returned == 1
    rejected = spark.read.parquet(f"{gold.fact_sales.inputFiles()[0].split('/gold/')[0]}/bronze/orders_rejected")
    assert rejected.count() == 1
    assert main(["show", "monthly_trends", "--root", root]) == 0


def test_readme_example(spark, tmp_root):
    from tillroll.plans import views
    from tillroll.plans.measures import measures
    from tillroll.plans.pipeline import run_pipeline
    from tillroll.sources.readers import read_landing
    landing = {
        "orders": _write(tmp_root, "orders.csv", [
            HEADER,
            "1,CA-1,2016-01-02,2016-01-05,Second Class,C-1,Ann,Consumer,United States,Austin,Texas,73301,"
            "Central,P-1,Office,Paper,a b,10.5,2,0.2,1.25"]),
        "people": _write(tmp_root, "people.csv", ["Person,Region", "Ann Rep,Central"]),
        "returns_order": _write(tmp_root, "returns.csv", ["Returned,Order ID", "Yes,CA-1"]),
    }
    bronze = {t: read_landing(spark, t, path) for t, path in landing.items()}
    wh = run_pipeline(spark, bronze, root=os.path.join(tmp_root, "wh"))
    assert views.monthly_trends(wh.gold).orderBy("year", "month").count() == 1
    assert measures(wh.gold, by=["segment", "year"], date_role="ship").first().total_orders == 1
    assert spark.sql("SELECT * FROM gold_vw_regional_performance").first().sales_person == "Ann Rep"


def test_names_are_published_and_old_runs_pruned(spark, tmp_root):
    import os

    from tests.conftest import bronze_frames, order_row
    from tillroll.plans import views
    from tillroll.plans.pipeline import prune_runs, run_pipeline

    root = os.path.join(tmp_root, "warehouse")
    range_ = (__import__("datetime").date(1998, 1, 1), __import__("datetime").date(1998, 12, 31))
    runs = [run_pipeline(spark, bronze_frames(spark, [order_row(i), order_row(i + 1, order_id="O-2", postal_code=None)]), root=root,
                         date_range=range_, on_unmatched="quarantine", publish=i == 1) for i in range(4)]
    assert spark.sql("SELECT * FROM gold.vw_monthly_trends ORDER BY year, month").first().total_orders == 1
    assert spark.table("gold.fact_sales").count() == 1 and spark.table("bronze.orders").count() == 2
    published = runs[1].gold
    for name, make in views.VIEWS.items():
        by_name, made = spark.table(f"gold.{name}"), make(published)
        assert by_name.select(made.columns).exceptAll(made).count() == 0 == made.exceptAll(by_name.select(made.columns)).count()
    gone = prune_runs(spark, root, keep=1)
    assert sorted(gone) == sorted([runs[0].root, runs[2].root])
    assert spark.table("gold.fact_sales").count() == 1 and runs[3].gold.fact_sales.count() == 1
    assert prune_runs(spark, root, keep=1) == []
