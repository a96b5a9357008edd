"""End-to-end run (R3-R6): bronze -> silver -> gold, with step results.

Each run writes into its own folder ``<root>/<run_id>/<layer>/<table>`` and
reads every layer back before building the next, so

* lineage is cut at each layer (an executor lost later recomputes from the
  written files, not from the raw inputs);
* the dimension keys in the fact are exactly the persisted ones (R6);
* each write's observed row count is a proven size for broadcast decisions;
* nothing is visible to readers until the run has finished: a failed check
  leaves an unpublished folder, never a half-overwritten table (G13).

``root`` defaults to ``<spark.checkpoint.dir>/tillroll``, the shared folder
the cluster names.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.keys import partitions_for
from tillroll.operators.quality import DataQualityError, any_null, null_count_columns
from tillroll.plans import gold as gold_plan
from tillroll.plans import silver as silver_plan
from tillroll.plans.catalog import publish_catalog
from tillroll.plans.gold import Gold
from tillroll.plans.manifest import Manifest, earlier_run, register_run, run_digest
from tillroll.plans.views import VIEWS
from tillroll.rules import DEFAULT_DATE_RANGE, SilverRules
from tillroll.schemas import DIMENSIONS, FACT_NOT_NULL, TEXT_LENGTHS
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.layout import Layout, file_statistics, write_by_key
from tillroll.sources.sinks import fact_layout, passes_for, register_view, write_passes, write_table

log = logging.getLogger("tillroll.pipeline")

#: Bits of the fact's key below the number of its pass: a place within a task and the task.
KEY_BITS = 60


@dataclass
class StepResult:
    step: str
    status: str
    rows: int | None
    seconds: float
    error: str | None = None


@dataclass
class Warehouse:
    root: str
    bronze: dict
    silver: dict
    gold: Gold | None
    steps: list = field(default_factory=list)
    warnings: list = field(default_factory=list)
    quarantine: DataFrame | None = None
    stage_seconds: dict = field(default_factory=dict)
    layouts: list = field(default_factory=list)
    lattice: object = None

    def step_results(self, spark: SparkSession) -> DataFrame:
        """One row per step (bounded by the number of steps)."""
        rows = [(s.step, s.status, s.rows, float(s.seconds), s.error) for s in self.steps]
        return spark.createDataFrame(
            rows, "step string, status string, rows long, seconds double, error string")


def default_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillroll"


class _Runner:
    def __init__(self, spark: SparkSession, run_dir: str, on_error: str, resume: bool = False):
        self.spark = spark
        self.manifest = Manifest(spark, run_dir) if resume else None
        self.resumed: set[str] = set()
        self.run_dir = run_dir
        self.on_error = on_error
        self.steps: list[StepResult] = []
        self.failed: set[str] = set()
        self.order: list[str] = []
        self.stage_seconds: dict[str, float] = {}

    def persist(self, layer: str, name: str, make, **kw) -> tuple[DataFrame, dict]:
        """Write a table and read it back; with a manifest, a table that an earlier attempt finished is only read.

        ``make`` is the table or, where planning it already runs jobs, a function that gives it, or its parts to be written in turn.
        """
        path, step = f"{self.run_dir}/{layer}/{name}", f"{layer}.{name}"
        if self.manifest and (done := self.manifest.done(step)):
            self.resumed.add(step)
            return self.spark.read.schema(done[0]).parquet(path), done[1]
        df = make() if callable(make) else make
        # The tables of lines; a smaller file of a dimension would only have the planner take it for a smaller table.
        kw["compression"] = "zstd" if name in ("orders", "fact_sales") else None
        if isinstance(df, list):
            metrics, df = write_passes(df, path, **kw), df[0]
        else:
            metrics = write_table(df, path, **kw)
        if self.manifest:
            self.manifest.add(step, df.schema, metrics)
        # Read back with the written schema: an empty partitioned table has
        # no files to infer it from.
        return self.spark.read.schema(df.schema).parquet(path), metrics

    def step(self, name: str, fn, depends_on=()):
        if any(d in self.failed for d in depends_on):
            self.steps.append(StepResult(name, "skipped", None, 0.0, "dependency failed"))
            self.failed.add(name)
            return None
        start = time.perf_counter()
        try:
            result, rows = fn()
        except Exception as exc:  # R4: record, then stop or continue
            self.steps.append(StepResult(name, "failed", None, time.perf_counter() - start, str(exc)))
            self.failed.add(name)
            log.error("step %s failed: %s", name, exc)
            if self.on_error == "fail":
                raise
            return None
        status = "resumed" if name in self.resumed else "ok"
        self.steps.append(StepResult(name, status, rows, time.perf_counter() - start))
        log.info("step %s: %s rows", name, rows)
        return result

    def skip(self, stage: str, names: list[str]) -> None:
        """Record steps that cannot run because an input is missing."""
        self.order.extend(names)
        self.stage_seconds[stage] = 0.0
        for name in names:
            self.steps.append(StepResult(name, "skipped", None, 0.0, "input missing"))
            self.failed.add(name)

    def group(self, stage: str, steps: list) -> list:
        start = time.perf_counter()
        try:
            return self._group(steps)
        finally:
            self.stage_seconds[stage] = time.perf_counter() - start

    def _group(self, steps: list) -> list:
        """Run independent steps concurrently (each is its own Spark job).

        Small jobs -- dimensions, side tables -- leave most of a cluster idle
        when run one after another; submitted together they share it.
        """
        self.order.extend(name for name, _, _ in steps)
        if len(steps) == 1:
            name, fn, deps = steps[0]
            return [self.step(name, fn, deps)]
        with ThreadPoolExecutor(max_workers=len(steps)) as pool:
            futures = [pool.submit(self.step, name, fn, deps) for name, fn, deps in steps]
            errors, results = [], []
            for fut in futures:
                try:
                    results.append(fut.result())
                except Exception as exc:
                    errors.append(exc)
                    results.append(None)
        if errors:
            raise errors[0]
        return results


def run_pipeline(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    root: str | None = None,
    rules: SilverRules | None = None,
    date_range: tuple[dt.date, dt.date] | str | None = None,
    dedupe: str = "distinct",
    on_unmatched: str = "fail",
    on_error: str = "fail",
    register_views: bool = True,
    broadcast_limit: int | None = None,
    run_id: str | None = None,
    collation: str | None = None,
    publish: bool = False,
    on_overlong: str = "warn",
    resume: bool = False,
) -> Warehouse:
    """Run every layer; see the module docstring for the guarantees.

    ``on_unmatched``: 'fail' (default) raises when a required fact key is
    missing, 'warn' records a warning, 'quarantine' sets those rows aside in
    a partition of ``gold/fact_sales`` that readers leave out.  ``on_error``: 'fail' stops at the first
    failing step, 'continue' records it and skips its dependants.
    ``collation`` (e.g. 'UTF8_LCASE_RTRIM') makes every text comparison of
    silver and gold follow it, as a case-insensitive server collation would.
    ``publish`` points ``<root>/_published`` and the catalog's names at this run
    once it succeeded.
    ``date_range``: (start, end), None for the default range, or 'data' for
    the whole calendar years spanned by the silver order and ship dates.
    ``on_overlong``: landing text longer than its declared length is a
    warning ('warn', default), an error ('fail') or not checked ('ignore').
    Declared NOT NULL dimension columns follow ``on_unmatched`` ('quarantine'
    leaves such members out, so their fact rows are set aside with the rest).
    ``resume`` goes on with the newest run of equal inputs, rules and options:
    steps that it finished are read, the others run (see
    :mod:`tillroll.plans.manifest`).
    """
    root = (root or default_root(spark)).rstrip("/")
    if resume and not run_id:
        run_id = earlier_run(spark, root, run_digest(bronze, rules, date_range, dedupe, on_unmatched, collation, on_overlong, broadcast_limit))
    run_id = run_id or f"run-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    run_dir = f"{root}/{run_id}"
    derive_range = date_range == "data"
    start, end = DEFAULT_DATE_RANGE if derive_range or not date_range else date_range
    runner = _Runner(spark, run_dir, on_error, resume)
    if resume:
        register_run(spark, root, run_id, run_digest(bronze, rules, date_range, dedupe, on_unmatched, collation, on_overlong, broadcast_limit))
    wh = Warehouse(root=run_dir, bronze={}, silver={}, gold=None)

    # -- bronze: land the inputs with their declared types (S7) ---------------
    def land(name, df):
        def run():
            # Q5: overlong text, counted while landing (no second pass).
            lengths = {} if on_overlong == "ignore" else TEXT_LENGTHS.get(name, {})
            present = {c: n for c, n in lengths.items() if c in df.columns}
            checks = [F.count_if(F.length(c) > n).alias(f"long_{c}") for c, n in present.items()]
            out, m = runner.persist("bronze", name, df, extra_metrics=checks)
            long = {c: m[f"long_{c}"] for c in present if m[f"long_{c}"]}
            if long:
                detail = ", ".join(f"{c} > {present[c]}: {k}" for c, k in long.items())
                message = f"bronze.{name}: text longer than declared ({detail})"
                if on_overlong == "fail":
                    raise DataQualityError(message)
                wh.warnings.append(message)
            return out, m["rows"]
        return run
    landed = runner.group("bronze", [(f"bronze.{n}", land(n, df), ()) for n, df in bronze.items()])
    wh.bronze = dict(zip(bronze, landed))

    # -- silver (R1) -------------------------------------------------------------
    silver_rows: dict[str, int] = {}
    observed: dict = {}
    if not all(wh.bronze.get(n) is not None for n in ("orders", "people", "returns_order")):
        runner.skip("silver", ["silver.orders", "silver.people", "silver.returns_order"])
    else:
        built = silver_plan.build_silver(wh.bronze, rules, collation=collation)

        def clean(name, make):
            def run():
                # The date range is observed while writing (no second pass).
                bounds = gold_plan.date_bounds() if name == "orders" and derive_range else None
                out, m = runner.persist("silver", name, make, extra_metrics=bounds)
                silver_rows[name] = m["rows"]
                if bounds:
                    observed.update(m)
                return out, m["rows"]
            return run
        cleaned = runner.group("silver", [(f"silver.{n}", clean(n, make), [f"bronze.{n}"]) for n, make in built.items()])
        wh.silver = dict(zip(built, cleaned))

    # -- gold dimensions (R2) ------------------------------------------------------
    if derive_range and wh.silver.get("orders") is not None:
        start, end = gold_plan.whole_years(observed["first_date"], observed["last_date"])
    rows: dict[str, int] = {"dim_date": gold_plan.date_range_days(start, end)}
    if "returns_order" in silver_rows:
        rows["silver_returns_order"] = silver_rows["returns_order"]
    dims: dict[str, DataFrame] = {}

    def build_date():
        out, m = runner.persist("gold", "dim_date", gold_plan.dim_date(spark, start, end))
        rows["dim_date"] = m["rows"]
        return out, m["rows"]
    silver_orders = wh.silver.get("orders")

    def build_dim(name):
        def run():
            # The source's proven row count bounds the dimension's size.
            if name == "dim_sales_person":
                parts = partitions_for(wh.silver["people"], silver_rows.get("people"))
                make = lambda: gold_plan.dim_sales_person(wh.silver["people"], parts)
            else:
                parts = partitions_for(silver_orders, silver_rows.get("orders"))
                make = lambda: gold_plan.dimension(silver_orders, name, dedupe, parts,
                                                   drop_missing_required=on_unmatched == "quarantine")
            # Q2: declared NOT NULL natural keys, counted while writing.
            required = DIMENSIONS[name]["required"]
            out, m = runner.persist("gold", name, make, extra_metrics=null_count_columns(required))
            missing = {c: m[f"null_{c}"] for c in required if m[f"null_{c}"]}
            if missing:
                message = f"gold.{name}: required columns missing ({missing})"
                if on_unmatched == "fail":
                    raise DataQualityError(message)
                wh.warnings.append(message)
            rows[name] = m["rows"]
            return out, m["rows"]
        return run
    dim_steps = [("gold.dim_date", build_date, ())]
    for name in gold_plan.DIMENSION_NAMES:
        source = "silver.people" if name == "dim_sales_person" else "silver.orders"
        dim_steps.append((f"gold.{name}", build_dim(name), [source]))
    built_dims = runner.group("gold_dims", dim_steps)
    dim_date_df = built_dims[0]
    dims.update(zip(gold_plan.DIMENSION_NAMES, built_dims[1:]))

    # -- gold fact, checked before it is published (Q1/Q2, G3) ---------------------
    fact_deps = ["silver.orders", "silver.returns_order", "gold.dim_date",
                 *[f"gold.{n}" for n in gold_plan.DIMENSION_NAMES]]

    def build_fact():
        checks = [F.count_if(any_null(FACT_NOT_NULL)).alias("missing"),
                  *null_count_columns(FACT_NOT_NULL)]
        # One write: set-aside rows go to a partition of their own.
        parts = ["_quarantined", "order_year"] if on_unmatched == "quarantine" else ["order_year"]

        def arranged(lines):
            out = fact_layout(lines)
            return out.withColumn("_quarantined", any_null(FACT_NOT_NULL)) if on_unmatched == "quarantine" else out

        def laid_out():
            # By stretches of dates, so that files stay narrow in the order date; their keys are numbered apart.
            slices = gold_plan.date_slices(silver_orders, passes_for(silver_rows.get("orders")))
            made = [gold_plan.fact_sales(lines, wh.silver["returns_order"], dim_date_df, dims, rows, broadcast_limit, arranged) for lines in slices]
            return [df.withColumn("fact_key", F.col("fact_key") + F.lit(i << KEY_BITS)) for i, df in enumerate(made)]
        out, m = runner.persist("gold", "fact_sales", laid_out, partition_by=parts, extra_metrics=checks)
        if m["missing"]:
            detail = ", ".join(f"{k}={m['null_' + k]}" for k in FACT_NOT_NULL if m["null_" + k])
            message = f"fact_sales: {m['missing']} rows with missing required columns (unmatched dimension keys or no order id) ({detail})"
            if on_unmatched == "fail":
                raise DataQualityError(message)
            wh.warnings.append(message)
        kept = m["rows"]
        if on_unmatched == "quarantine":
            wh.quarantine = out.filter("_quarantined").drop("_quarantined")
            out, kept = out.filter("NOT _quarantined").drop("_quarantined"), m["rows"] - m["missing"]
        rows["fact_sales"] = kept
        return out, kept
    fact = runner.group("gold_fact", [("gold.fact_sales", build_fact, fact_deps)])[0]

    if fact is not None:
        wh.gold = Gold(dim_date=dim_date_df, fact_sales=fact, rows=rows, **dims)
        if register_views:
            for layer in ("bronze", "silver"):
                for name, df in getattr(wh, layer).items():
                    if df is not None:
                        register_view(df, f"{layer}_{name}")
            for name, df in wh.gold.tables().items():
                register_view(df, f"gold_{name}")
            for name, view in VIEWS.items():
                register_view(view(wh.gold), f"gold_{name}")
    wh.stage_seconds = dict(runner.stage_seconds)
    wh.steps = sorted(runner.steps, key=lambda r: runner.order.index(r.step))
    if publish and wh.gold is not None and not runner.failed:
        publish_run(spark, root, wh)
        publish_names(spark, wh)
    return wh


def index_fact(spark: SparkSession, wh: Warehouse) -> list[Layout]:
    """The fact's layouts for :func:`tillroll.sources.layout.read_where`, by order date and by the other keys.

    Written once per run, below the run's folder; the copy by key costs the
    fact's size in storage, as a covering index does.
    """
    if not wh.layouts:
        good = [f"{wh.root}/gold/fact_sales"]
        schema = wh.gold.fact_sales.schema
        if wh.quarantine is not None:
            good = [f"{good[0]}/_quarantined=false"]
        wh.layouts = [file_statistics(spark, good[0], schema, to=f"{wh.root}/layouts/fact_sales_files"),
                      write_by_key(wh.gold.fact_sales, f"{wh.root}/layouts/fact_sales_by_key", wh.gold.rows.get("fact_sales"))]
    return wh.layouts


def publish_names(spark: SparkSession, wh: Warehouse) -> None:
    """The run's tables and views under the schemas bronze, silver and gold."""
    publish_catalog(spark, wh.root, {
        "bronze": [n for n, df in wh.bronze.items() if df is not None],
        "silver": [n for n, df in wh.silver.items() if df is not None],
        "gold": list(wh.gold.tables())})


def prune_runs(spark: SparkSession, root: str | None = None, keep: int = 3) -> list[str]:
    """Delete all but the newest ``keep`` runs below ``root`` and return the deleted folders.

    The published run is never deleted, whatever its age, nor is anything that
    is not a run folder.  Run ids begin with the time they started, so their
    order by name is their order in time.
    """
    if keep < 1:
        raise ValueError("keep at least one run")
    root = (root or default_root(spark)).rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(conf)
    if not fs.exists(folder):
        return []
    runs = sorted(s.getPath().getName() for s in fs.listStatus(folder)
                  if s.isDirectory() and s.getPath().getName().startswith("run-"))
    published = {_published_record(spark, root)["run"].rstrip("/").rpartition("/")[2]} if fs.exists(
        jvm.org.apache.hadoop.fs.Path(f"{root}/_published")) else set()
    gone = [r for r in runs[:-keep] if r not in published]
    for run in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{run}"), True)
    return [f"{root}/{r}" for r in gone]


def _published_record(spark: SparkSession, root: str) -> dict:
    records = spark.read.text(f"{root}/_published").select(
        F.get_json_object("value", "$.published_at").alias("at"), "value")
    return json.loads(records.orderBy(F.col("at").desc()).first()["value"])


def publish_run(spark: SparkSession, root: str, wh: Warehouse) -> None:
    """Make ``wh`` the run readers open.

    Publishing appends one small record (run folder, proven row counts,
    time) to ``<root>/_published``; nothing is deleted or rewritten, so a
    reader sees either the previous newest record or this one, and a failed
    publish leaves the previous one in force.
    """
    record = json.dumps({"run": wh.root, "rows": wh.gold.rows,
                         "published_at": dt.datetime.now(dt.timezone.utc).isoformat()})
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("append").text(
        f"{root.rstrip('/')}/_published")


def open_published(spark: SparkSession, root: str | None = None) -> Gold:
    """Open the gold layer of the newest published run, with its row counts."""
    root = (root or default_root(spark)).rstrip("/")
    record = _published_record(spark, root)
    run = record["run"]
    tables = {name: spark.read.parquet(f"{run}/gold/{name}")
              for name in ["dim_date", *gold_plan.DIMENSION_NAMES, "fact_sales"]}
    if "_quarantined" in tables["fact_sales"].columns:
        tables["fact_sales"] = tables["fact_sales"].filter("NOT _quarantined").drop("_quarantined")
    return Gold(rows=record["rows"], **tables)
