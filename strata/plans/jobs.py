"""Jobs: bronze, silver and gold publishes, and the gated pipeline.

Each job is a few Spark actions orchestrated by plain Python on the driver;
the data never passes through the driver, only counts and check results do.
Every step appends one audit record (success or failure) for the run.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import contract as C
from strata.functions import predicates as P
from strata.functions.names import missing_columns
from strata.operators import checks, marts, silver
from strata.sources import audit as A
from strata.sources import landing, publish, storage


class GateClosed(RuntimeError):
    """A check said no: nothing after it runs and nothing it guards is published."""


@dataclass
class PipelineConfig:
    period_start: str
    period_end: str
    source_file: str
    root: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    pipeline: str = "trips_medallion"
    bronze_schema: str = "strata_bronze"
    silver_schema: str = "strata_silver"
    gold_schema: str = "strata_gold"
    # "block": a failing raw check stops the run; "report": it is audited only
    raw_gate: str = "block"

    @property
    def bronze_table(self) -> str:
        return f"{self.bronze_schema}.trips"

    @property
    def silver_table(self) -> str:
        return f"{self.silver_schema}.trips"

    @property
    def split_table(self) -> str:
        """What silver and quarantine are views over; its switch publishes both."""
        return f"{self.silver_schema}.trips_split"

    @property
    def quarantine_table(self) -> str:
        return f"{self.silver_schema}.trips_quarantine"

    @property
    def daily_table(self) -> str:
        return f"{self.gold_schema}.mart_daily_trip_metrics"

    @property
    def monthly_table(self) -> str:
        return f"{self.gold_schema}.mart_monthly_trip_kpis"

    @property
    def quality_table(self) -> str:
        return f"{self.gold_schema}.mart_data_quality_summary"

    @property
    def audit_path(self) -> str:
        return posixpath.join(self.root, "audit")

    def versions(self, table: str) -> str:
        return posixpath.join(self.root, "versions", table)


def default_config(spark: SparkSession, **overrides) -> PipelineConfig:
    base = dict(root=storage.work_root(spark))
    base.update(overrides)
    return PipelineConfig(**base)


def _version_dir(cfg: PipelineConfig, table: str) -> str:
    """A new folder per write, named after the run that made it."""
    return posixpath.join(cfg.versions(table), f"{cfg.run_id}-{uuid.uuid4().hex[:12]}")


def _audited(spark: SparkSession, cfg: PipelineConfig, step: str, body: Callable[[dict], None],
             began: datetime | None = None, report_success: bool = True) -> dict:
    """Run ``body(fields)``; append a SUCCESS or FAILED record with the fields it set.

    A step done in two parts reports its success with the second, which says when
    the first ``began``.
    """
    fields: dict = {"source_file": cfg.source_file}
    started = began or A.clock()
    try:
        body(fields)
    except Exception as err:
        rec = A.record(cfg.run_id, cfg.pipeline, step, A.FAILED, started,
                       error_type=type(err).__name__, error_message=str(err), **fields)
        A.append_audit(spark, rec, cfg.audit_path)
        raise
    rec = A.record(cfg.run_id, cfg.pipeline, step, A.SUCCESS, started, **fields)
    if report_success:
        A.append_audit(spark, rec, cfg.audit_path)
    return rec


def ensure_layers(spark: SparkSession, cfg: PipelineConfig) -> None:
    publish.ensure_schemas(spark, [cfg.bronze_schema, cfg.silver_schema, cfg.gold_schema],
                           comment="medallion layer", root=cfg.root)


def resolve_tables(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Point the layers' names at their last published versions under ``cfg.root``.

    A session with its own in-memory catalog does not know what another process
    published; the audit under the root does.
    """
    ensure_layers(spark, cfg)
    published = A.read_audit(spark, cfg.audit_path).filter(
        (F.col("status") == A.SUCCESS) & F.col("table_location").isNotNull())
    # one row per table: a handful
    last = published.groupBy("table_name").agg(F.max_by("table_location", "ended_at").alias("path"))
    found = {r["table_name"]: r["path"] for r in last.collect()}
    for name in (cfg.bronze_table, cfg.daily_table, cfg.monthly_table, cfg.quality_table):
        if name in found and not spark.catalog.tableExists(name):
            publish.point_table(spark, name, found[name], spark.read.parquet(found[name]).schema)
    if cfg.silver_table in found and not spark.catalog.tableExists(cfg.split_table):
        path = found[cfg.silver_table]
        publish_split(spark, cfg, publish.Staged(path, {"rows": None}, spark.read.parquet(path).schema, ()))


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------

def job_bronze(spark: SparkSession, raw: DataFrame | Callable[[], DataFrame], cfg: PipelineConfig,
               expected_rows: int | None = None) -> dict:
    """Raw plus lineage, published as a new version of the bronze table.

    ``raw`` may be a function that opens the input, so that a missing file is an
    audited failure of this step. ``expected_rows`` is the raw gate's count.
    """
    ensure_layers(spark, cfg)

    def body(f: dict) -> None:
        bronze = silver.add_lineage(raw() if callable(raw) else raw, cfg.source_file)
        staged = publish.stage(bronze, _version_dir(cfg, cfg.bronze_table))
        rows = staged.metrics["rows"]
        f.update(raw_count=rows)
        if expected_rows is not None and rows != expected_rows:
            raise GateClosed(f"bronze has {rows} rows, the raw input had {expected_rows}")
        publish.publish(spark, cfg.bronze_table, staged)
        f.update(table_name=cfg.bronze_table, table_location=staged.path)

    return _audited(spark, cfg, "bronze", body)


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------

SILVER_PARTITIONS = ("year", "month")
# Never null in the staging model, so not in silver, which it renames.
STAGING_KEYS = (C.PICKUP.lower(), C.DROPOFF.lower(), "_source_file")


def stage_silver(spark: SparkSession, bronze: DataFrame, cfg: PipelineConfig) -> publish.Staged:
    """Write silver and quarantine from ONE scan of bronze, with their counts.

    Rows are labelled by the split and written partitioned by
    ``_layer/year/month``; the Observation on that write yields the raw,
    silver and quarantine counts, so reconciliation needs no extra pass.
    """
    labelled = silver.labelled(bronze, cfg.period_start, cfg.period_end)
    pick, drop = F.col(C.PICKUP.lower()), F.col(C.DROPOFF.lower())
    bound = P.column_type(labelled, C.PICKUP.lower())
    outside = (pick < P.ts_bound(cfg.period_start, bound)) | (pick >= P.ts_bound(cfg.period_end, bound))
    labelled = publish.with_year_month(labelled, C.PICKUP.lower())
    layer = F.col(silver.LAYER_COLUMN)
    kept = layer == F.lit(silver.SILVER)
    # Quarantined rows lie in any month, so without clustering every task would
    # write a file for every month; REBALANCE also splits a heavy month.
    return publish.stage(
        labelled,
        _version_dir(cfg, cfg.silver_table),
        partition_by=(silver.LAYER_COLUMN, *SILVER_PARTITIONS),
        metrics=[F.count_if(kept).alias("silver"),
                 F.count_if(layer == F.lit(silver.QUARANTINE)).alias("quarantine"),
                 F.count_if(kept & (drop < pick)).alias(C.DROPOFF_BEFORE_PICKUP),
                 F.count_if(kept & outside).alias(C.PICKUP_OUTSIDE_PERIOD),
                 *[F.count_if(kept & F.col(c).isNull()).alias(f"null_{c}") for c in STAGING_KEYS]],
        rebalance=True,
    )


def silver_gate(staged: publish.Staged) -> list[str]:
    """The silver rules that a staged write breaks, from what was observed in it."""
    m = staged.metrics
    broken = [rule for rule in (C.DROPOFF_BEFORE_PICKUP, C.PICKUP_OUTSIDE_PERIOD) if m[rule]]
    broken += [f"null_{c}" for c in STAGING_KEYS if m.get(f"null_{c}")]
    if m["rows"] != m["silver"] + m["quarantine"]:
        broken.insert(0, C.RECONCILIATION)
    names = [f.name for f in staged.schema.fields]
    return broken + [C.SILVER_SCHEMA] * bool(missing_columns(C.EXPECTED_SILVER_COLUMNS, names))


def reconcile(metrics: dict) -> tuple[int, int, int]:
    """Raise unless raw = silver + quarantine (checked before publishing)."""
    raw, s, q = metrics["rows"], metrics["silver"], metrics["quarantine"]
    if raw != s + q:
        raise RuntimeError(f"the split lost or doubled rows: {s} kept and {q} rejected of {raw}")
    return raw, s, q


def publish_split(spark: SparkSession, cfg: PipelineConfig, staged: publish.Staged) -> None:
    """Silver and quarantine of one staged version, by one switch."""
    layer = silver.LAYER_COLUMN
    publish.publish_parts(spark, cfg.split_table, staged, {
        cfg.silver_table: (f"{layer} = '{silver.SILVER}'", (layer, C.REASON_COLUMN)),
        cfg.quarantine_table: (f"{layer} = '{silver.QUARANTINE}'", (layer,)),
    })


def job_silver(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame | None = None,
               expected_rows: int | None = None) -> dict:
    """Split bronze, check the staged write, then publish both tables.

    Both are replaced as one whole version by one switch, so a run without
    rejected rows leaves an empty quarantine table and no stale rows, and no
    reader sees new silver beside old quarantine. Nothing is published when a
    count or a silver rule fails.
    """
    ensure_layers(spark, cfg)

    def body(f: dict) -> None:
        source = bronze if bronze is not None else spark.table(cfg.bronze_table)
        staged = stage_silver(spark, source, cfg)
        m = staged.metrics
        f.update(raw_count=m["rows"], silver_count=m["silver"], quarantine_count=m["quarantine"])
        reconcile(m)
        if expected_rows is not None and m["rows"] != expected_rows:
            raise GateClosed(f"silver saw {m['rows']} rows, the raw input had {expected_rows}")
        if broken := silver_gate(staged):
            raise GateClosed(f"silver validation failed: {', '.join(broken)}")
        publish_split(spark, cfg, staged)
        f.update(table_name=cfg.silver_table, table_location=staged.path)

    return _audited(spark, cfg, "silver", body)


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class MartContract:
    """What must hold of a mart before it is published."""

    keys: tuple[str, ...]  # one row for each
    not_null: tuple[str, ...]
    trips: str | None = None  # adds up to the fact's rows


GOLD_CONTRACTS = {
    "gold_daily": MartContract(("pickup_date",), ("pickup_date", "trip_count"), "trip_count"),
    "gold_monthly": MartContract(("pickup_month",), ("pickup_month", "total_trips"), "total_trips"),
    "gold_quality": MartContract(("pickup_month", "quality_issue"), ("pickup_month", "quality_issue", "issue_count")),
}


def stage_mart(mart: DataFrame, path: str, contract: MartContract) -> publish.Staged:
    """Write a mart once; NULLs and trips are counted in that write."""
    metrics = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in contract.not_null]
    if contract.trips:
        metrics.append(F.coalesce(F.sum(contract.trips), F.lit(0)).alias("trips"))
    return publish.stage(mart, path, metrics=metrics)


def gold_gate(spark: SparkSession, staged: publish.Staged, contract: MartContract, fact_rows: int) -> list[str]:
    """The rules of its contract that a staged mart breaks."""
    m = staged.metrics
    broken = [f"not_null_{c}" for c in contract.not_null if m[f"null_{c}"]]
    if contract.trips and m["trips"] != fact_rows:
        broken.append(f"{C.RECONCILIATION} ({m['trips']} trips of {fact_rows})")
    # the staged version is read: as many rows as there are days or months
    written = spark.read.schema(staged.schema).parquet(staged.path)
    if not checks.duplicate_keys(written, contract.keys).isEmpty():
        broken.append(f"unique_{'_'.join(contract.keys)}")
    return broken


def job_gold(spark: SparkSession, cfg: PipelineConfig, expected_rows: int | None = None) -> list[dict]:
    """Staging -> enrichment -> daily mart (written once) -> monthly and quality.

    The fact table is aggregated once; the two dependants read the small staged
    daily mart. All three are written and checked against their contracts before
    any name is switched, so a mart with a repeated day, a NULL key or a lost trip
    is never visible, nor are new marts beside old ones because a later one fails.
    ``expected_rows`` is the silver job's count; without it silver's rows are
    counted (from file footers).
    """
    ensure_layers(spark, cfg)
    fact_rows = spark.table(cfg.silver_table).count() if expected_rows is None else expected_rows
    ready: dict[str, publish.Staged] = {}

    def daily() -> DataFrame:
        return spark.read.schema(ready["gold_daily"].schema).parquet(ready["gold_daily"].path)

    plan = {
        "gold_daily": (cfg.daily_table,
                       lambda: marts.daily_mart(marts.enrich(marts.stage(spark.table(cfg.silver_table))))),
        "gold_monthly": (cfg.monthly_table, lambda: marts.monthly_mart(daily())),
        "gold_quality": (cfg.quality_table, lambda: marts.quality_mart(daily())),
    }
    began = {}
    for step, (table, mart) in plan.items():
        def check(f: dict, step=step, table=table, mart=mart) -> None:
            f.update(silver_count=fact_rows)
            ready[step] = stage_mart(mart(), _version_dir(cfg, table), GOLD_CONTRACTS[step])
            if broken := gold_gate(spark, ready[step], GOLD_CONTRACTS[step], fact_rows):
                raise GateClosed(f"gold validation failed for {table}: {', '.join(broken)}")
        began[step] = A.clock()
        _audited(spark, cfg, step, check, report_success=False)
    records = []
    for step, (table, _) in plan.items():
        def switch(f: dict, step=step, table=table) -> None:
            publish.publish(spark, table, ready[step])
            f.update(table_name=table, table_location=ready[step].path)
        records.append(_audited(spark, cfg, step, switch, began=began[step]))
    return records


# ---------------------------------------------------------------------------
# Gated pipeline
# ---------------------------------------------------------------------------

def _gate(spark: SparkSession, cfg: PipelineConfig, step: str,
          check: Callable[[dict], DataFrame], message: str, block: bool = True) -> dict:
    def body(f: dict) -> None:
        verdict = check(f).first()
        if block and not verdict["passed"]:
            raise GateClosed(message)

    return _audited(spark, cfg, step, body)


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame | Callable[[], DataFrame],
    cfg: PipelineConfig,
    landing_glob: str | None = None,
) -> DataFrame:
    """Landing -> raw gate -> bronze -> silver -> gold.

    Each gate must pass before the next step runs; a failing gate raises
    ``GateClosed`` after auditing it (``cfg.raw_gate`` "report" lets the raw gate
    only report). The raw input's rows are counted, and bronze and silver must
    have as many. Silver's rules and the marts' contracts are checked on the
    staged writes, before anything of them is published. Returns this run's audit
    rows.
    """
    if landing_glob:
        def landing_check(f: dict) -> DataFrame:
            checked = landing.check_landing(landing.list_files(spark, landing_glob))
            return checked.agg(F.coalesce(F.bool_and("valid"), F.lit(False)).alias("passed"))
        _gate(spark, cfg, "landing", landing_check, "landing validation failed")
    opened: list[DataFrame] = []

    def raw_check(f: dict) -> DataFrame:
        opened.append(raw() if callable(raw) else raw)
        f["raw_count"] = opened[0].count()
        return checks.verdict(checks.check_raw(opened[0], cfg.period_start, cfg.period_end))

    gate = _gate(spark, cfg, "raw_validation", raw_check, "raw validation failed",
                 block=cfg.raw_gate == "block")
    job_bronze(spark, opened[0], cfg, expected_rows=gate["raw_count"])
    split = job_silver(spark, cfg, expected_rows=gate["raw_count"])
    job_gold(spark, cfg, expected_rows=split["silver_count"])
    return run_audit(spark, cfg)


def expire(spark: SparkSession, cfg: PipelineConfig, keep: int = 2) -> list[str]:
    """Delete superseded versions of this pipeline's tables; ``keep`` of each stay.

    What a name shows now always stays, also after runs that failed and left newer
    folders. Returns the deleted folders.
    """
    published = A.read_audit(spark, cfg.audit_path).filter(
        (F.col("status") == A.SUCCESS) & F.col("table_location").isNotNull())
    # one row per table: a handful
    live = [r["path"] for r in published.groupBy("table_name").agg(
        F.max_by("table_location", "ended_at").alias("path")).collect()]
    tables = (cfg.bronze_table, cfg.silver_table, cfg.daily_table, cfg.monthly_table, cfg.quality_table)
    return [v for t in tables for v in publish.expire_versions(spark, cfg.versions(t), live, keep)]


def run_audit(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return A.read_audit(spark, cfg.audit_path).filter(F.col("run_id") == cfg.run_id)
