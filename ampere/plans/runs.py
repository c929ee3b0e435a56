"""End-to-end runs with persisted layers under one warehouse root.

    landing/raw/<dataset>/year=YYYY/month=MM/   gzipped JSON per month (S2)
    raw/<table>/                                  last load only (truncate + append)
    staging/<table>/                              upserted months, one commit per batch
    marts/<name>/v=<version>/                     full replace behind a pointer

Every step is a Spark job over shared storage; nothing but small reports, manifests (one
row per month) and version names reaches the driver. Re-running a step is safe: staging
upserts are idempotent, and staging and mart versions become visible only when whole.

Counts and latest periods are gathered by the jobs that write the layers: the effect of a
batch and a mart's rows by ``observe``, a table's months in its manifest. Reports read
those, not the tables.

The datasets do not depend on each other, and most jobs of a step are small, so a step takes
them side by side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.functions.periods import in_hourly_pull, month_window
from ampere.operators.merge import EFFECT, effect_counts, merge
from ampere.operators.quality import FAIL, PASS, nonempty_report, require, status
from ampere.plans import checks, exports, marts, staging
from ampere.plans import publish as publishing
from ampere.schemas import STAGING as STAGING_SCHEMAS
from ampere.session import configure, remove_path, scratch_path, side_by_side
from ampere.sources import landing, versions
from ampere.sources.bindings import (LOAD_TIMES, LOOKBACK_MONTHS, RECORDS, payload_records)

TABLES = {"retail": "retail_prices", "generation": "generation", "demand": "rto_demand"}
STAGE = {"retail": staging.stage_retail, "generation": staging.stage_generation,
         "demand": staging.stage_demand}
KEYS = {"retail": staging.RETAIL_KEYS, "generation": staging.GENERATION_KEYS,
        "demand": staging.DEMAND_KEYS}
COLUMNS = {"retail": staging.RETAIL_COLUMNS, "generation": staging.GENERATION_COLUMNS,
           "demand": staging.DEMAND_COLUMNS}
PART_COL = versions.PART  # month of the period: a function of every staging key


@dataclass(frozen=True)
class Layout:
    root: str

    @property
    def landing(self) -> str:
        return f"{self.root.rstrip('/')}/landing"

    def raw(self, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/raw/{TABLES[dataset]}"

    def staging(self, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/staging/{TABLES[dataset]}"

    def mart(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/marts/{name}"


# ---------------------------------------------------------------- ingest + raw

def ingest(records: Mapping[str, DataFrame], layout: Layout, end_day: date | None = None) -> None:
    """Land each dataset's pull, one folder per month; empty months are not written.

    ``end_day`` is the last day whose hours an hourly pull asks for; later ones are not landed."""
    def land(dataset: str) -> None:
        recs = records[dataset]
        if dataset == "demand" and end_day is not None:
            recs = hourly_pull(recs, end_day)
        landing.write_landing(payload_records(recs, dataset), layout.landing, dataset)

    if records:
        side_by_side(next(iter(records.values())).sparkSession, land, records)


def hourly_pull(records: DataFrame, end_day: date) -> DataFrame:
    """Hourly records of each month up to the end of that month or of ``end_day``.

    Of a period only the date is compared; text without one is not an hour of any pull."""
    day = F.when(F.length("period") >= 10, F.substring("period", 1, 10).try_cast("date"))
    return records.filter(in_hourly_pull(day, day, F.lit(end_day)))


def load_raw(spark: SparkSession, layout: Layout, months: Sequence[date] | None,
             ingested_at: str, datasets: Sequence[str] = tuple(TABLES)) -> DataFrame:
    """Replace each raw table with the landed months of this run; returns the rows written."""
    def load(dataset: str) -> tuple[str, int]:
        count = Observation()
        raw = landing.load_raw(spark, layout.landing, dataset, months, ingested_at)
        raw.observe(count, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(layout.raw(dataset))
        return dataset, count.get["n"]

    return spark.createDataFrame(side_by_side(spark, load, datasets), "dataset string, rows long")


# ---------------------------------------------------------------- staging

def _with_part(df: DataFrame) -> DataFrame:
    return df.withColumn(PART_COL, F.substring(F.col("period").cast("string"), 1, 7))


def read_staging(spark: SparkSession, layout: Layout, dataset: str) -> DataFrame:
    """The staging table, or an empty one of the declared schema before the first load."""
    return versions.read(spark, layout.staging(dataset), STAGING_SCHEMAS[dataset]).drop(PART_COL)


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                 columns: Sequence[str]) -> dict[str, int]:
    """MERGE ``source`` into the versioned table at ``path`` in one commit; returns how many rows of
    the touched months were kept, inserted, replaced, unchanged and reinserted.

    The batch is computed once, into a scratch table. Only the months it holds are read,
    merged and written, as a new version that becomes visible with all its months at once.
    """
    configure(spark)
    held = scratch_path(spark, "batch")
    _with_part(source.select(*columns)).write.parquet(held)
    batch = spark.read.parquet(held)
    months = [r[0] for r in batch.select(PART_COL).distinct().collect()]  # one column is scanned
    schema = T.StructType([f for f in batch.schema.fields if f.name != PART_COL])
    base = versions.current(spark, path)
    target = versions.read(spark, path, schema, base, months)
    effects = Observation()
    merged = merge(target, batch, keys).observe(effects, *effect_counts())
    versions.commit(spark, path, merged.drop(EFFECT), schema, base)
    remove_path(spark, held)
    return dict(effects.get)


def run_staging(spark: SparkSession, layout: Layout,
                datasets: Sequence[str] = tuple(TABLES)) -> DataFrame:
    """Stage each raw table, upsert it, and fail if raw has rows but staging is empty; returns the
    effect of the batch on each table."""
    def stage(d: str) -> tuple[dict[str, int], tuple]:
        raw = spark.read.parquet(layout.raw(d))
        effect = upsert_table(spark, layout.staging(d), STAGE[d](raw), KEYS[d], COLUMNS[d])
        loaded, stored = raw.count(), versions.stats(spark, layout.staging(d))[0]  # both without reading rows
        return effect, (TABLES[d], loaded, stored, FAIL if loaded and not stored else PASS)

    done = side_by_side(spark, stage, datasets)
    effects, guards = {d: effect for d, (effect, _) in zip(datasets, done)}, [guard for _, guard in done]
    require(spark.createDataFrame(guards, "table_name string, raw_rows long, staging_rows long, status string"))
    return checks.staging_effect(effects, spark)


# ---------------------------------------------------------------- marts

#: The column whose largest value tells how fresh a mart is (dimensions have none).
FRESH = {"fact_retail_prices": "period", "fact_generation": "period", "fact_rto_heatmap": "month",
         "fact_rto_regional": "month"}
METRICS = "n_rows long, latest string"


def write_mart(df: DataFrame, layout: Layout, name: str) -> str:
    """Write a new version and what was observed while writing it, then make it the current one."""
    spark = df.sparkSession
    version = versions.new_version()
    path = f"{layout.mart(name)}/v={version}"
    seen = Observation()
    latest: Column = F.max(FRESH[name]).cast("string") if name in FRESH else F.max(F.lit("-"))
    df.observe(seen, F.count(F.lit(1)).alias("n_rows"), latest.alias("latest")).write.parquet(path)
    row = (seen.get["n_rows"], seen.get["latest"] if name in FRESH else "-")
    spark.createDataFrame([row], METRICS).coalesce(1).write.parquet(f"{layout.mart(name)}/metrics/v={version}")
    versions.advance(spark, layout.mart(name), version)
    return path


def read_mart(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    path = layout.mart(name)
    return spark.read.parquet(f"{path}/v={versions.current(spark, path)}")


def mart_metrics(spark: SparkSession, layout: Layout, name: str):
    """(n_rows, latest) of the current version, as observed while it was written."""
    path = layout.mart(name)
    return spark.read.schema(METRICS).parquet(f"{path}/metrics/v={versions.current(spark, path)}").first()


MART_NAMES = ("fact_retail_prices", "fact_generation", "dim_state", "fact_rto_heatmap",
              "fact_rto_regional", "fact_anomaly_leaderboard")


def run_marts(spark: SparkSession, layout: Layout, datasets: Sequence[str] = tuple(TABLES)) -> dict[str, DataFrame]:
    """Rebuild the marts that the datasets feed."""
    def write(df: DataFrame, name: str) -> str:
        write_mart(df, layout, name)
        return name

    def rebuild(d: str) -> list[str]:
        stg = read_staging(spark, layout, d)
        if d == "generation":
            return [write(marts.fact_generation(stg), "fact_generation")]
        if d == "demand":
            return [write(marts.fact_rto_heatmap(stg), "fact_rto_heatmap"),
                    write(marts.fact_rto_regional(stg), "fact_rto_regional")]
        # the leaderboard reads the price mart just written, as the SQL script does
        return [write(marts.fact_retail_prices(stg), "fact_retail_prices"),
                write(marts.dim_state(stg), "dim_state"),
                write(marts.fact_anomaly_leaderboard(read_mart(spark, layout, "fact_retail_prices")),
                      "fact_anomaly_leaderboard")]

    written = sum(side_by_side(spark, rebuild, [d for d in TABLES if d in datasets]), [])
    return {n: read_mart(spark, layout, n) for n in written}


def layer_report(spark: SparkSession, layout: Layout, datasets: Sequence[str] = tuple(TABLES),
                 mart_names: Sequence[str] = MART_NAMES) -> DataFrame:
    """PASS/FAIL with rows and latest of every stored layer, from manifests and observed metrics."""
    found = []
    for d in datasets:
        n, _, last = versions.stats(spark, layout.staging(d))
        found.append((f"staging.{TABLES[d]}", n, last))
    for name in mart_names:
        m = mart_metrics(spark, layout, name)
        found.append((f"marts.{name}", m.n_rows, m.latest))
    listed = spark.createDataFrame(found, "table_name string, n_rows long, latest string")
    return nonempty_report(listed).withColumnRenamed("table_name", "check_name")


def validate(spark: SparkSession, layout: Layout, names: Sequence[str] = tuple(FRESH)) -> DataFrame:
    """(table, rows, latest) of the time-series marts as written; an empty one raises."""
    found = [(n, *mart_metrics(spark, layout, n)) for n in names]
    report = spark.createDataFrame(found, "table_name string, n_rows long, latest string")
    require(nonempty_report(report))
    return report


def publish(spark: SparkSession, layout: Layout, out_root: str) -> dict[str, int]:
    """Publish all tabs in chunks and prove what was written; returns data rows per tab."""
    frames = exports.tab_frames({n: read_mart(spark, layout, n) for n in MART_NAMES})
    counts = publishing.publish(frames, out_root)
    require(reconciled(spark, layout, out_root))
    return counts


def reconciled(spark: SparkSession, layout: Layout, out_root: str) -> DataFrame:
    """PASS per tab whose published files hold exactly what its query gives."""
    frames = exports.tab_frames({n: read_mart(spark, layout, n) for n in MART_NAMES})
    report = publishing.reconcile(spark, out_root, frames)
    same = F.col("header_equal") & F.col("content_equal") & (F.col("n_rows") == F.col("n_published"))
    return report.select(
        F.concat(F.lit("published."), F.col("table_name")).alias("check_name"),
        status(F.coalesce(same, F.lit(False))).alias("status"),
        F.concat(F.col("n_published").cast("string"), F.lit(" of "), F.col("n_rows").cast("string"),
                 F.lit(" rows")).alias("detail"))


def export_csv(spark: SparkSession, layout: Layout, out_root: str) -> dict[str, str]:
    """Typed marts, hourly demand and the tabs as CSV folders with a header line."""
    found = {n: read_mart(spark, layout, n) for n in MART_NAMES}
    return (exports.write_csv(exports.tab_frames(found), f"{out_root.rstrip('/')}/tabs")
            | exports.write_typed_csv(found, read_staging(spark, layout, "demand"), out_root))


# ---------------------------------------------------------------- whole runs

def run(spark: SparkSession, layout: Layout, records: Mapping[str, DataFrame],
        months: Sequence[date] | None, ingested_at: str, publish_to: str | None = None,
        end_day: date | None = None) -> dict:
    """One scheduled run: land the pull, reload raw for ``months``, upsert staging,
    rebuild marts, validate, optionally publish."""
    configure(spark)
    datasets = tuple(records)
    ingest(records, layout, end_day)
    load_raw(spark, layout, months, ingested_at, datasets)
    result = {"effect": run_staging(spark, layout, datasets)}
    run_marts(spark, layout, datasets)
    if set(datasets) == set(TABLES):
        result["validate"] = validate(spark, layout)
        if publish_to:
            result["published"] = publish(spark, layout, publish_to)
    return result


def run_from_tables(spark: SparkSession, sf_dir: str, layout: Layout, load: str = "backfill",
                    lookback: int = LOOKBACK_MONTHS, publish_to: str | None = None,
                    datasets: Sequence[str] = tuple(TABLES), records=RECORDS) -> dict:
    """Drive a run with the bound test tables: ``backfill`` lands and loads every month;
    ``revision`` lands the re-pulled window and loads only the window's months."""
    configure(spark)
    pulls = {d: records[d](spark, sf_dir, load, lookback) for d in datasets}
    ingest(pulls, layout)
    if load == "backfill":
        load_raw(spark, layout, None, LOAD_TIMES[load], datasets)
    else:
        def load_window(d: str) -> None:  # it differs per dataset (each has its own latest month)
            landed = landing.file_inventory(spark, layout.landing, d)  # listed, not read
            latest = landed.agg(F.max(F.concat_ws("-", "year", "month"))).first()[0]
            window = month_window(date(int(latest[:4]), int(latest[5:7]), 1), lookback)
            load_raw(spark, layout, window, LOAD_TIMES[load], (d,))

        side_by_side(spark, load_window, datasets)
    result = {"effect": run_staging(spark, layout, datasets)}
    run_marts(spark, layout, datasets)
    if set(datasets) == set(TABLES):
        result["validate"] = validate(spark, layout)
        if publish_to:
            result["published"] = publish(spark, layout, publish_to)
    return result


def check_all(spark: SparkSession, layout: Layout, min_months: int = checks.MIN_MONTHS,
              min_regions: int = checks.MIN_REGIONS, first_year: int = checks.FIRST_YEAR,
              start: str | None = None, published: str | None = None,
              raise_on_fail: bool = True) -> DataFrame:
    """PASS/FAIL for every stored layer. Raises if anything FAILs.

    Landed months come from the listing of files, held against a calendar from ``start``
    (default: January of ``first_year``); rows and latest from manifests and metrics;
    demand coverage from the stored table's key columns; ``published`` tabs by digest."""
    report = layer_report(spark, layout)
    for d in TABLES:
        present = landing.file_inventory(spark, layout.landing, d).select(
            F.concat_ws("-", "year", "month").alias(PART_COL))
        cov = checks.month_calendar(present, d, start or f"{first_year}-01", min_months=min_months)
        report = report.unionByName(cov.select(
            F.concat(F.lit("landing."), F.col("dataset")).alias("check_name"), "status",
            F.concat(F.col("n_months").cast("string"), F.lit(" months up to "),
                     F.coalesce("latest", F.lit("nothing")),
                     F.when(F.col("missing") != "", F.concat(F.lit(", missing "), F.col("missing")))
                     .otherwise("")).alias("detail")))
    dem = checks.demand_coverage(read_staging(spark, layout, "demand"), min_regions, first_year)
    report = report.unionByName(dem.select(
        F.lit("staging.demand_coverage").alias("check_name"), "status",
        F.concat(F.col("regions").cast("string"), F.lit(" regions since "),
                 F.coalesce(F.col("first_hour").cast("string"), F.lit("nothing"))).alias("detail")))
    if published:
        report = report.unionByName(reconciled(spark, layout, published))
    return require(report) if raise_on_fail else report


def diagnose_demand(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows and parse rates of the stored raw load of hourly demand, and what staging holds."""
    raw = spark.read.parquet(layout.raw("demand"))
    rates = checks.parse_rates(raw)
    n, first, last = versions.stats(spark, layout.staging("demand"))
    return rates.select("*", F.lit(n).alias("staging_rows"), F.lit(first).alias("first_hour"),
                        F.lit(last).alias("latest_hour"))
