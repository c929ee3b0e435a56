"""Bind the generated tables to the pipeline's three source datasets.

The source pipeline reads API records shaped as JSON objects. Here every record is
derived by Spark from the given tables, so the work grows with them:

* retail prices, one record per (month, state, sector) plus an all-sectors record
  (sector ``ALL``): orders + lineitem + customer + nation. The month is the order
  month, the state the customer's nation, the sector the order priority.
  price = revenue / quantity, sales = quantity, customers = distinct customers.
* generation, one record per (month, location, fuel code): lineitem + supplier.
  The month is the ship month, the location the supplier's nation, the fuel code a
  fixed list indexed by part key; generation = quantity.
* hourly demand, one record per event: the hour of the event in one of four period
  shapes, the event type as the region, the value as demand; the series type comes
  from ``props.k`` (D, DF, NG, TI, or no type at all).

Two loads exist per dataset: the full history (``backfill``) and a re-pull of the
latest ``lookback + 1`` months with revised numbers (``revision``), ingested a month
later. Revised retail prices are net of discount and revised generation is net of
discount; revised demand is the same readings pulled again.
Money is summed exactly as integers (cents, basis points) on ``long`` (codegen'd,
no BigDecimal per row), so every engine derives bit-identical records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.sources.tables import table

BACKFILL_AT = "2026-01-02 14:00:00"
REVISION_AT = "2026-02-02 14:00:00"
LOAD_TIMES = {"backfill": BACKFILL_AT, "revision": REVISION_AT}
LOOKBACK_MONTHS = 3

DATASET_FOLDERS = {"retail": "retail-prices", "generation": "generation", "demand": "rto-demand"}

# Binding-only values: part key modulo 20 picks a code from this list, so every
# category and several aggregate codes occur.
BOUND_FUEL_CODES = ("ALL", "FOS", "NGO", "WNT", "WNS", "SPV", "STH", "GEO", "NUC", "SUB",
                    "LIG", "BIT", "RC", "HYC", "HPS", "PET", "COL", "NG", "WAS", "OOG")
SERIES_TYPES = ("D", "DF", "NG", "TI")  # props.k % 5 == 4 -> no type key at all
PERIOD_SHAPES = ("yyyy-MM-dd'T'HH", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss",
                 "yyyy-MM-dd'T'HH'Z'")


def _hundredths(c: str) -> Column:
    """A 2-decimal value as an exact integer count of hundredths."""
    return F.rint(F.col(c) * 100).cast("long")


def _gross(c: str) -> Column:
    """Value in units of 1e-4 (same scale as the net value)."""
    return _hundredths(c) * 100


def _net(c: str, discount: str) -> Column:
    """value * (1 - discount) in units of 1e-4, exact."""
    return _hundredths(c) * (F.lit(100) - _hundredths(discount))


def _from_units(c: Column) -> Column:
    """1e-4 units -> double (one correctly rounded division)."""
    return c.cast("double") / F.lit(10000.0)


def _state_code(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 2, "0")


def _num_text(c: Column) -> Column:
    return c.cast("string")


def _window_filter(df: DataFrame, ts: str, lookback: int) -> DataFrame:
    """Keep rows whose month lies in the re-pull window ending at the latest month.

    Both ends are scalar subqueries over the latest timestamp: planning starts no job, and
    at run time the scan gets them as literals on the raw timestamp column, so row groups
    outside the window are skipped instead of computing a month per row. An empty table has
    no window and no rows.
    """
    month = F.trunc(F.max(ts), "MM")
    start, end = (df.select(F.add_months(month, k).cast("timestamp_ntz")).scalar() for k in (-lookback, 1))
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))


# ---------------------------------------------------------------- retail prices

def retail_records(spark: SparkSession, sf_dir: str, load: str = "backfill",
                   lookback: int = LOOKBACK_MONTHS) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate",
                   "o_orderpriority")
    if load == "revision":
        orders = _window_filter(orders, "o_orderdate", lookback)
    # The month travels as a date; its text is made once per record, not once per order.
    orders = orders.withColumn("month", F.trunc("o_orderdate", "MM")).drop("o_orderdate")
    line = table(spark, sf_dir, "lineitem", "l_orderkey", "l_extendedprice", "l_discount",
                 "l_quantity")
    if load == "revision":
        # Only lines of the window's orders are re-pulled; the semi-join keeps the
        # lineitem side hash-partitioned on the order key for the aggregate below.
        line = line.join(orders.select("o_orderkey"),
                         line.l_orderkey == orders.o_orderkey, "left_semi")
    amount = _gross("l_extendedprice") if load == "backfill" else _net("l_extendedprice",
                                                                       "l_discount")
    # Pre-aggregate lines to one row per order (map-side combine); the aggregate is
    # hash-partitioned on the order key, which the join with orders then reuses.
    per_order = line.groupBy("l_orderkey").agg(F.sum(amount).alias("amount"),
                                               F.sum("l_quantity").alias("qty"))
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    # Orders are shuffled once, by customer and month, and each then counts for its priority and
    # for all: rows are doubled after the shuffle, and a customer's are counted where they lie.
    base = (per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
            .select("month", "o_custkey", "o_orderpriority", "amount", "qty")
            .repartition("o_custkey", "month")
            .join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    sectors = F.array(F.struct(F.lit(False).alias("is_all"), "o_orderpriority"),
                      F.struct(F.lit(True).alias("is_all"), F.lit(None).cast("string").alias("o_orderpriority")))
    keys = ["month", "n_nationkey", "n_name", "is_all", "o_orderpriority"]
    agg = (base.select("month", "n_nationkey", "n_name", "o_custkey", "amount", "qty", F.inline(sectors))
           .groupBy(*keys, "o_custkey").agg(F.sum("amount").alias("amount"), F.sum("qty").alias("qty"))
           .groupBy(*keys).agg(F.sum("amount").alias("amount"), F.sum("qty").alias("qty"),
                               F.count("o_custkey").alias("customers")))
    is_all = F.col("is_all")
    return agg.select(
        F.date_format("month", "yyyy-MM").alias("period"),
        _state_code("n_nationkey").alias("stateid"),
        F.col("n_name").alias("stateDescription"),
        F.when(is_all, F.lit("ALL")).otherwise(F.col("o_orderpriority")).alias("sectorid"),
        F.when(is_all, F.lit("all sectors"))
         .otherwise(F.concat(F.lit("priority "), F.col("o_orderpriority"))).alias("sectorName"),
        F.try_divide(_from_units(F.col("amount")), F.col("qty")).alias("price"),
        F.col("qty").alias("sales"),
        F.col("customers"),
    )


# ---------------------------------------------------------------- generation

def generation_records(spark: SparkSession, sf_dir: str, load: str = "backfill",
                       lookback: int = LOOKBACK_MONTHS) -> DataFrame:
    line = table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_quantity",
                 "l_discount", "l_shipdate")
    if load == "revision":
        line = _window_filter(line, "l_shipdate", lookback)
    # Grouped by the month as a date, whose text is made once per record, not once per line.
    line = line.withColumn("month", F.trunc("l_shipdate", "MM"))
    codes = F.array(*[F.lit(c) for c in BOUND_FUEL_CODES])
    line = line.withColumn("fueltypeid", F.element_at(codes, (F.pmod("l_partkey", F.lit(20)) + 1)
                                                      .cast("int")))
    qty = _gross("l_quantity") if load == "backfill" else _net("l_quantity", "l_discount")
    supp = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    joined = line.join(supp, line.l_suppkey == supp.s_suppkey)
    agg = joined.groupBy("month", "s_nationkey", "fueltypeid").agg(F.sum(qty).alias("gen"))
    return agg.select(
        F.date_format("month", "yyyy-MM").alias("period"),
        _state_code("s_nationkey").alias("location"),
        "fueltypeid",
        F.concat(F.lit("fuel "), F.lower("fueltypeid")).alias("fuelTypeDescription"),
        _from_units(F.col("gen")).alias("generation"),
    )


# ---------------------------------------------------------------- hourly demand

def demand_records(spark: SparkSession, sf_dir: str, load: str = "backfill",
                   lookback: int = LOOKBACK_MONTHS) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value", "props")
    if load == "revision":
        ev = _window_filter(ev, "ts", lookback)
    shape = F.pmod("event_id", F.lit(len(PERIOD_SHAPES)))
    period = None
    for i, fmt in enumerate(PERIOD_SHAPES):
        text = F.date_format("ts", fmt)
        period = F.when(shape == i, text) if period is None else period.when(shape == i, text)
    k = F.get_json_object("props", "$.k").try_cast("int")
    types = F.array(*[F.lit(t) for t in SERIES_TYPES], F.lit(None).cast("string"))
    return ev.select(
        period.alias("period"),
        F.col("event_type").alias("respondent"),
        F.concat(F.upper("event_type"), F.lit(" GRID")).alias("respondent-name"),
        F.col("value"),
        F.element_at(types, (F.pmod(k, F.lit(5)) + 1).cast("int")).alias("type"),
    )


RECORDS = {"retail": retail_records, "generation": generation_records, "demand": demand_records}
NUMERIC_FIELDS = {"retail": ("price", "sales", "customers"), "generation": ("generation",),
                  "demand": ("value",)}


def payload_records(records: DataFrame, dataset: str) -> DataFrame:
    """API-shaped JSON text per record (numbers sent as strings, NULL keys omitted)."""
    numeric = NUMERIC_FIELDS[dataset]
    fields = [(_num_text(F.col(f"`{c}`")) if c in numeric else F.col(f"`{c}`")).alias(c)
              for c in records.columns]
    return records.select(F.col("period"), F.to_json(F.struct(*fields)).alias("payload"))


def source_key(dataset: str, period: Column) -> Column:
    folder = DATASET_FOLDERS[dataset]
    return F.concat(F.lit(f"raw/{folder}/year="), F.substring(period, 1, 4),
                    F.lit("/month="), F.substring(period, 6, 2), F.lit("/data.json.gz"))


def raw_load(spark: SparkSession, sf_dir: str, dataset: str, load: str = "backfill",
             lookback: int = LOOKBACK_MONTHS) -> DataFrame:
    """The raw table after one load: (payload, source_file, ingested_at)."""
    recs = payload_records(RECORDS[dataset](spark, sf_dir, load, lookback), dataset)
    return recs.select(
        "payload",
        source_key(dataset, F.col("period")).alias("source_file"),
        F.lit(LOAD_TIMES[load]).cast("timestamp_ntz").alias("ingested_at"),
    )


def raw_history(spark: SparkSession, sf_dir: str, dataset: str,
                lookback: int = LOOKBACK_MONTHS) -> DataFrame:
    """Both loads kept side by side (a raw table that was never truncated)."""
    return raw_load(spark, sf_dir, dataset, "backfill", lookback).unionByName(
        raw_load(spark, sf_dir, dataset, "revision", lookback))
