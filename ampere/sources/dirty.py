"""The bound records with the defects real pulls have, placed by key modulus.

Same shapes and loads as ``bindings``, but with copies inside one load, missing periods, states,
regions and codes, text where a number belongs, hours that do not exist, ids longer than a
state code, a state that changes its name, records that only the re-pull has, and hourly
demand spread over six months of which the re-pull revises some readings. Each rule a mart
or staging step applies to such rows then decides at least one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.sources.bindings import (LOAD_TIMES, LOOKBACK_MONTHS, PERIOD_SHAPES, SERIES_TYPES, generation_records,
                                     payload_records, retail_records, source_key)
from ampere.sources.tables import table

#: Numbers as no number is written; the parsers give NULL for each.
BAD_NUMBERS = ("n/a", "12f", "NaN", "1,5")
RENAMED_NATION, RENAMED_SINCE = 3, "1998-01"
LONG_NATION, LONG_ID = 5, "LONG05"
MONTHS_BACK, DAYS_A_MONTH = 6, 30


def _month_index(period: Column) -> Column:
    return F.substring(period, 1, 4).cast("int") * 12 + F.substring(period, 6, 2).cast("int") - 1


def _key(state: str, code: str) -> Column:
    return _month_index(F.col("period")) * 3 + F.col(state).cast("int") * 7 + F.ascii(code)


def _every(k: str, n: int, r: int = 0) -> Column:
    return F.pmod(F.col(k), F.lit(n)) == r


def _nulled(c: str, cond: Column) -> Column:
    return F.when(~cond, F.col(c))


def _with_copies(df: DataFrame, name: str, value: str, load: str) -> DataFrame:
    """Two more copies of every eleventh record in the same load, and periodless ones; every
    nineteenth record is in the re-pull only.

    Each record gives an array of its copies, so the records are computed once, and no
    condition on them is pushed below their aggregation, to be tested for every order."""
    none = F.lit(None).cast("string")

    def row(**changed):
        return F.struct(*(changed.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns))

    best = row(**{name: F.concat(F.lit("~"), name), value: F.col(value) + 1})
    last = row(**{name: none, value: F.col(value) + 2})
    twice, lost = _every("k", 11), _every("k", 13)
    no_rows = F.array().cast(f"array<{df.schema.simpleString()}>")
    rows = F.concat(F.array(row()), F.when(twice, F.array(best, last)).otherwise(no_rows),
                    F.when(lost, F.array(row(period=none))).otherwise(no_rows))
    if load == "backfill":
        rows = F.when(~_every("k", 19, 4), rows).otherwise(no_rows)
    return df.select(F.inline(rows))


def _number(c: str, bad: Column) -> Column:
    texts = F.array(*(F.lit(t) for t in BAD_NUMBERS))
    return F.when(bad, F.element_at(texts, (F.pmod("k", F.lit(len(BAD_NUMBERS))) + 1).cast("int"))).otherwise(
        F.col(c).cast("string"))


def dirty_retail(spark: SparkSession, sf_dir: str, load: str = "backfill", lookback: int = LOOKBACK_MONTHS) -> DataFrame:
    df = retail_records(spark, sf_dir, load, lookback).withColumn("k", _key("stateid", "sectorid"))
    nation = F.col("stateid").cast("int")
    renamed = (nation == RENAMED_NATION) & (F.col("period") >= RENAMED_SINCE)
    df = (df.withColumn("stateDescription", F.when(renamed, F.concat(F.lit("NEW "), "stateDescription"))
                        .otherwise(F.col("stateDescription")))
            .withColumn("stateid", F.when(nation == LONG_NATION, LONG_ID).otherwise(F.col("stateid")))
            .withColumn("stateid", _nulled("stateid", _every("k", 17, 1))))
    df = _with_copies(df, "sectorName", "price", load)
    return (df.withColumn("price", _number("price", _every("k", 7, 2)))
              .withColumn("sales", _number("sales", _every("k", 23, 5)))
              .withColumn("customers", F.when(_every("k", 7, 3), F.concat(F.col("customers").cast("string"), F.lit(".0")))
                          .otherwise(F.col("customers").cast("string"))).drop("k"))


def dirty_generation(spark: SparkSession, sf_dir: str, load: str = "backfill",
                     lookback: int = LOOKBACK_MONTHS) -> DataFrame:
    df = generation_records(spark, sf_dir, load, lookback).withColumn("k", _key("location", "fueltypeid"))
    df = (df.withColumn("location", _nulled("location", _every("k", 29, 2)))
            .withColumn("fueltypeid", _nulled("fueltypeid", _every("k", 17, 1))))
    df = _with_copies(df, "fuelTypeDescription", "generation", load)
    return df.withColumn("generation", _number("generation", _every("k", 7, 2))).drop("k")


def dirty_demand(spark: SparkSession, sf_dir: str, load: str = "backfill", lookback: int = LOOKBACK_MONTHS) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value", "props").withColumnRenamed("event_id", "k")
    back = F.make_dt_interval(days=(F.pmod("k", F.lit(MONTHS_BACK)) * DAYS_A_MONTH).cast("int"))
    ev = ev.withColumn("at", F.col("ts") - back)
    if load == "backfill":
        ev = ev.filter(~_every("k", 47, 5))
    else:
        start = ev.select(F.add_months(F.trunc(F.max("ts"), "MM"), -lookback).cast("timestamp_ntz")).scalar()
        ev = ev.filter(F.col("at") >= start)
    shape = F.pmod("k", F.lit(len(PERIOD_SHAPES)))
    period = F.when(_every("k", 19), F.concat(F.date_format("at", "yyyy-MM"), F.lit("-45T99")))
    period = period.when(_every("k", 23), F.date_format("at", "yyyy-MM"))
    for i, form in enumerate(PERIOD_SHAPES):
        period = period.when(shape == i, F.date_format("at", form))
    value = F.col("value") + 1 if load == "revision" else F.col("value")
    value = F.when(_every("k", 3), value).otherwise(F.col("value")).cast("string")
    series = F.pmod(F.get_json_object("props", "$.k").try_cast("int"), F.lit(5))
    types = F.array(*(F.lit(t) for t in SERIES_TYPES), F.lit(None).cast("string"))
    return ev.select(
        F.when(~_every("k", 41), period).alias("period"),
        _nulled("event_type", _every("k", 29)).alias("respondent"),
        F.when(~_every("k", 43), F.concat(F.upper("event_type"), F.lit(" GRID"))).alias("respondent-name"),
        F.when(_every("k", 37), F.lit("bad")).when(~_every("k", 31), value).alias("value"),
        F.element_at(types, (series + 1).cast("int")).alias("type"))


DIRTY = {"retail": dirty_retail, "generation": dirty_generation, "demand": dirty_demand}


def dirty_raw(spark: SparkSession, sf_dir: str, dataset: str, load: str = "backfill") -> DataFrame:
    """The raw table after one load of the dirty records: (payload, source_file, ingested_at)."""
    recs = payload_records(DIRTY[dataset](spark, sf_dir, load), dataset)
    return recs.select("payload", source_key(dataset, F.col("period")).alias("source_file"),
                       F.lit(LOAD_TIMES[load]).cast("timestamp_ntz").alias("ingested_at"))
