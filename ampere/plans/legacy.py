"""Variants kept from the pipeline's first version (different, older semantics)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.functions.casts import safe_bigint, safe_double
from ampere.operators.dedup import distinct_latest
from ampere.plans.staging import stage_demand, typed_retail

RETAIL_ATTRS = ("period", "state_id", "state_name", "sector_id", "sector_name",
                "price_cents_kwh", "sales_mwh", "customers")


def retail_distinct(raw_retail: DataFrame) -> DataFrame:
    """GROUP BY all eight attributes, MAX(ingested_at): only identical rows collapse."""
    return distinct_latest(typed_retail(raw_retail), RETAIL_ATTRS)


def demand_all_series(raw_demand: DataFrame) -> DataFrame:
    """Hourly mean over every series type (the demand filter did not exist yet)."""
    return stage_demand(raw_demand, demand_series_only=False)


def hourly_export(stg_demand: DataFrame) -> DataFrame:
    """Hourly rows for the CSV export: hour, hour of day, month number, weekday (Sun=0)."""
    return (stg_demand.filter(F.col("demand_mwh").isNotNull()).select(
        F.date_trunc("hour", "period").cast("timestamp_ntz").alias("hour"),
        F.hour("period").alias("hour_of_day"),
        F.month("period").alias("month"),
        (F.dayofweek("period") - 1).alias("day_of_week"),
        "region_id", "region_name", "demand_mwh"))


def typed_generation_strict(raw_generation: DataFrame) -> DataFrame:
    """Older generation staging: variant-path casts. ``period`` is cut to 7 characters,
    ids to their column widths, and the number cast is strict (a non-numeric value
    fails the job instead of becoming NULL). No dedup: rows load as they come."""
    from ampere.functions.payload import GENERATION_FIELDS, field, with_fields
    j = with_fields(raw_generation, GENERATION_FIELDS, ("ingested_at",))
    return (j.filter(field("period").isNotNull())
             .select(F.left(field("period"), F.lit(7)).alias("period"),
                     F.left(field("location"), F.lit(10)).alias("state_id"),
                     F.left(field("fueltypeid"), F.lit(50)).alias("fuel_type_code"),
                     field("fuelTypeDescription").alias("fuel_type_desc"),
                     field("generation").cast("double").alias("generation_mwh"),
                     "ingested_at"))


# ---------------------------------------------------------------- variant path, strict casts

def _variant(raw: DataFrame) -> DataFrame:
    return raw.select(F.parse_json("payload").alias("v"), "payload", "ingested_at")


def _text(key: str, width: int | None = None) -> Column:
    """The value at a key of the variant as text, cut to a column's width."""
    t = F.variant_get(F.col("v"), f"$['{key}']", "string")
    return t if width is None else F.left(t, F.lit(width))


def _strict(text: Column, cast: Column, key: str, kind: str) -> Column:
    """``cast`` where it succeeds or there is nothing to cast; any other text fails the job and
    names the record."""
    wrong = F.concat(F.lit(f"{key} is not {kind}: "), text, F.lit(" in "), F.col("payload"))
    return F.when(text.isNotNull() & cast.isNull(), F.raise_error(wrong)).otherwise(cast)


def _number(key: str) -> Column:
    return _strict(_text(key), safe_double(_text(key)), key, "a number").cast("double")


def _whole(key: str) -> Column:
    return _strict(_text(key), safe_bigint(_text(key)), key, "a whole number").cast("bigint")


_HOUR = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}Z?$"


def _moment(key: str) -> Column:
    """A timestamp to the precision its text has; a bare hour is that hour."""
    t = _text(key)
    hour = F.concat(F.left(t, F.lit(10)), F.lit(" "), F.substring(t, 12, 2), F.lit(":00:00"))
    moment = F.when(t.rlike(_HOUR), hour.try_cast("timestamp")).otherwise(t.try_cast("timestamp"))
    return _strict(t, moment.cast("timestamp_ntz"), key, "a timestamp").cast("timestamp_ntz")


def staged_retail_strict(raw_retail: DataFrame) -> DataFrame:
    """First version of the retail staging: variant path, strict casts, identical rows collapse."""
    typed = _variant(raw_retail).filter(_text("period").isNotNull()).select(
        _text("period", 7).alias("period"), _text("stateid", 10).alias("state_id"),
        _text("stateDescription").alias("state_name"), _text("sectorid", 20).alias("sector_id"),
        _text("sectorName").alias("sector_name"), _number("price").alias("price_cents_kwh"),
        _number("sales").alias("sales_mwh"), _whole("customers").alias("customers"), "ingested_at")
    return distinct_latest(typed, RETAIL_ATTRS)


def staged_demand_strict(raw_demand: DataFrame) -> DataFrame:
    """First version of the hourly staging: every series, periods as precise as they are, a NULL
    region is a group."""
    typed = _variant(raw_demand).filter(_text("period").isNotNull()).select(
        _moment("period").alias("period"), _text("respondent", 50).alias("region_id"),
        _text("respondent-name").alias("region_name"), _number("value").alias("value"), "ingested_at")
    return typed.groupBy("period", "region_id").agg(
        F.max("region_name").alias("region_name"), F.avg("value").alias("demand_mwh"),
        F.max("ingested_at").alias("ingested_at"))
