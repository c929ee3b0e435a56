"""JSON payload extraction: parse each record once, read named scalar fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field names the three source datasets carry inside each JSON record (fixed values,
# case-sensitive, including the hyphenated key).
RETAIL_FIELDS = ("period", "stateid", "stateDescription", "sectorid", "sectorName",
                 "price", "sales", "customers")
GENERATION_FIELDS = ("period", "location", "fueltypeid", "fuelTypeDescription", "generation")
DEMAND_FIELDS = ("period", "respondent", "respondent-name", "value", "type")


def _name(f: str) -> str:
    return f"_f_{f}"


def with_fields(raw: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Parse each payload once into one string column per field (JSON_VALUE semantics:
    numbers as text, JSON null and missing keys as NULL, malformed text all NULL).

    ``json_tuple`` is a generator, so filters on the extracted fields stay above it:
    with a plain ``from_json`` projection, Catalyst pushes such filters below the
    projection and inlines the parse into every predicate, parsing a row many times.
    """
    return raw.select(*keep, F.json_tuple("payload", *fields).alias(*[_name(f) for f in fields]))


def field(name: str) -> Column:
    """The field's scalar text. An object or array value is NULL, as JSON_VALUE gives
    (json_tuple would return its JSON text); only text starting with { or [ is parsed."""
    t = F.col(f"`{_name(name)}`")
    nested = ((t.startswith("{") & F.json_object_keys(t).isNotNull())
              | (t.startswith("[") & F.json_array_length(t).isNotNull()))
    return F.when(nested, F.lit(None).cast("string")).otherwise(t)
