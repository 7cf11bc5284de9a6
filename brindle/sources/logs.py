"""Parsers for the visit log and the access log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field order of the visit log, and its in-band missing markers.
VISIT_FIELDS = (
    ("date", "string"),
    ("user_id", "bigint"),
    ("session_id", "string"),
    ("page_id", "bigint"),
    ("action_time", "string"),
    ("search_keyword", "string"),
    ("click_category_id", "string"),
    ("click_product_id", "bigint"),
    ("order_category_ids", "list"),
    ("order_product_ids", "list"),
    ("pay_category_ids", "list"),
    ("pay_product_ids", "list"),
    ("city_id", "string"),
)
NO_ID = "-1"
NO_VALUE = "null"
ID_FIELDS = ("click_category_id", "click_product_id")

# Places of the fields in an access log line, and its time format.
LOG_ADDRESS, LOG_TIME, LOG_URL = 0, 3, 6
LOG_TIME_PATTERN = r"^\?(\d\d)/(\d\d)/(\d{4}):(\d\d:\d\d:\d\d)$"


def _visit_field(fields: Column, place: int, name: str, kind: str) -> Column:
    marker = NO_ID if name in ID_FIELDS else NO_VALUE
    raw = F.nullif(fields.getItem(place), F.lit(marker))
    if kind == "list":
        return F.split(raw, ",").alias(name)
    return (raw if kind == "string" else raw.try_cast(kind)).alias(name)


def _fields(value: Column) -> Column:
    return F.split(value, "_")


def parse_visits(lines: DataFrame) -> DataFrame:
    """Typed visits from ``value`` lines; lines without 13 fields are left out.

    They are what ``visit_rejects`` returns.
    """
    fields = _fields(F.col("value"))
    return lines.filter(F.size(fields) == len(VISIT_FIELDS)).select(
        *[_visit_field(fields, place, name, kind) for place, (name, kind) in enumerate(VISIT_FIELDS)]
    )


def visit_rejects(lines: DataFrame) -> DataFrame:
    """The lines ``parse_visits`` leaves out."""
    return lines.filter(F.coalesce(F.size(_fields(F.col("value"))) != len(VISIT_FIELDS), F.lit(True)))


def parse_access_log(lines: DataFrame) -> DataFrame:
    """``ip``, ``ts`` and ``url`` of each line; what is missing or malformed is NULL."""
    fields = F.split("value", " ")
    parts = lines.select(
        F.get(fields, F.lit(LOG_ADDRESS)).alias("ip"),
        F.get(fields, F.lit(LOG_TIME)).alias("time"),
        F.get(fields, F.lit(LOG_URL)).alias("url"),
    )
    # Rearranged and cast, so that no session time zone takes part.  Text of another
    # shape is left as it is by the pattern, and the cast does not take it for a time
    # because of the mark in front.
    iso = F.regexp_replace(F.concat(F.lit("?"), "time"), LOG_TIME_PATTERN, "$3-$2-$1 $4")
    return parts.select("ip", iso.try_cast("timestamp_ntz").alias("ts"), "url")
