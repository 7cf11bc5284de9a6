"""JSON lines whose schema is found in the data.

Each line is parsed into a VARIANT.  The fields of all lines are counted by kind, and
their types merged, in one aggregate; nothing is sampled, so a field that only the last
line has is found, and so is the one line where a number is a text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.plans import materialize
from brindle.sources.files import read_text

MOST_FIELDS = 2_000


@dataclass(frozen=True)
class InferredJson:
    """``rows`` typed by ``fields`` (``field, kinds, type, conflict, lines``), and the ``rejects`` (``line``)."""

    rows: DataFrame
    fields: DataFrame
    rejects: DataFrame


def parsed_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``line`` and ``parsed``: its VARIANT, or NULL where the line is not a JSON object."""
    parsed = F.try_parse_json(F.col(column))
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return lines.select(F.col(column).alias("line"), F.when(is_object, parsed).alias("parsed"))


def field_types(parsed: DataFrame) -> DataFrame:
    """One row per field of the objects: its kinds, merged type, whether the kinds conflict, and the lines that have it.

    Numbers of several widths merge into one that holds them all.  Fields whose kinds have no
    common type, and fields that are always null, are texts.
    """
    cells = parsed.sparkSession.sql("SELECT cell.key AS field, cell.value FROM {rows}, LATERAL variant_explode(parsed) AS cell", rows=parsed)
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    merged = cells.groupBy("field").agg(
        F.sort_array(F.collect_set(F.when(kind != "VOID", kind))).alias("kinds"),
        F.schema_of_variant_agg("value").alias("merged"),
        F.count(F.lit(1)).alias("lines"),
    )
    conflict = F.col("merged") == "VARIANT"
    usable = F.when(conflict | (F.col("merged") == "VOID"), "STRING").otherwise(F.regexp_replace("merged", "OBJECT<", "STRUCT<"))
    return merged.select("field", "kinds", usable.alias("type"), conflict.alias("conflict"), "lines")


def infer_json(spark: SparkSession, path: str | list[str], most_fields: int = MOST_FIELDS) -> InferredJson:
    """JSON lines of a file, folder or list of these, typed by what all of them hold.

    Two passes: one for the fields, whose table is at most ``most_fields`` rows, and one,
    when the rows are used, for the values.  Columns are in the order of their names.
    """
    parsed = parsed_lines(read_text(spark, path))
    good = parsed.where(F.col("parsed").isNotNull())
    fields = materialize(field_types(good), "json-fields")
    known = fields.orderBy("field").limit(most_fields + 1).collect()
    if len(known) > most_fields:
        raise ValueError(f"the lines have more than {most_fields} fields; read such data as maps")

    def value(name: str, kind: str) -> Column:
        # A path has no escapes: it quotes a name by the mark the name does not have.
        mark = next((mark for mark in "'\"" if mark not in name), None)
        if mark:
            return F.try_variant_get("parsed", f"$[{mark}{name}{mark}]", kind).alias(name)
        cells = F.try_variant_get("parsed", "$", "map<string, variant>")
        return F.try_variant_get(F.try_element_at(cells, F.lit(name)), "$", kind).alias(name)

    rows = good.select(*[value(row["field"], row["type"]) for row in known])
    return InferredJson(rows, fields, parsed.where(F.col("parsed").isNull()).select("line"))
