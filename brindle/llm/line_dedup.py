"""Line dedup by site-relative frequency.

For each host, a line's frequency is the number of its pages with that line over the
number of its pages.  Lines above ``MAX_RATIO`` that at least ``MIN_PAGES`` pages have
are boilerplate of that host and go.

Pages with the same text count as one: a page copied a thousand times is not a template.
Lines and pages are named by 128 bits of hash, so only keys are shuffled.  A line counts
once per page, and counts combine before each shuffle, so a hot host or line is no hot
task.  The cleaned text is rebuilt inside the row that holds it.

Defined results: a null host is a host of its own; a null text stays null; blank lines
are never counted nor dropped; lines are compared without outer spaces; a text of
boilerplate only becomes empty, and its row stays; repeated rows are all cleaned; other
columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.common import column, fresh, table, text_key
from brindle.plans.sizing import broadcast_if_small
from brindle.plans.workspace import materialize

MAX_RATIO = 0.02
MIN_PAGES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_key(line: Column) -> Column:
    bare = F.trim(line)
    return F.struct(text_key(bare).alias("x"), text_key(bare, 1).alias("y"))


def boilerplate_lines(pages: DataFrame, host: str, page: str, keys: str, max_ratio: float, min_pages: int) -> DataFrame:
    """``host, line, pages, total`` of the lines above the ratio; ``keys`` holds the distinct line keys of a page."""
    whole = F.struct(F.lit(None).cast("bigint").alias("x"), F.lit(None).cast("bigint").alias("y"))
    lines = pages.select(host, page, F.explode(F.concat(column(keys), F.array(whole))).alias("line"))
    counted = lines.groupBy(host, "line").agg(F.countDistinct(page).alias("pages"))
    # The key of nulls stands for the page itself: its count is the host's total.
    often = materialize(counted.where((F.col("pages") >= min_pages) | F.col("line.x").isNull()), "lines")
    totals = often.where("line.x is null").select(host, F.col("pages").alias("total"))
    return often.where("line.x is not null").join(totals, host).where(F.col("pages") > max_ratio * F.col("total"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, counts: tuple[str, str] | None = None
) -> DataFrame:
    """``docs`` with boilerplate lines out of ``text``; ``counts`` names columns for all lines and dropped lines."""
    h, p, keys, bad, bh, bp = fresh([*docs.columns, *(counts or ())], "llm_host", "llm_page", "llm_keys", "llm_bad", "bad_host", "bad_page")
    named = docs.withColumns(
        {
            h: F.coalesce(F.concat(F.lit("="), column(host).cast("string")), F.lit("")),
            p: F.struct(text_key(column(text)).alias("x"), text_key(column(text), 1).alias("y")),
        }
    )
    filled = F.filter(_lines(column(text)), lambda line: F.trim(line) != "")
    pages = named.where(column(text).isNotNull()).select(h, p, F.array_distinct(F.transform(filled, _line_key)).alias(keys))
    frequent = materialize(boilerplate_lines(pages, h, p, keys, max_ratio, min_pages).select(h, "line"), "boilerplate")

    hits = pages.select(h, p, F.explode(keys).alias("line")).join(broadcast_if_small(frequent), [h, "line"])
    affected = materialize(hits.groupBy(F.col(h).alias(bh), F.col(p).alias(bp)).agg(F.collect_set("line").alias(bad)), "affected")
    joined = named.join(broadcast_if_small(affected), (F.col(h) == F.col(bh)) & (F.col(p) == F.col(bp)), "left")

    lines = _lines(column(text))
    kept = F.filter(lines, lambda line: (F.trim(line) == "") | ~F.array_contains(F.col(bad), _line_key(line)))
    cleaned = F.when(F.col(bad).isNull(), column(text)).otherwise(F.array_join(kept, "\n"))
    out = [cleaned.alias(text) if name == text else column(name) for name in docs.columns]
    if counts:
        size = F.when(column(text).isNull(), 0).otherwise(F.size(lines))
        gone = F.when(F.col(bad).isNull(), F.lit(0)).otherwise(size - F.size(kept))
        out += [size.cast("bigint").alias(counts[0]), gone.cast("bigint").alias(counts[1])]
    return joined.select(*out)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, counts=("n_lines", "n_dropped"))


OP3_SQL = f"""
WITH page AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
total AS (SELECT source, count(*) AS total FROM page GROUP BY source),
counted AS (
    SELECT source, line, count(*) AS pages
    FROM (SELECT source, text, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda x: trim(x)))) AS line FROM page)
    WHERE line <> '' GROUP BY source, line
),
frequent AS (
    SELECT c.source AS source, list(line) AS lines
    FROM counted c JOIN total t ON c.source IS NOT DISTINCT FROM t.source
    WHERE pages >= {MIN_PAGES} AND pages > {MAX_RATIO}::DOUBLE * total GROUP BY c.source
),
cleaned AS (
    SELECT doc_id, d.source AS source, d.text AS text, coalesce(string_split(d.text, chr(10)), []) AS lines,
           CASE WHEN d.text IS NOT NULL THEN list_filter(string_split(d.text, chr(10)), lambda x: trim(x) = '' OR NOT coalesce(list_contains(f.lines, trim(x)), false)) END AS kept
    FROM documents d LEFT JOIN frequent f ON d.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, source, CASE WHEN text IS NOT NULL THEN CASE WHEN len(kept) = 0 THEN '' ELSE array_to_string(kept, chr(10)) END END AS text,
       CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(len(kept), 0) AS BIGINT) AS n_dropped
FROM cleaned
"""
