"""Visit-log, access-log and text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle import datasets
from brindle.catalog.registry import query, with_ctes
from brindle.operators import visits as jobs
from brindle.operators.aggregates import cogroup_counts, count_by
from brindle.operators.rows import flatten_lists, flatten_mixed, words
from brindle.operators.states import States
from brindle.plans import shared_dir, table_name
from brindle.sinks import write_text
from brindle.sources import parse_access_log, parse_visits, read_text, read_whole_files, visit_rejects

_BEST = "ORDER BY clicks DESC, orders DESC, pays DESC, category_id LIMIT 10"
DAY = "17/01/2024"
SEARCHED = "the"
# Files of the whole-file query have about this many bytes, so a file is a row of bounded size.
FILE_BYTES = 4 * 1024 * 1024


@query("hot_category_top10", with_ctes("category", f"SELECT category_id, clicks, orders, pays FROM category {_BEST}"))
def hot_category_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.hot_categories(datasets.visits(spark, sf_dir))


@query(
    "hot_category_top10_exclusive",
    with_ctes(
        "visit",
        f"""
        , first_kind AS (
            SELECT unnest(CASE WHEN click_category_id IS NOT NULL THEN [click_category_id]
                               ELSE COALESCE(order_category_ids, pay_category_ids) END) AS category_id,
                   CASE WHEN click_category_id IS NOT NULL THEN 'click'
                        WHEN order_category_ids IS NOT NULL THEN 'order' ELSE 'pay' END AS action
            FROM visit
        )
        SELECT category_id,
               CAST(count(*) FILTER (action = 'click') AS BIGINT) AS clicks,
               CAST(count(*) FILTER (action = 'order') AS BIGINT) AS orders,
               CAST(count(*) FILTER (action = 'pay') AS BIGINT) AS pays
        FROM first_kind GROUP BY category_id {_BEST}
        """,
    ),
)
def hot_category_top10_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.hot_categories(datasets.visits(spark, sf_dir), exclusive=True)


def delivered_states(spark: SparkSession, visits: DataFrame) -> States:
    """States of visits that came in packets: some late for their day, the last day cut short and then sent again."""
    visits = visits.withColumn("late", F.col("page_id") % 10 == 3)
    last = visits.agg(F.max("date")).first()[0]
    before, on_last = F.col("date") < last, F.col("date") == last
    states = jobs.category_states(spark, table_name("states"))
    states.create(jobs.category_measures(visits.where(before & ~F.col("late"))))
    states.replace(jobs.category_measures(visits.where(on_last & (F.col("page_id") < 25))))
    states.merge(jobs.category_measures(visits.where(before & F.col("late"))))
    states.replace(jobs.category_measures(visits.where(on_last)))
    return states


@query("incremental_hot_categories", with_ctes("category", f"SELECT category_id, clicks, orders, pays FROM category {_BEST}"))
def incremental_hot_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hot categories from the states of the days; no visit is read again."""
    return jobs.hottest(delivered_states(spark, datasets.visits(spark, sf_dir)).value())


@query("cogroup_counts", with_ctes("category", "SELECT category_id, clicks, orders, pays FROM category"))
def cogroup_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = datasets.visits(spark, sf_dir)
    clicked = visits.select(F.col("click_category_id").alias("category_id")).filter(F.col("category_id").isNotNull())
    ordered = visits.select(F.explode("order_category_ids").alias("category_id"))
    paid = visits.select(F.explode("pay_category_ids").alias("category_id"))
    return cogroup_counts("category_id", clicks=clicked, orders=ordered, pays=paid)


@query(
    "top_sessions",
    with_ctes(
        "category",
        f"""
        , hot AS (SELECT category_id FROM category {_BEST}),
        counted AS (
            SELECT click_category_id AS category_id, session_id, CAST(count(*) AS BIGINT) AS clicks
            FROM visit WHERE click_category_id IN (SELECT category_id FROM hot)
            GROUP BY 1, 2
        )
        SELECT category_id, session_id, clicks, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY clicks DESC, session_id) AS rank
              FROM counted)
        WHERE rank <= 10
        """,
    ),
)
def top_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_sessions(datasets.visits(spark, sf_dir))


# ---- text ------------------------------------------------------------------


@query("text_lines", with_ctes("doc_line", "SELECT value FROM doc_line"))
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document as text, read the lines back."""
    path = shared_dir(spark, "text")
    write_text(datasets.table(spark, sf_dir, "documents").select("text"), path)
    return read_text(spark, path)


@query("gzip_text_lines", with_ctes("doc_line", "SELECT value, CAST(count(*) AS BIGINT) AS cnt FROM doc_line GROUP BY value"))
def gzip_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "gzip")
    write_text(datasets.table(spark, sf_dir, "documents").select("text"), path, compression="gzip")
    return count_by(read_text(spark, path), "value")


@query(
    "whole_files",
    """
    SELECT doc_id, n_chars, CAST(length(text) AS BIGINT) AS text_length, md5(text) AS text_md5 FROM documents
    """,
)
def whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write documents as JSON lines, read each file as one row, take it apart again."""
    path = shared_dir(spark, "whole")
    documents = datasets.table(spark, sf_dir, "documents")
    lines = documents.select(F.to_json(F.struct("doc_id", "n_chars", "text")).alias("value"))
    write_text(lines, path, file_bytes=FILE_BYTES)
    lines = read_whole_files(spark, path).select(F.explode(F.split("value", "\n")).alias("line")).filter("line <> ''")
    parsed = lines.select(F.from_json("line", "doc_id bigint, n_chars bigint, text string").alias("d")).select("d.*")
    return parsed.select(
        "doc_id",
        "n_chars",
        F.length("text").cast("bigint").alias("text_length"),
        F.md5("text").alias("text_md5"),
    )


@query("word_count", with_ctes("doc_word", "SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM doc_word GROUP BY word"))
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(words(datasets.document_lines(spark, sf_dir)), "word")


@query("search_contains", f"SELECT doc_id, text FROM documents WHERE contains(text, '{SEARCHED}')")
def search_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.search(datasets.table(spark, sf_dir, "documents").select("doc_id", "text"), SEARCHED, "text")


# ---- log parsing -----------------------------------------------------------


@query(
    "visit_parse",
    with_ctes(
        "visit",
        """
        SELECT date, user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id,
               array_to_string(order_category_ids, ',') AS order_category_ids,
               array_to_string(order_product_ids, ',') AS order_product_ids,
               array_to_string(pay_category_ids, ',') AS pay_category_ids,
               array_to_string(pay_product_ids, ',') AS pay_product_ids, city_id
        FROM visit
        """,
    ),
)
def visit_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits from their text lines; id lists shown as text."""
    parsed = parse_visits(datasets.visit_lines(spark, sf_dir))
    lists = [c for c, kind in parsed.dtypes if kind == "array<string>"]
    return parsed.select(*[F.array_join(c, ",").alias(c) if c in lists else F.col(c) for c in parsed.columns])


@query(
    "visit_rejects",
    with_ctes(
        "k_events",
        """
        SELECT CAST(user_id AS VARCHAR) || ' - - ' || strftime(ts, '%d/%m/%Y:%H:%M:%S') AS value FROM k_events
        WHERE event_type = 'error'
        """,
    ),
)
def rejected_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events come as lines of another shape; the visit parser must set them aside."""
    other = (
        datasets.table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "error")
        .select(
            F.concat(F.col("user_id").cast("string"), F.lit(" - - "), datasets.log_time_text("ts")).alias("value")
        )
    )
    return visit_rejects(datasets.visit_lines(spark, sf_dir).unionByName(other))


_ADDRESS = "'10.0.' || CAST(CAST(floor(user_id / 256) AS BIGINT) AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR)"


@query(
    "access_log_parse",
    with_ctes(
        "k_events",
        f"""
        SELECT {_ADDRESS} AS ip, date_trunc('second', ts) AS ts,
               '/' || event_type || '/' || CAST(k AS VARCHAR) AS url
        FROM k_events
        """,
    ),
)
def access_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_log(datasets.access_log_lines(spark, sf_dir))


@query("distinct_ips", f"SELECT DISTINCT {_ADDRESS} AS ip FROM events")
def distinct_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.distinct_addresses(parse_access_log(datasets.access_log_lines(spark, sf_dir)))


@query(
    "visits_per_hour",
    "SELECT CAST(hour(ts) AS VARCHAR) AS hour, CAST(count(*) AS BIGINT) AS visits FROM events GROUP BY 1",
)
def visits_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.visits_per_hour(parse_access_log(datasets.access_log_lines(spark, sf_dir)))


@query(
    "log_urls_on_day",
    with_ctes(
        "k_events",
        f"""
        SELECT '/' || event_type || '/' || CAST(k AS VARCHAR) AS url FROM k_events
        WHERE strftime(ts, '%d/%m/%Y') = '{DAY}'
        """,
    ),
)
def log_urls_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.urls_on_day(datasets.access_log_lines(spark, sf_dir), DAY)


# ---- one-to-many -----------------------------------------------------------


@query(
    "explode_lists",
    with_ctes("visit", "SELECT session_id, unnest(order_category_ids) AS category_id FROM visit"),
)
def explode_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = datasets.visits(spark, sf_dir).select("session_id", "order_category_ids")
    return flatten_lists(ordered, "order_category_ids", "category_id")


@query(
    "explode_mixed",
    with_ctes(
        "visit",
        """
        SELECT session_id, unnest(COALESCE(order_category_ids, [click_category_id])) AS category_id FROM visit
        WHERE order_category_ids IS NOT NULL OR click_category_id IS NOT NULL
        """,
    ),
)
def explode_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lists and single clicks in one stream of category ids."""
    mixed = datasets.visits(spark, sf_dir).select("session_id", "order_category_ids", "click_category_id")
    return flatten_mixed(mixed, "order_category_ids", "click_category_id", "category_id")
