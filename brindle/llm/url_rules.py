"""URL filter by association rules.

Written rules come first: a rule fits its host and all subdomains if the path starts with
the rule's path, and the longest that fits decides.  Other URLs are judged by learned
rules: each labelled URL is a set of items (scheme, top-level domain, site, first host
label, host, first folder, extension, query or fragment present, and ``label=block``),
Spark's FP-growth mines the frequent sets, and the rules that conclude ``label=block``
with enough support, confidence and lift are kept.

Rules match through an inverted index: the rules are listed under each item they need,
the URLs' distinct item sets look up their items, and a rule fires if all its items were
hit.  Item sets fold equal URLs before that, so a hot host is a few sets.

``judge`` mines the URL's tokens besides: every host label, every path segment, every name
and value of the query, whole and split at other characters than letters and digits.
Tokens with too few blocked URLs can be in no rule and go before FP-growth; items that
lie in the same labelled URLs count as one there, and a rule fires on any of them.

DataFrame operations throughout.

Defined results: a null URL, or one without ``://``, has an empty host and path, no
written rule fits it, and no item beyond its marks; a rule of equal length that comes
first in the alphabet wins; without labelled URLs the verdict is ``allow``; labels of the
same id count once, as block if any says so; repeated rows are judged alike; other
columns are ignored.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.common import column, table
from brindle.plans.sizing import broadcast_if_small
from brindle.plans.workspace import materialize

MIN_SUPPORT = 0.002
MIN_LABELS = 20  # labelled URLs behind a rule, at least
MIN_CONFIDENCE = 0.8
MIN_LIFT = 1.2
BLOCK = "label=block"

Rule = tuple[str, str, str]  # verdict, host, path

# The written rules.
RULES: list[Rule] = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def written_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls if none does."""
    ordered = sorted(rules, key=lambda rule: (-len(rule[1] + rule[2]), rule[1] + rule[2], rule[0]))
    found, verdict = [], []
    for kind, rule_host, rule_path in ordered:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found.append(F.when(fits, F.lit(rule_host + rule_path)))
        verdict.append(F.when(fits, F.lit(kind)))
    nothing = F.lit(None).cast("string")
    return F.coalesce(*found, nothing), F.coalesce(*verdict, nothing)


def items_of(url: Column, host: Column, path: Column) -> Column:
    """The distinct items of a URL, sorted."""
    url = F.coalesce(url, F.lit(""))
    labels = F.split(host, r"\.", -1)
    parts = {
        "scheme": F.when(url.contains("://"), F.lower(F.substring_index(url, "://", 1))),
        "tld": F.element_at(labels, -1),
        "site": F.substring_index(host, ".", -2),
        "first": F.element_at(labels, 1),
        "host": host,
        "folder": F.regexp_extract(path, r"\A/([^/]+)/", 1),
        "type": F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})\z", 1)),
    }
    named = [F.when(part != "", F.concat(F.lit(name + "="), part)) for name, part in parts.items()]
    marks = [F.when(url.contains("?"), F.lit("has=query")), F.when(url.contains("#"), F.lit("has=fragment"))]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*named, *marks))))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The items of a URL and all its tokens by part, distinct and sorted."""
    query = F.coalesce(F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1), F.lit(""))
    fields = F.split(query, "&", -1)
    parts = {
        "at": F.split(host, r"\.", -1),
        "dir": F.split(F.lower(path), "/", -1),
        "arg": F.transform(fields, lambda field: F.lower(F.substring_index(field, "=", 1))),
        "arg-value": F.transform(fields, lambda field: F.lower(F.regexp_extract(field, r"(?s)\A[^=]*=(.*)\z", 1))),
    }

    def named(name: str, whole: Column) -> Column:
        words = F.concat(whole, F.flatten(F.transform(whole, lambda word: F.split(word, r"[^\p{L}\p{M}\p{N}]+", -1))))
        return F.transform(F.filter(words, lambda word: word != ""), lambda word: F.concat(F.lit(name + "="), word))

    tokens = F.concat(items_of(url, host, path), *[named(name, part) for name, part in parts.items()])
    return F.array_sort(F.array_distinct(tokens))


def parsed(pages: DataFrame, id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, items, tokens`` of every page."""
    rows = pages.select(column(id).alias("page_id"), column(url).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    parts = F.col("url"), F.col("host"), F.col("path")
    return rows.select("page_id", "host", "path", items_of(*parts).alias("items"), tokens_of(*parts).alias("tokens"))


def block_labels(labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """``page_id, block`` once per labelled id: blocked if of poor quality or toxic."""
    bad = (F.coalesce(column("quality"), F.lit(1)) == 0) | (F.coalesce(column("toxic"), F.lit(0)) == 1)
    return labels.where(column(id).isNotNull()).groupBy(column(id).alias("page_id")).agg(F.max(bad).alias("block"))


def mine(
    urls: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT
) -> DataFrame:
    """``rule, items, size, confidence, support`` of the rules that conclude block.

    ``urls`` has ``page_id, items``; ``labels`` has ``page_id, block``.
    """
    marked = urls.join(labels, "page_id").select(
        F.when(F.col("block"), F.concat("items", F.array(F.lit(BLOCK)))).otherwise(F.col("items")).alias("items")
    )
    marked = materialize(marked.where(F.size("items") > 0), "marked")
    count = max(1, marked.count())
    support = (max(MIN_LABELS, ceil(min_support * count)) - 0.5) / count  # half a row below, against rounding
    growth = FPGrowth(itemsCol="items", minSupport=min(1.0, support), minConfidence=min_confidence)
    rules = growth.fit(marked).associationRules
    enough = (F.element_at("consequent", 1) == BLOCK) & (F.col("lift") >= min_lift) & (F.col("support") >= support)
    kept = rules.where(enough)
    kept = kept.select(F.array_sort("antecedent").alias("items"), F.size("antecedent").alias("size"), "confidence", "support")
    return materialize(kept.withColumn("rule", F.array_join("items", " & ")), "rules")


def folded(
    urls: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is left to mine, which items are the same, and the rules of one item.

    Rows: ``urls`` with the labelled rows' items that longer rules can hold, one for all that
    lie in the same rows.  Then ``item, same``, all items with theirs.  Rules as in ``mine``.
    """
    marked = urls.join(labels, "page_id").where(F.col("block") | (F.size("items") > 0))
    marked = materialize(marked.select("block", "items", F.monotonically_increasing_id().alias("row")), "tokens")
    count, blocked = marked.agg(F.count("*"), F.count_if("block")).first()
    least = max(MIN_LABELS, ceil(min_support * count))
    place = [F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(salt), "row"), 32)).alias(name) for salt, name in enumerate("xy")]
    single = marked.select("row", "block", F.explode("items").alias("item")).groupBy("item").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("block"), 1)).alias("blocked"), *place
    )
    confidence = F.col("blocked") / F.col("n")
    sure = (confidence >= min_confidence) & (confidence / F.lit(blocked / max(1, count)) >= min_lift)
    single = materialize(single.where(F.col("blocked") >= least).withColumn("sure", sure), "single")
    same = single.join(single.groupBy("n", "x", "y").agg(F.max("item").alias("same")), ["n", "x", "y"])
    same = materialize(same.select("item", "same", "sure", "n", "blocked"), "same")
    alone = same.where("sure and item = same").select(
        F.array("item").alias("items"), F.lit(1).alias("size"), confidence.alias("confidence"),
        (F.col("blocked") / F.lit(count)).alias("support"), F.col("item").alias("rule"),
    )
    own = same.where("item = same and not sure").select("item")
    kept = marked.select("row", F.explode("items").alias("item")).join(broadcast_if_small(own), "item").groupBy("row").agg(F.collect_set("item").alias("own"))
    # An allowed row without such items still counts for support and lift.
    bare = F.when(F.col("block"), F.array().cast("array<string>")).otherwise(F.array(F.lit("none")))
    rows = marked.join(kept, "row", "left").select(F.col("row").alias("page_id"), "block", F.coalesce("own", bare).alias("items"))
    return materialize(rows, "folded"), same.select("item", "same"), alone


def minimal(rules: DataFrame) -> DataFrame:
    """The rules none of whose proper subsets is a rule too; subsets are found by their items."""
    needs = rules.select("rule", "size", F.explode("items").alias("item"))
    short = needs.select(F.col("rule").alias("short"), F.col("size").alias("short_size"), "item")
    held = needs.join(short, "item").where("short_size < size").groupBy("rule", "short", "short_size").agg(F.count("*").alias("hits"))
    return rules.join(held.where("hits = short_size").select("rule").distinct(), "rule", "left_anti")


def fired(urls: DataFrame, rules: DataFrame, same: DataFrame) -> DataFrame:
    """``items, learned, confidence``: for each distinct item set on which a rule fires, the surest such rule.

    An item of a rule is hit by each ``item`` that is the ``same``; the last of them names it.
    """
    needs = rules.select(F.explode("items").alias("same"), "rule", "size", "confidence", "support")
    index = materialize(needs.join(same, "same"), "index")
    sets = urls.select("items").distinct()
    hits = sets.select("items", F.explode("items").alias("item")).join(broadcast_if_small(index), "item")
    hits = hits.groupBy("items", "rule", "same", "size", "confidence", "support").agg(F.max("item").alias("item"))
    whole = hits.groupBy("items", "rule", "size", "confidence", "support").agg(F.array_sort(F.collect_list("item")).alias("own"))
    rank = F.struct("confidence", "support", F.negative("size").alias("short"), F.array_join("own", " & ").alias("rule"))
    return whole.where(F.size("own") == F.col("size")).groupBy("items").agg(F.max(rank).alias("best")).select(
        "items", F.col("best.rule").alias("learned"), F.col("best.confidence").alias("confidence")
    )


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule] = RULES, id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page, with the learned rule behind a learned block."""
    urls = parsed(pages, id, url).drop("items").withColumnRenamed("tokens", "items")
    rows, same, alone = folded(urls, labels)
    longer = minimal(mine(rows.select("page_id", "items"), rows.select("page_id", "block"))).select(*alone.columns)
    blocks = fired(urls, longer.unionByName(alone), same)
    judged = urls.join(broadcast_if_small(materialize(blocks, "fired")), "items", "left")
    rule, verdict = written_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("learned").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "learned", "confidence")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), block_labels(table(spark, sf_dir, "labels")))


def _rules_sql() -> tuple[str, str]:
    ordered = sorted(RULES, key=lambda rule: (-len(rule[1] + rule[2]), rule[1] + rule[2], rule[0]))
    fits = [(kind, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for kind, h, p in ordered]
    return tuple("CASE " + " ".join(f"WHEN {test} THEN '{(name, kind)[part]}'" for kind, name, test in fits) + " END" for part in (0, 1))


_BREAK = r"[^\p{L}\p{M}\p{N}]+"


def _words_sql(name: str, parts: str) -> str:
    """The whole parts and their words, marked with the part's name."""
    words = f"list_concat({parts}, flatten(list_transform({parts}, lambda p: regexp_split_to_array(p, '{_BREAK}'))))"
    return f"list_transform(list_filter({words}, lambda w: w <> ''), lambda w: '{name}=' || w)"


# Counts the sets of those items of a labelled URL that make no rule alone: for small tables.
OP9_SQL = f"""
WITH url AS (
    SELECT page_id, coalesce(url, '') AS url,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
),
part AS (
    SELECT *, string_split(host, '.') AS labels, regexp_extract(path, '^/([^/]+)/', 1) AS folder,
           lower(regexp_extract(path, '\\.([A-Za-z0-9]{{1,8}})$', 1)) AS kind,
           CASE WHEN contains(url, '://') THEN lower(split_part(url, '://', 1)) ELSE '' END AS scheme,
           string_split(lower(path), '/') AS dirs, string_split(regexp_extract(url, '(?s)^[^?#]*\\?([^#]*)', 1), '&') AS fields
    FROM url
),
page AS (
    SELECT page_id, host, path, list_sort(list_distinct(list_concat(list_filter([
               CASE WHEN scheme <> '' THEN 'scheme=' || scheme END, CASE WHEN host <> '' THEN 'tld=' || labels[-1] END,
               CASE WHEN host <> '' THEN 'site=' || array_to_string(labels[-2:], '.') END,
               CASE WHEN labels[1] <> '' THEN 'first=' || labels[1] END, CASE WHEN host <> '' THEN 'host=' || host END,
               CASE WHEN folder <> '' THEN 'folder=' || folder END, CASE WHEN kind <> '' THEN 'type=' || kind END,
               CASE WHEN contains(url, '?') THEN 'has=query' END, CASE WHEN contains(url, '#') THEN 'has=fragment' END
           ], lambda x: x IS NOT NULL),
           {_words_sql("at", "labels")},
           {_words_sql("dir", "dirs")},
           {_words_sql("arg", "list_transform(fields, lambda f: lower(split_part(f, '=', 1)))")},
           {_words_sql("arg-value", "list_transform(fields, lambda f: lower(regexp_extract(f, '(?s)^[^=]*=(.*)$', 1)))")}))) AS items
    FROM part
),
label AS (
    SELECT doc_id, bool_or(coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1) AS block FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
marked AS (SELECT items, block FROM page JOIN label ON page_id = doc_id WHERE block OR len(items) > 0),
whole AS (
    SELECT count(*) AS n, count(*) FILTER (block) AS blocked, greatest({MIN_LABELS}, ceil({MIN_SUPPORT}::DOUBLE * count(*))) AS least FROM marked
),
single AS (
    SELECT item, c.blocked::DOUBLE / c.n AS confidence, c.blocked::DOUBLE / w.n AS support,
           c.blocked::DOUBLE / c.n >= {MIN_CONFIDENCE} AND (c.blocked::DOUBLE / c.n) / (w.blocked::DOUBLE / w.n) >= {MIN_LIFT} AS sure
    FROM (SELECT item, count(*) AS n, count(*) FILTER (block) AS blocked FROM (SELECT block, unnest(items) AS item FROM marked) GROUP BY item) c, whole w
    WHERE c.blocked >= least
),
open_items AS (SELECT coalesce(list(item), []) AS names FROM single WHERE NOT sure),
counted AS (
    SELECT list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS part, count(*) AS n, count(*) FILTER (block) AS blocked
    FROM (SELECT items, block, unnest(range(1, 1 << len(items))) AS mask
          FROM (SELECT block, list_filter(items, lambda x: list_contains(names, x)) AS items FROM marked, open_items))
    GROUP BY 1
),
several AS (
    SELECT part, c.blocked::DOUBLE / c.n AS confidence, c.blocked::DOUBLE / w.n AS support
    FROM counted c, whole w
    WHERE c.blocked >= least AND c.blocked::DOUBLE / c.n >= {MIN_CONFIDENCE} AND (c.blocked::DOUBLE / c.n) / (w.blocked::DOUBLE / w.n) >= {MIN_LIFT}
),
found AS (
    SELECT [item] AS part, confidence, support FROM single WHERE sure
    UNION ALL
    SELECT * FROM several s WHERE NOT EXISTS (SELECT 1 FROM several o WHERE len(o.part) < len(s.part) AND list_has_all(s.part, o.part))
),
fired AS (
    SELECT items, array_to_string(part, ' & ') AS learned, confidence,
           row_number() OVER (PARTITION BY items ORDER BY confidence DESC, support DESC, len(part), array_to_string(part, ' & ') DESC) AS place
    FROM (SELECT DISTINCT items FROM page) JOIN found ON list_has_all(items, part)
)
SELECT page_id, host, path, {_rules_sql()[0]} AS rule,
       coalesce({_rules_sql()[1]}, CASE WHEN learned IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, learned, confidence
FROM page p LEFT JOIN fired f ON p.items = f.items AND f.place = 1
"""
