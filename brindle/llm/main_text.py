"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive, tags negative, and one
linear scan finds the contiguous region of the largest sum.  The weights come from
labelled pages, those that mark their content by one ``<article>`` or ``<main>``: a word
weighs as much as words under the same tag lie inside the content, a tag loses as much as
that tag lies outside.  The marking tags themselves are neutral, so the scan works alike
on pages without them.

Inside the region, elements that are boilerplate by their name, by a token of their
class, id or role, or by what was learned are left out; what remains is split into blocks.
Tokens never tell against html, body, main, article, headings or what holds the content.
On sections and on elements named as containers tokens count whole; on others their parts
at ``-`` and ``_`` count too, unless one says a state, as in ``has-sidebar``.

Learning reads a sample of ``SAMPLE`` labelled pages by hash of the id (the documented
bound); extraction reads every page, whole.

Defined results: a null or empty page, or one without words, has empty text; an element,
tag or quoted value that is never closed ends with the page; tags are read in time linear
in the page, however malformed; inside ``<article>`` and ``<main>`` a tag costs next to nothing,
so tables, listings and lists of links there are kept whole; a region of equal score that comes first wins;
without labelled pages the prior weights stand; repeated rows are extracted alike; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.common import column, table

SAMPLE = 2_000
TAG_COST = 0.2
MARKED_COST = 0.05
TAG_RANGE = 12.0
LEARNED_SHARE = 0.95
LEARNED_SUPPORT = 20

# Names that mean the same on any page.
LABELS = frozenset("article main".split())
RAW = "script style template textarea title iframe svg select".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav aside footer header form button dialog menu label".split())
BOILERPLATE_TOKENS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies notice consent sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs footer header comment comments share sharing social related newsletter subscribe "
    "popup modal login signup search widget complementary contentinfo hidden".split()
)
TOKENS_IGNORED = frozenset("html body main article h1 h2 h3 h4 h5 h6 hgroup".split())
CONTAINER_TOKENS = frozenset("content main article post entry story body text wrapper container page".split())
STATES = frozenset("has no not with without is open opened closed enabled disabled on off".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)

TEXT_TAGS = frozenset(
    "p br b i u em strong span a h1 h2 h3 h4 h5 h6 blockquote code pre ul ol li sup sub small mark q cite figure figcaption "
    "table caption colgroup col thead tbody tfoot tr td th dl dt dd kbd samp var abbr time del ins details summary "
    "math mi mn mo mrow msub msup mfrac msqrt mtext semantics".split()
)

# Every alternative takes all it looks at, to the end of the page if need be, and gives
# nothing back: a page is cut into tokens in time in proportion to its length.
_TOKEN = re.compile(
    r"<!--(?>.*?(?:-->|\Z))"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*+(?:>(?>.*?(?:</(?P=raw)\s*+>|\Z))|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<rest>[^>=]*+(?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+[^>=]*+)*+)(?:>|\Z)"
    r"|<[/!?][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.I | re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# kind (text, open, close), signature of the tag or of the parent, text, inside boilerplate, tag of an element that holds the
# content, inside an element that marks content
Token = tuple[str, str, str, bool, bool, bool]


def signature(name: str, rest: str) -> str:
    """The tag's name and its class, id and role tokens."""
    if not rest or "=" not in rest:
        return name
    words = " ".join(a or b or c for a, b, c in _NAMES.findall(rest)).lower().split()
    return " ".join([name, *sorted(set(words))])


def is_boilerplate(sign: str, inside_label: bool, holds: bool = False) -> bool:
    name, *tokens = sign.split(" ")
    if holds:
        return False
    if name in BOILERPLATE and not (inside_label and name == "header"):
        return True
    if name in TOKENS_IGNORED:
        return False
    if not BOILERPLATE_TOKENS.isdisjoint(tokens):
        return True
    if name == "section" or not CONTAINER_TOKENS.isdisjoint(tokens):
        return False
    parts = [re.split("[-_]", token) for token in tokens]
    return any(not BOILERPLATE_TOKENS.isdisjoint(own) and STATES.isdisjoint(own) for own in parts)


def holders(html: str) -> frozenset[int]:
    """Where the elements open that hold the content: the only ``<main>``, or else the only outermost ``<article>``."""
    stack: list[tuple[str, int]] = []
    found: dict[str, list[int]] = {"main": [], "article": []}
    opened: Counter[str] = Counter()
    depth: Counter[str] = Counter()
    for token in _TOKEN.finditer(html):
        name = (token["name"] or "").lower()
        if not name or name in VOID:
            continue
        if not token["close"]:
            if name in ("p", "li") and stack and stack[-1][0] == name:
                depth[stack.pop()[0]] -= 1
            if name in LABELS and not any(depth[label] for label in LABELS):
                opened[name] += 1
                if opened[name] == 1:
                    found[name] = [place for _, place in stack]
            if not token["rest"].endswith("/"):
                stack.append((name, token.start()))
                depth[name] += 1
        elif depth[name] > 0:
            while True:
                popped = stack.pop()[0]
                depth[popped] -= 1
                if popped == name:
                    break
    label = "main" if opened["main"] else "article"
    return frozenset(found[label] if opened[label] == 1 else [])


def scan(html: str, learned: frozenset[str] = frozenset()) -> Iterator[Token]:
    """The tags and texts of a page, in order, each with the tag it stands under."""
    stack: list[tuple[str, str, bool, bool]] = []  # name, signature, boilerplate from here down, holds the content
    depth: Counter[str] = Counter()
    holding = holders(html)
    for token in _TOKEN.finditer(html):
        text, name = token["text"], token["name"]
        top = stack[-1] if stack else ("", "", False, False)
        marked = any(depth[label] for label in LABELS)
        if text is not None:
            yield "text", top[1], text, top[2], False, marked
        elif name is not None:
            name = name.lower()
            if not token["close"]:
                sign = signature(name, token["rest"])
                if name == "p" and top[0] == "p" or name == "li" and top[0] == "li":
                    depth[stack.pop()[0]] -= 1
                    top = stack[-1] if stack else ("", "", False, False)
                inside = any(depth[label] for label in LABELS)
                holds = token.start() in holding
                free = holds or name in TOKENS_IGNORED
                out = top[2] or sign in learned and not free or is_boilerplate(sign, inside, holds)
                yield "open", sign, name, out, holds, marked
                if name not in VOID and not token["rest"].endswith("/"):
                    stack.append((name, sign, out, holds))
                    depth[name] += 1
            elif depth[name] > 0:
                while True:
                    popped = stack.pop()
                    depth[popped[0]] -= 1
                    if popped[0] == name:
                        break
                yield "close", popped[1], name, popped[2], popped[3], marked
            else:
                yield "close", name, name, top[2], False, marked


def label_counts(html: str) -> Counter[tuple[str, str, bool]]:
    """``(word or tag, signature, inside the content)`` counts of a page with one content element; else nothing."""
    counts: Counter[tuple[str, str, bool]] = Counter()
    inside, labels = False, 0
    for kind, sign, text, _, holds, _ in scan(html):
        if kind == "text":
            counts["word", sign, inside] += len(text.split())
        elif text in LABELS:
            inside = kind == "open"
            labels += inside
        else:
            counts["holder" if holds else "tag", sign, inside] += 1
    return counts if labels == 1 else Counter()


class Weights:
    """What words under a tag and tags themselves add to the score."""

    def __init__(self, inside: dict[tuple[str, str], int], outside: dict[tuple[str, str], int]):
        # Tags of elements that hold the content cost as others do, but are no evidence of boilerplate.
        alone = outside
        outside = Counter({key: n for key, n in outside.items() if key[0] != "holder"})
        outside.update({("tag", sign): n for (kind, sign), n in alone.items() if kind == "holder"})
        share = {key: (inside.get(key, 0) + 1) / (inside.get(key, 0) + outside.get(key, 0) + 2) for key in inside.keys() | outside.keys()}
        self.word = {sign: value for (kind, sign), value in share.items() if kind == "word"}
        self.tag = {sign: -TAG_COST - TAG_RANGE * (1 - value) for (kind, sign), value in share.items() if kind == "tag"}
        # A tag that labelled pages show next to never in their content.
        self.learned = frozenset(
            sign for (kind, sign), value in share.items()
            if kind == "tag" and " " in sign and value < 1 - LEARNED_SHARE and alone.get((kind, sign), 0) >= LEARNED_SUPPORT and ("holder", sign) not in alone
        )

    def of_words(self, sign: str, words: int) -> float:
        return words * self.word.get(sign, 0.5)

    def of_tag(self, sign: str, name: str, marked: bool = False) -> float:
        if marked:  # what stands inside marked content is not cut for its tags
            return -MARKED_COST
        if name in LABELS:
            return -TAG_COST
        unseen = -TAG_COST if name in TEXT_TAGS else -TAG_COST - TAG_RANGE / 2 if " " in sign else -1.0
        return self.tag.get(sign, self.tag.get(name, unseen) if name in TEXT_TAGS else unseen)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the stretch with the largest positive sum; the first of equals; ``0, 0`` if none."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for place, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, place
        total += score
        if total > best:
            best, region = total, (start, place + 1)
    return region


def main_text(html: str | None, weights: Weights) -> str:
    """The main text of a page: blocks joined by a line break."""
    tokens = list(scan(html or "", weights.learned))
    scores = []
    for kind, sign, text, out, _, marked in tokens:
        if kind == "text":
            scores.append(0.0 if out else weights.of_words(sign, len(unescape(text).split())))
        else:
            scores.append(weights.of_tag(sign, text, marked))
    low, high = best_region(scores)
    blocks, own = [], []
    for kind, _, text, out, _, _ in tokens[low:high]:
        if kind == "text":
            if not out:
                own.append(text)
        elif text in BLOCKS:
            blocks.append(own)
            own = []
        elif text == "br":
            own.append(" ")
    blocks.append(own)
    lines = (" ".join("".join(map(unescape, own)).split()) for own in blocks)
    return "\n".join(line for line in lines if line)


def learn(pages: DataFrame, id: str = "page_id", html: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights from a sample of the labelled pages."""
    marked = pages.select(column(id).alias("id"), column(html).alias("html")).where(
        F.col("html").rlike("(?i)<(" + "|".join(sorted(LABELS)) + r")[\s>]")
    )
    share = min(1.0, sample / max(1, marked.count()))
    drawn = marked.where(F.pmod(F.xxhash64(F.lit(5), F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1 << 30)) < share * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, str, bool]] = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                total.update(label_counts(page))
        rows = list(zip(*[(kind, sign, inside, n) for (kind, sign, inside), n in total.items()])) or [[]] * 4
        kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds)], ["kind", "sign", "inside", "n"])

    counted = drawn.select("html").mapInArrow(count, "kind string, sign string, inside boolean, n bigint")
    sides: dict[bool, dict[tuple[str, str], int]] = {True: {}, False: {}}
    for row in counted.groupBy("kind", "sign", "inside").agg(F.sum("n").alias("n")).collect():
        sides[row["inside"]][row["kind"], row["sign"]] = row["n"]
    return Weights(sides[True], sides[False])


def extract(pages: DataFrame, weights: Weights, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    source = pages.select(column(id).alias("page_id"), column(url).alias("url"), column(html).alias("html"))
    schema = source.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("bigint").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return source.mapInArrow(run, schema)


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learn(pages))
