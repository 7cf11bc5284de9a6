"""Repair of conversations by Knuth's lightest derivation.

A conversation should have the role initials ``(s?(ua)+)?``.  Its repair is a derivation:
an item ``at(i, q)`` says that the first ``i`` rows are read and leave the pattern in state
``q``; with the fact ``row(i)`` it gives ``at(i + 1, q')`` by keeping, re-roling or
deleting the row, and alone it gives ``at(i, q')`` by inserting one.  The weight of an item
is ``(cost, audit)``.  Both only grow along a deduction (superior functions), and of two
audits of one item with equal cost none is a prefix of the other, so order is kept
(monotone).  The agenda therefore pops items in the order of their final weights, and the
repair is known when the goal is popped.

Conversations of ordinary size are sorted into the stream of one task each.  Long ones are
cut into blocks over many tasks; each block derives its four by four spans ``q -> q'`` by
the same agenda, and the spans of a conversation are chained in order.  Only their audits
meet in one task.  The digest of a long conversation's repaired text is one stream by its
nature: it is read in order, never held.

Defined results: a null role or text is one space; rows are read by turn, nulls first, then
by role and text; a null ``conv_id`` is a conversation; roles are told by their first
character, and any but ``s``, ``u``, ``a`` cannot be kept; repeated rows are duplicates; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.common import column, table, text_key
from brindle.plans.sizing import broadcast_if_small
from brindle.plans.workspace import materialize

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}  # the role of what is made in a state
COMPLETE = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
REROLE, DELETE, TRUNCATED, INSERT = 1, 2, 5, 5
BLANK, COPY, CUT = 1, 2, 3  # the faults of a row
BLOCK = 256  # rows of one agenda: its items hold audits of that length
LONG_ROWS, LONG_BYTES = 20_000, 16 << 20
_BLANKS = " \t\n\v\f\r"

Weight = tuple[int, str]
Fact = tuple[str, int]  # initial of the role, fault

RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string,"
    " repaired_sha256 string"
)
ROWS = "conv_id bigint, place bigint, edit string, role string, text string"


def lightest(axioms: dict, consequences: Callable, goal: object = None) -> dict:
    """Final weights of the items that ``axioms`` and ``consequences`` derive, in the order of their weights.

    ``consequences(item, chart)`` gives ``(weight, item)`` of every deduction whose last
    antecedent to become final is ``item``.  Stops when ``goal`` is final.
    """
    agenda = [(weight, item) for item, weight in axioms.items()]
    heapq.heapify(agenda)
    chart: dict = {}
    while agenda and goal not in chart:
        weight, item = heapq.heappop(agenda)
        if item not in chart:
            chart[item] = weight
            for made in consequences(item, chart):
                if made[1] not in chart:
                    heapq.heappush(agenda, made)
    return chart


def derive(facts: list[Fact], start: int = START, closing: bool = True) -> dict[int, Weight]:
    """The lightest repair of rows from a state of the pattern: its weight by the state it ends in.

    With ``closing`` only complete patterns end, in the one lightest way (state ``ASSISTANT``).
    Otherwise rows follow, and what is inserted after the last row is left to them.
    """
    size = len(facts)

    def edits(i: int, state: int, weight: Weight) -> Iterator[tuple[Weight, tuple]]:
        cost, audit = weight
        initial, fault = facts[i]
        yield (cost + DELETE, audit + "D"), ("at", i + 1, state)
        if fault not in (BLANK, COPY):
            stays = cost + (TRUNCATED if fault == CUT else 0)
            if (state, initial) in NEXT:
                yield (stays, audit + "K"), ("at", i + 1, NEXT[state, initial])
            yield (stays + REROLE, audit + "R"), ("at", i + 1, NEXT[state, WANTED[state][0]])

    def consequences(item: tuple, chart: dict) -> Iterator[tuple[Weight, tuple]]:
        kind, i, state = item
        weight = chart[item]
        if kind == "row":
            for before in range(4):
                if ("at", i, before) in chart:
                    yield from edits(i, before, chart["at", i, before])
        elif kind == "at":
            if i < size or closing:
                yield (weight[0] + INSERT, weight[1] + "I"), ("at", i, NEXT[state, WANTED[state][0]])
            if i < size and ("row", i, 0) in chart:
                yield from edits(i, state, weight)
            if i == size and closing and state in COMPLETE:
                yield weight, goal

    goal = ("goal", size, 0)
    axioms: dict = {("row", i, 0): (0, "") for i in range(size)}
    axioms["at", 0, start] = (0, "")
    chart = lightest(axioms, consequences, goal if closing else None)
    if closing:
        return {ASSISTANT: chart[goal]}
    return {state: chart["at", size, state] for state in range(4) if ("at", size, state) in chart}


_ENDS = {state: derive([], state) for state in range(4)}


def chain(blocks: Iterable[dict[int, dict[int, Weight]]]) -> tuple[int, list[tuple[int, str]]]:
    """The cost of a conversation from the spans of its blocks, and the start state and audit of each block and of its end.

    A state keeps its cost and the rank of its audit among the states'.  Audits that read
    the same rows end in a row's edit, so none is a prefix of another, and ranks decide.
    """
    now: dict[int, tuple[int, int]] = {START: (0, 0)}
    back: list[dict[int, tuple[int, str]]] = []
    for spans in [*blocks, _ENDS]:
        best: dict[int, tuple[int, int, str, int]] = {}
        for before, (cost, rank) in now.items():
            for state, (more, audit) in spans[before].items():
                made = (cost + more, rank, audit, before)
                if state not in best or made < best[state]:
                    best[state] = made
        order = sorted(best, key=lambda state: best[state][1:3])
        now = {state: (best[state][0], order.index(state)) for state in best}
        back.append({state: (made[3], made[2]) for state, made in best.items()})
    pieces, state = [], ASSISTANT
    for links in reversed(back):
        state, audit = links[state]
        pieces.append((state, audit))
    return now[ASSISTANT][0], pieces[::-1]


def all_spans(facts: list[Fact]) -> dict[int, dict[int, Weight]]:
    return {state: derive(facts, state, closing=False) for state in range(4)}


def repair(facts: list[Fact]) -> Weight:
    """Cost and audit of the cheapest repair."""
    if len(facts) <= BLOCK:
        return derive(facts)[ASSISTANT]
    cost, pieces = chain(all_spans(facts[low : low + BLOCK]) for low in range(0, len(facts), BLOCK))
    return cost, "".join(audit for _, audit in pieces)


def rebuilt(audit: str, rows: Iterator[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str, str]]:
    """``edit, role, text`` of the repaired rows; takes from ``rows`` what ``audit`` reads."""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        role = role if edit == "K" else WANTED[state]
        state = NEXT[state, role[0]]
        yield edit, role, text


def fault_of(text: str, seen: bool) -> int:
    """The first fault of a row."""
    last = text.rstrip(_BLANKS)[-1:]
    return BLANK if not last else COPY if seen else CUT if last not in ".!?" else 0


def _illegal(initials: list[str]) -> int:
    return sum(pair not in LEGAL for pair in map("".join, zip(initials, initials[1:])))


class _Digest:
    """The digest of ``role:text`` lines."""

    def __init__(self) -> None:
        self.sha, self.lines = hashlib.sha256(), 0

    def add(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(part.to_pylist() for part in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(part, kind) for part, kind in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(part, kind) for part, kind in zip(zip(*held), schema.types)], schema=schema)


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}


def _mapped(df: DataFrame, made: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``made`` of the rows of each partition, as a stream."""
    fields = [field.split() for field in schema.split(",")]
    arrow = pa.schema([(name, _ARROW[kind]) for name, kind in fields])
    return df.mapInArrow(lambda batches: _batches(made(_values(batches)), arrow), schema)


def _whole(rows: Iterator[tuple], wanted: str) -> Iterator[tuple]:
    """Results (or repaired rows) of sorted ``conv_id, turn, role, text`` rows that hold whole conversations."""
    for conv, own in groupby(rows, key=lambda row: row[0]):
        own = list(own)
        said: set = set()
        facts: list[Fact] = []
        for _, _, role, text in own:
            facts.append((role[:1], fault_of(text, (role, text) in said)))
            said.add((role, text))
        cost, audit = repair(facts)
        made = rebuilt(audit, ((role, text) for _, _, role, text in own))
        if wanted == ROWS:
            yield from ((conv, place, *row) for place, row in enumerate(made))
            continue
        digest = _Digest()
        for _, role, text in made:
            digest.add(role, text)
        turns = {turn for _, turn, _, _ in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults = [fault for _, fault in facts]
        yield (
            conv, gaps, faults.count(BLANK), faults.count(COPY), faults.count(CUT), _illegal([initial for initial, _ in facts]),
            cost, audit, digest.sha.hexdigest(),
        )


_ORDER = ("conv_id", "turn", "role", "text")


def _spans_of(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Spans of blocks, as one row for each pair of states; ``facts`` come as initials and digits in one text."""
    for conv, block, initials, faults in rows:
        facts = list(zip(initials, map(int, faults)))
        for state, ends in all_spans([(initial.strip("\0"), fault) for initial, fault in facts]).items():
            for end, (cost, audit) in ends.items():
                yield conv, block, initials, state, end, cost, audit


def _chained(rows: Iterator[tuple]) -> Iterator[tuple]:
    """For each block and the end of each conversation: start state, audit; the end also has cost and illegal pairs."""
    for conv, own in groupby(rows, key=lambda row: row[0]):
        places: list[int] = []
        illegal, last = 0, ""

        def spans() -> Iterator[dict]:
            nonlocal illegal, last
            for block, cells in groupby(own, key=lambda row: row[1]):
                found: dict = {state: {} for state in range(4)}
                for _, _, initials, state, end, cost, audit in cells:
                    found[state][end] = (cost, audit)
                illegal += _illegal([*last, *initials])
                last = initials[-1]
                places.append(block)
                yield found

        cost, pieces = chain(spans())
        for block, (state, audit) in zip(places, pieces):
            yield conv, block, state, audit, None, None
        yield conv, places[-1] + 1, *pieces[-1], cost, illegal


def _streamed(rows: Iterator[tuple], wanted: str) -> Iterator[tuple]:
    """Digests (or repaired rows) from sorted rows of texts, each block led by the row with its audit."""
    for conv, own in groupby(rows, key=lambda row: row[0]):
        digest, audits = _Digest(), []
        for _, _, _, role, text, state, audit, cost, illegal in own:
            # Row by row: the generator below takes the texts that follow from the same stream.
            for edit, role, text in rebuilt(audit, ((row[3], row[4]) for row in own), state):
                if wanted == ROWS:
                    yield conv, digest.lines, edit, role, text
                digest.add(role, text)
            audits.append(audit)
        if wanted != ROWS:
            yield conv, illegal, cost, "".join(audits), digest.sha.hexdigest()


def _long(rows: DataFrame, wanted: str) -> DataFrame:
    """The same for conversations too long for one task."""
    place = F.monotonically_increasing_id()
    # Equal rows differ by where they lay, so that a range of them can be split too.
    dealt = rows.withColumn("lay", place).repartitionByRange("conv_id", F.asc_nulls_first("turn"), "role", "text", "lay")
    dealt = dealt.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text").drop("lay").withColumn("place", place)
    keyed = dealt.withColumns({"first": text_key(F.col("text")), "second": text_key(F.col("text"), 1)})
    ordered = materialize(keyed.withColumn("block", F.expr(f"place div {BLOCK}")), "long-rows")

    said = ["conv_id", "role", "first", "second"]
    earliest = ordered.groupBy(*said).agg(F.min("place").alias("earliest")).select(*[F.col(c).alias(f"{c}_") for c in said], "earliest")
    same = F.col("conv_id").eqNullSafe(F.col("conv_id_"))
    for name in said[1:]:
        same = same & (F.col(name) == F.col(f"{name}_"))
    blanks = F.lit(_BLANKS)
    last = F.substring(F.rtrim("text", blanks), -1, 1)
    fault = (
        F.when(last == "", BLANK).when(F.col("earliest") < F.col("place"), COPY).when(~last.isin(".", "!", "?"), CUT).otherwise(0)
    )
    initial = F.when(F.col("role") == "", F.lit("\0")).otherwise(F.substring("role", 1, 1))
    marked = ordered.join(earliest, same).select("conv_id", "turn", "block", "place", initial.alias("initial"), fault.alias("fault"))
    marked = materialize(marked, "long-marks")

    listed = F.sort_array(F.collect_list(F.struct("place", "initial", "fault")))
    blocks = marked.groupBy("conv_id", "block").agg(listed.alias("listed")).select(
        "conv_id", "block", F.array_join("listed.initial", "").alias("initials"),
        F.array_join(F.transform("listed.fault", lambda one: one.cast("string")), "").alias("faults"),
    )
    spans = _mapped(blocks, _spans_of, "conv_id bigint, block bigint, initials string, start int, end int, cost bigint, audit string")
    spans = spans.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    audits = materialize(
        _mapped(spans, _chained, "conv_id bigint, block bigint, start int, audit string, cost bigint, illegal bigint"), "long-audits"
    )

    none = F.lit(None)
    lines = audits.select(
        "conv_id", "block", F.lit(-1).cast("bigint").alias("place"), none.cast("string").alias("role"), none.cast("string").alias("text"),
        "start", "audit", "cost", "illegal",
    ).union(
        ordered.select(
            "conv_id", "block", "place", "role", "text", none.cast("int"), none.cast("string"), none.cast("bigint"), none.cast("bigint")
        )
    )
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "block", "place")
    if wanted == ROWS:
        return _mapped(lines, lambda stream: _streamed(stream, ROWS), ROWS)
    digests = _mapped(
        lines, lambda stream: _streamed(stream, RESULT),
        "conv_id bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    )
    turns = marked.groupBy("conv_id", "turn").agg(*[F.count_if(F.col("fault") == n).alias(f"n{n}") for n in (BLANK, COPY, CUT)])
    counted = turns.groupBy(F.col("conv_id").alias("counted")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(f"n{n}").alias(name) for n, name in ((BLANK, "blank"), (COPY, "duplicate"), (CUT, "truncated"))],
    )
    met = digests.join(counted, F.col("conv_id").eqNullSafe(F.col("counted")))
    return met.select(*[field.split()[0] for field in RESULT.split(",")])


def _repaired(rows: DataFrame, wanted: str, long_rows: int, long_bytes: int) -> DataFrame:
    space = F.lit(" ")
    plain = rows.select(
        "conv_id", "turn", F.coalesce(column("role"), space).alias("role"), F.coalesce(column("text"), space).alias("text")
    )
    sizes = plain.groupBy(F.col("conv_id").alias("long_id")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text") + 64).alias("bytes"))
    long_ids = materialize(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("long_id"), "long-ids")
    any_long = not long_ids.isEmpty()
    listed, same = broadcast_if_small(long_ids), F.col("conv_id").eqNullSafe(F.col("long_id"))
    usual = plain.join(listed, same, "left_anti") if any_long else plain
    usual = usual.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    done = _mapped(usual, lambda stream: _whole(stream, wanted), wanted)
    return done.union(_long(plain.join(listed, same, "left_semi"), wanted)) if any_long else done


def repaired(rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """For each ``conv_id`` of ``rows`` (``conv_id, turn, role, text``): its faults, the cheapest repair and that one's digest."""
    return _repaired(rows, RESULT, long_rows, long_bytes)


def repaired_rows(rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """The rows of the repaired conversations in order: ``conv_id, place, edit, role, text``."""
    return _repaired(rows, ROWS, long_rows, long_bytes)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with every twentieth, told by a checksum of conversation and turn, dropped, emptied, cut, repeated or made the user's."""
    space = F.lit(" ")
    named = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind: Column = F.crc32(named.cast("binary")) % 20
    text = F.coalesce(column("text"), space)
    return (
        rows.select("conv_id", "turn", F.coalesce(column("role"), space).alias("role"), text.alias("text"), kind.alias("kind"))
        .where("kind <> 0")
        .withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", "role", "text")
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repair of every conversation after ``damaged``; one that lost all its rows has zeros and an empty audit."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    known = rows.select(F.col("conv_id").alias("known")).distinct()
    found = known.join(repaired(damaged(rows)), F.col("known").eqNullSafe(F.col("conv_id")), "left")
    nothing = hashlib.sha256().hexdigest()
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        F.col("known").alias("conv_id"), *[F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


def _moves() -> str:
    """The steps of a repair from one row to the next, as SQL rows: state, what is inserted and done, initial wanted, new state, cost."""
    found = []
    for state in range(4):
        inserted, at, seen = "", state, set()
        while at not in seen:  # an insertion that comes back to a state is never cheapest
            seen.add(at)
            cost = INSERT * len(inserted)
            made = NEXT[at, WANTED[at][0]]
            found.append((state, inserted + "D", None, at, cost + DELETE))
            found.append((state, inserted + "R", None, made, cost + REROLE))
            found += [(state, inserted + "K", initial, after, cost) for (before, initial), after in NEXT.items() if before == at]
            inserted, at = inserted + "I", made
    cells = (f"({q}, '{edits}', {f"'{initial}'" if initial else 'NULL'}, {after}, {cost})" for q, edits, initial, after, cost in found)
    return ", ".join(cells)


_CLOSING = ", ".join(f"({state}, {ends[ASSISTANT][0]}, '{ends[ASSISTANT][1]}')" for state, ends in _ENDS.items())

# A recursive query reads one row of every conversation a step and keeps the lightest audit of each state.
OP11_SQL = f"""
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda c, n: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
        FROM range(256) r(i))
),
named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
),
kinds AS (
    SELECT conv_id, turn, role, text,
           xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                                        list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(substr(name, i, 1)) AS BIGINT))),
                           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
    FROM named, crc_table
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM kinds WHERE kind <> 0
),
placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
           right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last_char
    FROM damaged
),
marked AS (
    SELECT *, CASE WHEN last_char = '' THEN 1 WHEN seen THEN 2 WHEN last_char NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
           initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS pair
    FROM placed
),
counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
),
moves(q, edits, initial, after, cost) AS (VALUES {_moves()}),
steps AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, {START} AS q, {{'cost': CAST(0 AS BIGINT), 'audit': ''}} AS best FROM counted
    UNION ALL
    SELECT s.conv_id, s.i + 1, m.after,
           min({{'cost': CAST(s.best.cost + m.cost + CASE WHEN r.fault = 3 AND m.edits NOT LIKE '%D' THEN {TRUNCATED} ELSE 0 END AS BIGINT),
                 'audit': s.best.audit || m.edits}})
    FROM steps s
    JOIN marked r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1
    JOIN moves m ON m.q = s.q AND (m.initial IS NULL OR m.initial = r.initial) AND (r.fault NOT IN (1, 2) OR m.edits LIKE '%D')
    GROUP BY s.conv_id, s.i, m.after
),
closing(q, cost, audit) AS (VALUES {_CLOSING}),
ended AS (
    SELECT s.conv_id, min({{'cost': s.best.cost + e.cost, 'audit': s.best.audit || e.audit}}) AS best
    FROM steps s JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i JOIN closing e ON e.q = s.q
    GROUP BY s.conv_id
),
letters AS (
    SELECT conv_id, unnest(string_split(best.audit, '')) AS edit, unnest(range(1, length(best.audit) + 1)) AS k
    FROM ended WHERE best.audit <> ''
),
read AS (
    SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS place
    FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)
),
kept AS (
    SELECT d.*, r.role, r.text, CAST(d.edit = 'K' AND r.initial = 's' AS INTEGER) AS opens
    FROM read d LEFT JOIN marked r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i
    WHERE d.edit <> 'D'
),
lines AS (
    SELECT conv_id, place,
           CASE WHEN edit = 'K' THEN role WHEN (place - max(opens) OVER (PARTITION BY conv_id)) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line
    FROM kept
),
digests AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY place)) AS digest FROM lines GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost,
       coalesce(e.best.audit, '') AS audit, coalesce(d.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""
