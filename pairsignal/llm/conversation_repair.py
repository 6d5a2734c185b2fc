"""Conversation structure repair: bidirectional Dijkstra over the edit lattice.

A conversation is repaired into an optional system turn and one or more (user, assistant) pairs, or
into nothing.  A node of the lattice is (rows read, state of that grammar); an edge reads a row (Keep
it, Rerole it to user or assistant, Delete it) or Inserts an empty turn.  One heap grows from the
start, one from the accepting ends.  Where both have labelled a node, the sum of its labels is a whole
repair; the search goes on until the tops of the heaps together exceed the best sum, so every crossing
of that cost is finished, and the least concatenation of audits over all crossings is the answer.  No
two different audits of equal cost into one node begin with one another (an audit fixes the roles and
so the cost), so the least audits on either side join to the least whole one.

Rows are numbered within their conversation and get their faults in Spark; a row's part in the
lattice is one letter.  The letters of BLOCK rows are one task's unit: a longer conversation is many
units, searched between all pairs of grammar states, and the stream that assembles a conversation
links its units, holding four audits.  That stream reads the audit first and then the rows in order,
one at a time, so texts are never gathered; a conversation's rows pass through one task because its
hash is defined over them in order.

Defined cases: a null role or text is one space (so the text is blank and the role fits nowhere); a
null turn sorts first and counts for no gap; a null conv_id is a conversation of its own; rows of one
turn follow by role, then text; repeated rows are duplicates after the first; a role counts by its
first letter (s, u, a); a conversation without rows has no faults, cost 0 and an empty audit; an empty
table gives no row.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import ship, stored, table

BLOCK = 256  # rows searched at once
MEMORY = 50_000  # searched units a task remembers, the latest ones

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Grammar s?(ua)+ or nothing: the state after each role's letter.
STATES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
SPACES = "\\x20\\x09-\\x0D"


def edits(letter: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(audit, cost, next state) of the edges that read a row.

    ``letter`` is x for a row that must go, else the initial of its role (o for others), in capitals
    for a truncated row.
    """
    yield "D", DELETE, state
    if letter == "x":
        return
    extra = TRUNCATED if letter.isupper() else 0
    to = STATES[state]
    if letter.lower() in to:
        yield "K", extra, to[letter.lower()]
    for role in ROLES:
        if role in to:
            yield "R", REROLE + extra, to[role]


def inserts(state: int) -> Iterator[int]:
    return (STATES[state][role] for role in ROLES if role in STATES[state])


# The states before each state, with the role's letter read or inserted between them.
BEFORE = [[p for p in range(4) if q in STATES[p].values()] for q in range(4)]


def least_repair(letters: str, entry: int = 0, exits: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest way from ``entry`` to any of ``exits``, the least audit among equals."""
    n = len(letters)
    # labels: node -> [cost, audit so far]; heaps hold (cost, rows read so far, node).  Keep costs
    # nothing and always reads a row, so nodes of equal cost are final in order of the rows read.
    ahead, behind = {(0, entry): (0, "")}, {(n, q): (0, "") for q in exits}
    up, down = [(0, 0, (0, entry))], [(0, 0, (n, q)) for q in exits]
    done: tuple[set, set] = (set(), set())
    best: int | None = None

    def label(own: dict, other: dict, heap: list, node: tuple, cost: int, audit: str, read: int) -> None:
        nonlocal best
        if node not in own or (cost, audit) < own[node]:
            own[node] = (cost, audit)
            heappush(heap, (cost, read, node))
            if node in other and (best is None or cost + other[node][0] < best):
                best = cost + other[node][0]

    for node in ahead.keys() & behind.keys():
        best = 0
    while up and down and (best is None or up[0][0] + down[0][0] <= best):
        if up[0][0] <= down[0][0]:
            cost, _, (i, q) = heappop(up)
            if (i, q) in done[0]:
                continue
            done[0].add((i, q))
            cost, audit = ahead[i, q]
            if i < n:
                for said, more, to in edits(letters[i], q):
                    label(ahead, behind, up, (i + 1, to), cost + more, audit + said, i + 1)
            for to in inserts(q):
                label(ahead, behind, up, (i, to), cost + INSERT, audit + "I", i)
        else:
            cost, _, (i, q) = heappop(down)
            if (i, q) in done[1]:
                continue
            done[1].add((i, q))
            cost, audit = behind[i, q]
            if i:
                for p in {q, *BEFORE[q]}:
                    for said, more, to in edits(letters[i - 1], p):
                        if to == q:
                            label(behind, ahead, down, (i - 1, p), cost + more, said + audit, n - i + 1)
            for p in BEFORE[q]:
                if q in inserts(p):
                    label(behind, ahead, down, (i, p), cost + INSERT, "I" + audit, n - i)
    # A heap that runs dry has labelled all it can reach, so the crossings are complete then too.
    whole = [
        (cost + behind[node][0], audit + behind[node][1])
        for node, (cost, audit) in ahead.items() if node in behind and cost + behind[node][0] == best
    ]
    return min(whole) if whole else None


def unit_repairs(letters: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) between the states a unit can begin and end in; -1 stands for any
    accepting end."""
    found = []
    for entry in (0,) if first else range(4):
        for to, exits in ((-1, ENDS),) if last else ((q, (q,)) for q in range(4)):
            if way := least_repair(letters, entry, exits):
                found.append((entry, to, *way))
    return found


def linked(ways: list[tuple[int, str] | None], unit: list[dict]) -> list[tuple[int, str] | None]:
    """The least way to each state after one more unit; the last slot is the accepting end."""
    out: list = [None] * 5
    for way in unit:
        before = ways[way["entry"]]
        if before is not None:
            new = (before[0] + way["cost"], before[1] + way["audit"])
            if out[way["exit"]] is None or new < out[way["exit"]]:
                out[way["exit"]] = new
    return out


_UNIT = "conv_id long, pos long, ways array<struct<entry int, exit int, cost long, audit string>>"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: OrderedDict = OrderedDict()
    kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        found = []
        for key in zip(*(batch.column(c).to_pylist() for c in ("letters", "first", "last"))):
            if key not in known:
                known[key] = [dict(zip(("entry", "exit", "cost", "audit"), w)) for w in unit_repairs(*key)]
                if len(known) > MEMORY:
                    known.popitem(last=False)
            found.append(known[key])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("pos"), pa.array(found, kind)], names=["conv_id", "pos", "ways"]
        )


class _Assembly:
    """One conversation as its units and rows come by."""

    def __init__(self, conv_id):
        self.conv_id, self.ways, self.place = conv_id, [(0, ""), None, None, None, None], 0
        self.audit, self.cost, self.initial = None, 0, ""

    def unit(self, ways: list[dict]) -> None:
        self.ways = linked(self.ways, ways)

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.place < len(self.audit) and self.audit[self.place] == "I":
            yield self._turn("I", "", "")
        return

    def _turn(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        self.place += 1
        letter = role[:1] if edit == "K" else "a" if self.initial == "u" else "u"
        self.initial = letter
        return edit, role if edit == "K" else ROLES[letter], text

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The repaired turns up to this row; (edit, role, text)."""
        self.begin()
        yield from self._inserted()
        edit = self.audit[self.place]
        if edit == "D":
            self.place += 1
        else:
            yield self._turn(edit, role, text)

    def begin(self) -> None:
        if self.audit is None:
            self.cost, self.audit = self.ways[-1] or (0, "")

    def rest(self) -> Iterator[tuple[str, str, str]]:
        self.begin()
        yield from self._inserted()


def _streams(batches: Iterator[pa.RecordBatch], opened, turn, closed) -> Iterator:
    """Calls for each conversation and its repaired turns, in order; yields what ``closed`` gives."""
    now = None
    for batch in batches:
        for conv_id, pos, ways, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    for said in now.rest():
                        turn(now, *said)
                    yield closed(now)
                now = _Assembly(conv_id)
                opened(now)
            if ways is not None:
                now.unit(ways)
            else:
                for said in now.row(role, text):
                    turn(now, *said)
    if now is not None:
        for said in now.rest():
            turn(now, *said)
        yield closed(now)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def opened(a):
        a.hash, a.any = hashlib.sha256(), False

    def turn(a, _, role, text):
        a.hash.update((f"\n{role}:{text}" if a.any else f"{role}:{text}").encode())
        a.any = True

    def closed(a):
        return a.conv_id, a.cost, a.audit, a.hash.hexdigest()

    out: list = []
    for row in _streams(batches, opened, turn, closed):
        out.append(row)
        if len(out) == 1024:
            yield _rows(out, _DIGEST)
            out = []
    yield _rows(out, _DIGEST)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list = []

    def opened(a):
        a.said = 0

    def turn(a, edit, role, text):
        out.append((a.conv_id, a.said, edit, role, text))
        a.said += 1

    for _ in _streams(batches, opened, turn, lambda a: None):
        if len(out) >= 1024:
            yield _rows(out, _TURN)
            out.clear()
    yield _rows(out, _TURN)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_TURN = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _rows(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def marked_rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, pos, fault (blank, duplicate, truncated or null), letter, illegal
    and new_turn of every row; ``illegal`` marks a row whose role cannot follow the one before.

    Equal texts are found by their SHA-256, so sorts carry 32 bytes, not texts.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role").alias("role"), text("text").alias("text")
    ).withColumn("said", F.sha2("text", 256))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = own.withColumns({
        "pos": F.row_number().over(order).cast("long") - 1,
        "last": F.lead(F.lit(False), 1, True).over(order),
        "new_turn": F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(order)),
        "pair": F.concat(F.left(F.lag("role").over(order), F.lit(1)), F.left("role", F.lit(1))),
        "pair_long": F.length(F.lag("role").over(order)) * F.length("role"),
    })
    # A role without letters makes no legal pair either.
    illegal = (F.col("pos") > 0) & ~(F.col("pair").isin("su", "ua", "au") & (F.col("pair_long") > 0))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "said").orderBy("pos"))
    fault = (
        F.when(~F.col("text").rlike(f"[^{SPACES}]"), "blank")
        .when(seen > 1, "duplicate")
        .when(~F.col("text").rlike(f"[.!?][{SPACES}]*\\z"), "truncated")
    )
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("o")
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x")
        .when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    )
    return placed.withColumn("fault", fault).withColumns({"letter": letter, "illegal": illegal}).select(
        "conv_id", "turn", "role", "text", "pos", "last", "fault", "letter", "illegal", "new_turn"
    )


def _streamed(marked: DataFrame, block: int) -> DataFrame:
    """Units (before all rows) and rows of each conversation, in one task and in order."""
    ship(marked.sparkSession)
    units = marked.groupBy("conv_id", F.expr(f"pos DIV {block}").alias("unit")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "letter"))).alias("rows"), F.max("last").alias("last")
    ).select(
        "conv_id", (F.col("unit") - 2**40).alias("pos"), F.concat_ws("", "rows.letter").alias("letters"),
        (F.col("unit") == 0).alias("first"), "last",
    ).mapInArrow(_search, _UNIT)
    rows = marked.select("conv_id", "pos", F.lit(None).cast(units.schema["ways"].dataType).alias("ways"), "role", "text")
    none = F.lit(None).cast("string")
    both = units.select("*", none.alias("role"), none.alias("text")).unionByName(rows)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "pos")


def repair_digests(marked: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, cost, audit, repaired_sha256 of each conversation of ``marked_rows``, stored."""
    return _streamed(marked, block).mapInArrow(_digests, "conv_id long, cost long, audit string, repaired_sha256 string")


def repaired_turns(marked: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, place, edit, role, text of every turn of the repaired conversations."""
    return _streamed(marked, block).mapInArrow(_turns, "conv_id long, place long, edit string, role string, text string")


def repair_conversations(rows: DataFrame, of: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Faults, cheapest repair and digest of each conversation; those of ``of`` without rows too."""
    marked = stored(marked_rows(rows))
    faults = {k: F.count_if(F.col("fault") == k) for k in ("blank", "duplicate", "truncated")}
    facts = marked.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn")).alias("gaps"),
        *[n.alias(k) for k, n in faults.items()], F.count_if("illegal").alias("illegal"),
    )
    found = repair_digests(marked, block)
    if of is not None:
        found = found.unionByName(of.select(F.col("conv_id").cast("long")).distinct(), allowMissingColumns=True)
    each = facts.unionByName(found, allowMissingColumns=True)  # null ids meet in a group, not in a join
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return each.groupBy("conv_id").agg(*[
        F.coalesce(F.max(c), F.lit(none.get(c, 0))).alias(c) for c in
        ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    ])


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by the checksum of their place: one in twenty each is dropped, emptied,
    cut of its sentence ends, repeated, or given to the user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    return (
        rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), what.alias("what"))
        .filter("what <> 0")
        .withColumn("text", F.when(F.col("what") == 1, "").when(
            F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("what") == 4, "user").otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("what", "copy")
    )


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair_conversations(damaged(rows), of=rows)
