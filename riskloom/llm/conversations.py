"""Conversation structure repair: cheapest edits to ``(s?(ua)+)?`` by secondary-sorted streaming.

Rows are dealt out by conversation and sorted by turn, and one pass carries the state of a dynamic programme across Arrow batches.
The programme has four states (nothing yet, after a system, a user, an assistant row) with a cost and a rank each; the rank orders the
audits of the states, so equal costs are decided for the ASCII-least audit without comparing texts. A row costs one lookup in a
table of steps that fills as it is used, and leaves one backpointer: the number of the step.

What a task holds of a conversation is bounded by ``HELD`` rows and ``HELD_BYTES``. Longer conversations spill: their rows go on undecided, in
pieces, and each piece hands on its backpointers compacted to one character per row and final state. When the last state is
known, the pieces are decided by joins, so nothing of a giant conversation stays in memory but the four states.

Rows of equal turn are ordered by role and text; repeated rows are duplicates; null turns come first; a null role or text counts as one space
(so it is blank, and its role is neither system, user nor assistant); null conversation ids are one conversation; empty texts are blank; a text may be as long
as a string; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from riskloom.llm.shared import Stored, read
from riskloom.llm.spelling import crc32_sql

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
HELD = 20_000
HELD_BYTES = 32 << 20
BLANKS = " \t\n\x0b\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # state after a rerole or an insert
LETTERS = "KRD"
#: Kinds of rows: initial s, u, a or other, twice (whole and truncated), and rows that must go.
KINDS = [(initial, cut) for initial in ("s", "u", "a", "") for cut in (0, TRUNCATED)]
MUST_GO = len(KINDS)
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # inserts that end the conversation


def _choices(kind: int) -> list[tuple[int, int, int, str, int]]:
    """(from, to, cost, letters, code) of every way to take one row of ``kind``, with up to two inserts before it."""
    initial, cut = KINDS[kind] if kind < MUST_GO else ("", 0)
    out = []
    for origin in range(4):
        state = origin
        for inserts in range(3):
            ways = [(state, DELETE, 2)]
            if kind < MUST_GO:
                ways.append((GIVEN[state], REROLE + cut, 1))
                if (state, initial) in KEPT:
                    ways.append((KEPT[state, initial], cut, 0))
            out += [(origin, to, INSERT * inserts + cost, "I" * inserts + LETTERS[way], 9 * origin + 3 * inserts + way) for to, cost, way in ways]
            state = GIVEN[state]
    return out


class Machine:
    """Steps between vectors of (cost, rank) per state, worked out once each; a cost of ``None`` marks a state that cannot win."""

    def __init__(self):
        self.choices = [_choices(kind) for kind in range(MUST_GO + 1)]
        self.known: dict = {}
        self.back: list[list] = []

    @staticmethod
    def first() -> tuple:
        return ((0, 0), None, None, None)

    def step(self, vector: tuple, kind: int) -> tuple[tuple, int]:
        """(next vector, number of the step whose ``back`` holds per state the state before and the code of the edits)."""
        found = self.known.get((vector, kind))
        if found is None:
            best: list = [None] * 4
            for origin, to, cost, letters, code in self.choices[kind]:
                if vector[origin] is not None:
                    way = (vector[origin][0] + cost, vector[origin][1], letters, origin, code)
                    if best[to] is None or way < best[to]:
                        best[to] = way
            # The audits of two states differ before either ends, so (rank before, letters) orders them.
            order = sorted((b[1], b[2], s) for s, b in enumerate(best) if b)
            rank = {s: r for r, (_, _, s) in enumerate(order)}
            cost = [b[0] if b else 1 << 30 for b in best]
            # A state goes if another one, with inserts or a deletion that make up for it, is cheaper whatever follows.
            u, a = cost[USER], cost[ASSISTANT]
            least = {START: min(a + DELETE, u + INSERT + DELETE), SYSTEM: min(a, u + INSERT), USER: a + INSERT, ASSISTANT: u + INSERT}
            alive = [s for s in range(4) if best[s] and cost[s] <= least[s]]
            base = min(cost[s] for s in alive)
            after = tuple((cost[s] - base, rank[s]) if s in alive else None for s in range(4))
            self.back.append([best[s][3:] if s in alive else None for s in range(4)])
            found = self.known[vector, kind] = (after, len(self.back) - 1)
        return found

    def end(self, vector: tuple) -> int:
        """The state in which the cheapest repair ends, before its last inserts."""
        return min((v[0] + INSERT * TAIL[s], v[1], s) for s, v in enumerate(vector) if v is not None)[2]

    def trace(self, steps: list[int], state: int) -> tuple[int, np.ndarray]:
        """(state before the first step, codes of the edits) of the way that ends in ``state``."""
        codes = np.empty(len(steps), np.int16)
        for i in range(len(steps) - 1, -1, -1):
            state, codes[i] = self.back[steps[i]][state]
        return state, codes


#: What the pass adds to the rows: kind 0 a row, 1 a decision about a piece of a long conversation.
_ADDED = "kind int, chunk int, at int, code int, starts array<int>, codes array<string>, last int"


class _Stream:
    """One pass over sorted rows: decided rows, undecided rows of long conversations and the decisions about their pieces."""

    def __init__(self, names: list[str], rows: int, size: int):
        self.names, self.rows, self.size, self.machine = names, rows, size, Machine()
        self.out: list[pa.RecordBatch] = []
        self.begin()

    def begin(self) -> None:
        self.vector, self.steps, self.held, self.bytes, self.chunk = Machine.first(), [], [], 0, 0

    def take(self, piece: pa.RecordBatch, kinds: list[int]) -> None:
        """The next rows of the conversation at hand."""
        if len(self.steps) >= self.rows or self.bytes >= self.size:
            self.spill(False)
        step, vector, steps = self.machine.step, self.vector, self.steps
        for kind in kinds:
            vector, number = step(vector, kind)
            steps.append(number)
        self.vector = vector
        self.held.append(piece)
        self.bytes += piece.nbytes

    def finish(self) -> None:
        """The conversation at hand, if any, is over."""
        if self.chunk:
            self.spill(True)
        elif self.steps:
            end = self.machine.end(self.vector)
            _, codes = self.machine.trace(self.steps, end)
            codes[-1] += 36 * TAIL[end]
            self.send(codes)
        self.begin()

    def spill(self, last: bool) -> None:
        starts, texts = [None] * 4, [None] * 4
        for s in (s for s in range(4) if self.vector[s] is not None):
            starts[s], codes = self.machine.trace(self.steps, s)
            if last:
                codes[-1] += 36 * TAIL[s]
            texts[s] = "".join(chr(48 + c) for c in codes.tolist())
        self.send(None)
        end = self.machine.end(self.vector) if last else None
        self.put(self.held[-1].slice(0, 1), 1, None, None, ([starts], [texts], [end]), only_id=True)
        self.steps, self.held, self.bytes, self.chunk = [], [], 0, self.chunk + 1

    def send(self, codes: np.ndarray | None) -> None:
        at = 0
        for piece in self.held:
            n = piece.num_rows
            self.put(piece, 0, np.arange(at, at + n), None if codes is None else codes[at : at + n], None)
            at += n

    def put(self, piece: pa.RecordBatch, kind: int, at, codes, decision, only_id: bool = False) -> None:
        n, i32 = piece.num_rows, pa.int32()
        columns = [piece.column(c) if c == "conv_id" or not only_id else pa.nulls(n, piece.schema.field(c).type) for c in self.names]
        columns += [pa.array([kind] * n, i32), pa.array([self.chunk] * n, i32)]
        columns += [pa.nulls(n, i32) if v is None else pa.array(v.astype(np.int32)) for v in (at, codes)]
        kinds = (pa.list_(i32), pa.list_(pa.string()), i32)
        columns += [pa.nulls(n, t) if decision is None else pa.array(v, t) for v, t in zip(decision or (None,) * 3, kinds, strict=True)]
        self.out.append(pa.RecordBatch.from_arrays(columns, [*self.names, *[f.split()[0] for f in _ADDED.split(", ")]]))

    def taken(self) -> Iterator[pa.RecordBatch]:
        if self.out:
            yield from pa.Table.from_batches(self.out).combine_chunks().to_batches()
        self.out = []


def _stream(batches: Iterator[pa.RecordBatch], names: list[str], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their ``place`` in the conversation (from 1) and ``row_kind`` to rows with codes and decisions."""
    stream = _Stream(names, rows, size)
    for batch in batches:
        kinds = batch.column("row_kind").to_numpy(zero_copy_only=False)
        first = np.flatnonzero(batch.column("place").to_numpy(zero_copy_only=False) == 1).tolist()
        edges = sorted({0, *first, batch.num_rows})
        fresh = set(first)
        for start, stop in zip(edges[:-1], edges[1:], strict=True):
            if start in fresh:
                stream.finish()
            for cut in range(start, stop, rows):
                upto = min(stop, cut + rows)
                stream.take(batch.slice(cut, upto - cut), kinds[cut:upto].tolist())
        yield from stream.taken()
    stream.finish()
    yield from stream.taken()


def marked_rows(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with fault, place, new_turn, illegal and row_kind, dealt out by conversation and sorted by turn.

    One shuffle of the texts; both windows and the sort use it. ``illegal`` marks a row whose role may not follow the one before.
    """
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    dealt = rows.repartition(F.col("conv_id"))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    core = F.rtrim(F.col("text"), F.lit(BLANKS))
    cut = ~F.substring(core, -1, 1).isin(".", "!", "?")
    fault = F.when(core == "", "blank").when(F.col("seen"), "duplicate").when(cut, "truncated")
    initial = F.substring("role", 1, 1)
    in_order = Window.partitionBy("conv_id").orderBy(*order)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO)
    for i, (letter, short) in enumerate(KINDS):
        if letter:
            kind = kind.when((initial == letter) & (F.col("fault").isNotNull() == F.lit(bool(short))), i)
    kind = kind.otherwise(F.when(F.col("fault").isNotNull(), len(KINDS) - 1).otherwise(len(KINDS) - 2))
    marked = dealt.withColumn("seen", seen).withColumn("fault", fault).drop("seen")
    before = F.lag(initial).over(in_order)
    first = F.row_number().over(in_order)
    marked = marked.withColumn("place", first).withColumn("before", before).withColumn("turn_before", F.lag("turn").over(in_order))
    return marked.select(
        "conv_id", "turn", F.col("place").cast("long").alias("place"), "role", "text", "fault",
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))).alias("new_turn"),
        (F.col("before").isNotNull() & ~F.concat("before", initial).isin("su", "ua", "au")).alias("illegal"),
        kind.cast("int").alias("row_kind"),
    ).sortWithinPartitions("conv_id", "place")


def _decided(table: DataFrame) -> DataFrame:
    """All rows with their codes; those of long conversations get them from the decisions about their pieces, last piece first."""
    rows = table.where("kind = 0")
    pieces = table.where("kind = 1")
    ends = pieces.groupBy("conv_id").agg(F.max("last").alias("last"), F.sort_array(F.collect_list(F.struct("chunk", "starts")), asc=False).alias("way"))
    # From the last piece back: the state a piece ends in is the one the piece after it starts from.
    walk = F.aggregate(
        "way",
        F.struct(F.col("last").alias("state"), F.array().cast("array<struct<chunk:int,state:int>>").alias("ends")),
        lambda acc, x: F.struct(
            F.element_at(x["starts"], acc["state"] + 1).alias("state"),
            F.concat(acc["ends"], F.array(F.struct(x["chunk"].alias("chunk"), acc["state"].alias("state")))).alias("ends"),
        ),
        lambda acc: acc["ends"],
    )
    ends = ends.select(F.col("conv_id").alias("id"), F.inline(walk)).withColumnRenamed("chunk", "of")
    chosen = pieces.join(ends, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("chunk") == F.col("of")))
    chosen = chosen.select("id", "of", F.element_at("codes", F.col("state") + 1).alias("chosen"))
    late = rows.where(F.col("code").isNull()).join(chosen, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("chunk") == F.col("of")))
    code = (F.ascii(F.col("chosen").substr(F.col("at") + 1, F.lit(1))) - 48).cast("int")
    keep = ["conv_id", "turn", "place", "role", "text", "fault", "new_turn", "illegal"]
    return rows.where(F.col("code").isNotNull()).select(*keep, "code").unionByName(late.select(*keep, code.alias("code")))


def repair(conversations: DataFrame, held: int = HELD, held_bytes: int = HELD_BYTES) -> DataFrame:
    """The edited rows of every conversation, in the order (place, part).

    Columns conv_id, place, part, edit (K keep, R rerole, D delete, I insert), role and text after the edit, cost, and of the row
    itself (null for inserts) turn, fault (blank, duplicate, truncated), illegal and new_turn. Rows with edit D are the ones to leave
    out. ``held`` and ``held_bytes`` bound what a task holds of one conversation and never change the result.
    """
    rows = marked_rows(conversations)
    names = [c for c in rows.columns if c != "row_kind"]
    schema = StructType([StructField(f.name, f.dataType, True) for f in rows.schema if f.name in names] + _parse_datatype_string(_ADDED).fields)
    table, _ = Stored(conversations.sparkSession, "conversations").put(rows.mapInArrow(partial(_stream, names=names, rows=held, size=held_bytes), schema))
    return _edits(_decided(table))


def _edits(rows: DataFrame) -> DataFrame:
    """One row per edit from rows with codes: inserts before, the row itself, inserts at the end."""
    origin, inserts, letter, tail = [F.floor(F.col("code") % m / d).cast("int") for m, d in ((36, 9), (9, 3), (3, 1), (1 << 20, 36))]
    # Given roles alternate, starting from assistant after a user row.
    given = lambda j: F.when((j + F.when(F.col("origin") == USER, 1).otherwise(0)) % 2 == 0, "user").otherwise("assistant")
    rows = rows.select("*", origin.alias("origin"), inserts.alias("inserts"), letter.alias("letter"), tail.alias("tail")).drop("code")

    def entry(part, edit, role, text, cost, own: bool) -> Column:
        of_row = [F.col(c).alias(c) if own else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "fault", "illegal", "new_turn")]
        return F.struct(part.cast("int").alias("part"), edit.alias("edit"), role.alias("role"), text.alias("text"), cost.cast("long").alias("cost"), *of_row)

    def added(many: Column, after: Column, first: Column) -> Column:
        one = lambda j: entry(j + first, F.lit("I"), given(j + after), F.lit(""), F.lit(INSERT), False)
        return F.when(many > 0, F.transform(F.sequence(F.lit(0), many - 1), one))

    cut = F.when(F.col("fault").eqNullSafe("truncated"), TRUNCATED).otherwise(0)
    edit = F.element_at(F.array(*[F.lit(x) for x in LETTERS]), F.col("letter") + 1)
    role = F.when(F.col("letter") == 1, given(F.col("inserts"))).otherwise(F.col("role"))
    cost = F.when(F.col("letter") == 2, DELETE).otherwise(F.when(F.col("letter") == 1, REROLE).otherwise(0) + cut)
    own = F.array(entry(F.col("inserts"), edit, role, F.col("text"), cost, True))
    # One insert at the end follows a user row, two a system row.
    last = F.when(F.col("tail") == 1, F.lit("assistant"))
    ending = F.when(
        F.col("tail") > 0,
        F.transform(
            F.sequence(F.lit(0), F.col("tail") - 1),
            lambda j: entry(j + F.col("inserts") + 1, F.lit("I"), F.coalesce(last, F.when(j == 0, "user").otherwise("assistant")), F.lit(""), F.lit(INSERT), False),
        ),
    )
    none = F.array().cast(rows.select(own.alias("x")).schema["x"].dataType)
    before = added(F.col("inserts"), F.lit(0), F.lit(0))
    return rows.select("conv_id", "place", F.inline(F.concat(F.coalesce(before, none), own, F.coalesce(ending, none))))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest per conversation, of rows (conv_id, head, edit, line) in order; a line is null where a row is left out."""
    kind, done = None, ([], [], [])
    audit, digest, empty, ident, begun = bytearray(), hashlib.sha256(), True, None, False

    def finish() -> None:
        for column, value in zip(done, (ident, audit.decode(), digest.hexdigest()), strict=True):
            column.append(value)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "head", "edit", "line")]
        for i, head, edit, line in zip(*columns, strict=True):
            if head:
                if begun:
                    finish()
                audit, digest, empty, ident, begun = bytearray(), hashlib.sha256(), True, i, True
            audit += edit.encode()
            if line is not None:
                digest.update((line if empty else "\n" + line).encode())
                empty = False
        if len(done[0]) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(done[0], kind), *[pa.array(c, pa.string()) for c in done[1:]]], ["conv_id", "audit", "repaired_sha256"])
            done = ([], [], [])
    if begun:
        finish()
        yield pa.RecordBatch.from_arrays([pa.array(done[0], kind), *[pa.array(c, pa.string()) for c in done[1:]]], ["conv_id", "audit", "repaired_sha256"])


def digests(edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): initials of the edits in order, sha256 of the kept `role:text` joined by newlines."""
    line = F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text"))
    head = (F.col("place") == 1) & (F.col("part") == 0)
    rows = edits.select("conv_id", "place", "part", head.alias("head"), "edit", line.alias("line"))
    rows = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "place", "part")
    kind = edits.schema["conv_id"].dataType.simpleString()
    return rows.select("conv_id", "head", "edit", "line").mapInArrow(_digests, f"conv_id {kind}, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's faults, by crc32(`conv_id:turn`) % 20: dropped, emptied, without end marks, repeated, given to the user; nulls are one space."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("h", (F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")) % 20).cast("int")).where("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def summary(edits: DataFrame) -> DataFrame:
    """Per conversation: gaps, the counts of faults and of illegal neighbours, and the cost of the edits."""
    count = lambda test: F.sum(F.when(test, 1).otherwise(0)).cast("long")
    span = F.max("turn") - F.min("turn") + 1 - count(F.col("new_turn"))
    return edits.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
        *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        count(F.col("illegal")).alias("illegal"),
        F.sum("cost").alias("cost"),
    )


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation after the contract's damage: what was wrong, the cheapest edits and a digest of the repaired rows."""
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    edits = repair(damaged(rows))
    told = summary(edits).withColumnRenamed("conv_id", "told_id")
    written = digests(edits).withColumnRenamed("conv_id", "written_id")
    out = rows.select("conv_id").distinct()
    out = out.join(told, F.col("conv_id").eqNullSafe(F.col("told_id")), "left").join(written, F.col("conv_id").eqNullSafe(F.col("written_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


OP12_SQL = rf"""
WITH RECURSIVE raw AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h
    FROM conversations
), hurt AS (
    SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM raw WHERE h <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core
    FROM hurt
), marked AS (
    SELECT conv_id, turn, role, text, place, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before,
        CASE WHEN core = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
        count_if(fault = 'truncated') AS truncated, count_if(before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(place) AS size
    FROM marked GROUP BY conv_id
), inserts(state, letters, lines, after) AS (
    VALUES ('', '', []::VARCHAR[], ''), ('', 'I', ['user:'], 'u'), ('', 'II', ['user:', 'assistant:'], 'a'), ('s', '', [], 's'), ('s', 'I', ['user:'], 'u'), ('s', 'II', ['user:', 'assistant:'], 'a'),
        ('u', '', [], 'u'), ('u', 'I', ['assistant:'], 'a'), ('u', 'II', ['assistant:', 'user:'], 'u'), ('a', '', [], 'a'), ('a', 'I', ['user:'], 'u'), ('a', 'II', ['user:', 'assistant:'], 'a')
), ways AS (
    SELECT m.conv_id, m.place, i.state, i.letters || e.letter AS letters, 2 * length(i.letters) + e.cost + CASE WHEN fault = 'truncated' AND e.letter <> 'D' THEN 1 ELSE 0 END AS cost,
        CASE e.letter WHEN 'D' THEN i.after WHEN 'K' THEN initial ELSE given END AS after,
        CASE e.letter WHEN 'D' THEN i.lines WHEN 'K' THEN list_append(i.lines, role || ':' || text) ELSE list_append(i.lines, CASE given WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text) END AS lines
    FROM marked m, (SELECT *, CASE after WHEN 'u' THEN 'a' ELSE 'u' END AS given FROM inserts) i, (VALUES ('K', 0), ('R', 2), ('D', 3)) e(letter, cost)
    WHERE e.letter = 'D' OR fault NOT IN ('blank', 'duplicate') AND (e.letter = 'R' OR i.after || ',' || initial IN (',s', ',u', 's,u', 'u,a', 'a,u'))
), paths AS (
    SELECT conv_id, 0::BIGINT AS place, '' AS state, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS best FROM counted
    UNION ALL
    SELECT p.conv_id, w.place, w.after, arg_min(
            {{'cost': p.best.cost + w.cost, 'audit': p.best.audit || w.letters, 'lines': list_concat(p.best.lines, w.lines)}}, {{'cost': p.best.cost + w.cost, 'audit': p.best.audit || w.letters}})
    FROM paths p JOIN ways w ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND w.place = p.place + 1 AND w.state = p.state GROUP BY p.conv_id, w.place, w.after
), ended AS (
    SELECT p.conv_id, arg_min({{'cost': best.cost + 2 * length(i.letters), 'audit': best.audit || i.letters, 'lines': list_concat(best.lines, i.lines)}},
        {{'cost': best.cost + 2 * length(i.letters), 'audit': best.audit || i.letters}}) AS best
    FROM paths p JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND p.place = c.size JOIN inserts i ON i.state = p.state
    WHERE i.after IN ('', 'a') GROUP BY p.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
