"""Conversation structure repair: the cheapest edits that give ``system? (user assistant)+``, by divide and conquer.

Rows are edited from first to last: kept (K), given another role (R), deleted (D), with turns inserted (I) between
them. A prefix of a conversation ends in one of four states: nothing yet, after the system turn, after a user's, after an
assistant's. What a piece of a conversation costs is therefore a four by four table, and tables of neighbours combine
to the table of both. Edits of a piece are found in linear space: forward costs of its first half and backward costs
of its second meet in the middle, the state in which they cost least is the crossing, and both halves are solved by
themselves. Of equal crossings the one whose edits so far are ASCII-least is taken; forward costs carry that order.

A long conversation is cut into blocks. Tables of blocks are made in parallel, crossings between blocks are found from
the tables, and the blocks are then solved in parallel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from talklake.llm.common import inner_names, slices, text_sizes, worker_state, written

#: Characters that are no blanks, and ends of a finished text.
FILLED = r"[^\x20\x09-\x0D]"
FINISHED = r"[.!?][\x20\x09-\x0D]*\z"
#: Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
#: Rows of a block: what a task holds of one conversation while it looks for edits.
BLOCK = 4096
#: Short blocks recur; so many solutions of blocks up to this length are remembered.
REMEMBERED, SHORT = 50_000, 24

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state after one more turn that fits: what an inserted or renamed turn leads to.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Where a kept row leads, by state and initial of its role.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: What is left to insert at the end of a conversation, by state.
TAIL = ("", "II", "I", "")

#: Costs and order of the ASCII-least cheapest edits, from each state to each; None where there is no way.
Table = tuple[tuple["tuple[int, int] | None", ...], ...]


def _ways(code: str) -> list[list[tuple[int, str] | None]]:
    """For one row: the cheapest edits from each state to each, the row's own edit last.

    ``code`` is the initial of the role as ``s, u, a`` or ``o`` for others; in capitals if the text is truncated,
    and ``x`` if the row has to go.
    """
    initial, extra = code.lower(), UNFINISHED if code.isupper() else 0
    best: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in STATES]
    for state in STATES:
        now = state
        for inserted in range(3):
            steps = [(now, DELETE, "D")]
            if code != "x":
                steps.append((NEXT[now], REROLE + extra, "R"))
                if (now, initial) in KEPT:
                    steps.append((KEPT[now, initial], extra, "K"))
            for end, cost, edit in steps:
                way = cost + inserted * INSERT, "I" * inserted + edit
                if best[state][end] is None or way < best[state][end]:
                    best[state][end] = way
            now = NEXT[now]
    return best


WAYS = {code: _ways(code) for code in "suaoSUAOx"}


def _ranked(ways: list[list[tuple[int, str] | None]]) -> Table:
    """Costs with the place of each way's edits among those from the same state."""
    table = []
    for row in ways:
        order = sorted(w[1] for w in row if w)
        table.append(tuple(None if w is None else (w[0], order.index(w[1])) for w in row))
    return tuple(table)


ROW_TABLES: dict[str, Table] = {code: _ranked(ways) for code, ways in WAYS.items()}


def _forward(line: Sequence[tuple[int, int] | None], table: Table) -> list[tuple[int, int] | None]:
    """Costs and order after one more item. ``line`` holds both for the items before, by state.

    Edits that lead to different states differ, and none is the beginning of another, as all end with the
    same row. So the order of what came before decides, and only from one state the item's own order does.
    """
    found: list[tuple[int, int, int] | None] = [None] * 4
    for state, before in enumerate(line):
        if before is None:
            continue
        for end, own in enumerate(table[state]):
            if own is not None:
                way = before[0] + own[0], before[1], own[1]
                if found[end] is None or way < found[end]:
                    found[end] = way
    order = sorted((w[1], w[2]) for w in found if w)
    return [None if w is None else (w[0], order.index((w[1], w[2]))) for w in found]


def _backward(line: Sequence[int | None], table: Table) -> list[int | None]:
    """The least cost of one more item in front, by the state before it."""
    return [
        min((own[0] + after for own, after in zip(row, line, strict=True) if own is not None and after is not None), default=None)
        for row in table
    ]


def _line(state: int) -> list[tuple[int, int] | None]:
    return [(0, 0) if s == state else None for s in STATES]


def combined(tables: Sequence[Table]) -> Table:
    """The table of neighbouring items."""
    rows = []
    for state in STATES:
        line: Sequence[tuple[int, int] | None] = _line(state)
        for table in tables:
            line = _forward(line, table)
        rows.append(tuple(line))
    return tuple(rows)


def crossings(tables: Sequence[Table], start: int, ends: Sequence[int | None]) -> list[int]:
    """The states between and after the items on the ASCII-least cheapest way; ``ends`` are costs at the end, by state.

    Space is linear: each call keeps two lines of four, finds the state in the middle, and looks at
    both halves.
    """
    if not tables:
        return []
    middle = (len(tables) + 1) // 2
    line: Sequence[tuple[int, int] | None] = _line(start)
    for table in tables[:middle]:
        line = _forward(line, table)
    back: Sequence[int | None] = ends
    for table in reversed(tables[middle:]):
        back = _backward(back, table)
    meet = [(ahead[0] + behind, ahead[1], s) for s, (ahead, behind) in enumerate(zip(line, back, strict=True)) if ahead is not None and behind is not None]
    state = min(meet)[2]
    if len(tables) == 1:
        return [state]
    at_middle: list[int | None] = [0 if s == state else None for s in STATES]
    return crossings(tables[:middle], start, at_middle) + crossings(tables[middle:], state, ends)


def edits_between(codes: str, start: int, end: int) -> list[str]:
    """For each row its edits, inserted turns first, from ``start`` to ``end``."""
    states = crossings([ROW_TABLES[c] for c in codes], start, [0 if s == end else None for s in STATES])
    return [WAYS[code][a][b][1] for code, a, b in zip(codes, [start, *states], states, strict=False)]


#: Costs at the end of a conversation: what has to be inserted still.
ENDS = tuple(INSERT * len(t) for t in TAIL)


def audit(codes: str) -> tuple[list[str], str]:
    """The edits of each row of a whole conversation, and those after its last row."""
    states = crossings([ROW_TABLES[c] for c in codes], START, ENDS)
    found = [WAYS[code][a][b][1] for code, a, b in zip(codes, [START, *states], states, strict=False)]
    return found, TAIL[states[-1] if states else START]


def _whole(codes: str) -> str:
    """The edits of a whole conversation as one string; those of short ones are remembered, up to a number."""
    if len(codes) > SHORT:
        found, tail = audit(codes)
        return "".join(found) + tail
    known = worker_state("conversation repair")
    if codes not in known:
        if len(known) >= REMEMBERED:
            known.clear()
        found, tail = audit(codes)
        known[codes] = "".join(found) + tail
    return known[codes]


def _rows(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    return inner_names(conversations, {"conv_id": conv_id, "turn": turn, "role": role, "text": text})


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that the query repairs; a null role or text is one space.

    By CRC-32 of ``conv_id:turn``, a null of either being one space, modulo 20: 0 drops the row, 1 empties the text, 2
    removes its sentence ends, 3 repeats the row, 4 makes it the user's.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fate = (F.crc32(name.cast("binary")) % 20).cast("int")
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate")).where("fate <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _placed(rows: DataFrame) -> DataFrame:
    """The rows, dealt by ranges of conversation and turn and written, with ``place``, which tells their order.

    Turns are ordered by number, nulls first, and equal ones by role and digest of the text, which keeps the
    bounds of the ranges short. A conversation of any length is spread over as many ranges as it fills.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    marked = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    sorted_rows = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(sorted_rows.withColumn("place", F.monotonically_increasing_id()), "turns")


def _coded(placed: DataFrame) -> DataFrame:
    """``conv_id, place, code`` of each row: its role's initial and its first fault."""
    same = ["conv_id", "role", "digest"]
    # Only groups with repeats meet the rows again; equal rows are counted before they are shuffled.
    repeats = placed.groupBy(*same).agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    repeats = repeats.select(*(F.col(c).alias(f"_{c}") for c in same), "first")
    meets = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same]
    filled, finished = F.col("text").rlike(FILLED), F.col("text").rlike(FINISHED)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(~filled, "b").when(F.col("first") < F.col("place"), "d").when(finished, letter).otherwise(F.upper(letter))
    return placed.join(repeats, meets, "left").select("conv_id", "place", code.alias("code"))


def _lossy(codes: str) -> str:
    """Codes as the tables know them: blank and repeated rows have to go."""
    return codes.replace("b", "x").replace("d", "x")


def _blocks(coded: DataFrame, block: int) -> DataFrame:
    """``conv_id, place, codes``: rows of one range and conversation, ``block`` at most, in order, named by the first."""
    number = F.shiftright("place", 33) * F.lit(1 << 33) + F.floor((F.col("place") % (1 << 33)) / block)
    pairs = F.sort_array(F.collect_list(F.struct("place", "code")))
    grouped = coded.groupBy("conv_id", number.alias("number")).agg(pairs.alias("rows"))
    return grouped.select(
        "conv_id",
        F.get("rows", F.lit(0))["place"].alias("place"),
        F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("codes"),
    )


def _solved(blocks: DataFrame) -> DataFrame:
    """``conv_id, place, codes, start, edits``: the edits of each block's rows, and the state in front of it.

    A conversation of one block is solved at once. Of others, only the blocks' tables meet, in order: sixteen
    numbers for every ``BLOCK`` rows.
    """
    kind = blocks.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL("place bigint, codes string, start int, edits string").fields])
    counted = blocks.withColumn("n", F.count("*").over(W.partitionBy("conv_id")))
    counted = written(counted, "blocks")
    one, many = counted.where("n = 1").drop("n"), counted.where("n > 1").drop("n")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = [_whole(_lossy(codes)) for codes in batch.column("codes").to_pylist()]
            columns = [*batch.columns, pa.array([START] * batch.num_rows, pa.int32()), pa.array(edits, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    if many.isEmpty():
        return one.mapInArrow(whole, schema)

    table_schema = T.StructType([*many.schema.fields, T.StructField("costs", T.ArrayType(T.IntegerType()))])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = []
            for codes in batch.column("codes").to_pylist():
                found = combined([ROW_TABLES[c] for c in _lossy(codes)])
                flat.append([x for row in found for way in row for x in (way or (-1, -1))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flat, pa.list_(pa.int32()))], names=table_schema.fieldNames())

    costs = written(many.mapInArrow(tables, table_schema), "tables")
    line = costs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "costs"))).alias("line"))
    bound_schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL("places array<bigint>, bounds array<int>").fields])

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, states = [], []
            for line in batch.column("line").to_pylist():
                found = []
                for item in line:
                    pairs = [None if c < 0 else (c, r) for c, r in zip(item["costs"][::2], item["costs"][1::2], strict=True)]
                    found.append(tuple(tuple(pairs[4 * s : 4 * s + 4]) for s in STATES))
                places.append([item["place"] for item in line])
                states.append([START, *crossings(found, START, ENDS)])
            columns = [batch.column("conv_id"), pa.array(places, pa.list_(pa.int64())), pa.array(states, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=bound_schema.fieldNames())

    found = line.mapInArrow(bounds, bound_schema)
    ends = found.select(F.posexplode("places").alias("i", "place"), "bounds", F.size("places").alias("n")).select(
        "place", F.get("bounds", F.col("i")).alias("start"), F.get("bounds", F.col("i") + 1).alias("end"), (F.col("i") + 1 == F.col("n")).alias("last")
    )
    part_schema = T.StructType([*schema.fields[:4], *T.StructType.fromDDL("end int, last boolean, edits string").fields])

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = []
            values = (batch.column(c).to_pylist() for c in ("codes", "start", "end", "last"))
            for codes, start, end, last in zip(*values, strict=True):
                edits.append("".join(edits_between(_lossy(codes), start, end)) + (TAIL[end] if last else ""))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, pa.string())], names=part_schema.fieldNames())

    parts = many.join(ends, "place").select("conv_id", "place", "codes", "start", "end", "last")
    return one.mapInArrow(whole, schema).unionByName(parts.mapInArrow(between, part_schema).select(*schema.fieldNames()))


def _lines(original: DataFrame, placed: DataFrame, solved: DataFrame) -> DataFrame:
    """One table per conversation in order: its name, then each block's edits ahead of the block's rows."""
    none = lambda kind: F.lit(None).cast(kind)
    turn = placed.schema["turn"].dataType
    columns = lambda **own: [own.get(n, none(k)).alias(n) for n, k in (("kind", "int"), ("place", "bigint"), ("turn", turn), ("role", "string"), ("text", "string"), ("codes", "string"), ("edits", "string"), ("start", "int"))]
    every = original.select("conv_id").union(placed.select("conv_id")).distinct()
    names = every.select("conv_id", *columns(kind=F.lit(0), place=F.lit(-1).cast("bigint")))
    plans = solved.select("conv_id", *columns(kind=F.lit(1), place=F.col("place"), codes=F.col("codes"), edits=F.col("edits"), start=F.col("start")))
    rows = placed.select("conv_id", *columns(kind=F.lit(2), place=F.col("place"), turn=F.col("turn"), role=F.col("role"), text=F.col("text")))
    return names.unionByName(plans).unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")


class _Stream:
    """Goes through one conversation's lines, whatever their number, and keeps counts alone."""

    def __init__(self) -> None:
        self.digest, self.told = hashlib.sha256(), 0
        self.turns, self.low, self.high, self.last_turn = 0, None, None, None
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.illegal, self.initial, self.cost = 0, None, 0
        self.edits: list[str] = []
        self.plan, self.at, self.codes, self.row, self.state = "", 0, "", 0, START

    def plan_for(self, codes: str, edits: str, start: int) -> None:
        """The edits of the next block."""
        self.codes, self.plan, self.at, self.row, self.state = codes, edits, 0, 0, start
        self.edits.append(edits)
        self.cost += DELETE * edits.count("D") + REROLE * edits.count("R") + INSERT * edits.count("I")

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.plan) and self.plan[self.at] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield "I", NAMES[self.state], ""

    def turn(self, turn, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What a row becomes, with the turns inserted before it, and after the block's last row."""
        code = self.codes[self.row]
        if turn is not None:
            if self.turns == 0 or turn != self.last_turn:
                self.turns, self.last_turn = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        truncated = code.isupper()
        if code in "bd":
            self.counts[code] += 1
        self.counts["t"] += truncated
        initial = role[:1]
        if self.initial is not None:
            self.illegal += f"{self.initial}{initial}" not in ("su", "ua", "au")
        self.initial = initial
        self.row += 1
        yield from self._inserted()
        edit = self.plan[self.at]
        self.at += 1
        if edit != "D":
            self.cost += UNFINISHED * truncated
            self.state = NEXT[self.state] if edit == "R" else KEPT[self.state, initial]
            yield edit, NAMES[self.state] if edit == "R" else role, text
        if self.row == len(self.codes):
            yield from self._inserted()

    def tell(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.told else "").encode() + f"{role}:{text}".encode())
        self.told += 1


LINE = ("conv_id", "kind", "turn", "role", "text", "codes", "edits", "start")


def _streamed(lines: DataFrame, schema: T.StructType, each: Callable, done: Callable) -> DataFrame:
    """Run ``each(conv_id, stream, edit, role, text)`` and ``done(conv_id, stream)``, which give rows, over all lines."""

    def rows(part: pa.RecordBatch, open_one: list) -> Iterator[tuple]:
        for conv, kind, turn, role, text, codes, edits, start in zip(*(part.column(c).to_pylist() for c in LINE), strict=True):
            if kind == 0:
                if open_one:
                    yield from done(*open_one)
                open_one[:] = conv, _Stream()
            elif kind == 1:
                open_one[1].plan_for(codes, edits, start)
            else:
                for edit in open_one[1].turn(turn, role, text):
                    yield from each(*open_one, *edit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_one: list = []
        kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string()}
        conv_type = None

        def packed(found: list[tuple]) -> Iterator[pa.RecordBatch]:
            if found:
                arrays = [
                    pa.array(values, conv_type if field.name == "conv_id" else kinds[field.dataType])
                    for values, field in zip(zip(*found, strict=True), schema.fields, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for start, stop in slices(text_sizes(batch.column("text"))):
                yield from packed(list(rows(batch.slice(start, stop - start), open_one)))
        if open_one:
            yield from packed(list(done(*open_one)))

    return lines.mapInArrow(run, schema)


def _prepared(original: DataFrame, rows: DataFrame, block: int) -> DataFrame:
    placed = _placed(rows)
    solved = written(_solved(_blocks(_coded(placed), block)), "edits")
    return _lines(original, placed, solved)


def repaired(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """``conv_id, seq, role, text, edit``: the turns of each repaired conversation, counted from 0.

    ``edit`` says what became of a turn: K kept, R given the role, I inserted. Deleted turns are left out. A null
    role or text counts as one space. Turns go by number, nulls first, then by role and text; rows without a
    conversation id are one conversation. A role is known by its first character; one without a character, or
    with another than ``s, u, a``, cannot be kept. Other columns do not matter; an empty table gives no rows.
    """
    own = _rows(conversations, conv_id, turn, role, text)
    rows = own.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    schema = T.StructType([own.schema["conv_id"], *T.StructType.fromDDL("seq bigint, role string, text string, edit string").fields])

    def each(conv, stream, edit, new_role, new_text):
        stream.told += 1
        return [(conv, stream.told - 1, new_role, new_text, edit)]

    return _streamed(_prepared(own, rows, block), schema, each, lambda conv, stream: ())


def report(
    conversations: DataFrame, rows: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """One row per conversation of ``conversations``: faults, cost, audit and a digest of what the repair gives.

    ``rows`` are the rows to repair, ``conversations`` themselves unless given; a conversation without one has zeros, an
    empty audit and the digest of nothing. Nulls, ties and clashing names are handled as in ``repaired``. The digest is
    of the whole repaired text in order, so one task reads a conversation's rows as a stream; it keeps counts and the
    audit alone. The audit is one string, so it cannot be longer than a Spark string.
    """
    own = _rows(conversations, conv_id, turn, role, text)
    rows = own if rows is None else _rows(rows, conv_id, turn, role, text)
    rows = rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    names = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    schema = T.StructType([own.schema["conv_id"], *T.StructType.fromDDL(names).fields])

    def each(conv, stream, edit, new_role, new_text):
        stream.tell(new_role, new_text)
        return ()

    def done(conv, stream):
        gaps = 0 if stream.low is None else stream.high - stream.low + 1 - stream.turns
        counts = stream.counts
        return [(conv, gaps, counts["b"], counts["d"], counts["t"], stream.illegal, stream.cost, "".join(stream.edits), stream.digest.hexdigest())]

    return _streamed(_prepared(own, rows, block), schema, each, done)
