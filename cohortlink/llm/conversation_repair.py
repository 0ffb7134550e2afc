"""Cheapest repair of a conversation's turn order by Four-Russians block tables.

A row is a symbol: the initial of its role (s, u, a or another), and whether it
is cut off, or that it must go (blank or repeated). A repaired conversation is
(s?(ua)+)?, which an automaton of four states accepts: nothing yet, after s,
after u, after a. The cost of repairing what follows a place is a vector over
the states there; less its minimum it takes few values, so a vector is a
number, and a table holds for every vector and every block of ``LENGTH``
symbols the vector before the block and the cost added. The tables are computed
by joining shorter blocks. A conversation is priced from its last block to its
first by look-up. The edits are then read forward: each block is expanded
backward from the vector behind it into the vectors at its rows, and the least
letter among all edits of least cost is taken, so ties are resolved exactly.

Rows are dealt by ranges of (conversation, turn, role, text), so that a long
conversation is spread over tasks, and are cut into segments of at most
``SEGMENT_ROWS`` rows and ``SEGMENT_CHARS`` characters of text. Equal rows are counted before they are shuffled.
A conversation of one segment is repaired where it is. Of longer ones, segments
are priced side by side for every vector they may end in; the results, a few
bytes per segment, are chained. The repaired text of a conversation is hashed
as one stream, segment by segment, in bounded memory.

Hard rows: a null role or text reads as one space, and a null id or turn does so
in the key that decides on the damage. Rows without a turn come first; rows of one turn are taken in
the order of role, then text. Rows without an id are one conversation. Equal rows are repeats. A row whose role does
not begin with s, u or a (also an empty one) cannot be kept as it is. Very long texts are never cut. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, written

LENGTH = 4
SEGMENT_ROWS = 4096
SEGMENT_CHARS = 4 * 1024 * 1024
SPACE = " \t\n\x0b\x0c\r"

# Costs of the edits, and of a cut-off row that stays.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
START, S, U, A = range(4)
# State after a user or an assistant turn is put behind each state; after s, u and a kept.
PUT = {START: U, S: U, U: A, A: U}
KEPT = {"s": {START: S}, "u": {START: U, S: U, A: U}, "a": {U: A}}
# Symbols: nothing, a row that must go, then each kind of role whole and cut off.
NOTHING, GONE = 0, 1
KINDS = ["s", "u", "a", "?"]
SYMBOLS = 2 + 2 * len(KINDS)


def symbol_of(role: str, cut_off: bool) -> int:
    kind = KINDS.index(role[0]) if role[:1] in ("s", "u", "a") else 3
    return 2 + 2 * kind + cut_off


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row."""
    if symbol == NOTHING:
        return [("", 0, state)]
    found = [("D", DELETE, state)]
    if symbol != GONE:
        kind, more = KINDS[(symbol - 2) // 2], CUT_OFF * ((symbol - 2) % 2)
        if state in KEPT.get(kind, {}):
            found.append(("K", more, KEPT[kind][state]))
        found.append(("R", REROLE + more, PUT[state]))
    return found


def _with_inserts(cost: list[int]) -> tuple[int, ...]:
    """The cost from each state if turns may also be put in at this place."""
    u, a = min(cost[U], INSERT + cost[A]), min(cost[A], INSERT + cost[U])
    return min(cost[START], INSERT + u), min(cost[S], INSERT + u), u, a


def before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """The cost vector before a row, from that behind it."""
    if symbol == NOTHING:
        return behind
    return _with_inserts([min(c + behind[t] for _, c, t in _edits(symbol, s)) for s in range(4)])


# Behind the last row: nothing is to be paid after an a, or where nothing was said.
END = _with_inserts([0, 1 << 20, 1 << 20, 0])


class Tables:
    """Normalised vectors by number, and the step from the vector behind a block to that before it."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        least = min(END)
        self.vectors = [tuple(x - least for x in END)]
        number = {self.vectors[0]: 0}
        step: list[list[int]] = []
        added: list[list[int]] = []
        for vector in self.vectors:  # grows while it is read
            step.append([])
            added.append([])
            for symbol in range(SYMBOLS):
                new = before(symbol, vector)
                low = min(new)
                key = tuple(x - low for x in new)
                if key not in number:
                    number[key] = len(self.vectors)
                    self.vectors.append(key)
                step[-1].append(number[key])
                added[-1].append(low)
        # tables of blocks of n symbols, numbered with the first symbol as the highest digit
        one_step, one_added = np.array(step, dtype=np.int32), np.array(added, dtype=np.int32)
        self.step, self.added = one_step, one_added
        for _ in range(length - 1):
            # a symbol more in front: look up the block behind first
            self.added = (self.added[:, None, :] + one_added[self.step].transpose(0, 2, 1)).reshape(len(step), -1)
            self.step = one_step[self.step].transpose(0, 2, 1).reshape(len(step), -1)
        self.places = SYMBOLS ** np.arange(length - 1, -1, -1)

    def blocks(self, symbols: bytes) -> np.ndarray:
        """The numbers of a sequence's blocks; the last one is filled up with nothing."""
        row = np.frombuffer(symbols, dtype=np.uint8).astype(np.int64)
        row = np.pad(row, (0, -len(row) % self.length))
        return row.reshape(-1, self.length) @ self.places

    def price(self, symbols: bytes, behind: int) -> tuple[list[int], int]:
        """The vector behind each block and before the first, and the cost added; by look-up from the last block."""
        at, cost = [behind], 0
        for block in self.blocks(symbols)[::-1].tolist():
            cost += int(self.added[at[-1], block])
            at.append(int(self.step[at[-1], block]))
        return at[::-1], cost

    def trace(self, symbols: bytes, behind: int, state: int, last: bool) -> Iterator[str]:
        """For each row the letters up to and with its own, from ``state`` on; then those put in after the last row.

        ``last`` tells that nothing follows; otherwise turns put in behind
        belong to the segment that follows.
        """
        at, _ = self.price(symbols, behind)
        for k in range(0, len(symbols), self.length):
            block = symbols[k : k + self.length]
            # expanded backward: the vectors at the rows of this block alone
            costs = [self.vectors[at[k // self.length + 1]]]
            for symbol in reversed(block):
                costs.append(before(symbol, costs[-1]))
            costs.reverse()
            for i, symbol in enumerate(block):
                letters = ""
                while True:
                    here, edits = costs[i][state], _edits(symbol, state)
                    best = {x: t for x, c, t in edits if c + costs[i + 1][t] == here}
                    if "D" not in best and INSERT + costs[i][PUT[state]] == here:
                        letters, state = letters + "I", PUT[state]
                        continue
                    letter = min(best)
                    state = best[letter]
                    yield letters + letter
                    break
        letters = ""
        if last:
            while state not in (START, A):
                letters, state = letters + "I", PUT[state]
        yield letters


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) after the damage that the hash of id and turn decides on; a repeated row occurs twice."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.withColumns({"text": F.coalesce("text", blank), "role": F.coalesce("role", blank)}).where(kind != 0).select(
        "conv",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("times"),
    )


SEGMENT = (
    "conv bigint, segment bigint, symbols binary, lines array<struct<at:int,role:string,text:string>>, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
    "turns bigint, low bigint, high bigint"
)


class _Segment:
    """Rows of a conversation that follow one another."""

    def __init__(self, conv: int | None, number: int):
        self.conv, self.number = conv, number
        self.symbols, self.lines, self.chars = bytearray(), [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, row: dict, copies: int, first: bool) -> None:
        role, text, turn = row["role"], row["text"], row["turn"]
        shown = text.rstrip(SPACE)
        if not shown:
            self.blank += copies
            self.symbols.extend(bytes([GONE]) * copies)
        else:
            cut_off = shown[-1] not in ".!?"
            self.duplicate += copies - first
            if first:
                self.truncated += cut_off
                self.lines.append({"at": len(self.symbols), "role": role, "text": text})
                self.symbols.append(symbol_of(role, cut_off))
            self.symbols.extend(bytes([GONE]) * (copies - first))
        initial = role[:1]
        self.illegal += (self.last is not None and self.last + initial not in ("su", "ua", "au")) + (copies - 1)
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.chars += len(text)

    def row(self) -> tuple:
        return (
            self.conv, self.number, bytes(self.symbols), self.lines, self.blank, self.duplicate, self.truncated,
            self.illegal, self.first, self.last, self.turns, self.low, self.high,
        )


_LINE = pa.struct([("at", pa.int32()), ("role", pa.string()), ("text", pa.string())])
_LONG, _STRING = pa.int64(), pa.string()
SEGMENT_SCHEMA = pa.schema(
    [("conv", _LONG), ("segment", _LONG), ("symbols", pa.binary()), ("lines", pa.list_(_LINE))]
    + [(x, _LONG) for x in ("blank", "duplicate", "truncated", "illegal")]
    + [("first", _STRING), ("last", _STRING), ("turns", _LONG), ("low", _LONG), ("high", _LONG)]
)


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (part, conv, turn, role, text, times, new) as segments of at most ``most`` rows."""
    now: _Segment | None = None
    done: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), SEGMENT_SCHEMA, strict=True)], schema=SEGMENT_SCHEMA
        )

    for batch in batches:
        for row in batch.to_pylist():
            left, first = row["times"], row["new"]
            while left:
                full = now is not None and (len(now.symbols) >= most or now.chars >= SEGMENT_CHARS)
                if now is None or full or now.conv != row["conv"]:
                    if now is not None:
                        done.append(now.row())
                        size += now.chars + len(now.symbols)
                        if size >= SEGMENT_CHARS or len(done) >= SEGMENT_ROWS:
                            yield out()
                            done, size = [], 0
                    follows = now is not None and now.conv == row["conv"]
                    # segments of a conversation are in order within a task, and tasks are in order
                    now = _Segment(row["conv"], now.number + 1 if follows else row["part"] << 32)
                take = min(left, most - len(now.symbols))
                now.add(row, take, first)
                left, first = left - take, False
    if now is not None:
        done.append(now.row())
    if done:
        yield out()


def _prices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, segment, step): the vector before a segment for every one that may be behind it."""
    t = tables()
    for batch in batches:
        rows = batch.to_pylist()
        steps = [[t.price(r["symbols"], v)[0][0] for v in range(len(t.vectors))] for r in rows]
        columns = [batch.column("conv"), batch.column("segment"), pa.array(steps, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "segment", "step"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, segment, behind): the vector behind each segment; rows arrive by conversation, the last segment first."""
    conv, vector, any_ = None, 0, False
    for batch in batches:
        behind = []
        for row in batch.to_pylist():
            if not any_ or row["conv"] != conv:
                conv, vector, any_ = row["conv"], 0, True
            behind.append(vector)
            vector = row["step"][vector]
        columns = [batch.column("conv"), batch.column("segment"), pa.array(behind, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "segment", "behind"])


RESULT = (
    "conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


class _Repair:
    """One conversation, segment by segment."""

    def __init__(self, conv: int | None):
        self.conv, self.state, self.cost = conv, START, 0
        self.letters: list[str] = []
        self.hash, self.any_line = hashlib.sha256(), False
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last = self.low = self.high = None

    def line(self, role: str, text: str) -> None:
        self.hash.update(("\n" * self.any_line + f"{role}:{text}").encode())
        self.any_line = True

    def put(self, text: str = "") -> None:
        self.state = PUT[self.state]
        self.line("user" if self.state == U else "assistant", text)

    def add(self, row: dict, last: bool) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + row[name])
        if self.last is not None:
            self.illegal += self.last + row["first"] not in ("su", "ua", "au")
        self.last = row["last"]
        if row["low"] is not None:
            self.turns -= row["low"] == self.high
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        lines = {x["at"]: x for x in row["lines"]}
        symbols = row["symbols"]
        for i, letters in enumerate(tables().trace(symbols, row["behind"], self.state, last)):
            self.letters.append(letters)
            for letter in letters:
                line = lines.get(i)
                cut_off = line is not None and (symbols[i] - 2) % 2
                if letter == "I":
                    self.put()
                    self.cost += INSERT
                elif letter == "R":
                    self.put(line["text"])
                    self.cost += REROLE + CUT_OFF * cut_off
                elif letter == "K":
                    self.state = KEPT[line["role"][0]][self.state]
                    self.line(line["role"], line["text"])
                    self.cost += CUT_OFF * cut_off
                else:
                    self.cost += DELETE

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (self.conv, *counts, "".join(self.letters), self.hash.hexdigest())


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation, from its segments in order, each with the vector behind it; ``final`` marks the last."""
    now: _Repair | None = None
    kinds = [_LONG] * 7 + [_STRING] * 2
    names = [x.split()[0] for x in RESULT.split(", ")]
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            now = now or _Repair(row["conv"])
            now.add(row, row["final"])
            if row["final"]:
                done.append(now.row())
                now = None
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def repair_conversations(
    table: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    damage: bool = True,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row per conversation.

    With ``damage`` rows are first damaged as a drill for the repair; without
    it, they are repaired as they are.
    """
    rows = table.select(
        F.col(id_col).cast("bigint").alias("conv"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    names = rows.select("conv").distinct()
    if damage:
        rows = damaged(rows)
    else:
        blank = F.lit(" ")
        rows = rows.withColumns({"text": F.coalesce("text", blank), "role": F.coalesce("role", blank), "times": F.lit(1)})
    # what is said is compared by its hash; a length in front keeps role and text apart
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("said")
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("times")).withColumn("said", said)
    rows = written(rows, "turns")
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = rows.groupBy("conv", "said").agg(F.min(place)["turn"].alias("since"))
    firsts = firsts.select(F.col("conv").alias("c"), F.col("said").alias("s"), "since", F.xxhash64("conv", "said").alias("h"))
    # the hash beside the keys asks for a shuffle of both sides, so that AQE can split what one conversation often says
    meets = _same(F.col("conv"), F.col("c")) & (F.col("said") == F.col("s")) & (F.xxhash64("conv", "said") == F.col("h"))
    marked = rows.join(firsts, meets)
    marked = marked.select("conv", "turn", "role", "text", "times", _same(F.col("turn"), F.col("since")).alias("new"))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    dealt = marked.repartitionByRange(partitions(table.sparkSession), *order).sortWithinPartitions(*order)
    dealt = dealt.select(F.spark_partition_id().cast("bigint").alias("part"), "*")
    segments = written(dealt.mapInArrow(lambda batches: _cut(batches, segment_rows), SEGMENT), "segments")

    ends = segments.groupBy("conv").agg(F.count("*").alias("n"), F.max("segment").alias("end"))
    ends = written(ends.where("n > 1").select(F.col("conv").alias("c"), "end"), "long")
    long = segments.join(ends, _same(F.col("conv"), F.col("c")), "left_semi")
    short = segments.join(ends, _same(F.col("conv"), F.col("c")), "left_anti")
    alone = short.withColumns({"behind": F.lit(0), "final": F.lit(True)}).mapInArrow(_repair, RESULT)

    prices = long.select("conv", "segment", "symbols").mapInArrow(_prices, "conv bigint, segment bigint, step array<int>")
    back = prices.repartition("conv").sortWithinPartitions("conv", F.desc("segment"))
    behind = back.mapInArrow(_chain, "conv bigint, segment bigint, behind int")
    behind = behind.select(F.col("conv").alias("c"), F.col("segment").alias("g"), "behind")
    each = long.join(behind, _same(F.col("conv"), F.col("c")) & (F.col("segment") == F.col("g"))).drop("c", "g")
    each = each.join(ends, _same(F.col("conv"), F.col("c"))).withColumn("final", F.col("segment") == F.col("end")).drop("c", "end")
    chained = each.repartition("conv").sortWithinPartitions("conv", "segment").mapInArrow(_repair, RESULT)

    found = alone.unionByName(chained).withColumnRenamed("conv", "c")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return names.join(found, _same(F.col("conv"), F.col("c")), "left").select(
        F.col("conv").alias(id_col),
        *(F.coalesce(x, F.lit(0)).cast("bigint").alias(x) for x in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
