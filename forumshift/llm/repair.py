"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation's role initials must read ``(s?(ua)+)?``.  Its rows may be kept, given another
role, deleted, or have empty turns put in before them; the cheapest edits are wanted, among equal
ones those whose letters (D, I, K, R) are least.

The grammar's states are what may follow: the start, after s, after u, after a.  An item (place,
state, goal) says that the rows from a place to the end of a block can be read from the state so
that the goal state is left; its weight is (cost, rows covered, letters).  Deductions put one
edit before an item: every one raises the cost, or the rows covered at equal cost, and puts the
same letter before both of two weights, so it is monotone and superior, and the agenda pops each
item for good.  Goals are the four states at the end of the block; popping goes on until the
items at the block's first place are final.

No conversation is held in one task.  Its rows are put in order by a range sort, which deals a long one
over many tasks, and cut into blocks of at most ``BLOCK`` rows.  Turns are inserted only before
rows (after the last row stands an empty block), so letters of two derivations of one block are
never the beginning of one another, and whole conversations can be put together from block
tables: for each state the best (cost, letters) over the block's exits, from the last block back.
Only these tables (sixteen costs and letter strings a block) and at last the letters themselves,
which are one string of the report, meet by conversation; texts stay where they are.

Rows are taken by turn (nulls first), then by role and text; nulls in role or text are one space.
Faults, of which a row has its first: ``blank`` (nothing but space and 0x09-0x0D), ``duplicate``
(same role and text earlier in the conversation), ``truncated`` (does not end in . ! or ?).
Blank and duplicate rows must be deleted; a truncated one that stays costs 1 more.

Cases: an empty table gives empty results; a null conv_id is a conversation; a role without a
first letter, or with another than s, u and a, cannot be kept; repeated rows are duplicates; very
long texts are never copied between tasks; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumshift.llm.shipping import arrow_map
from forumshift.llm.staging import stage

BLOCK = 512
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_READ = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A,
         (AFTER_A, "u"): AFTER_U}
_ENDS = (START, AFTER_A)
_BY_EXIT: list[list[tuple[int, str]]] = [[(q, x) for (q, x), to in _READ.items() if to == end] for end in range(4)]
_ROLE = {"u": "user", "a": "assistant"}


def lightest(rows: list[tuple[str, bool, bool]], insert_at_end: bool = False) -> dict[tuple[int, int], tuple[int, str]]:
    """{(entry state, exit state): (cost, letters)} of a block of rows (role initial, whether it must
    go, whether it is truncated)."""
    n = len(rows)
    table: dict[tuple[int, int], tuple[int, str]] = {}
    for goal in range(4):
        done: set[tuple[int, int]] = set()
        agenda: list[tuple[int, int, str, int]] = [(0, 0, "", goal)]       # cost, rows covered, letters, state
        while agenda:
            cost, covered, letters, state = heapq.heappop(agenda)
            if (covered, state) in done:
                continue
            done.add((covered, state))
            if covered == n:
                table[state, goal] = (cost, letters)
            if covered or insert_at_end:                                   # a turn put in before the row at this place
                for q, x in _BY_EXIT[state]:
                    if x != "s" and (covered, q) not in done:
                        heapq.heappush(agenda, (cost + INSERT, covered, "I" + letters, q))
            if covered == n:
                continue
            initial, must_go, cut = rows[n - 1 - covered]
            heapq.heappush(agenda, (cost + DELETE, covered + 1, "D" + letters, state))
            if not must_go:
                for q, x in _BY_EXIT[state]:
                    if x == initial:
                        heapq.heappush(agenda, (cost + TRUNCATED * cut, covered + 1, "K" + letters, q))
                    elif x != "s":
                        heapq.heappush(agenda, (cost + REROLE + TRUNCATED * cut, covered + 1, "R" + letters, q))
    return table


def joined(tables: list[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, list[str]]:
    """(cost, letters by block) of a whole conversation from its block tables."""
    tables = [*tables, lightest([], insert_at_end=True)]
    best: dict[int, int] = {q: 0 for q in _ENDS}
    steps: list[dict[int, tuple[str, int]]] = []
    for table in reversed(tables):
        now: dict[int, tuple[int, str, int]] = {}
        for (q, to), (cost, letters) in table.items():
            if to in best:
                x = (cost + best[to], letters, to)
                if q not in now or x[:2] < now[q][:2]:
                    now[q] = x
        best = {q: x[0] for q, x in now.items()}
        steps.append({q: x[1:] for q, x in now.items()})
    state, out = START, []
    for step in reversed(steps):
        letters, state = step[state]
        out.append(letters)
    return best[START], out


_BLANKS = " \t\n\x0b\x0c\r"


def in_order(turns: DataFrame) -> DataFrame:
    """The turns with their place, which ascends over the table by conversation and turn; staged, for
    range bounds are sampled.  Equal rows are told apart so that even they can be dealt out."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        F.monotonically_increasing_id().alias("copy"))
    order = ["conv_id", "turn", "role", "text", "copy"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    said = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    end = F.substring(F.rtrim("text", F.lit(_BLANKS)), -1, 1)
    return stage(rows.select(F.monotonically_increasing_id().alias("place"), "conv_id", "turn", "role", "text",
                             said.alias("said"), end.alias("end")), "repair-turns")


def faults(rows: DataFrame) -> DataFrame:
    """place, conv_id, turn, initial, fault (or null) of rows in order; no texts are moved."""
    first = rows.groupBy("conv_id", "said").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("end") == "", "blank").when(F.col("first").isNull(), "duplicate").when(
        ~F.col("end").isin(".", "!", "?"), "truncated")
    narrow = rows.select("place", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "end")
    return narrow.join(first, "place", "left").select("place", "conv_id", "turn", "initial", fault.alias("fault"))


_TABLE = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("place", T.LongType()), T.StructField("rows", T.IntegerType()),
                       T.StructField("blank", T.LongType()), T.StructField("duplicate", T.LongType()),
                       T.StructField("truncated", T.LongType()), T.StructField("illegal", T.LongType()),
                       T.StructField("initials", T.StringType()), T.StructField("turns", T.ArrayType(T.LongType())),
                       T.StructField("costs", T.ArrayType(T.IntegerType())), T.StructField("letters", T.ArrayType(T.StringType()))])
_TABLE_ARROW = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("rows", pa.int32()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                          ("truncated", pa.int64()), ("illegal", pa.int64()), ("initials", pa.string()),
                          ("turns", pa.list_(pa.int64())), ("costs", pa.list_(pa.int32())), ("letters", pa.list_(pa.string()))])
_FOLLOWS = {"su", "ua", "au"}
_STATES = [(q, to) for q in range(4) for to in range(4)]


def _block_row(conv_id, block: list[tuple]) -> tuple:
    """One row of _TABLE for rows (place, turn, initial, fault) that follow one another."""
    initials = [x[2] for x in block]
    named = [x[3] for x in block]
    table = lightest([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, named)])
    turns = [x[1] for x in block if x[1] is not None]
    distinct = sum(a != b for a, b in zip(turns, turns[1:])) + bool(turns)
    return (conv_id, block[0][0], len(block), named.count("blank"), named.count("duplicate"), named.count("truncated"),
            sum(a + b not in _FOLLOWS for a, b in zip(initials, initials[1:])), (initials[0] or " ") + (initials[-1] or " "),
            [turns[0], turns[-1], distinct] if turns else [],
            [table[s][0] if s in table else -1 for s in _STATES], [table[s][1] if s in table else "" for s in _STATES])


def _blocks(rows: DataFrame) -> DataFrame:
    """Block tables of rows in order; a block's places follow one another without a gap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        conv, out = None, []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _TABLE_ARROW)], schema=_TABLE_ARROW)

        for b in batches:
            for conv_id, *row in zip(*[c.to_pylist() for c in b.columns]):
                if held and (conv_id != conv or len(held) == BLOCK or row[0] != held[-1][0] + 1):
                    out.append(_block_row(conv, held))
                    held = []
                conv = conv_id
                held.append(tuple(row))
                if len(out) == 256:
                    yield batch()
                    out = []
        if held:
            out.append(_block_row(conv, held))
        if out:
            yield batch()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = rows.select("conv_id", "place", "turn", "initial", "fault")
    return arrow_map(narrow.repartitionByRange(parts, "place").sortWithinPartitions("place"), run, _TABLE)


_REPORT = T.StructType([T.StructField("conv_id", T.LongType())] +
                       [T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] +
                       [T.StructField("audit", T.StringType()), T.StructField("place", T.ArrayType(T.LongType())),
                        T.StructField("letters", T.ArrayType(T.StringType()))])


def _report_row(conv_id, blocks: list[tuple]) -> tuple:
    tables = [{s: (c, x) for s, c, x in zip(_STATES, b[8], b[9]) if c >= 0} for b in blocks]
    cost, letters = joined(tables)
    turns = [b[7] for b in blocks if b[7]]
    distinct = sum(t[2] for t in turns) - sum(a[1] == b[0] for a, b in zip(turns, turns[1:]))
    gaps = turns[-1][1] - turns[0][0] + 1 - distinct if turns else 0
    illegal = sum(b[5] for b in blocks) + sum(a[6][1] + b[6][0] not in _FOLLOWS for a, b in zip(blocks, blocks[1:]))
    return (conv_id, gaps, sum(b[2] for b in blocks), sum(b[3] for b in blocks), sum(b[4] for b in blocks), illegal, cost,
            "".join(letters), [b[0] for b in blocks] + [None], letters)


def _reports(blocks: DataFrame) -> DataFrame:
    """One row per conversation from its blocks, a partition sorted by conversation at a time."""
    schema = pa.schema([("conv_id", pa.int64())] + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] +
                       [("audit", pa.string()), ("place", pa.list_(pa.int64())), ("letters", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        conv, out = None, []
        for b in batches:
            for conv_id, *row in zip(*[c.to_pylist() for c in b.columns]):
                if held and conv_id != conv:
                    out.append(_report_row(conv, held))
                    held = []
                conv = conv_id
                held.append(tuple(row))
            if len(out) > 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if held:
            out.append(_report_row(conv, held))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return arrow_map(blocks.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "place"), run, _REPORT)


_EDIT = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("step", T.LongType()),
                      T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()), T.StructField("new_role", T.StringType())])


def _edits(found: DataFrame) -> DataFrame:
    """(conv_id, step, place, edit, new_role) of every turn of the repaired conversations: step counts
    them; place is null where the turn is put in; new_role is null where the row's own is kept."""
    outputs = F.length(F.regexp_replace("audit", "D", ""))
    blocks = found.select("conv_id", (outputs % 2).alias("odd"), "place", "letters", F.transform(
        "letters", lambda x: F.length(F.regexp_replace(x, "D", ""))).alias("sizes"))
    blocks = blocks.select("conv_id", "odd", F.posexplode(F.arrays_zip("place", "letters")).alias("k", "b"), "sizes")
    before = F.aggregate(F.slice("sizes", 1, F.col("k")), F.lit(0).cast("long"), lambda a, x: a + x)
    blocks = blocks.select("conv_id", "odd", "b.place", "b.letters", before.alias("before"))
    schema = pa.schema([("conv_id", pa.int64()), ("step", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("new_role", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for conv_id, odd, place, letters, step in zip(*[c.to_pylist() for c in b.columns]):
                out, row = [], 0
                for x in letters:
                    if x != "D":
                        role = None if x == "K" else _ROLE["ua"[(step - odd) % 2]]
                        out.append((conv_id, step, None if x == "I" else place + row, x, role))
                        step += 1
                    row += x != "I"
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return arrow_map(blocks, run, _EDIT)


class Repair:
    """The repair of a table of turns (conv_id, turn, role, text)."""

    def __init__(self, turns: DataFrame):
        self._rows = in_order(turns)
        self._found = stage(_reports(stage(_blocks(faults(self._rows)), "repair-blocks")), "repair-report")

    @property
    def report(self) -> DataFrame:
        """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
        return self._found.drop("place", "letters")

    @property
    def turns(self) -> DataFrame:
        """The repaired conversations: conv_id, step (from 0), edit (I, K or R), role, text."""
        edits = _edits(self._found)
        texts = self._rows.select("place", "role", "text")
        return edits.join(texts, "place", "left").select(
            "conv_id", "step", "edit", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, sha256 of the lines ``role:text`` of its turns by step.  One hash runs over a
    conversation's turns in order, so they pass through one task, a batch of them at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running = None, None
        for b in batches:
            out = []
            for conv_id, role, text in zip(*[c.to_pylist() for c in b.columns]):
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                if running is not None and conv_id == conv:
                    running.update(b"\n" + line)
                else:
                    if running is not None:
                        out.append((conv, running.hexdigest()))
                    conv, running = conv_id, hashlib.sha256(line)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out])],
                                                 names=["conv_id", "sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([running.hexdigest()])], names=["conv_id", "sha256"])

    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "step")
    return arrow_map(dealt.select("conv_id", "role", "text"), run, "conv_id long, sha256 string")
