"""Conversation structure repair: faults by windows, and the cheapest edits by a fold over sorted turns.

A well-formed conversation has the role initials `(s?(ua)+)?`. repaired() finds, for each
conversation, the cheapest edits of its rows that make it so: Keep costs nothing, Rerole (to
user or assistant) REROLE, Delete DELETE, which blank and duplicate rows need, Insert (an
empty turn of user or assistant, anywhere) INSERT; rows that are cut off and stay add
TRUNCATED. Of edits of one cost, those whose initials in order are least in ASCII.

1. Rows are ordered by turn (nulls first), role and text. Those that agree in all of these
   are one row with a count, made before anything is shuffled by conversation. A window over
   (conversation, role, digest of the text) marks those that were seen earlier.
2. The rows are dealt by ranges of (conversation, turn, role, beginning of the text) and
   numbered in that order, so that one conversation may be spread over all tasks. BLOCK
   neighbours are a block.
3. Spark SQL's aggregate() folds the sorted turn structs of a block. Its state is four
   structs of (cost, audit), one for each state of the automaton (nothing yet, after system,
   after user, after assistant), advanced by least(): structs compare by cost, then by audit.
   It is run from each of the four states, which gives a block's 4 by 4 table of cheapest
   (cost, audit). Least costs with audits of one beginning stay least whatever follows, as
   no audit of the same cost and rows is the beginning of another one.
4. Tables of BLOCK neighbouring blocks are folded the same way, until a conversation has
   one. No group has more than BLOCK entries, however long a conversation is.
5. The repaired text is hashed row by row in a stream that is sorted by conversation and
   place; a task holds a batch of rows and an audit at a time. A digest is a chain over the
   whole text, so that one conversation's rows do pass through one task here.

damaged() makes the faults of the test query. Cases: null roles and texts count as one
space, null conversations are one conversation and null turns come first; roles are known
by their first letter, and others than s, u and a must be reroled or deleted; rows that repeat
are duplicates but for the first; very long texts are hashed once and carried once; a
conversation of deleted rows alone, or of none, has an empty repair; an empty table gives an
empty result; columns other than the four are ignored, whatever their names are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skjald.llm.common import cut

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Entries that a fold takes at most, as a power of two.
BLOCK = 8
#: Cost of what can't be.
NEVER = 10**15
#: States of the automaton: nothing yet, then after system, user and assistant.
STATES = ["z", "s", "u", "a"]
BLANKS = "".join(map(chr, [*range(9, 14), 32]))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """conv_id, turn, role, text and n (how often the row stands there), with faults by the check of conversation and turn."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space(conv), F.lit(":"), space(turn))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    named = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.when(fault == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.when(fault == 3, 2).otherwise(1).alias("n"), fault.alias("fault"))
    return named.filter("fault != 0").drop("fault")


def flagged(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, n), each once with its count, in order: at (a number that rises along a conversation), initial, bad (blank or seen earlier), blank, cut_off."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy("turn")
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    rows = rows.withColumn("again", F.row_number().over(earlier) > 1).withColumn("last", last)
    rows = rows.select("conv_id", "turn", "role", "text", "n", F.substring("role", 1, 1).alias("initial"), (F.col("last") == "").alias("blank"), "again", (~F.col("last").isin(".", "!", "?")).alias("cut_off"))
    rows = rows.withColumn("bad", F.col("blank") | F.col("again"))
    # The beginning of a text orders ranges as the text itself does.
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv_id", "turn", "role", "text")
    return cut(dealt.withColumn("at", F.monotonically_increasing_id()))


def best(cost: Column, audit: Column) -> Column:
    return F.struct(cost.cast("long").alias("cost"), audit.alias("audit"))


def least(*found: Column) -> Column:
    return found[0] if len(found) == 1 else F.least(*found)


def then(x: Column, cost: Column | int, edits: Column | str) -> Column:
    """The state reached from `x` by edits of that cost."""
    return best(x.cost + (F.lit(cost) if isinstance(cost, int) else cost), F.concat(x.audit, F.lit(edits) if isinstance(edits, str) else edits))


def states(z: Column, s: Column, u: Column, a: Column) -> Column:
    return F.struct(z.alias("z"), s.alias("s"), u.alias("u"), a.alias("a"))


def inserted(x: Column) -> Column:
    """The states after as many inserted turns as are worth it: a user turn, then an assistant's."""
    with_u = lambda x: states(x.z, x.s, least(x.u, *(then(x[c], INSERT, "I") for c in "zsa")), x.a)
    with_a = lambda x: states(x.z, x.s, x.u, least(x.a, then(x.u, INSERT, "I")))
    return F.transform(F.transform(F.array(x), with_u), with_a)[0]


def turned(x: Column, t: Column) -> Column:
    """The states after a row: `t` has initial, n, bad and cut_off. Its copies are deleted."""
    gone = F.repeat(F.lit("D"), t.n.cast("int"))
    copies = F.repeat(F.lit("D"), t.n.cast("int") - 1)
    stays = F.when(t.bad, NEVER).otherwise(0) + F.when(t.cut_off, TRUNCATED).otherwise(0) + DELETE * (t.n - 1)
    drop = lambda c: then(x[c], DELETE * t.n, gone)
    keep = lambda c, role: then(x[c], stays + F.when(t.initial == role, 0).otherwise(NEVER), F.concat(F.lit("K"), copies))
    rerole = lambda c: then(x[c], stays + REROLE, F.concat(F.lit("R"), copies))
    user = [f for c in "zsa" for f in (keep(c, "u"), rerole(c))]
    return states(drop("z"), least(drop("s"), keep("z", "s")), least(drop("u"), *user), least(drop("a"), keep("u", "a"), rerole("u")))


def starting(at: str) -> Column:
    """A fold's beginning in one state."""
    here = lambda c: best(F.lit(0 if c == at else NEVER), F.lit(""))
    return states(*(here(c) for c in STATES))


def folded(turns: Column) -> Column:
    """The table of a block: for each state before it, the cheapest ways to each state behind it."""
    step = lambda x, t: F.transform(F.array(turned(x, t)), inserted)[0]
    return F.struct(*(F.aggregate(turns, inserted(starting(c)), step).alias(c) for c in STATES))


def chained(tables: Column) -> Column:
    """The table of several blocks in order."""
    onto = lambda x, c, m: least(*(best(x[k].cost + m.ways[k][c].cost, F.concat(x[k].audit, m.ways[k][c].audit)) for k in STATES))
    return F.struct(*(F.aggregate(tables, starting(c), lambda x, m: states(*(onto(x, k, m) for k in STATES))).alias(c) for c in STATES))


def breaks(entries: Column, before: str, after: str) -> Column:
    """How many neighbours aren't su, ua or au: of the last role of one (`after`) and the first of the next one (`before`)."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).cast("long").alias("n"))
    wrong = lambda x, e: F.when(F.concat(x.last, e[before]).isin("su", "ua", "au"), 0).when(x.last.isNull(), 0).otherwise(1)
    return F.aggregate(entries, start, lambda x, e: F.struct(e[after].alias("last"), (x.n + wrong(x, e)).alias("n")), lambda x: x.n)


def summed(rows: DataFrame) -> DataFrame:
    """conv_id, ways (from and to each state), illegal and first (the first row's number) of each conversation."""
    turns = rows.select("conv_id", F.shiftright("at", BLOCK).alias("block"), F.struct("at", "initial", "n", "bad", "cut_off").alias("t"))
    level = turns.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    copies = F.aggregate("turns", F.lit(0).cast("long"), lambda x, t: x + t.n - 1)
    level = level.select("conv_id", "block", folded(F.col("turns")).alias("ways"), (breaks(F.col("turns"), "initial", "initial") + copies).alias("illegal"), F.col("turns")[0].initial.alias("head"), F.element_at("turns", -1).initial.alias("tail"), F.col("turns")[0]["at"].alias("first"))
    while True:
        level = cut(level)
        most = level.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return level
        block = F.lit(0).cast("long") if most <= 1 << BLOCK else F.shiftright("block", BLOCK)
        entries = level.select("conv_id", block.alias("to"), F.struct("block", "ways", "illegal", "head", "tail", "first").alias("b"))
        grouped = entries.groupBy("conv_id", F.col("to").alias("block")).agg(F.sort_array(F.collect_list(F.struct("b.block", "b.first", "b.head", "b.tail", "b.illegal", "b.ways"))).alias("bs"))
        inner = F.aggregate("bs", F.lit(0).cast("long"), lambda x, b: x + b.illegal)
        level = grouped.select("conv_id", "block", chained(F.col("bs")).alias("ways"), (inner + breaks(F.col("bs"), "head", "tail")).alias("illegal"), F.col("bs")[0].head.alias("head"), F.element_at("bs", -1).tail.alias("tail"), F.col("bs")[0].first.alias("first"))


class Repair:
    """A conversation's repaired text, written row by row as the audit says."""

    def __init__(self, audit: str):
        self.audit, self.at, self.out, self.last, self.n = audit, 0, hashlib.sha256(), "", 0

    def write(self, role: str, text: str) -> None:
        self.out.update(f"{chr(10) * bool(self.n)}{role}:{text}".encode())
        self.last, self.n = role[:1], self.n + 1

    def next_role(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.write(self.next_role(), "")
            self.at += 1

    def row(self, role: str, text: str, n: int) -> None:
        self.insert()
        edit = self.audit[self.at]
        if edit != "D":
            self.write(role if edit == "K" else self.next_role(), text)
        self.at += n  # the copies are deleted

    def digest(self) -> str:
        self.insert()
        return self.out.hexdigest()


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """first and repaired_sha256 of each conversation; `audits` has first and audit."""
    heads = rows.join(audits, rows["at"] == audits["first"], "left").select("conv_id", "at", "role", "text", "n", "first", "audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = first = None
        done: list[tuple[int, str]] = []
        for batch in batches:
            for role, text, n, begins, audit in zip(*(batch.column(k).to_pylist() for k in range(2, 7)), strict=True):
                if begins is not None:
                    if repair is not None:
                        done.append((first, repair.digest()))
                    repair, first = Repair(audit), begins
                repair.row(role, text, n)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())], ["first", "repaired_sha256"])
            done = []
        if repair is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([repair.digest()], pa.string())], ["first", "repaired_sha256"])

    streams = heads.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return streams.mapInArrow(run, "first long, repaired_sha256 string")


def repaired(rows: DataFrame, all_conversations: DataFrame | None = None) -> DataFrame:
    """A row for each conversation of `rows` (conv_id, turn, role, text, n), and of `all_conversations` (conv_id): its faults, the cost and initials of its cheapest edits, and the digest of its repaired text."""
    rows = flagged(rows)
    counts = lambda when, n: F.sum(F.when(when, n).otherwise(0)).alias
    n, blank, again = F.col("n"), F.col("blank"), F.col("again")
    faults = rows.groupBy("conv_id").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"),
        counts(blank, n)("blank"),
        F.sum(F.when(blank, 0).when(again, n).otherwise(n - 1)).alias("duplicate"),
        counts(~blank & ~again & F.col("cut_off"), 1)("truncated"),
    )
    turns = rows.filter("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("*").alias("turns"))
    found = summed(rows)
    ends = least(F.col("ways.z.z"), F.col("ways.z.a"))
    ways = cut(found.select("conv_id", "first", "illegal", ends.cost.alias("cost"), ends.audit.alias("audit")))
    texts = digests(rows, ways.select("first", "audit"))
    known = ways.join(texts, "first")
    ids = rows.select("conv_id") if all_conversations is None else all_conversations.select("conv_id")
    joined = reduce(lambda x, y: x.join(y.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")), "left").drop("id"), [faults, turns, known], ids.distinct())
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps")
    return joined.select("conv_id", gaps, *(zero(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
