"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target is its share of all words by weight, at most `most` times its own
words; what is above is shared again by weight. A document's copies are its source's
target over its words: the whole part is taken for certain, and the rest is rounded
jointly. Documents are paired, and words move at random from one fraction to the other
until one of them is whole, so that a pair's expected words and each document's
expected copies stay as they were. Blocks of documents leave one open document for
each source; the open ones of many blocks meet in the next level of a tree, until
each source has one, which goes to the nearer whole number.

A document's block follows from its id and size, and its number among rows that agree in
both and the source; random numbers follow from seed, level and block, so that reruns
agree whatever the partitions are.

Cases: a null source is a source of its own, the last in order; a null text has no
words; documents without words are never taken; a very long text is one document as any
other, and a source's taken words may miss its target by half of its longest one; of
pairs in which both documents become whole at once, both are settled; an empty table
gives an empty result; equal ids are documents of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skjald.llm.common import WORD, cut, small, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
#: Documents of a block, on average, and blocks that meet at a level of the tree.
BLOCK_ROWS, FAN_IN = 20_000, 64


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"))


def word_count(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")


def targets(by_source: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Adds `target` to rows of source and source_size, one row for each source.

    Sources in the order of room by weight fill up one after the other: a source stops at
    its room if the words that are left, by weight, would give it more."""
    order = Window.orderBy(F.encode("source", "UTF-8").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = by_source.withColumn("weight", weight).withColumn("room", F.col("source_size") * F.lit(float(most)))
    up = Window.orderBy(F.col("room") / F.col("weight"), F.encode("source", "UTF-8").asc_nulls_last())
    everything = Window.partitionBy()
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("words", F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
    rows = rows.withColumn("weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", F.col("words") / F.col("weights")).withColumn("full", F.col("room") <= F.col("level") * F.col("weight"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return rows.select("source", "source_size", F.when(F.col("full"), F.col("room")).otherwise(F.least("room", level * F.col("weight"))).alias("target"))


def pivot(size: np.ndarray, part: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Rounds fractions `part` of documents of `size` words in pairs; one of them may stay open."""
    part, draws = part.copy(), rng.random(len(part)).tolist()
    sizes, parts = size.tolist(), part.tolist()
    i = -1  # the open document
    for j, p in enumerate(parts):
        if not 0 < p < 1:
            continue
        if i < 0:
            i = j
            continue
        a, b, q = sizes[i], sizes[j], parts[i]
        up, down = min((1 - q) * a, p * b), min(q * a, (1 - p) * b)  # words that i can gain, and lose
        move = up if draws[j] * (up + down) < down else -down
        # The one that the move fills or empties becomes whole exactly.
        if move > 0:
            filled, emptied = (1 - q) * a <= p * b, p * b <= (1 - q) * a
            parts[i], parts[j] = (1.0 if filled else q + move / a), (0.0 if emptied else p - move / b)
        else:
            emptied, filled = q * a <= (1 - p) * b, (1 - p) * b <= q * a
            parts[i], parts[j] = (0.0 if emptied else q + move / a), (1.0 if filled else p - move / b)
        i = i if 0 < parts[i] < 1 else j if 0 < parts[j] < 1 else -1
    return np.array(parts)


def _level(rows: DataFrame, level: int, seed: int, final: bool) -> DataFrame:
    """Rounds each block's documents source by source; `part` is 0 or 1 for all but one of each."""
    schema = rows.schema

    def run(block: pa.Table) -> pa.Table:
        block = block.take(pc.sort_indices(block, [("source", "ascending"), ("tie", "ascending"), ("doc_id", "ascending"), ("size", "ascending")]))
        rng = np.random.default_rng([seed, level, block["block"][0].as_py()])
        size, part = block["size"].to_numpy(), block["part"].to_numpy()
        sources = block["source"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        cuts = np.flatnonzero(np.diff(sources)) + 1
        part = np.concatenate([pivot(a, b, rng) for a, b in zip(np.split(size, cuts), np.split(part, cuts), strict=True)])
        if final:
            part = np.floor(part + 0.5)
        return block.set_column(block.column_names.index("part"), "part", pa.array(part))

    return rows.groupBy("block").applyInArrow(run, schema)


def mix(sized: DataFrame, seed: int = 7, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Rows of doc_id, source and size with source_size, target, copies and taken (words).

    `sized` has a row for each document and is read a few times: cut its lineage before."""
    by_source = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    rates = small(by_source.select(F.col("source").alias("s"), F.col("source_size"), F.col("target")))
    # Rows that agree in all of these stand for one another: they are numbered, so that many don't meet in one block.
    each = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")).withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows")
    rows = each.join(rates, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    taken = F.when(F.col("size") > 0, rate).otherwise(0.0)
    rows = rows.withColumn("whole", F.floor(taken)).withColumn("part", taken - F.floor(taken)).withColumn("tie", F.xxhash64(F.lit(seed), "doc_id", "size", "number")).drop("number")
    blocks = max(1, -(-sized.count() // BLOCK_ROWS))
    done = []
    open_rows, level = rows, 0
    while True:
        last = blocks == 1
        placed = open_rows.withColumn("block", F.pmod(F.col("tie"), F.lit(blocks)).cast("long"))
        rounded = cut(_level(placed.repartition(_spread(rows, blocks), "block"), level, seed, last))
        is_open = (F.col("part") > 0) & (F.col("part") < 1)
        done.append(rounded.filter(~is_open).drop("block"))
        if last:
            break
        open_rows, level, blocks = rounded.filter(is_open).drop("block"), level + 1, -(-blocks // FAN_IN)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("whole") + F.col("part").cast("long")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _spread(rows: DataFrame, blocks: int) -> int:
    return max(1, min(blocks, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def mix_documents(docs: DataFrame, seed: int = 7, weights: Sequence[float] = WEIGHTS, most: float = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return mix(cut(sizes(docs, id_col, text_col, source_col)), seed, weights, most)


def repeated(docs: DataFrame, copies: Column) -> DataFrame:
    """Each row as often as its `copies` say, which may be none."""
    names = docs.columns
    return docs.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select(*names)


def ranked(rows: DataFrame, key: list[str]) -> DataFrame:
    """Numbers the rows that agree in `key` from 1 in `__rank`, by a digest of all of their columns that can be compared, so that reruns agree."""
    digest = F.xxhash64(*(f.name for f in rows.schema if f.dataType.typeName() not in ("map", "variant")))
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(digest)))
