"""Helpers that the corpus operators share: shared storage, lineage cuts, row keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skjald.sources.shared import remove, shared_path, shared_root  # noqa: F401 - used by the operators

#: Rows up to which a table of short rows is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 20_000
#: Short rows that one task passes on from shuffle to shuffle.
PIECE_ROWS = 20_000
#: ASCII blanks: words are what stands between them.
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """`df` with its lineage cut by a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks `df` for broadcast if its counted rows are few, else leaves the join to shuffles."""
    few = df.limit(rows + 1).count() <= rows
    return F.broadcast(df) if few else df


def pieces(rows: int, each: int = PIECE_ROWS) -> int:
    """Tasks that read `rows` short rows, `each` by one of them.

    What one shuffle gives to the next is coalesced to so many, as each task of a shuffle
    writes a block for every partition, however few rows there are."""
    return max(1, -(-rows // each))


def with_free_names(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """stage(docs), where columns of `docs` whose names begin as those used within (with two underscores) have other names meanwhile."""
    taken = set(docs.columns)
    held: dict[str, str] = {}
    for name in docs.columns:
        if name.startswith("__"):
            held[name] = f"held{name}"
            while held[name] in taken:
                held[name] += "_"
            taken.add(held[name])
    if not held:
        return stage(docs)
    return stage(docs.withColumnsRenamed(held)).withColumnsRenamed({v: k for k, v in held.items()})


def by_size(sizes: list[int], most: int) -> Iterator[slice]:
    """Runs of rows whose sizes sum to `most`, unless one row has more."""
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tiled(rows: DataFrame, group: str, member: str, size: int) -> DataFrame:
    """Splits groups of `n` rows into tiles of about `size`, and sends each row to all tiles that it meets.

    Grouped by (`group`, lo, hi), rows of tile lo meet those of tile hi; every pair of
    a group's members meets in one of these, which holds about 2 * size rows at most."""
    tiles = F.ceil(F.col("n") / size)
    rows = rows.withColumn("tile", F.pmod(F.xxhash64(F.lit(11), member), tiles))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
    return rows.withColumn("lo", F.least("tile", "other")).withColumn("hi", F.greatest("tile", "other"))
