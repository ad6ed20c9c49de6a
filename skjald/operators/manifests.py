"""Manifests of segments: validation, deterministic splits, samples, aligned outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skjald.functions import draws, paths, text


def normal_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Without lines that hold /// or `manifest`; the others normalised."""
    kept = ~F.contains(F.col(line), F.lit("///")) & ~F.contains(F.col(line), F.lit("manifest"))
    return lines.filter(kept).withColumn(line, paths.normal_line(F.col(line)))


def valid(line: Column, parts: int = 4) -> Column:
    """Whether the line has so many parts by slashes, and a path and a length by one tab."""
    return (F.size(F.split(line, "/")) == parts) & (F.size(F.split(line, "\t")) == 2)


def fields(lines: DataFrame, line: str = "value") -> DataFrame:
    halves = F.split(line, "\t")
    return lines.select(F.element_at(halves, 1).alias("path"), F.element_at(halves, 2).try_cast("long").alias("n_samples"))


def split(rows: DataFrame, key: str, seed: str, n_valid: int = 8_000) -> DataFrame:
    """Adds `split`: the first `n_valid` rows in seeded order are `valid`, the others `train`.

    Only the order key of the last valid row is looked for, by a top-k, so that nothing is sorted whole."""
    rows = rows.withColumn("__rank", draws.rank_key(seed, F.col(key)))
    last = rows.select("__rank", key).orderBy("__rank", key).limit(n_valid).agg(F.max(F.struct("__rank", key)).alias("__last"))
    return rows.join(F.broadcast(last)).withColumn("split", F.when(F.struct("__rank", key) <= F.col("__last"), "valid").otherwise("train")).drop("__rank", "__last")


def sample(rows: DataFrame, key: str, seed: str, n: int = 100) -> DataFrame:
    """`n` rows, always the same ones."""
    return rows.orderBy(draws.rank_key(seed, F.col(key)), key).limit(n)


def segment_lines(segments: DataFrame, key: str) -> DataFrame:
    """A line of file name and samples for each segment, beside its number."""
    return segments.select(key, "seg_id", F.format_string("%d.wav\t%d", F.col("seg_id"), F.col("end_sample") - F.col("start_sample")).alias("line"))


def triples(rows: DataFrame, path: str, samples: str, sentence: str) -> DataFrame:
    """Aligned lines for speech recognition: tsv, wrd and ltr."""
    return rows.select(F.concat_ws("\t", path, F.col(samples).cast("string")).alias("tsv"), F.col(sentence).alias("wrd"), text.letters(F.col(sentence)).alias("ltr"))


def collisions(rows: DataFrame, path: str, existing: DataFrame | None = None) -> DataFrame:
    """Output paths that more than one row would write, or that are among the `existing` ones: path, n (rows) and exists."""
    n = rows.groupBy(path).agg(F.count("*").alias("n"))
    if existing is None:
        return n.withColumn("exists", F.lit(False)).filter("n > 1")
    there = existing.select(F.col(path).alias("__there")).distinct()
    found = n.join(there, F.col(path) == F.col("__there"), "left")
    return found.select(path, "n", F.col("__there").isNotNull().alias("exists")).filter("n > 1 OR exists")


def numbered(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("seg_id", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)
