"""Programme metadata: file lookup, rerun detectors, their union, and the keep-list."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skjald.functions import paths
from skjald.operators import segments
from skjald.sources.shared import cut, sized


def mentions(text: Column, phrases: list[str], literal: bool = False, null_is_match: bool = False) -> Column:
    """True if the text holds one of the patterns; they are regular expressions unless `literal`."""
    found = reduce(or_, (F.contains(text, F.lit(p)) for p in phrases)) if literal else text.rlike("|".join(phrases))
    return F.coalesce(found, F.lit(null_is_match))


def catalogue(files: DataFrame, name: str, path: str, order: str) -> DataFrame:
    """One path for each file name: the last in `order`."""
    return files.groupBy(F.col(name).alias("filename")).agg(F.max_by(path, order).alias("file_path"))


def with_paths(rows: DataFrame, files: DataFrame, name: str = "filename") -> DataFrame:
    """Left lookup; rows without a file get a null path."""
    return rows.join(sized(files.withColumnRenamed("filename", "__name")), F.col(name) == F.col("__name"), "left").drop("__name")


def with_status(rows: DataFrame, status: DataFrame, key: str, flag: str, null_safe: bool = True) -> DataFrame:
    """Adds `flag`: whether the status table, with columns id and status, has `rerun` for the key.

    Keys that repeat on the right multiply rows; null keys match null keys if `null_safe`."""
    right = sized(status.select(F.col("id").alias("__id"), F.col("status").alias("__status")))
    same = F.col(key).eqNullSafe(F.col("__id")) if null_safe else F.col(key) == F.col("__id")
    return rows.join(right, same, "left").withColumn(flag, F.coalesce(F.col("__status") == "rerun", F.lit(False))).drop("__id", "__status")


def merge_flags(rows: DataFrame, name: str = "is_rerun") -> DataFrame:
    """True if any column whose name holds `rerun` is true."""
    flags = [F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in rows.columns if "rerun" in c]
    return rows.withColumn(name, reduce(or_, flags, F.lit(False)))


def keep_list(rows: DataFrame, flag: str = "is_rerun", path: str = "file_path", keep_nulls: bool = False) -> DataFrame:
    kept = rows.filter(~F.col(flag)).select(path)
    return kept if keep_nulls else kept.filter(F.col(path).isNotNull())


def listed(files: DataFrame, keep: DataFrame, path: str = "file_path") -> DataFrame:
    """The files whose base name is on the keep-list."""
    names = keep.select(paths.basename(F.col(path)).alias("__name")).distinct()
    return files.join(sized(names), paths.basename(F.col(path)) == F.col("__name"), "left_semi")


def pending(files: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return files.join(sized(done.select(key).distinct()), key, "left_anti")


#: The end of an audited name that may be missing in its key: any four characters, or a file's extension alone.
ANY_END, EXTENSION = r"(?s).{0,4}\z", r"\.[A-Za-z0-9]{3}\z"


def audit(wanted: DataFrame, done: DataFrame, path: str = "file_path", quarantine: DataFrame | None = None, end: str = ANY_END) -> DataFrame:
    """One row: all, processed and not processed, and the lines in `quarantine`, which are none of these. A line counts if it has a folder; its key is the name
    without .mp3, or without `end` as well. Any four characters are right for ids of one length (UUIDs) alone: of
    numbers, 12345 without them is 1, which may be another file."""
    lines = wanted.filter(F.size(F.split(path, "/")) >= 2).select(paths.basename(F.col(path)).alias("name"))
    key = F.when(F.contains("name", F.lit(".mp3")), F.expr("left(name, greatest(length(name) - 4, 0))")).otherwise(F.col("name"))
    keys = lines.withColumn("k1", key).withColumn("k2", F.regexp_replace("k1", end, ""))
    there = sized(done.select(F.col("name").alias("d")).distinct())
    found = keys.join(there.withColumnRenamed("d", "d1"), F.col("k1") == F.col("d1"), "left").join(there.withColumnRenamed("d", "d2"), F.col("k2") == F.col("d2"), "left")
    ready = F.col("d1").isNotNull() | F.col("d2").isNotNull()
    sums = found.agg(F.count("*").alias("n_all"), F.count_if(ready).alias("n_processed"), F.count_if(~ready).alias("n_pending"))
    return sums if quarantine is None else sums.join(F.broadcast(quarantine.agg(F.count("*").alias("n_quarantined"))))


#: Bytes of parts that one automaton holds.
PARTS = 8_000_000


def held_parts(texts: DataFrame, parts: DataFrame, text: str, part: str, order: str) -> DataFrame:
    """part, first_match (the least `order` of the texts that hold it) and n_matches, of the parts that a text holds.

    An automaton of all parts runs over each text once, whatever their number; tables of
    parts above PARTS bytes are taken in several runs. What is shuffled is a row for each batch
    of texts and part."""
    parts = cut(parts.select(F.col(part).alias("part")).dropna().distinct())
    kind = texts.schema[order].dataType.simpleString()
    runs = -(-int(parts.agg(F.coalesce(F.sum(F.octet_length("part") + 40), F.lit(0))).first()[0]) // PARTS)
    found = None
    for number in range(max(runs, 1)):
        sent = texts.sparkSession.sparkContext.broadcast(parts.filter(F.pmod(F.xxhash64("part"), F.lit(max(runs, 1))) == number).toArrow().column(0).to_pylist())
        some = texts.select(text, order).mapInArrow(_scan(sent), f"part string, first_match {kind}, n_matches long")
        found = some if found is None else found.union(some)
    return found.groupBy("part").agg(F.min("first_match").alias("first_match"), F.sum("n_matches").alias("n_matches"))


def _scan(sent: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for part in sent.value:
            if part:
                automaton.add_word(part, part)
        automaton.make_automaton()
        empty = "" in sent.value  # which every text holds
        for batch in batches:
            first: dict = {}
            n: Counter = Counter()
            for text, order in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text is None:
                    continue
                here = {part for _, part in automaton.iter(text)} if len(automaton) else set()
                if empty:
                    here.add("")
                for part in here:
                    n[part] += 1
                    if order is not None and (part not in first or order < first[part]):
                        first[part] = order
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([first.get(p) for p in n], batch.schema.field(1).type), pa.array(list(n.values()), pa.int64())], ["part", "first_match", "n_matches"])

    return run


def first_match(rows: DataFrame, texts: DataFrame, text: str, part: str, order: str) -> DataFrame:
    """For each row of `rows` (with column `part`), the first row of `texts` in `order` whose `text` holds it literally, and how many do.

    A part's words but the first and last are whole words of each text that holds it: the
    one of them that the fewest texts have finds the texts, and the part is then looked for
    in these. Parts of fewer than three words have no such word: held_parts() looks for all of them at once."""
    words_of = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))
    parts = rows.withColumn("__inner", words_of(F.array_join(F.slice(F.split(part, " "), F.lit(2), F.greatest(F.size(F.split(part, " ")) - 2, F.lit(0))), " ")))
    asked = parts.select(F.explode("__inner").alias("__word")).distinct()
    held = texts.select(F.explode(words_of(F.col(text))).alias("__word")).join(sized(asked), "__word", "left_semi").groupBy("__word").agg(F.count("*").alias("__n"))
    each = parts.filter(F.size("__inner") > 0).drop("__inner").distinct().withColumn("__word", F.explode(words_of(F.array_join(F.slice(F.split(part, " "), F.lit(2), F.size(F.split(part, " ")) - 2), " "))))
    rarest = each.join(sized(held), "__word").groupBy(*rows.columns).agg(F.min_by("__word", F.struct("__n", "__word")).alias("__word"))
    with_word = rows.join(rarest.select(F.col(part).alias("__part"), "__word").distinct(), F.col(part) == F.col("__part")).drop("__part")
    long = texts.withColumn("__word", F.explode(words_of(F.col(text)))).join(sized(with_word), "__word").filter(F.contains(F.col(text), F.col(part))).drop("__word")
    found = long.select(*rows.columns, order).groupBy(*rows.columns).agg(F.min(order).alias("first_match"), F.count("*").alias("n_matches"))
    short = parts.filter(F.size("__inner") == 0).drop("__inner").distinct()
    short = short.join(held_parts(texts, short, text, part, order).withColumnRenamed("part", "__part"), F.col(part) == F.col("__part")).drop("__part")
    return found.union(short.select(*rows.columns, "first_match", "n_matches"))


def only_months(files: DataFrame, month: str, months: list[str], exclude: bool = False) -> DataFrame:
    """The files of the months on the list, or of all others."""
    listed = F.col(month).isin(months)
    return files.filter(~listed if exclude else listed)


def without_rows(rows: DataFrame, number: str, bad: list[int]) -> DataFrame:
    """Drops rows by their number in the source, which is a column: rows of a table have no places."""
    return rows.filter(~F.col(number).isin(bad))


def zipped(left: DataFrame, right: DataFrame, number: str) -> DataFrame:
    """Columns of both tables side by side, by the number that both have for each row; what one lacks is null."""
    return left.join(right, number, "full")


def snippets(files: DataFrame, done: DataFrame, key: str, samples: str, start: int, end: int, rate: int = 16_000) -> DataFrame:
    """Samples from second `start` to `end` of each file, as far as it has them, but for the files that are in `done`."""
    return segments.snippet(pending(files, done, key), key, samples, start, end, rate)
