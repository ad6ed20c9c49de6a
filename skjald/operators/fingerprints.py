"""Fingerprint index and offset-aligned matching."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skjald.sources.shared import cut, sized


def hashes(tokens: Column, size: int = 3, digest: Callable[[Column], Column] = F.xxhash64) -> Column:
    """The hash of each run of `size` tokens of an array, in order."""
    n = F.size(tokens) - size + 1
    # The shifted arrays are arguments, not captured by the lambda, so that each is made once a row.
    shifted = [F.slice(tokens, F.lit(k + 1), F.greatest(n, F.lit(0))) for k in range(size)]
    return F.transform(F.arrays_zip(*shifted), lambda z: digest(F.concat_ws(" ", *(z.getField(str(k)) for k in range(size)))))


def index(songs: DataFrame, key: str, tokens: str | Column, size: int = 3, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """song_id, hash and offset of each run of `size` tokens of an array."""
    return songs.filter(F.size(tokens) >= size).select(F.col(key).alias("song_id"), F.posexplode(hashes(tokens, size, digest)).alias("offset", "hash"))


def hash_totals(songs: DataFrame, key: str, tokens: str | Column, size: int = 3, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """query_id and total (its distinct hashes) of each song that index() has hashes of.

    Hashes are counted within their row and not shuffled, but for keys of several rows,
    whose hashes are counted together."""
    rows = songs.filter(F.size(tokens) >= size)
    several = rows.groupBy(F.col(key).alias("query_id")).agg(F.count("*").alias("__rows")).filter("__rows > 1 AND query_id IS NOT NULL").select("query_id")
    once = lambda some: some.select(F.col(key).alias("query_id"), F.size(F.array_distinct(hashes(tokens, size, digest))).cast("long").alias("total"))
    if several.isEmpty():
        return once(rows)
    several = sized(cut(several))
    those = index(rows.join(several, F.col(key) == F.col("query_id"), "left_semi"), key, tokens, size, digest)
    return once(rows.join(several, F.col(key) == F.col("query_id"), "left_anti")).unionByName(asked_hashes(those)[1])


def asked_hashes(query: DataFrame) -> tuple[DataFrame, DataFrame]:
    """query_id, hash and at (its first place) of each query's distinct hashes, and query_id and total."""
    asked = query.groupBy(F.col("song_id").alias("query_id"), "hash").agg(F.min("offset").alias("at"))
    return asked, asked.groupBy("query_id").agg(F.count("*").alias("total"))


def candidates(asked: DataFrame, totals: DataFrame, indexed: DataFrame, confidence: float, song: list[str]) -> DataFrame:
    """query_id, `song` and shift of all places at which a query may reach `confidence`.

    So many of a query's `total` hashes must agree that one at least is among any total -
    need + 1 of them: only that many of its rarest ones in the index are looked up. The rarest
    are those that the index lacks, which `asked` may lack too: of the `held` others,
    held - need + 1 are left. Hashes that all songs share are looked up by queries alone
    that have next to nothing else."""
    often = indexed.groupBy("hash").agg(F.count("*").alias("often"))
    need = F.greatest(F.ceil(F.lit(confidence) * F.col("total") - 1e-9), F.lit(1))
    within = Window.partitionBy("query_id")
    ranked = asked.join(often, "hash").join(totals, "query_id").withColumn("place", F.row_number().over(within.orderBy("often", "hash"))).withColumn("held", F.count("*").over(within))
    rare = ranked.filter(F.col("place") <= F.col("held") - need + 1)
    return rare.select("query_id", "hash", "at").join(indexed, "hash").select("query_id", *song, (F.col("offset") - F.col("at")).alias("shift")).distinct()


def aligned(query: DataFrame, indexed: DataFrame, confidence: float, song: list[str], totals: DataFrame | None = None) -> DataFrame:
    """query_id, `song`, aligned, confidence and rank within the query (and the other columns of `song`).

    Only hashes that the index has are gathered by query: the others count in `totals` alone."""
    totals = asked_hashes(query)[1] if totals is None else totals
    asked = asked_hashes(query.join(indexed.select("hash"), "hash", "left_semi"))[0]
    shift = (F.col("offset") - F.col("at")).alias("shift")
    if confidence > 0:
        asked = cut(asked)
        found = cut(candidates(asked, totals, indexed, confidence, song))
        wanted = found.join(asked, "query_id").select("query_id", *song, "shift", "hash", (F.col("at") + F.col("shift")).alias("offset"))
        there = indexed.join(sized(found.select(*song).distinct()), song, "left_semi")
        votes = wanted.join(there, [*song, "hash", "offset"])
    else:  # any vote counts, so that all are looked up
        votes = asked.join(indexed, "hash").select("query_id", *song, shift)
    votes = votes.groupBy("query_id", *song, "shift").agg(F.count("*").alias("n"))
    best = votes.groupBy("query_id", *song).agg(F.max("n").alias("aligned")).join(totals, "query_id").withColumn("confidence", F.col("aligned") / F.col("total"))
    order = Window.partitionBy("query_id", *song[:-1]).orderBy(F.desc("aligned"), song[-1])
    return best.filter(F.col("confidence") >= confidence).withColumn("rank", F.row_number().over(order)).select("query_id", *song, "aligned", "confidence", "rank")


def match(query: DataFrame, indexed: DataFrame, confidence: float = 0.0, totals: DataFrame | None = None) -> DataFrame:
    """query_id, song_id, aligned, confidence and rank of songs whose hashes agree with a query's at one shift.

    A song's votes are the query's distinct hashes at its best shift, and its confidence their share
    of all of the query's hashes. Repeats of a hash within a query count once; a query, song and
    shift fix the offset of each hash, so that rows are votes. With a least confidence above
    0, votes are counted for candidates() alone. `totals` are the query's hash_totals(), where its
    songs are at hand; without them all of its hashes are shuffled to be counted."""
    return aligned(query, indexed, confidence, ["song_id"], totals)


def index_names(asked: DataFrame, names: DataFrame) -> DataFrame:
    """channel, year and name: the index whose name has the channel, an underscore and, somewhere after, the year.

    `asked` has channel and year, `names` the column name. It is an error if several names fit;
    what has no index has no row."""
    pattern = F.concat(F.col("channel"), F.lit("_.*"), F.col("year").cast("string"))
    rows = asked.select("channel", "year").distinct()
    found = rows.join(sized(names.select("name").distinct()), F.regexp_like("name", pattern)).groupBy("channel", "year").agg(F.collect_set("name").alias("fit"))
    several = F.raise_error(F.concat(F.lit("several indexes fit "), "channel", F.lit(" "), F.col("year").cast("string"))).cast("string")
    return found.select("channel", "year", F.when(F.size("fit") == 1, F.element_at("fit", 1)).otherwise(several).alias("name"))


def match_indexes(query: DataFrame, indexes: DataFrame, names: DataFrame, confidence: float = 0.0, totals: DataFrame | None = None) -> DataFrame:
    """match() in each of the named indexes apart: adds the column name, within which ranks count.

    `indexes` is the table of all of them, with name, song_id, hash and offset: a search over many
    indexes is one join, not a loop, and folders by name prune those that aren't asked for."""
    chosen = indexes.join(sized(names.select("name").distinct()), "name", "left_semi")
    return aligned(query, chosen, confidence, ["name", "song_id"], totals)


def listed(matches: DataFrame, *by: str) -> DataFrame:
    """Per query, and `by`, the matched songs and their confidences, by rank."""
    rows = F.array_sort(F.collect_list(F.struct("rank", "song_id", "confidence")))
    return matches.groupBy("query_id", *by).agg(rows.alias("r")).select("query_id", *by, F.col("r.song_id").alias("matched"), F.col("r.confidence").alias("confidences"))


def find_duplicates(rows: DataFrame, key: str, query: DataFrame, indexes: DataFrame, names: list[str], totals: DataFrame | None = None) -> DataFrame:
    """The rows with matched_files_, confidences_ and error_ of each index: what it has that matches, best first.

    The error is that the row has no fingerprint in `query`. Columns come together by the rows' key, not by their places."""
    spark = rows.sparkSession
    found = listed(match_indexes(query, indexes, spark.createDataFrame([(n,) for n in names], "name string"), totals=totals), "name")
    wide = found.groupBy("query_id").pivot("name", names).agg(F.first("matched").alias("matched"), F.first("confidences").alias("confidences"))
    known = (query.select("song_id") if totals is None else totals.select("query_id")).toDF("__known").distinct()
    out = rows.join(known, rows[key] == F.col("__known"), "left").join(wide, rows[key] == F.col("query_id"), "left")
    columns = []
    for name in names:
        matched, confidences = F.col(f"`{name}_matched`"), F.col(f"`{name}_confidences`")
        columns += [F.coalesce(matched, F.array().cast(out.schema[f"{name}_matched"].dataType)).alias(f"matched_files_{name}"), F.coalesce(confidences, F.array().cast("array<double>")).alias(f"confidences_{name}"), F.col("__known").isNull().alias(f"error_{name}")]
    return out.select(*(rows[c] for c in rows.columns), *columns)


def duplicates(matches: DataFrame, least: float = 0.5) -> DataFrame:
    """Queries that have a confident match other than themselves."""
    return matches.filter("query_id != song_id").groupBy("query_id").agg(F.max("confidence").alias("best")).withColumn("is_duplicate", F.col("best") >= least)
