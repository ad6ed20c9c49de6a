"""A fingerprint index that grows: songs by the digest of their content, hashes in buckets.

Two tables stand in one folder. `fingerprints` (hash, song_id, offset) is partitioned by
batch and bucketed by hash: a search joins it as it lies, and only the query's hashes are
shuffled. `songs` has a row for each song: song_id (the digest of its content), song_name,
fingerprinted, file_sha1, total_hashes, date_created and date_modified, also by batch.

add() leaves out songs whose content is in the index. It writes the hashes first and the
songs last, both by replacing the one partition of their batch, whose name follows from
the songs that it adds. Hashes are read only of batches that songs names; so a run that
ends between the two writes has added nothing, and the next one removes what it left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skjald.operators import fingerprints
from skjald.sources.shared import cut, made, remove, sized

#: Buckets of the hashes: a search has as many tasks at least. Choose some 100 MB of hashes a bucket.
BUCKETS = 64
SONGS = "song_id STRING, song_name STRING, fingerprinted BOOLEAN, file_sha1 STRING, total_hashes BIGINT, date_created TIMESTAMP, date_modified TIMESTAMP, batch STRING"
HASHES = "hash BIGINT, song_id STRING, `offset` INT, batch STRING"


class SongIndex:
    """The index in the folder `at`; it is made if it isn't there."""

    def __init__(self, spark: SparkSession, at: str, buckets: int = BUCKETS):
        self.spark, self.at = spark, at
        name = uuid.uuid4().hex
        self.songs_name, self.hashes_name = f"songs_{name}", f"hashes_{name}"
        spark.sql(f"CREATE TABLE {self.songs_name} ({SONGS}) USING parquet OPTIONS ('partitionOverwriteMode' 'dynamic') PARTITIONED BY (batch) LOCATION '{made(spark, at + '/songs')}'")
        spark.sql(f"CREATE TABLE {self.hashes_name} ({HASHES}) USING parquet OPTIONS ('partitionOverwriteMode' 'dynamic') PARTITIONED BY (batch) CLUSTERED BY (hash) SORTED BY (hash) INTO {buckets} BUCKETS LOCATION '{made(spark, at + '/fingerprints')}'")
        self.buckets = buckets
        for table in (self.songs_name, self.hashes_name):
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")

    def songs(self) -> DataFrame:
        return self.spark.table(self.songs_name)

    def _batches(self, table: str) -> set[str]:
        return {row[0].removeprefix("batch=") for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}

    def fingerprints(self) -> DataFrame:
        """hash, song_id and offset of all songs of the index."""
        known = sorted(self._batches(self.songs_name))
        return self.spark.table(self.hashes_name).filter(F.col("batch").isin(known)).drop("batch")

    def repair(self) -> set[str]:
        """Removes hashes of batches that no songs were written for; their names."""
        left = self._batches(self.hashes_name) - self._batches(self.songs_name)
        for batch in left:
            self.spark.sql(f"ALTER TABLE {self.hashes_name} DROP PARTITION (batch = '{batch}')")
            remove(self.spark, f"{self.at}/fingerprints/batch={batch}")
        return left

    def new_songs(self, songs: DataFrame, name: str, content: str | Column) -> DataFrame:
        """file_sha1, song_name and `tokens` of the songs whose content the index lacks; of equal ones the least name."""
        tokens = F.col(content) if isinstance(content, str) else content
        rows = songs.select(F.sha1(F.to_json(tokens)).alias("file_sha1"), F.col(name).cast("string").alias("song_name"), tokens.alias("tokens")).filter("tokens IS NOT NULL")
        rows = rows.join(sized(self.songs().filter("fingerprinted").select("file_sha1")), "file_sha1", "left_anti")
        once = rows.groupBy("file_sha1").agg(F.min_by(F.struct("song_name", "tokens"), "song_name").alias("x"))
        return once.select("file_sha1", "x.song_name", "x.tokens")

    def write_hashes(self, rows: DataFrame, batch: str) -> None:
        placed = rows.select("hash", "song_id", "offset", F.lit(batch).alias("batch")).repartition(self.buckets, "hash")
        placed.write.mode("overwrite").insertInto(self.hashes_name)

    def write_songs(self, rows: DataFrame, batch: str) -> None:
        now = F.current_timestamp()
        rows = rows.select("song_id", "song_name", F.lit(True), "file_sha1", "total_hashes", now, now, F.lit(batch))
        rows.write.mode("overwrite").insertInto(self.songs_name)

    def add(self, songs: DataFrame, name: str, content: str | Column, size: int = 3) -> int:
        """Adds the songs whose content (an array of tokens) isn't in the index; their number."""
        self.repair()
        new = cut(self.new_songs(songs, name, content))
        n, digest = new.agg(F.count("*"), F.bit_xor(F.xxhash64("file_sha1"))).first()
        if not n:
            return 0
        batch = f"{n}-{digest & (1 << 64) - 1:016x}"
        keyed = new.withColumn("song_id", F.col("file_sha1"))
        self.write_hashes(fingerprints.index(keyed, "song_id", "tokens", size), batch)
        total = F.greatest(F.size("tokens") - size + 1, F.lit(0)).cast("long")
        self.write_songs(keyed.withColumn("total_hashes", total), batch)
        return n

    def match(self, query: DataFrame, confidence: float = 0.0) -> DataFrame:
        """match() of query hashes (song_id, hash, offset) within the index."""
        return fingerprints.match(query, self.fingerprints(), confidence)

    def forget(self) -> None:
        """Takes the tables out of the session's catalogue; their folders stay."""
        for table in (self.songs_name, self.hashes_name):
            self.spark.sql(f"DROP TABLE {table}")
