"""The folder that driver and executors share, for tables between two steps."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a catalogue or status table up to which it is broadcast.
BROADCAST_ROWS = 100_000
#: Bytes of files or samples that a task gives back at a time, unless one row has more.
BATCH_BYTES = 4_000_000


def batched(rows: Iterator[tuple], schema: pa.Schema, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows, whose last value is bytes, in batches of some `most` of them: a task holds one at a time, whatever it reads."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= (most or BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a side of a join for broadcast if its counted rows are few."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shared_root(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; one of its own only in local mode, where nothing needs sharing."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir")
    if not found and not conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return found or "file:///tmp/checkpoints/skjald"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table that was written to the shared folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def made(spark: SparkSession, path: str) -> str:
    """The folder, which is there from now on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    return path


def cut(df: DataFrame) -> DataFrame:
    """`df` with its lineage cut by a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()
