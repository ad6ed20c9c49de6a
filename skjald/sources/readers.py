"""Sources: listings, lists, tables and recordings as DataFrames."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skjald.functions import paths
from skjald.functions.resampling import resample
from skjald.sources.files import contents, walked
from skjald.sources.shared import batched, cut


def json_lines(spark: SparkSession, at: str | list[str], schema: StructType | str, nested: str | None = None) -> DataFrame:
    """JSON lines; the fields of the struct `nested` become columns before the others."""
    rows = spark.read.schema(schema).json(at)
    return rows.select(f"{nested}.*", *[c for c in rows.columns if c != nested]) if nested else rows


#: Keys that JSON objects may have together; each becomes a column.
KEYS = 10_000
SCALARS = ("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN", "STRING", "DATE", "TIMESTAMP", "DECIMAL")


def object_keys(values: DataFrame, value: str, most: int = KEYS) -> dict[str, str]:
    """The keys that the objects of the variant column `value` have anywhere, and the type of all that stands there, by one aggregate."""
    keyed = values.select(F.col(value).alias("v"), F.explode(F.json_object_keys(F.to_json(value))).alias("key"))
    held = F.try_variant_get("v", F.concat(F.lit("$['"), "key", F.lit("']")), "variant")
    found = keyed.groupBy("key").agg(F.schema_of_variant_agg(held).alias("kind")).orderBy("key").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"the objects have more than {most} keys")
    return {row.key: row.kind for row in found}


def key_columns(value: str, kinds: dict[str, str]) -> list[Column]:
    """A column for each key: of its type if that is a scalar one, else JSON text; null where an object lacks it."""
    columns = []
    for key, kind in kinds.items():
        path = f"$['{key}']"
        scalar = kind.startswith(SCALARS)
        held = F.try_variant_get(value, F.lit(path), kind if scalar else "variant")
        columns.append((held if scalar else F.to_json(held)).alias(key))
    return columns


def json_objects(spark: SparkSession, at: str | list[str], nested: str | None = None) -> DataFrame:
    """JSON lines whose keys aren't known before: the union of all files' keys as columns.

    The keys of the object `nested` become columns before the others. Lines that are no
    object have no row; keys that stand on both levels are an error, as one would hide the other."""
    rows = spark.read.text(at).select(F.try_parse_json("value").alias("__line")).filter("schema_of_variant(__line) LIKE 'OBJECT%'")
    outer = object_keys(rows, "__line")
    if nested is None:
        return rows.select(key_columns("__line", outer))
    outer.pop(nested, None)
    rows = rows.withColumn("__nested", F.try_variant_get("__line", F.lit(f"$['{nested}']"), "variant"))
    inner = object_keys(rows.filter("schema_of_variant(__nested) LIKE 'OBJECT%'"), "__nested")
    if both := sorted(set(inner) & set(outer)):
        raise ValueError(f"keys on both levels: {', '.join(both)}")
    return rows.select(*key_columns("__nested", inner), *key_columns("__line", outer))


def checked(spark: SparkSession, at: str, schema: str, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """Rows of delimited lines without names that fit the schema, and the quarantine: file, line and reason of the others."""
    names = [field.name for field in StructType.fromDDL(schema)]
    read = spark.read.schema(f"{schema}, __line string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__line").csv(at, sep=sep)
    # The reader can't give its column of bad lines alone: what it found is kept once for both tables.
    rows = cut(read.select(*names, "__line", F.col("_metadata.file_path").alias("__file")))
    parts = F.size(F.split("__line", F.lit(f"\\Q{sep}\\E"), -1))
    reason = F.when(parts != len(names), F.concat(parts.cast("string"), F.lit(f" fields of {len(names)}"))).otherwise("a field of another type")
    bad = rows.filter("__line IS NOT NULL").select(F.col("__file").alias("file"), F.col("__line").alias("line"), reason.alias("reason"))
    return rows.filter("__line IS NULL").select(*names), bad


def status(spark: SparkSession, at: str, skip_first: bool = False) -> DataFrame:
    """Tab-separated id and status without names; the first line is left out on request."""
    return spark.read.csv(at, sep="\t", header=skip_first, schema="id string, status string", enforceSchema=True)


def delimited(spark: SparkSession, at: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    return spark.read.csv(at, sep=sep, header=True, schema=schema)


def lines(spark: SparkSession, at: str) -> DataFrame:
    """One row a line; an empty last line isn't a row."""
    return spark.read.text(at)


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, filename and folder of all files under `root`; contents aren't read."""
    files = walked(spark, root, pattern)
    if files is None:  # a store, or a pattern, that is Spark's alone
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", paths.basename(F.col("path")).alias("filename"), paths.parent(F.col("path")).alias("folder"))


def recordings(spark: SparkSession, root: str, decode: Callable[[bytes], tuple[int, bytes]], pattern: str = "*.wav") -> DataFrame:
    """path, rate, n_samples and samples (signed 16-bit, mono) of files; `decode` gives rate and samples of one."""
    return decoded(contents(spark, root, pattern), decode)


def decoded(files: DataFrame, decode: Callable[[bytes], tuple[int, bytes]]) -> DataFrame:
    """The same of a table of path and content."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rate, samples = decode(content.as_py())
            yield path.as_py(), rate, len(samples) // 2, samples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from batched(rows(batch), pa.schema([("path", pa.string()), ("rate", pa.int32()), ("n_samples", pa.int64()), ("samples", pa.binary())]))

    return files.select("path", "content").mapInArrow(run, "path string, rate int, n_samples long, samples binary")


def wav(content: bytes) -> tuple[int, bytes]:
    """Rate and signed 16-bit samples of a WAV file of 8, 16, 24 or 32 bits; channels are averaged."""
    with wave.open(io.BytesIO(content)) as file:
        channels, size, rate, raw = file.getnchannels(), file.getsampwidth(), file.getframerate(), file.readframes(file.getnframes())
    if (channels, size) == (1, 2):
        return rate, raw
    if size == 1:
        values = (np.frombuffer(raw, np.uint8).astype(np.int64) - 128) << 8
    elif size == 2:
        values = np.frombuffer(raw, "<i2").astype(np.int64)
    else:  # the upper two bytes of each sample
        values = np.frombuffer(raw, np.uint8).reshape(-1, size)[:, -2:].copy().view("<i2").ravel().astype(np.int64)
    mono = np.rint(values.reshape(-1, channels).mean(1)).astype("<i2")
    return rate, mono.tobytes()


def speech(content: bytes, rate: int = 16_000) -> tuple[int, bytes]:
    """A WAV file's samples at 16 kHz, by a filter that keeps what the new rate can hold."""
    old, raw = wav(content)
    if old == rate:
        return old, raw
    y = resample(np.frombuffer(raw, "<i2"), old, rate)
    return rate, np.clip(np.rint(y), -32768, 32767).astype("<i2").tobytes()


def utf8(content: Column) -> Column:
    """Bytes as text."""
    return F.decode(content, "utf-8")


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def stack(*tables: DataFrame) -> DataFrame:
    """All rows by column names; columns that a table lacks are null."""
    first, *others = tables
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
