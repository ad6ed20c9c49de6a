"""Sinks: manifests, keep-lists, aligned triples, recordings and the fingerprint index."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skjald.sources.files import write_files
from skjald.sources.shared import batched


def delimited(rows: DataFrame, to: str, sep: str = ",", header: bool = True) -> None:
    rows.write.option("header", header).option("sep", sep).csv(to)


def segment_tables(lines: DataFrame, to: str, key: str) -> None:
    """A folder for each file, with a line for each of its segments, in the order of their numbers where `lines` has seg_id beside key and line."""
    order = [c for c in ("seg_id", "line") if c in lines.columns]
    lines.repartition(key).sortWithinPartitions(key, *order).select(key, "line").write.partitionBy(key).text(to)


def manifest(lines: DataFrame, to: str, root: str) -> None:
    """Text files whose names are in the order of their lines: the root, then all lines in order."""
    head = lines.sparkSession.createDataFrame([(0, root)], "o int, value string")
    rows = head.unionByName(lines.select(F.lit(1).alias("o"), F.col(lines.columns[0]).alias("value")))
    rows.repartitionByRange("o", "value").sortWithinPartitions("o", "value").select("value").write.text(to)


def triples(rows: DataFrame, to: str) -> None:
    """tsv, wrd and ltr lines in one order, that of tsv: folders kind=tsv and so on, whose files have the same cuts.

    One job writes all three: each task its rows' lines, kind by kind."""
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("line")) for k in ("tsv", "wrd", "ltr")))).alias("x")
    placed = rows.repartitionByRange("tsv", "wrd", "ltr").select("tsv", "wrd", "ltr", kinds).select("tsv", "wrd", "ltr", "x.kind", "x.line")
    placed.sortWithinPartitions("kind", "tsv", "wrd", "ltr").select("kind", "line").write.partitionBy("kind").text(to)


def wav_files(segments: DataFrame, rate: int = 16_000) -> DataFrame:
    """path and content (WAV bytes) of segments with path and samples (signed 16-bit)."""

    def wav(samples: bytes) -> bytes:
        out = io.BytesIO()
        with wave.open(out, "wb") as file:
            file.setnchannels(1)
            file.setsampwidth(2)
            file.setframerate(rate)
            file.writeframes(samples)
        return out.getvalue()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((path.as_py(), wav(samples.as_py())) for path, samples in zip(batch.column(0), batch.column(1), strict=True))
            yield from batched(rows, pa.schema([("path", pa.string()), ("content", pa.binary())]))

    return segments.select("path", "samples").mapInArrow(run, "path string, content binary")


def audio_files(segments: DataFrame, to: str, rate: int = 16_000, overwrite: bool = False) -> None:
    """A WAV file below `to` for each segment, at its path; none is seen before all are written."""
    write_files(wav_files(segments, rate), to, overwrite)


def index(rows: DataFrame, to: str, by: list[str]) -> None:
    """A fingerprint index in folders such as channel and year, sorted by hash for pruning; folders of `rows` are replaced, others stay."""
    rows.repartition(*by, F.pmod(F.hash("hash"), F.lit(64))).sortWithinPartitions("hash").write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(to)
