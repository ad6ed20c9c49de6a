"""Error rates of transcripts, and summaries of corpora."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skjald.functions import edits, paths
from skjald.sources.shared import sized


UNITS = ("char", "word")
COUNTS = ("substitutions", "insertions", "deletions", "length")


def edit_counts(rows: DataFrame, reference: Column, other: Column, by: list[str]) -> DataFrame:
    """Of each row, and for characters and words: the edits that make the reference into the other text, apart, and the reference's length."""
    kinds = [rows.schema[c].dataType.simpleString() for c in by]
    names = [f"{unit}_{count}" for unit in UNITS for count in COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b in zip(batch.column(len(by)).to_pylist(), batch.column(len(by) + 1).to_pylist(), strict=True):
                row = []
                for x, y in ((a, b), ([w for w in a.split(" ") if w], [w for w in b.split(" ") if w])):
                    row += [*(edits.counts(x, y) if x != y else (0, 0, 0)), len(x)]
                found.append(row)
            columns = [pa.array([row[k] for row in found], pa.int64()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(by)], *columns], [*by, *names])

    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in zip(by, kinds, strict=True)), *(f"{n} long" for n in names)])
    texts = [F.coalesce(reference, F.lit("")).alias("__reference"), F.coalesce(other, F.lit("")).alias("__other")]
    return rows.select(*by, *texts).mapInArrow(run, schema)


def error_rates(rows: DataFrame, reference: Column, other: Column, by: list[str], apart: bool = False) -> DataFrame:
    """Character and word error rates of each group, all edits over the references' length; `apart` adds the kinds of edits."""
    names = [f"{unit}_{count}" for unit in UNITS for count in COUNTS]
    sums = edit_counts(rows, reference, other, by).groupBy(*by).agg(*(F.sum(n).alias(n) for n in names))
    all_edits = lambda unit: sum((F.col(f"{unit}_{count}") for count in COUNTS[:3]), F.lit(0))
    rate = lambda unit: F.when(F.col(f"{unit}_length") > 0, all_edits(unit) / F.col(f"{unit}_length"))
    return sums.select(*by, rate("char").alias("cer"), rate("word").alias("wer"), *(names if apart else []))


def grid(*dimensions: DataFrame) -> DataFrame:
    """All combinations of small tables, such as models and data sets; each side is sent only if its counted rows are few."""
    first, *others = dimensions
    for other in others:
        first = first.crossJoin(sized(other))
    return first


def speaker(pair: Column, interlocutor: Column) -> Column:
    """One name for a speaker: the pair and the place in it."""
    return F.concat(pair.cast("string"), interlocutor)


def labelled_rows(rows: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Columns that name rows, under other names."""
    return rows.withColumnsRenamed(labels)


def report(rows: DataFrame, flag: str) -> DataFrame:
    """What a report on a flag prints: rows, those that have it, and their share in per cent."""
    n = F.count_if(F.col(flag))
    return rows.agg(F.count("*").alias("n"), n.alias("n_flagged"), (100 * n / F.count("*")).alias("per_cent"))


def flattened(rows: DataFrame, key: str, metrics: str) -> DataFrame:
    """A row for each entry of a map of metrics."""
    return rows.select(key, F.explode(metrics).alias("metric", "value"))


def corpus_summary(rows: DataFrame, by: str, speaker: Column, seconds: Column) -> DataFrame:
    """Sentences, speakers and hours of each group."""
    return rows.groupBy(by).agg(F.count("*").alias("sentences"), F.count_distinct(speaker).alias("speakers"), paths.half_even(F.sum(seconds) / 3600).alias("hours"))


def hours_of_units(units: Column, seconds_each: int = 120) -> Column:
    return F.floor(units * seconds_each / 3600).cast("long")


def latex(rows: DataFrame, digits: int = 2) -> str:
    """A small result as a LaTeX table; null is NA."""
    shown = lambda v: "NA" if v is None else f"{v:.{digits}f}" if isinstance(v, float) else str(v)
    lines = [" & ".join(rows.columns), *(" & ".join(map(shown, row)) for row in rows.collect())]
    head, *body = [line + r" \\" for line in lines]
    return "\n".join([r"\begin{tabular}{" + "l" * len(rows.columns) + "}", r"\toprule", head, r"\midrule", *body, r"\bottomrule", r"\end{tabular}"])
