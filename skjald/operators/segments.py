"""Segmentation of recordings: tiles, frames, voice activity, custom segments, lengths."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skjald.functions import draws
from skjald.sources.shared import cut, sized

# Samples a second, of a window and from window to window, and shares of the threshold.
RATE, WINDOW, STEP = 16_000, 4_000, 200
SHARE, ABOVE = 0.89, 0.08
#: Values of a file that are sorted where they meet, and bins of a pass over more.
FEW, BINS = 20_000, 4_096
#: Means that are nearer to a level than this are equal to it, in whatever order they were summed.
NEAR = 1e-12


def tiles(files: DataFrame, key: str, samples: str, seed: str, shortest: int = 48_000, longest: int = 240_000, crop: int = 60 * RATE) -> DataFrame:
    """Random tiles of each file, cropped at both ends: key, seg_id, start_sample and end_sample within the crop.

    Tiling stops at the first tile that would overrun. A tile's length depends on seed, key and place alone."""
    n = F.greatest(F.col(samples) - 2 * crop, F.lit(0))
    most = F.floor(F.col("__n") / shortest)
    rows = files.select(key, n.alias("__n")).filter(most > 0).withColumn("seg_id", F.explode(F.sequence(F.lit(0).cast("long"), most - 1)))
    rows = rows.withColumn("__len", draws.whole_number(seed, shortest, longest, F.col(key), F.col("seg_id")))
    rows = rows.withColumn("end_sample", F.sum("__len").over(Window.partitionBy(key).orderBy("seg_id")))
    return rows.filter("end_sample <= __n").select(key, "seg_id", (F.col("end_sample") - F.col("__len")).alias("start_sample"), "end_sample")


def frames(files: DataFrame, key: str, samples: str, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """A row for each frame: its number, start, end, and the zeros that pad it."""
    rows = files.filter(F.col(samples) > 0).select(key, F.col(samples).alias("n"), F.posexplode(F.sequence(F.lit(0).cast("long"), F.col(samples).cast("long") - 1, F.lit(step).cast("long"))).alias("i", "start_sample"))
    stop = F.col("start_sample") + window
    return rows.select(key, "i", "start_sample", F.least(stop, F.col("n").cast("long")).alias("end_sample"), F.greatest(stop - F.col("n"), F.lit(0)).cast("long").alias("pad"))


def smoothed(probs: DataFrame, key: str = "file_id", back: int = WINDOW // STEP) -> DataFrame:
    """Adds `sp`, the largest of the last `back` probabilities of the file, this one included."""
    return probs.withColumn("sp", F.max("p").over(Window.partitionBy(key).orderBy("i").rowsBetween(1 - back, 0)))


def _between(rows: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """The rows whose value `v` is within their key's range, with the range and the rank that is looked for."""
    return rows.join(sized(ranges), key).filter("v BETWEEN lo AND hi")


def _narrowed(rows: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """One pass: counts in BINS bins of each range; the bin that holds the rank is the new range, from its least to its greatest value."""
    width = F.col("hi") / 2 - F.col("lo") / 2  # halves, so that no difference overflows
    share = F.when(width > 0, (F.col("v") / 2 - F.col("lo") / 2) / width).otherwise(0.0)
    bins = _between(rows, ranges, key).groupBy(key, "rank", F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.count("*").alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    before = F.sum("m").over(Window.partitionBy(key).orderBy("bin")) - F.col("m")
    held = bins.withColumn("before", before).filter("before <= rank AND rank < before + m")
    return cut(held.select(key, "lo", "hi", (F.col("rank") - F.col("before")).alias("rank"), "m"))


def middle_values(probs: DataFrame, key: str, value: str, few: int = FEW) -> DataFrame:
    """key, lower and upper: both values in the middle of each key's values, which are one if their number is odd. Nulls don't count.

    Up to `few` values of a key are sorted where they meet. For more, the range that holds the
    middle is narrowed by passes that count values in bins, until it has one value or few
    enough are left: partial sums are all that is shuffled, and no buffer grows with a file."""
    rows = probs.select(key, F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    ranges = cut(rows.groupBy(key).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("m")).withColumn("n", F.col("m")))
    if (ranges.agg(F.max("n")).first()[0] or 0) <= few:
        vs = rows.groupBy(key).agg(F.sort_array(F.collect_list("v")).alias("vs"))
        at = lambda k: F.get("vs", F.expr(f"(size(vs) - {k}) div 2").cast("int"))
        return vs.select(key, at(1).alias("lower"), at(0).alias("upper"))
    sizes = ranges.select(key, "n")
    open_ranges, settled = ranges.withColumn("rank", F.expr("(n - 1) div 2")).select(key, "lo", "hi", "rank", "m"), []
    while True:
        done = (F.col("lo") == F.col("hi")) | (F.col("m") <= few)
        settled.append(open_ranges.filter(done))
        open_ranges = open_ranges.filter(~done)
        if open_ranges.isEmpty():
            break
        open_ranges = _narrowed(rows, open_ranges, key)
    found = reduce(DataFrame.union, settled)
    one = found.filter("lo = hi").select(key, F.col("lo").alias("lower"))
    some = _between(rows, found.filter("lo < hi"), key).groupBy(key).agg(F.sort_array(F.collect_list("v")).alias("vs"), F.first("rank").alias("rank"))
    lower = cut(one.union(some.select(key, F.get("vs", F.col("rank").cast("int")))))
    above = F.min(F.when(F.col("v") > F.col("lower"), F.col("v"))).alias("above")
    around = rows.join(sized(lower), key).groupBy(key, "lower").agg(F.count_if(F.col("v") <= F.col("lower")).alias("upto"), above).join(sized(sizes), key)
    upper = F.when((F.col("n") % 2 == 1) | (F.col("upto") > F.expr("n div 2")), F.col("lower")).otherwise(F.col("above"))
    return around.select(key, "lower", upper.alias("upper"))


def thresholds(probs: DataFrame, key: str = "file_id") -> DataFrame:
    """By file, from the lower median of its probabilities."""
    last = probs.groupBy(key).agg(F.max("i").alias("last"))
    middle = middle_values(probs, key, "p").select(key, (F.lit(SHARE) * F.col("lower") + F.lit(ABOVE)).alias("thr"))
    return last.join(middle, key).select(key, "thr", "last")


def voice_segments(probs: DataFrame, key: str = "file_id", step: int = STEP, back: int = WINDOW // STEP, bridge: int = 15, shortest: int = 10_000) -> DataFrame:
    """Islands of smoothed probability at or over the threshold: key, seg_id, start, end, n (samples of the file).

    `probs` has key, i (frame number) and p. More than `bridge` low frames close an island; it
    starts `back` frames before its first one. Islands that are no longer than `shortest` go,
    unless they are open at the end of the file, which then is their end."""
    rows = smoothed(probs, key, back).join(thresholds(probs, key), key).filter("sp >= thr")
    order = Window.partitionBy(key).orderBy("i")
    rows = rows.withColumn("__new", F.coalesce(F.col("i") - F.lag("i").over(order) > bridge + 1, F.lit(True)).cast("int")).withColumn("__island", F.sum("__new").over(order))
    found = rows.groupBy(key, "__island", "last").agg(F.min("i").alias("a"), F.max("i").alias("b"))
    is_open, n = F.col("last") - F.col("b") < bridge + 1, (F.col("last") + 1) * step
    found = found.select(key, (F.lit(step) * F.greatest(F.lit(0), F.col("a") - back)).cast("long").alias("start"), F.when(is_open, n).otherwise(step * (F.col("b") + 1)).cast("long").alias("end"), n.cast("long").alias("n"), is_open.alias("is_open"))
    kept = found.filter(F.col("is_open") | (F.col("end") - F.col("start") > shortest))
    return kept.withColumn("seg_id", F.row_number().over(Window.partitionBy(key).orderBy("start")) - 1).select(key, "seg_id", "start", "end", "n")


def padded(segments: DataFrame, key: str = "file_id", pad: int = 2_000) -> DataFrame:
    """Segments widened by `pad`; where the gap is below twice that, both sides meet in its middle."""
    order = Window.partitionBy(key).orderBy("seg_id")
    before, after = F.col("start") - F.lag("end").over(order), F.lead("start").over(order) - F.col("end")
    start = F.when(before.isNull(), F.col("start") - pad).when(before < 2 * pad, F.col("start") - F.floor(before / 2)).otherwise(F.col("start"))
    end = F.when(after.isNull(), F.least(F.col("n"), F.col("end") + pad)).when(after < 2 * pad, F.col("end") + F.floor(after / 2)).otherwise(F.col("end") + pad)
    return segments.select(key, "seg_id", F.greatest(F.lit(0), start).cast("long").alias("start"), end.cast("long").alias("end"))


def levels(probs: DataFrame, key: str = "file_id") -> DataFrame:
    """By file, the level that speech exceeds: from the median of all its probabilities, the mean of the middle two where their number is even."""
    return middle_values(probs, key, "p").select(key, (F.lit(SHARE) * (0.5 * F.col("lower") + 0.5 * F.col("upper")) + ABOVE).alias("level"))


class SpeechBuffer:
    """Custom segments of one file, whose frames come one by one; what is open at its end is dropped.

    Before speech, the mean of the last `trigger` frames is held against the level. In speech
    the buffer grows, and its mean without the last `silence` frames is; a segment of
    `shortest` frames or more then ends, and one of more than `longest` is split."""

    def __init__(self, level: float, step: int = STEP, trigger: int = 320, silence: int = 23, longest: int = 1_200, shortest: int = 480, reach: int = 160):
        self.level, self.step, self.trigger, self.silence, self.longest, self.shortest, self.reach = level, step, trigger, silence, longest, shortest, reach
        self.held: deque[float] = deque()
        self.total = self.recent = 0.0  # sums of all frames held, and of the last `silence` of them
        self.talking, self.frame = False, -1

    def add(self, value: float) -> list[tuple[int, int]]:
        """Takes the next frame; the segments that end with it."""
        held = self.held
        held.append(value)
        self.frame += 1
        self.total += value
        self.recent += value - (held[-1 - self.silence] if len(held) > self.silence else 0.0)
        if len(held) < self.trigger:
            return []
        if not self.talking:
            self.talking = self.total / len(held) - self.level > NEAR
            if not self.talking:
                self.total -= held.popleft()
            return []
        spoken = len(held) - self.silence
        if len(held) < self.shortest or self.level - (self.total - self.recent) / spoken <= NEAR:
            return []
        return self._closed()

    def _closed(self) -> list[tuple[int, int]]:
        first, last = self.frame - len(self.held) + 1, self.frame
        ends = [(first, last)]
        if len(self.held) > self.longest:
            middle = first - 2 + split_point(list(self.held), self.silence, self.reach)
            ends = [(first, middle), (middle + 2, last)]
        self.held.clear()
        self.total = self.recent = 0.0
        self.talking = False
        return [(self.step * a, self.step * b) for a, b in ends]


def split_point(held: list[float], stride: int = 23, reach: int = 160) -> int:
    """Frame near the middle at which speech is least likely; the first of equal ones."""
    middle = len(held) // 2
    best = min(range(middle - reach, middle + reach, stride), key=lambda k: held[k + stride])
    return int(best + stride / 2)


def custom_segments(probs: DataFrame, key: str = "file_id", **settings: int) -> DataFrame:
    """SpeechBuffer's segments of each file: key, seg_id, start and end.

    A file's frames stream in order through one task, which holds the buffer alone."""
    kind = probs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, buffer, number = None, None, 0
        for batch in batches:
            found = []
            for file, level, value in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if buffer is None or file != name:
                    name, buffer, number = file, SpeechBuffer(level, **settings), 0
                for start, end in buffer.add(value):
                    found.append((file, number, start, end))
                    number += 1
            files, *others = zip(*found, strict=True) if found else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(files, batch.schema.field(0).type), *(pa.array(x, pa.int64()) for x in others)], [key, "seg_id", "start", "end"])

    rows = probs.filter(F.col("p").isNotNull() & F.col(key).isNotNull()).select(key, "i", "p")
    rows = rows.join(levels(rows, key), key).select(key, "i", "level", "p").repartition(key).sortWithinPartitions(key, "i")
    return rows.mapInArrow(run, f"{key} {kind}, seg_id long, start long, end long")


def frame_probabilities(audio: DataFrame, predict: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Probabilities from a model of the caller, which maps batches of frames to file_id, i and p."""
    return audio.mapInPandas(lambda batches: map(predict, batches), "file_id long, i int, p double")


def segment(method: str, data: DataFrame, **settings) -> DataFrame:
    """Segments by one of the methods simple, vad and custom."""
    if method == "simple":
        return tiles(data, **settings)
    if method == "vad":
        return padded(voice_segments(data, **settings))
    if method == "custom":
        return custom_segments(data, **settings)
    raise ValueError(f"no such method: {method}")


def snippet(files: DataFrame, key: str, samples: str, start: int, end: int, rate: int = RATE) -> DataFrame:
    """Samples from second `start` to `end`, as far as the file has them."""
    n = F.col(samples)
    return files.select(key, F.least(F.lit(start * rate), n).cast("long").alias("start_sample"), F.least(F.lit(end * rate), n).cast("long").alias("end_sample"))


def length_buckets(rows: DataFrame, seconds: Column, short: float, long: float) -> DataFrame:
    """Counts and sums below `short`, above `long`, and of the rest, which holds the short ones too."""
    low, high = seconds < short, seconds > long
    return rows.agg(
        F.count_if(low).alias("n_short"), F.sum(F.when(low, seconds)).alias("s_short"),
        F.count_if(high).alias("n_long"), F.sum(F.when(high, seconds)).alias("s_long"),
        F.count_if(~high).alias("n_between"), F.sum(F.when(~high, seconds)).alias("s_between"),
    )


def histogram(rows: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Counts in bins of equal width from the smallest to the largest value, which is in the last bin."""
    ends = rows.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    place = F.when(F.col("__hi") == F.col("__lo"), 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("__lo")) * bins / (F.col("__hi") - F.col("__lo"))))).cast("long")
    return rows.join(F.broadcast(ends)).filter(F.col(value).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))


def resampled(samples: Column, rate: Column, to: int = RATE) -> Column:
    return F.ceil(samples * to / rate)
