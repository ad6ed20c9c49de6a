"""Spelling variants of a corpus' words, grouped by forward and reversed sorted dictionaries.

count_words() takes the maximal runs of letters `[A-Za-z\\u00C0-\\u00FF]`, lower-cases only
A-Z, damages some of them by a digest of document and run (as a test of the grouping;
`damage=0` leaves them as they are) and counts those of LEAST_POINTS code points or more.
Each batch counts its own first, so that what is shuffled are distinct words.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point. If one has `s` code points and the other `s` or `s + 1`, such an edit leaves a
half of the shorter intact: they share the first s // 2 code points or the last s - s //
2. So the words are entered in a dictionary that is sorted forward, in blocks that share a
prefix, and in one of the reversed words, in blocks that share a suffix; near words meet in
a block. Blocks of more than BLOCK words are subdivided until none is left: a block is the
window [low, high) of the shorter word in which the edit lies, with what stands before
and after it in common, and its halves are blocks for the same reason. A window of one
code point can't be subdivided and needn't be: its words agree but for one letter, or two
for the longer ones, so that the alphabet bounds it. Within a block the sorted words are
joined and each pair is verified by its edit distance.

variants() then picks each word's form, its most frequent near word (the least of them in
code-point order where several are) if that has at least RATIO times its count, and
follows the forms to the last by doubling the steps. Counts at least double from a word
to its form, so that no chain comes back to where it began.

Cases: null and empty texts have no words; very long texts and very long runs are read
whole; rows that repeat count each; rows without an id are damaged as rows with an empty
one; words without near ones have no form and are their own root; an empty table gives an
empty result; columns other than id and text are ignored, whatever their names are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skjald.llm.common import by_size, cut, small

LEAST_POINTS, LEAST_COUNT, RATIO = 5, 3, 2
#: One in so many runs of a document loses a code point.
DAMAGE = 97
#: Words of a block from which it is subdivided.
BLOCK = 64
#: Bytes of text that are counted at a time.
BYTES = 8_000_000
#: Bytes of a run from which its digest is computed by itself.
LONG_RUN = 64

#: Letters: ASCII ones by their byte, U+00C0 to U+00FF by 0xC3 and the byte that follows.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ASCII_LETTER = np.isin(np.arange(256), range(97, 123))


def crc_steps() -> np.ndarray:
    """The table of the cyclic redundancy check of zlib."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(0xEDB88320), step >> 1)
    return step


STEPS = crc_steps()


def runs_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts with A-Z lower-cased, starts and ends of their runs of letters, and each run's row."""
    raw = [text.encode() if text else b"" for text in texts]
    found = LOWER[np.frombuffer(b" ".join([*raw, b""]) or b" ", np.uint8)]
    inside = ASCII_LETTER[found]
    lead = np.flatnonzero(found == 0xC3)
    inside[lead] = inside[lead + 1] = True  # the bytes after 0xC3 are those of U+00C0 to U+00FF
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.cumsum([0, *(len(x) + 1 for x in raw)])
    return found, starts, ends, np.searchsorted(bounds, starts, "right") - 1


def run_checks(prefixes: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The check of each run behind a prefix whose check is `prefixes`, a byte of all runs at a time."""
    state = prefixes ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-sizes, kind="stable")
    state, starts, left = state[order], starts[order], -sizes[order]
    for k in range(min(LONG_RUN, int(sizes.max(initial=0)))):
        n = np.searchsorted(left, -k, "left")  # runs of more than k bytes
        state[:n] = STEPS[(state[:n] ^ raw[starts[:n] + k]) & 0xFF] ^ state[:n] >> np.uint32(8)
    state ^= np.uint32(0xFFFFFFFF)
    for i in range(int(np.searchsorted(left, -LONG_RUN, "left"))):
        state[i] = zlib.crc32(raw[starts[i] + LONG_RUN : starts[i] - left[i]].tobytes(), int(state[i]))
    out = np.empty_like(state)
    out[order] = state
    return out


def word_counts(ids: list, texts: list[str | None], damage: int = DAMAGE) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a few texts, after damage, of LEAST_POINTS code points or more, and their counts."""
    raw, starts, ends, row = runs_of(texts)
    points = np.cumsum(np.append(0, (raw & 0xC0) != 0x80))
    points = points[ends] - points[starts]
    keep = points >= LEAST_POINTS
    starts, ends, row, points = starts[keep], ends[keep], row[keep], points[keep]
    sizes = ends - starts
    whole, lost = np.ones(len(starts), bool), []
    if damage:
        seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        checks = run_checks(seeds[row], raw, starts, sizes)
        whole = checks % damage != 0
        for i in np.flatnonzero(~whole).tolist():
            word = raw[starts[i] : ends[i]].tobytes().decode()
            at = int(checks[i]) % len(word)
            if len(word) > LEAST_POINTS:
                lost.append((word[:at] + word[at + 1 :]).encode())
    starts, sizes = starts[whole], sizes[whole]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    chars = raw[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(chars)])
    coded = pa.concat_arrays([words, pa.array(lost, pa.large_binary())]).dictionary_encode()
    return coded.dictionary.cast(pa.large_string()).cast(pa.string()), np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = DAMAGE, least: int = LEAST_COUNT) -> DataFrame:
    """word and n of the words that occur at least `least` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in by_size(pc.binary_length(batch.column(1)).fill_null(0).to_pylist(), BYTES):
                part = batch.slice(rows.start, rows.stop - rows.start)
                words, counts = word_counts(part.column(0).to_pylist(), part.column(1).to_pylist(), damage)
                for at in range(0, len(words), 20_000):
                    yield pa.RecordBatch.from_arrays([words.slice(at, 20_000), pa.array(counts[at : at + 20_000], pa.int64())], ["word", "n"])

    return docs.select(id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


KEY = ["s", "low", "high", "before", "after"]


def entered(words: DataFrame, low: str, high: str) -> DataFrame:
    """`words` (word, s) in the block of the window [low, high): what they share before it, and behind it reversed, so that both dictionaries sort by their keys."""
    before, after = f"substring(word, 1, {low})", f"reverse(right(word, s - {high}))"
    return words.selectExpr("word", "s", f"{low} AS low", f"{high} AS high", f"{before} AS before", f"{after} AS after")


def blocks(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """Entries (word, s, low, high, before, after) of both dictionaries: words in one block agree but for its window, and no block but those of one code point has more than `most` words."""
    length = F.char_length("word")
    roles = words.select("word", F.explode(F.array(length, length - 1)).alias("s")).filter("s > 0")
    forward, backward = entered(roles, "s div 2", "s"), entered(roles, "cast(0 AS bigint)", "s div 2")
    open_, done = cut(forward.union(backward).selectExpr("word", "s", "int(low) AS low", "int(high) AS high", "before", "after")), []
    while True:
        large = cut(open_.filter("high - low > 1").groupBy(*KEY).agg(F.count("*").alias("n")).filter(F.col("n") > most).drop("n"))
        if large.isEmpty():
            done.append(open_)
            break
        large = small(large)
        done.append(open_.join(large, KEY, "left_anti"))
        halves = open_.join(large, KEY, "left_semi").select("word", "s", F.explode(F.expr("array(struct(low AS low, (low + high) div 2 AS high), struct((low + high) div 2 AS low, high AS high))")).alias("w"))
        open_ = cut(entered(halves.select("word", "s", "w.low", "w.high"), "int(low)", "int(high)").select("word", *KEY))
    found = done[0].select("word", *KEY)
    for more in done[1:]:
        found = found.union(more.select("word", *KEY))
    return found


def near_pairs(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """a, b: each pair of words of one edit once, the shorter or else lesser one first."""
    found = cut(blocks(words, most))
    shorter = found.filter("char_length(word) = s").withColumnRenamed("word", "a")
    longer = found.withColumnRenamed("word", "b")
    one = F.expr("(char_length(b) > s OR a < b) AND levenshtein(a, b, 1) = 1")
    return shorter.join(longer, KEY).filter(one).select("a", "b").distinct()


def rooted(forms: DataFrame) -> DataFrame:
    """word and root of each word (word, form) that has a form: the last word that forms lead to."""
    steps = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = cut(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")))
        if joined.filter("more").isEmpty():
            return joined.select("word", "root")
        steps = joined.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, most: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near and form_n of each of `words` (word, n; each once)."""
    words = cut(words.select("word", "n"))
    pairs = cut(near_pairs(words, most))
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("word", "other")
    counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    # The largest count, and of those the least word.
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    rows = words.join(best, "word", "left")
    above = -F.col("best.less") >= ratio * F.col("n")
    rows = cut(rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(above, F.col("best.other")).alias("form"), F.when(above, -F.col("best.less")).alias("form_n")))
    roots = rooted(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = DAMAGE) -> DataFrame:
    """variants() of the words of all texts."""
    return variants(count_words(docs, id_col, text_col, damage))
