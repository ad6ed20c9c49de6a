"""Benchmark decontamination by a positional inverted index of the training texts.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z
lower-cased. A window is WINDOW consecutive words of a test item, or all words of an item
that has fewer; a training word inside any occurrence of a window is hit.

1. build_index() stores the postings: each task cuts its documents into chunks of some
   CHUNK_BYTES of text and writes, for each chunk and term, the term's places in
   ascending order. Documents of a chunk follow one another with GAP empty places
   between, so that no match runs from one into the next. A frequent term has a list in
   each chunk, and none is longer than a chunk: building it shuffles nothing.
2. search() takes the windows in batches of some BATCH, joins the index with their terms,
   and brings the lists of a chunk together. A window's candidates are the places of its
   rarest term in the chunk, less that term's offset; the other terms' lists, in ascending
   order of length, are intersected with them at their own offsets. A place that all
   lists hold is a phrase match; one where each list has a place within `slop` of the
   expected one is a proximity match.
3. contamination() gathers what each document was hit by, over all batches.

Cases: null, empty and wordless texts have no words and no hits; very long texts are
read whole, and one longer than a chunk is a chunk by itself; rows that repeat, in either
table, are rows of their own, and an item that repeats counts once; items without words
match nothing; items without an id hit words but are no item that is counted or named;
documents without an id have a row with a null id; empty tables give an empty result or
no hits; columns other than ids and texts are ignored, whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skjald.llm.common import by_size, cut, remove, shared_path, small

WINDOW = 10
#: Bytes of text in a chunk of the index.
CHUNK_BYTES = 8_000_000
#: Empty places between two documents of a chunk, and the most that `slop` may be.
GAP = 64
#: Windows that are searched at a time: their term numbers, some 10 MB, go to each task.
BATCH = 200_000
#: Candidates that are intersected at a time.
CANDIDATES = 2_000_000
#: How far a term may stand from its expected place in a proximity match.
SLOP = 3

TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
INSIDE = np.isin(np.arange(256), [*range(48, 58), *range(97, 123), *range(128, 256)])


def terms_of(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order (binary), and how many each text has."""
    raw = [text.encode() if text else b"" for text in texts]
    found = LOWER[np.frombuffer(b" ".join([*raw, b""]) or b" ", np.uint8)]
    inside = INSIDE[found]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(found[inside])])
    return words, np.diff(np.searchsorted(starts, np.cumsum([0, *(len(x) + 1 for x in raw)])))


def chunk_postings(chunk: int, ids: pa.Array, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
    """A chunk's rows of the index: one of its documents (without a term), then one for each term."""
    words, counts = terms_of(texts)
    starts = GAP + np.cumsum(counts + GAP) - (counts + GAP)
    place = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(len(words))
    names = ["chunk", "term", "places", "ids", "sizes"]
    one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
    yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.nulls(1, pa.string()), one(starts, pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), one(counts, pa.int32())], names)
    if not len(words):
        return
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    terms = coded.dictionary.cast(pa.string())
    offsets = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(terms)))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(place[np.argsort(codes, kind="stable")], pa.int32()))
    for at in range(0, len(terms), 20_000):
        n = min(20_000, len(terms) - at)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk)), terms.slice(at, n), lists.slice(at, n), pa.nulls(n, pa.list_(ids.type)), pa.nulls(n, pa.list_(pa.int32()))], names)


def build_index(docs: DataFrame, at: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the postings of all documents to the folder `at`."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in by_size(pc.binary_length(batch.column(1)).fill_null(0).to_pylist(), CHUNK_BYTES):
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield from chunk_postings(number, part.column(0), part.column(1).to_pylist())
                number += 1

    schema = f"chunk long, term string, places array<int>, ids array<{kind}>, sizes array<int>"
    docs.select(id_col, text_col).mapInArrow(run, schema).write.parquet(at)


def item_words(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """item (its id as a string), words and key (their digest) of each window of each item."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), item_words(F.col(text_col)).alias("w"))
    n = F.size("w")
    windows = F.when(n <= size, F.array("w")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.slice("w", i, size)))
    rows = rows.filter("size(w) > 0").select("item", F.explode(windows).alias("words"))
    return rows.withColumn("key", F.sha2(F.array_join("words", " "), 256))


class Windows:
    """A batch of windows as rows of term numbers, -1 beyond a window's end."""

    def __init__(self, words: list[list[str]]):
        self.terms = sorted({w for row in words for w in row})
        number = {w: i for i, w in enumerate(self.terms)}
        self.length = np.array([len(row) for row in words])
        self.codes = np.full((len(words), self.length.max()), -1, np.int32)
        for i, row in enumerate(words):
            self.codes[i, : len(row)] = [number[w] for w in row]

    def matches(self, codes: np.ndarray, lists: pa.Array, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """window, first place, last place and whether it is exact, of the matches in a chunk whose terms have `lists` of places."""
        order = np.argsort(codes)
        sizes = np.zeros(len(self.terms) + 1, np.int64)
        sizes[codes] = lists.value_lengths().to_numpy()
        begin = np.cumsum(sizes) - sizes
        lists = lists.take(pa.array(order))
        keys = np.repeat(codes[order].astype(np.int64), sizes[codes[order]]) << 32 | lists.flatten().to_numpy()
        have = np.where(self.codes < 0, np.iinfo(np.int64).max, sizes[self.codes])
        whole = np.flatnonzero(have.min(1) > 0)
        rank = np.argsort(have[whole], axis=1, kind="stable")  # of the rarest term first
        rarest = self.codes[whole, rank[:, 0]]
        for part in by_size(sizes[rarest].tolist(), CANDIDATES):
            each = sizes[rarest[part]]
            row = np.repeat(np.arange(part.start, part.stop), each)
            at = np.repeat(begin[rarest[part]] - (np.cumsum(each) - each), each) + np.arange(len(row))
            expected = (keys[at] & 0xFFFFFFFF) - rank[row, 0]
            low = high = keys[at] & 0xFFFFFFFF
            exact = np.ones(len(row), bool)
            for k in range(1, rank.shape[1]):
                w = whole[row]
                code, offset = self.codes[w, rank[row, k]].astype(np.int64), rank[row, k]
                there = code >= 0  # windows that are shorter have all their terms behind them
                target = code << 32 | (expected + offset)
                found = np.searchsorted(keys, target)
                after = keys[np.minimum(found, len(keys) - 1)]
                if slop:
                    before = keys[np.maximum(found - 1, 0)]
                    nearest = np.where(np.abs(after - target) <= np.abs(target - before), after, before)
                else:
                    nearest = after
                keep = ~there | (np.abs(nearest - target) <= slop)
                exact &= ~there | (nearest == target)
                place = np.where(there, nearest & 0xFFFFFFFF, low)
                low, high = np.minimum(low, place)[keep], np.maximum(high, np.where(there, place, high))[keep]
                row, expected, exact = row[keep], expected[keep], exact[keep]
            yield whole[row], np.where(exact, expected, low), np.where(exact, expected + self.length[whole[row]] - 1, high), exact


def chunk_hits(windows: Windows, tile: pa.Table, slop: int) -> pa.Table:
    """doc (its number in the chunk), windows of phrase and of proximity matches, and spans of words hit by phrases."""
    schema = pa.schema([("chunk", pa.int64()), ("doc", pa.int32()), ("exact", pa.list_(pa.int32())), ("near", pa.list_(pa.int32())), ("spans", pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])))])
    tile = tile.combine_chunks()
    head = tile.filter(pc.is_null(tile["code"]))
    lists = tile.filter(pc.is_valid(tile["code"]))
    if not lists.num_rows:
        return schema.empty_table()
    starts = head["places"].combine_chunks().flatten().to_numpy()
    edges = np.zeros(int(starts[-1]) + head["sizes"].combine_chunks().flatten()[-1].as_py() + 2, np.int32)
    pairs = [], []
    for window, low, high, exact in windows.matches(lists["code"].to_numpy(), lists["places"].combine_chunks(), slop):
        np.add.at(edges, low[exact], 1)
        np.add.at(edges, high[exact] + 1, -1)
        doc = np.searchsorted(starts, low, "right") - 1
        for into, which in zip(pairs, (exact, ~exact), strict=True):
            into.append(np.unique(doc[which] << 32 | window[which]))
    both = [np.unique(np.concatenate([np.zeros(0, np.int64), *found])) for found in pairs]
    step = np.diff((np.cumsum(edges) > 0).astype(np.int8), prepend=0)
    lows, highs = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    docs = np.unique(np.concatenate(both) >> 32)
    span_doc = np.searchsorted(starts, lows, "right") - 1
    first = starts[span_doc]

    def listed(values: pa.Array, of: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(of, docs), len(of)), pa.int32()), values)

    columns = [listed(pa.array(found & 0xFFFFFFFF, pa.int32()), found >> 32) for found in both]
    spans = pa.StructArray.from_arrays([pa.array(lows - first, pa.int32()), pa.array(highs - first, pa.int32())], ["low", "high"])
    return pa.table([pa.array(np.full(len(docs), head["chunk"][0].as_py()), pa.int64()), pa.array(docs, pa.int32()), *columns, listed(spans, span_doc)], schema=schema)


def search(spark: SparkSession, at: str, words: list[list[str]], slop: int = SLOP) -> DataFrame:
    """chunk, doc, exact and near (numbers of windows), spans (of words): the documents of the index `at` that hold a window of `words`."""
    windows = Windows(words)
    index = spark.read.parquet(at)
    terms = spark.createDataFrame(pa.table({"term": pa.array(windows.terms, pa.string()), "code": pa.array(np.arange(len(windows.terms)), pa.int32())}))
    needed = index.filter("term is not null").join(small(terms), "term").select("chunk", "code", "places", F.lit(None).cast("array<int>").alias("sizes"))
    heads = index.filter("term is null").select("chunk", F.lit(None).cast("int").alias("code"), "places", "sizes")
    sent = spark.sparkContext.broadcast(windows)
    run = lambda tile: chunk_hits(sent.value, tile, slop)
    return needed.unionByName(heads).groupBy("chunk").applyInArrow(run, "chunk long, doc int, exact array<int>, near array<int>, spans array<struct<low: int, high: int>>")


def merged(spans: Column) -> Column:
    """How many words the spans (array of low, high) cover together."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    grow = lambda a, s: F.struct((a.n + F.greatest(s.high - F.greatest(s.low, a.end), F.lit(0))).alias("n"), F.greatest(a.end, s.high).alias("end"))
    return F.aggregate(F.sort_array(spans), start, grow, lambda a: a.n)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """A row for each document: its id, n_words, spans (of words hit by phrases), items and near_items (sorted ids as strings, of items with phrase and of those with only proximity matches)."""
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must be between 0 and {GAP - 1}")
    spark = docs.sparkSession
    at = shared_path(spark, "postings")
    build_index(docs, at, id_col, text_col)
    windows = cut(item_windows(items, item_col, item_text, size))
    distinct = windows.dropDuplicates(["key"]).select("key", "words")
    batches = max(1, -(-distinct.count() // (BATCH * 4 // 5)))
    found = []
    for number in range(batches):  # each batch is sent to the tasks: its size has a bound
        batch = distinct.filter(F.pmod(F.xxhash64("key"), F.lit(batches)) == number).toArrow()
        if batch.num_rows:
            names = spark.createDataFrame(pa.table({"window": pa.array(np.arange(batch.num_rows), pa.int32()), "key": batch["key"]}))
            hits = cut(search(spark, at, batch["words"].to_pylist(), slop))
            of = [hits.select("chunk", "doc", F.explode(c).alias("window"), F.lit(c == "exact").alias("phrase")) for c in ("exact", "near")]
            keyed = of[0].union(of[1]).join(small(names, BATCH), "window").select("chunk", "doc", "key", "phrase")
            found.append((hits.select("chunk", "doc", "spans"), keyed))
    index = spark.read.parquet(at).filter("term is null")
    rows = index.select("chunk", F.posexplode(F.arrays_zip("ids", "sizes")).alias("doc", "row")).select("chunk", "doc", F.col("row.ids").alias("doc_id"), F.col("row.sizes").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    if not found:
        result = rows.select("doc_id", "n_words", F.array().cast("array<struct<low: int, high: int>>").alias("spans"), none.alias("items"), none.alias("near_items"))
    else:
        spans, keyed = found[0]
        for more, also in found[1:]:
            spans, keyed = spans.union(more), keyed.union(also)
        spans = spans.groupBy("chunk", "doc").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        named = keyed.join(small(windows.select("key", "item")), "key").groupBy("chunk", "doc", "item").agg(F.max("phrase").alias("phrase"))
        named = named.groupBy("chunk", "doc").agg(F.sort_array(F.collect_list(F.when(F.col("phrase"), F.col("item")))).alias("items"), F.sort_array(F.collect_list(F.when(~F.col("phrase"), F.col("item")))).alias("near_items"))
        joined = rows.join(spans, ["chunk", "doc"], "left").join(named, ["chunk", "doc"], "left")
        result = joined.select("doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<low: int, high: int>>")).alias("spans"), *(F.coalesce(c, none).alias(c) for c in ("items", "near_items")))
    result = cut(result.withColumnRenamed("doc_id", id_col))
    remove(spark, at)
    return result


def contamination(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The id of each document, n_words, n_hit, n_items, items_sha256, contaminated and n_near (items with proximity matches alone)."""
    found = matches(docs, items, **settings)
    hit = merged(F.col("spans"))
    ids = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select(settings.get("id_col", "doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), ids, (hit > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near"))


def without_contaminated(docs: DataFrame, items: DataFrame, most: float = 0.0, **settings) -> DataFrame:
    """The rows of `docs` of whose words at most a share of `most` is hit; ids name documents, and rows without one stay."""
    id_col = settings.get("id_col", "doc_id")
    found = contamination(docs, items, **settings)
    gone = found.filter(F.col("n_hit") > most * F.col("n_words")).select(id_col).dropna().distinct()
    return docs.join(small(gone), id_col, "left_anti").select(*docs.columns)
