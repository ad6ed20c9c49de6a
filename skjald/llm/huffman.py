"""Token-id files: canonical length-limited Huffman codes in independent blocks.

Ids are counted over the whole corpus, package-merge gives code lengths of at most
MAX_BITS, and canonical codes follow from the lengths alone. Each document is a block
that starts at a byte, with a checkpoint of its bit offset every LANE ids, so that a
reader decodes all lanes at once by one table of 2**MAX_BITS entries.

The file format is a folder of Parquet files, `blocks`, in ascending order of
documents by (shard, row): doc_id, n_ids, shard_start (ids before the block in its
shard), lanes (bits of each lane as little-endian 16-bit integers) and payload; and
`codebook`: id and code length.

Cases: a null text counts as empty; each document ends with the end id, so that an
empty one has one id; a very long text is one block, encoded by itself; an added token of
the vocabulary, such as <|endoftext|>, is one id wherever it stands, as in the library;
null doc_ids come first; rows with equal or no doc_id are ordered by the crc32 of their
ids, and dealt to several shards by it where they are many; an empty table gives empty
files; other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skjald.llm.common import by_size, remove, shared_path, tokenizer_file

MAX_BITS = 16
LANE = 64
#: Ids that a task encodes or decodes at a time, unless one document has more.
CHUNK_IDS = 1 << 16
#: Pieces, of Latin letters or marks, remembered in each of a worker's two memories: below about 120 MB.
MEMO_PIECES = 300_000
#: Characters of texts that are encoded at a time, unless one document has more.
CHUNK_CHARS = 8_000_000
#: A line of a part that is one short piece of letters and perhaps one of marks after it. An apostrophe may begin a piece of its own.
LETTERS, MARKS = "[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]{1,40}", r"[!-&(-/:-@\[-`{-~]{0,8}"
LATIN = re.compile(f"({LETTERS})({MARKS})\\Z")
#: What stands for each byte in the vocabulary: printable ones for themselves, the others for the characters from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SHOWN = {byte: 0x100 + i for i, byte in enumerate(x for x in range(256) if x not in PRINTABLE)}


class Encoder:
    """The library's tokenizer with a memory of what stands between single blanks.

    The vocabulary's split pattern never joins what stands before a blank that is alone
    to what follows it, so that such parts are encoded by themselves, each distinct one of
    a batch once. Parts of Latin letters are cut into the pattern's pieces here and go to
    the library's model; all others go through the whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model.tokenize
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u2").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of the pieces that the split pattern makes."""
        found = list(map(self.young.get, pieces))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            piece = pieces[i]
            ids = self.old.get(piece)
            if ids is None:
                shown = "\u0120" + piece[1:] if piece[0] == " " and piece.isascii() else piece.encode().decode("latin-1").translate(SHOWN)
                ids = array("H", [token.id for token in self.model(shown)]).tobytes()
            if len(self.young) >= MEMO_PIECES:  # what isn't asked for until the next time is forgotten
                self.young, self.old = {}, self.young
            self.young[piece] = found[i] = ids
        return found

    def _part(self, part: str) -> bytes | None:
        """Ids of a blank and the part, which has other characters than LATIN; none for one that isn't whole."""
        if not _whole(part):
            return None
        lines = list(map(LATIN.match, part.split("\n")))
        if len(lines) == 1 or not all(lines):
            return self.raw([" " + part])[0]
        pieces = [x for line in lines for x in ("\n", *line.groups()) if x]  # the end of a line between other characters is a piece
        return b"".join(self._pieces([" " + pieces[1], *pieces[2:]]))

    def _distinct(self, parts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, the first and the second piece of a blank and each part, and which parts aren't whole."""
        both = pc.extract_regex(parts, f"^(?P<core>{LETTERS})(?P<mark>{MARKS})$")
        latin = both.is_valid().to_numpy(zero_copy_only=False)
        core, mark = (both.field(k).filter(pa.array(latin)).dictionary_encode() for k in (0, 1))
        others = np.flatnonzero(~latin)
        odd = list(map(self._part, parts.take(pa.array(others)).to_pylist()))
        entries = [b"", *self._pieces(pc.binary_join_element_wise(pa.scalar("", core.dictionary.type), core.dictionary, pa.scalar(" ", core.dictionary.type)).to_pylist())]
        marks, first, second = len(entries), np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        entries += [ids for x in mark.dictionary.to_pylist() for ids in (self._pieces([x]) if x else [b""])]
        first[latin], second[latin] = 1 + core.indices.to_numpy(), marks + mark.indices.to_numpy()
        first[others] = len(entries) + np.arange(len(odd))
        bad = np.zeros(len(parts), bool)
        bad[others[[i for i, ids in enumerate(odd) if ids is None]]] = True
        return entries + [ids or b"" for ids in odd], first, second, bad

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 16-bit integers."""
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        stops = split.offsets.to_numpy()[1:].astype(np.int64)
        starts = np.append(0, stops[:-1])
        heads = pc.list_element(split, 0).to_pylist()  # the first part of a text has no blank before it
        follow = np.ones(int(stops[-1]), bool)
        follow[starts] = False
        parts = split.flatten().filter(pa.array(follow)).dictionary_encode()
        entries, first, second, bad = self._distinct(parts.dictionary)
        codes = parts.indices.to_numpy()
        places = np.zeros((len(follow), 2), np.int64)
        places[follow, 0], places[follow, 1] = first[codes], second[codes]
        places[starts, 0] = len(entries) + np.arange(len(texts))
        entries += self.raw(heads)
        unsure = np.zeros(len(follow), bool)
        unsure[follow] = bad[codes]
        whole = set(np.flatnonzero(np.logical_or.reduceat(unsure, starts)).tolist())
        for i, (text, head) in enumerate(zip(texts, heads, strict=True)):
            # An added token is one id, wherever it stands.
            if len(head) < len(text) and not _whole(head) or any(x in text for x in self.added):
                whole.add(i)
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 2
        table, each = np.frombuffer(b"".join(entries), "<u2"), sizes[places.ravel()]
        ends = np.cumsum(each)
        at = np.arange(int(ends[-1])) + np.repeat((np.cumsum(sizes) - sizes)[places.ravel()] - ends + each, each)
        joined = table[at].tobytes()
        bounds = (2 * np.append(0, ends)[2 * np.append(starts, len(follow))]).tolist()
        out = [joined[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        if whole:
            order = sorted(whole)
            for i, x in zip(order, self.raw([texts[i] for i in order]), strict=True):
                out[i] = x
        return out


def _whole(part: str) -> bool:
    """False if the part is empty or has a blank at an end, next to the one at which it was cut."""
    return part != "" and not part[0].isspace() and not part[-1].isspace()


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `max_bits` for the ids that occur (package-merge)."""
    ids = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(ids) < 2:
        lengths[ids] = 1
        return lengths
    if len(ids) > 1 << max_bits:
        raise ValueError("more ids than codes of this length")
    ids = ids[np.argsort(counts[ids], kind="stable")]
    weights, n = counts[ids].astype(np.float64), len(ids)
    merged, kinds = weights, []  # by level, whether each of the sorted packages is an id itself
    for _ in range(max_bits - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        kinds.append(order < n)
        merged = both[order]
    take = 2 * n - 2
    for single in reversed(kinds):
        used = int(single[:take].sum())
        lengths[ids[:used]] += 1
        take = 2 * (take - used)
    lengths[ids[:take]] += 1
    return lengths


@dataclass
class Codebook:
    """Canonical codes: by length, then by id."""

    lengths: np.ndarray

    def __post_init__(self) -> None:
        ids = np.flatnonzero(self.lengths)
        ids = ids[np.lexsort((ids, self.lengths[ids]))]
        size = 1 << (MAX_BITS - self.lengths[ids].astype(np.int64))
        start = np.cumsum(size) - size
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[ids] = start >> (MAX_BITS - self.lengths[ids].astype(np.int64))
        self.symbols = np.zeros(1 << MAX_BITS, np.uint16)
        self.symbols[: size.sum()] = np.repeat(ids, size)
        self.bits = np.zeros(1 << MAX_BITS, np.uint8)
        self.bits[: size.sum()] = np.repeat(self.lengths[ids], size)

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> list[tuple[bytes, bytes]]:
        """Lanes and payload of each of the documents, of `sizes` ids, that `ids` joins."""
        bits = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(sizes)
        upto = np.concatenate([[0], np.cumsum(bits)])
        total = upto[ends] - upto[ends - sizes]
        room = (total + 7) // 8
        base = np.cumsum(room) - room
        at = upto[:-1] + np.repeat(base * 8 - upto[ends - sizes], sizes)
        word = at >> 5
        shifted = self.codes[ids] << (64 - bits - (at & 31)).astype(np.uint64)
        packed = np.zeros(int(word[-1]) + 2 if len(ids) else 1, np.uint64)
        if len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            joined = np.bitwise_or.reduceat(shifted, first)
            packed[word[first]] |= joined >> np.uint64(32)
            packed[word[first] + 1] |= joined & np.uint64(0xFFFFFFFF)
        raw = packed.astype(">u4").tobytes()
        out = []
        for n, end, start, length in zip(sizes.tolist(), ends.tolist(), base.tolist(), room.tolist(), strict=True):
            cuts = np.append(np.arange(end - n, end, LANE), end)
            out.append((np.diff(upto[cuts]).astype("<u2").tobytes(), raw[start : start + length]))
        return out

    def decode(self, sizes: np.ndarray, lanes: list[bytes], payloads: list[bytes]) -> np.ndarray:
        """All ids of the documents, joined."""
        raw = np.frombuffer(b"".join(payloads) + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        room = np.array([len(x) for x in payloads], np.int64)
        n_lanes = -(-sizes // LANE)
        bits = np.frombuffer(b"".join(lanes), "<u2").astype(np.int64)
        begin = np.cumsum(bits) - bits
        first = np.cumsum(n_lanes) - n_lanes
        origin = np.append(begin, 0)[first]
        at = begin + np.repeat((np.cumsum(room) - room) * 8 - origin, n_lanes)
        index = np.arange(len(bits)) - np.repeat(first, n_lanes)
        out_at = np.repeat(np.cumsum(sizes) - sizes, n_lanes) + index * LANE
        count = np.minimum(LANE, np.repeat(sizes, n_lanes) - index * LANE)
        order = np.argsort(-count, kind="stable")
        at, out_at, count = at[order], out_at[order], count[order]
        out = np.zeros(int(sizes.sum()), np.uint16)
        active = np.searchsorted(-count, -np.arange(1, LANE + 1), side="right")
        for step, n in enumerate(active.tolist()):
            if not n:
                break
            now = at[:n]
            code = window[now >> 3] >> (16 - (now & 7)).astype(np.uint32) & 0xFFFF
            out[out_at[:n] + step] = self.symbols[code]
            now += self.bits[code]
        return out


def tokenize_documents(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents with their ids (16-bit, in a binary), and rows that count a batch's ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, end = encoder(path), np.array([end_id], "<u2").tobytes()
        names = ["doc_id", "ids", "seen"]
        key = None
        seen = np.zeros(1 << 16, np.int64)
        for batch in batches:
            key = batch.schema.field(0).type
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for rows in by_size(list(map(len, texts)), CHUNK_CHARS):
                part = batch[rows]
                ids = [x + end for x in tool.encode(texts[rows])]
                seen += np.bincount(np.frombuffer(b"".join(ids), "<u2"), minlength=1 << 16)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())], names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, key), pa.nulls(1, pa.binary()), pa.array([seen.astype("<i8").tobytes()])], names)

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids binary, seen binary")


def count_ids(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs; the table has an entry for each of the 65,536 possible ids at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for x in batch.column(0):
                seen += np.frombuffer(x.as_py(), "<i8")
        ids = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(seen[ids], pa.int64())], ["id", "n"])

    rows = tokens.select("seen").filter(F.col("seen").isNotNull()).mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << 16, np.int64)
    for row in rows:
        counts[row.id] = row.n
    return counts


def shard_bounds(tokens: DataFrame, shards: int) -> tuple[list[int], int]:
    """Ids in ascending order that part the documents into about equal shards, `shards` of them at most, and the shards of rows without an id.

    An id that is in the list several times has as many shards of its own."""
    at = [i / shards for i in range(1, shards)]
    found = tokens.agg(F.percentile_approx("doc_id", at or [0.5], 20 * shards).alias("at"), F.count("*").alias("n"), F.count("doc_id").alias("known")).first()
    return (found.at or []) if at else [], -(-shards * (found.n - found.known) // max(found.n, 1))


def shard_of(doc_id: int | None, tie: int, bounds: list[int], without: int) -> int:
    """The shard of a row; those of equal or no ids are dealt by their ties, of 32 bits."""
    if doc_id is None:
        return tie * without >> 32
    low, high = bisect.bisect_left(bounds, doc_id), bisect.bisect_right(bounds, doc_id)
    return without + (low + 1 + (tie * (high - low) >> 32) if high > low else low)


def encode_blocks(tokens: DataFrame, book: Codebook, bounds: list[int], without: int) -> DataFrame:
    """A block for each row of doc_id and ids, with its shard; rows without an id are in the first ones."""
    kind, lengths = tokens.schema["doc_id"].dataType.simpleString(), tokens.sparkSession.sparkContext.broadcast(book.lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(lengths.value)
        for batch in batches:
            raw = batch.column(1).to_pylist()
            for rows in by_size([len(x) // 2 for x in raw], CHUNK_IDS):
                sizes = np.array([len(x) // 2 for x in raw[rows]], np.int64)
                lanes, payloads = zip(*book.encode(np.frombuffer(b"".join(raw[rows]), "<u2"), sizes), strict=True)
                tie = [zlib.crc32(x) for x in raw[rows]]
                shard = [shard_of(x, t, bounds, without) for x, t in zip(batch.column(0)[rows].to_pylist(), tie, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), batch.column(0)[rows], pa.array(tie, pa.int64()), pa.array(sizes), pa.array(lanes, pa.binary()), pa.array(payloads, pa.binary())], ["shard", "doc_id", "tie", "n_ids", "lanes", "payload"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"shard int, doc_id {kind}, tie long, n_ids long, lanes binary, payload binary")


def _placed(blocks: DataFrame) -> DataFrame:
    """Sorted blocks with their place in their shard and the ids before them in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, row, ids = -1, 0, 0
        for batch in batches:
            rows, starts = [], []
            for shard, n in zip(batch.column("shard").to_pylist(), batch.column("n_ids").to_pylist(), strict=True):
                if shard != last:
                    last, row, ids = shard, 0, 0
                rows.append(row)
                starts.append(ids)
                row, ids = row + 1, ids + n
            columns = [batch.column("shard"), pa.array(rows, pa.int64()), batch.column("doc_id"), batch.column("n_ids"), pa.array(starts, pa.int64()), batch.column("lanes"), batch.column("payload")]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "row", "doc_id", "n_ids", "shard_start", "lanes", "payload"])

    kind = blocks.schema["doc_id"].dataType.simpleString()
    return blocks.mapInArrow(run, f"shard int, row long, doc_id {kind}, n_ids long, shard_start long, lanes binary, payload binary")


def write_files(docs: DataFrame, to: str, path: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenizes the documents and writes them to the folder `to` in ascending order of id."""
    spark = docs.sparkSession
    tokens_at = shared_path(spark, "ids")
    tokenize_documents(docs, path or tokenizer_file("byte_bpe_50k.json"), end_id, id_col, text_col).write.option("compression", "zstd").parquet(tokens_at)
    tokens = spark.read.parquet(tokens_at)
    book = Codebook(code_lengths(count_ids(tokens)))
    ids = np.flatnonzero(book.lengths)
    spark.createDataFrame([(int(i), int(book.lengths[i])) for i in ids], "id int, bits int").coalesce(1).write.parquet(f"{to}/codebook")
    tokens = tokens.filter(F.col("ids").isNotNull())
    bounds, without = shard_bounds(tokens, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # A part file for each shard, in their order.
    blocks = encode_blocks(tokens, book, bounds, without).repartitionById(without + len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "tie")
    _placed(blocks).write.option("compression", "uncompressed").parquet(f"{to}/blocks")
    remove(spark, tokens_at)


def read_files(spark: SparkSession, at: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and ids (32-bit, in a binary) from the files."""
    blocks = spark.read.parquet(f"{at}/blocks")
    lengths = np.zeros(1 << 16, np.uint8)
    for row in spark.read.parquet(f"{at}/codebook").collect():  # at most 65,536 rows
        lengths[row.id] = row.bits
    sent = spark.sparkContext.broadcast(lengths)
    # One row for each shard, of which the writer makes a few for each of its partitions.
    totals = {row.shard: row.n for row in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    before, offsets = 0, {}
    for shard in sorted(totals):
        offsets[shard], before = before, before + totals[shard]
    kind = blocks.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(sent.value)
        for batch in batches:
            sizes, lanes, payloads = batch.column("n_ids").to_numpy(), batch.column("lanes").to_pylist(), batch.column("payload").to_pylist()
            start = np.array([offsets[x] for x in batch.column("shard").to_pylist()], np.int64) + batch.column("shard_start").to_numpy()
            for rows in by_size(sizes.tolist(), CHUNK_IDS):
                ids = book.decode(sizes[rows], lanes[rows], payloads[rows]).astype("<u4")
                ends = np.cumsum(sizes[rows])
                raw = memoryview(ids.tobytes())
                parts = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), sizes[rows].tolist(), strict=True)]
                columns = [batch.column("doc_id")[rows], pa.array(start[rows]), pa.array(sizes[rows]), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                columns += [pa.array([x.tobytes() for x in parts], pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return blocks.select("shard", "doc_id", "n_ids", "shard_start", "lanes", "payload").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
