"""Byte-level BPE encoding and decoding of whole documents.

Two tiers resolve a pre-token: a minimal perfect hash over the vocabulary answers
for pre-tokens that are entries themselves, and the others are merged by a heap of
candidate pairs over linked bytes. Both tables have the size of the vocabulary, which
is fixed, and so go to the tasks whole. Encoding is a narrow operation without a shuffle.

Cases: a null text counts as empty and has no ids; very long texts and pre-tokens are
encoded whole, the latter in time near to linear; of pairs of equal rank the leftmost is merged first; rows with null or repeated ids are
encoded like any other; an empty table gives an empty result; columns other than the
id and text are ignored by the column names given.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from skjald.llm.common import tokenizer_file

#: Chunks in each of a worker's two memories, and the longest that is kept: below about 75 MB.
MEMO_CHUNKS, MEMO_CHARS = 150_000, 40
#: A lone blank between other characters always begins a pre-token.
SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")


class PerfectHash:
    """Minimal perfect hash by displacement: n keys on n slots, two table reads a lookup."""

    def __init__(self, keys: list[bytes], per_bucket: int = 2):
        self.n = n = len(keys)
        self.buckets = max(1, -(-n // per_bucket))
        self.shift = [0] * self.buckets
        self.slots: list[bytes | None] = [None] * n
        groups: dict[int, list[bytes]] = {}
        for key in keys:
            groups.setdefault(xxhash.xxh64_intdigest(key) % self.buckets, []).append(key)
        free = n
        for bucket, group in sorted(groups.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(group) == 1 and free < n:
                break
            shift, places = 1, set()
            while True:
                places = {self._slot(key, shift) for key in group}
                if len(places) == len(group) and all(self.slots[p] is None for p in places):
                    break
                shift += 1
            self.shift[bucket] = shift
            for key in group:
                self.slots[self._slot(key, shift)] = key
            free -= len(group)
        # What is left has a bucket of its own: a negative shift names the slot itself.
        holes = (p for p in range(n) if self.slots[p] is None)
        for bucket, group in groups.items():
            if not self.shift[bucket]:
                place = next(holes)
                self.shift[bucket] = -place - 1
                self.slots[place] = group[0]

    def _slot(self, key: bytes, shift: int) -> int:
        return xxhash.xxh64_intdigest(key, shift) % self.n

    def find(self, key: bytes) -> int:
        """The key's slot, or -1 if it isn't one of the keys."""
        if not self.n:
            return -1
        shift = self.shift[xxhash.xxh64_intdigest(key) % self.buckets]
        place = -shift - 1 if shift < 0 else self._slot(key, shift)
        return place if self.slots[place] == key else -1


class Codec:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.hash = PerfectHash(list(ranks))
        self.ids = [ranks[key] for key in self.hash.slots]
        self.words = {i: key for key, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.memo: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece that is no vocabulary entry: always joins the lowest, leftmost pair.

        Parts are linked by their first byte; the heap holds rank and place of each pair,
        and a pair whose rank is no longer the one in `pair` has been joined since."""
        n, rank = len(piece), self.ranks.get
        after, before = list(range(1, n + 2)), list(range(-1, n))
        bits = n.bit_length()
        low = (1 << bits) - 1
        pair = [rank(piece[i : i + 2], -1) for i in range(n)]
        pair[n - 1] = -1
        heap = [r << bits | i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            key = pop(heap)
            i = key & low
            if pair[i] != key >> bits:
                continue
            j = after[i]
            k = after[i] = after[j]
            pair[j] = -1
            if k < n:
                before[k] = i
                r = pair[i] = rank(piece[i : after[k]], -1)
                if r >= 0:
                    push(heap, r << bits | i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                r = pair[h] = rank(piece[h:k], -1)
                if r >= 0:
                    push(heap, r << bits | h)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def piece(self, raw: bytes) -> list[int]:
        place = self.hash.find(raw)
        return [self.ids[place]] if place >= 0 else self.merge(raw)

    def pieces(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self.piece(piece.encode())]

    def _learn(self, part: str) -> tuple[int, ...]:
        """Ids of a blank and `part`."""
        ids = self.old.get(part)
        if ids is None:
            word = part[:-1] if part[-1] in ",.!?;:" else part
            if word.isalpha() and max(word) < "\u0250":  # one pre-token, and the mark after it another
                ids = tuple(self.piece(b" " + word.encode()))
                if word is not part:
                    ids += tuple(self.piece(part[-1].encode()))
            else:
                ids = tuple(self.pieces(" " + part))
        if len(part) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_CHUNKS:  # what isn't asked for until the next time is forgotten
                self.memo, self.old = {}, self.memo
            self.memo[part] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text.

        A pre-token never crosses a cut before a blank that stands alone, so that the
        parts between such blanks are encoded by themselves and remembered."""
        parts = text.split(" ")
        found = list(map(self.memo.get, parts))
        found[0] = ()
        if None in found:
            missed = [i for i, ids in enumerate(found) if ids is None]
            if not all(map(_whole, map(parts.__getitem__, missed))):
                parts = SAFE_BLANK.split(text)
                found = [(), *map(self.memo.get, parts[1:])]
                missed = [i for i, ids in enumerate(found) if ids is None]
            for i in missed:
                found[i] = self.memo.get(parts[i]) or (self._learn(parts[i]) if _whole(parts[i]) else tuple(self.pieces(" " + parts[i])))
        if not _whole(parts[0]) and len(parts) > 1:
            parts, found = SAFE_BLANK.split(text), []
            found = [(), *(self.memo.get(p) or self.pieces(" " + p) for p in parts[1:])]
        return [*self.pieces(parts[0]), *itertools.chain.from_iterable(found)]

    def forget(self) -> None:
        """Drops what was remembered, at the end of a task: the worker lives on, for tasks of other kinds."""
        self.memo, self.old = {}, {}

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


def _whole(part: str) -> bool:
    """False if the part is empty or has a blank at an end, next to the one at which it was cut."""
    return part != "" and not part[0].isspace() and not part[-1].isspace()


@functools.cache
def load(path: str, pattern: str) -> Codec:
    """The codec of a rank file; once for each worker."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
    return Codec(ranks, pattern)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _settings(path: str | None, pattern: str | None) -> tuple[str, str]:
    return path or tokenizer_file("byte_bpe_50k.tiktoken"), pattern or default_pattern()


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and token ids (array<int>) of every document."""
    path, pattern = _settings(path, pattern)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [codec.encode(text.as_py() or "") for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        codec.forget()

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Id and the bytes of every row of encode_documents(); null ids count as none."""
    path, pattern = _settings(path, pattern)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = [codec.decode(ids.as_py() or []) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.binary())], ["doc_id", "raw"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, raw binary")


def round_trip_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every document in one pass; returns counts and digests of both.

    A worker keeps what it remembers for its next tasks, below about 75 MB."""
    path, pattern = _settings(path, pattern)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path, pattern)
        shown = {i: str(i) for i in codec.words}
        for batch in batches:
            counts, digests, decoded = [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py() or "")
                counts.append(len(ids))
                digests.append(hashlib.sha256(" ".join(map(shown.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
