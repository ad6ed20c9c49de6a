import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skjald.llm import bpe, huffman, queries
from tests.llm.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from([*" \n\t'sxéß漢1,.\x1c\x85 \U0001f600"]), max_size=30))
def test_codec_is_the_librarys(text):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load(PATH, public_tokenizers.PATTERN).ranks, special_tokens={})
    codec = bpe.load(PATH, public_tokenizers.PATTERN)
    ids = codec.encode(text)
    assert ids == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_perfect_hash():
    keys = [str(i).encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(map(table.find, keys)) == list(range(5000))
    assert table.find(b"missing") == -1
    assert bpe.PerfectHash([]).find(b"") == -1


def test_long_pieces(library):
    codec = bpe.load(PATH, public_tokenizers.PATTERN)
    for text in ("a" * 3000, " " * 3000, "ab" * 2000 + "\n" * 50, "!" * 999):
        assert codec.encode(text) == library.encode_ordinary(text)


def check_round_trip(rows, texts, library):
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()


def test_bpe_operator(spark, documents, empty, texts, library):
    rows = bpe.round_trip_documents(documents).collect()
    assert len(rows) == documents.count()
    check_round_trip([r for r in rows if r.doc_id is not None], dict(enumerate(texts)), library)
    encoded = bpe.encode_documents(documents)
    decoded = bpe.decode_documents(encoded).filter("doc_id is not null").collect()
    assert all(bytes(r.raw) == (texts[r.doc_id] or "").encode() for r in decoded)
    assert bpe.round_trip_documents(empty).count() == bpe.encode_documents(empty).count() == 0


def test_bpe_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op7_byte_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    check_round_trip(rows, docs, library)


def test_code_lengths():
    rng = np.random.default_rng(1)
    for n, bits in ((1, 4), (2, 1), (5, 3), (16, 4), (17, 5), (200, 9), (300, 16)):
        counts = np.zeros(1 << 16, np.int64)
        counts[rng.choice(1 << 16, n, replace=False)] = rng.integers(1, 1 << 40, n) >> rng.integers(0, 39, n)
        counts[counts < 0] = 1
        n = int((counts > 0).sum())
        lengths = huffman.code_lengths(counts, bits)
        used = lengths[lengths > 0].astype(float)
        assert len(used) == n and used.max() <= bits
        assert n == 1 or (2.0**-used).sum() == 1
    counts = np.array([1, 1, 2, 4, 8])
    assert huffman.code_lengths(counts, 16).tolist() == [4, 4, 3, 2, 1]
    assert (counts * huffman.code_lengths(counts, 3)).sum() == 8 * 1 + (1 + 1 + 2 + 4) * 3


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 65535), min_size=1, max_size=300), min_size=1, max_size=8))
def test_blocks_round_trip(docs):
    ids = np.concatenate([np.array(x, "<u2") for x in docs])
    sizes = np.array([len(x) for x in docs])
    book = huffman.Codebook(huffman.code_lengths(np.bincount(ids, minlength=1 << 16)))
    lanes, payloads = zip(*book.encode(ids, sizes), strict=True)
    assert book.decode(sizes, list(lanes), list(payloads)).tolist() == ids.tolist()


def wanted(docs):
    """Rows of the contract by the library alone."""
    tokenizer, out, start = Tokenizer.from_file(JSON), [], 0
    for doc_id, text in sorted(docs, key=lambda x: x[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_encoder_is_the_librarys():
    rng = random.Random(2)
    texts = ["".join(rng.choice(" \n'sxé漢1,.\x1c\x85 <|>") for _ in range(rng.randrange(25))) for _ in range(3000)]
    tokenizer = Tokenizer.from_file(JSON)
    tool = huffman.encoder(JSON)
    for _ in range(2):
        assert [np.frombuffer(x, "<u2").tolist() for x in tool.encode(texts)] == [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_file_operator(spark, documents, empty, texts, tmp_path):
    some = documents.filter("doc_id is not null").dropDuplicates(["doc_id"])
    huffman.write_files(some, str(tmp_path / "a"))
    rows = huffman.read_files(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert [tuple(r)[:4] for r in rows] == wanted(enumerate(texts))
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)
    huffman.write_files(documents, str(tmp_path / "b"))
    rows = huffman.read_files(spark, str(tmp_path / "b"), with_ids=False).orderBy("start").collect()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    huffman.write_files(empty, str(tmp_path / "c"))
    assert huffman.read_files(spark, str(tmp_path / "c")).count() == 0


def test_files_are_ascending_and_hot_ids_have_several_shards(spark, tmp_path):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i}") for i in range(900)]
    huffman.write_files(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "d"))
    files = sorted((tmp_path / "d" / "blocks").glob("*.parquet"))
    ids = [x for file in files for x in pq.read_table(file, columns=["doc_id"]).column(0).to_pylist()]
    assert ids == sorted((x for x, _ in rows), key=lambda x: (x is not None, x or 0))
    shards = {(r.doc_id, r.shard) for r in spark.read.parquet(str(tmp_path / "d" / "blocks")).filter("doc_id = 7 or doc_id is null").collect()}
    assert sum(x == 7 for x, _ in shards) > 2 and sum(x is None for x, _ in shards) > 2


def test_file_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op5_huffman_ids(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == wanted(docs)
