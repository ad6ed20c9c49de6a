"""Media columns: payloads kept as WAV bytes, their spectra, and peak-pair fingerprints.

A payload is a mono 8-bit WAV file in a binary column, written and read by the wave
module. Its fingerprint is an array of time-coded pairs of spectral peaks: the
strongest bin of each band and frame is a peak, and each peak is paired with the
other peaks of its frame and those of the next frames. All steps work row by row, without a shuffle.

Cases: a null text counts as empty, whose payload is one block of zeros; very long texts
are one file, transformed some frames at a time; of bins that are equally strong the lowest is the peak; equal texts
have equal values in every column; null and repeated ids and other columns don't
matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 64
RATE = 8000
#: Samples of a frame and from one frame to the next.
FRAME, HOP = 512, 256
#: Bounds of the bands, in bins, each with one peak a frame.
BANDS = (2, 16, 48, 112, 257)
#: Frames ahead in which each peak finds its partners.
AHEAD = 2
#: Frames transformed at a time.
FRAMES = 2048
WINDOW = np.hanning(FRAME).astype(np.float32)


def payload(text: str | None) -> bytes:
    """The text in UTF-8 with zeros up to a positive multiple of BLOCK."""
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK))


def to_wav(samples: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as file:
        file.setnchannels(1)
        file.setsampwidth(1)
        file.setframerate(RATE)
        file.writeframes(samples)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as file:
        if (file.getnchannels(), file.getsampwidth()) != (1, 1):
            raise ValueError("8-bit mono is expected")
        return file.readframes(file.getnframes())


def peaks(samples: bytes) -> np.ndarray:
    """Bin of the strongest frequency in each band (columns) of each frame (rows)."""
    x = np.frombuffer(samples, np.uint8).astype(np.float32) - 128
    n = max(1, -(-(len(x) - FRAME) // HOP) + 1)
    x = np.pad(x, (0, (n - 1) * HOP + FRAME - len(x)))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    out = np.empty((n, len(BANDS) - 1), np.int64)
    for at in range(0, n, FRAMES):
        power = np.abs(np.fft.rfft(frames[at : at + FRAMES] * WINDOW, axis=1))
        for band, (low, high) in enumerate(zip(BANDS[:-1], BANDS[1:], strict=True)):
            out[at : at + FRAMES, band] = low + power[:, low:high].argmax(1)
    return out


def fingerprints(found: np.ndarray) -> np.ndarray:
    """Pairs of peaks, sorted: frame << 20 | bin << 11 | later bin << 2 | frames between."""
    frame = np.arange(len(found))[:, None, None]
    pairs = [(frame[:-ahead] << 20 | found[:-ahead, :, None] << 11 | found[ahead:, None, :] << 2 | ahead).ravel() for ahead in range(1, AHEAD + 1) if len(found) > ahead]
    low, high = np.triu_indices(found.shape[1], 1)  # and the peaks of one frame among themselves
    pairs.append((frame[:, 0] << 20 | found[:, low] << 11 | found[:, high] << 2).ravel())
    return np.sort(np.concatenate(pairs))


def wav_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, bytes of the text, and its payload as a WAV file."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len((x or "").encode()) for x in texts], pa.int64()), pa.array([to_wav(payload(x)) for x in texts], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def read_media(media: DataFrame, with_prints: bool = True) -> DataFrame:
    """Reads the WAV bytes back: digests of payload and media, and the fingerprints.

    `feature` sums up the fingerprints: their number and a digest of them all."""
    kind = media.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "prints"][: 8 + with_prints]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for stored in part.column(2):
                    raw = stored.as_py()
                    samples = from_wav(raw)
                    prints = fingerprints(peaks(samples))
                    feature = f"{len(prints)}:{hashlib.sha256(prints.astype('<i8').tobytes()).hexdigest()}"
                    rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-BLOCK:]), len(raw), hashlib.sha256(raw).hexdigest(), feature, prints))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(x, k) for x, k in zip(columns[: len(names) - 2], kinds, strict=False))], names)

    kinds = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, kinds + ", prints array<bigint>" * with_prints)
