"""Media columns: WAV payloads, short-time Fourier transforms and spectral-peak pair fingerprints."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged, text_column
from .shipping import ship
from .simhash import slices

UNIT = 576
RATE = 8000
FRAME, HOP = 576, 288
#: Edges of the bands, in frequency bins, of which each frame can give one peak.
BANDS = (2, 12, 36, 96, 289)
#: A peak is paired with so many peaks after it, at most so many frames later.
FAN_OUT, REACH = 3, 16
#: Frames transformed at once, so that a very long text needs little more than itself.
CHUNK = 1024


def wav_bytes(payload: bytes, rate: int = RATE) -> bytes:
    """A mono WAV file whose 8-bit samples are the payload's bytes."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def wav_samples(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        if r.getsampwidth() != 1 or r.getnchannels() != 1:
            raise ValueError("a mono file of 8-bit samples is expected")
        return r.readframes(r.getnframes())


def stft(samples: np.ndarray, first: int = 0, frames: int | None = None) -> np.ndarray:
    """Magnitudes of ``frames`` frames from ``first`` on (all there are), one row a frame.

    There is one frame at least: short input is padded with silence.
    """
    every = max(0, len(samples) - FRAME) // HOP + 1
    last = every if frames is None else min(every, first + frames)
    x = samples[first * HOP : (last - 1) * HOP + FRAME].astype(np.float64) - 128.0
    if len(x) < FRAME:
        x = np.concatenate([x, np.zeros(FRAME - len(x))])
    return np.abs(np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP] * np.hanning(FRAME), axis=1))


def _strongest(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each frame's strongest bin in each band and its magnitude, some frames at a time."""
    every = max(0, len(samples) - FRAME) // HOP + 1
    best, top = np.empty((every, len(BANDS) - 1), np.int64), np.empty((every, len(BANDS) - 1))
    for at in range(0, every, CHUNK):
        power = stft(samples, at, CHUNK)
        for k, (lo, hi) in enumerate(zip(BANDS[:-1], BANDS[1:], strict=True)):
            part = power[:, lo:hi]
            own = part.argmax(axis=1)
            best[at : at + len(part), k], top[at : at + len(part), k] = own + lo, part[np.arange(len(part)), own]
    return best, top


def peak_pairs(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Times (frame numbers) and codes of spectral-peak pairs, in order of time.

    A frame's strongest bin in a band is a peak if it is no weaker than the strongest in the frames beside
    it.  A code holds the bins of both peaks and the frames between them: ``bin1 << 15 | bin2 << 5 | dt``.
    """
    best, every = _strongest(samples)
    at, bins = [], []
    for k in range(len(BANDS) - 1):
        top = np.concatenate([[-1.0], every[:, k], [-1.0]])
        peak = np.flatnonzero((top[1:-1] >= top[:-2]) & (top[1:-1] >= top[2:]) & (top[1:-1] > 0))
        at.append(peak)
        bins.append(best[peak, k])
    time, freq = np.concatenate(at), np.concatenate(bins)
    order = np.lexsort((freq, time))
    time, freq = time[order], freq[order]
    times, codes = [], []
    for step in range(1, FAN_OUT + 1):
        dt = time[step:] - time[:-step]
        near = np.flatnonzero(dt <= REACH)
        times.append(time[near])
        codes.append((freq[near] << 15) | (freq[near + step] << 5) | dt[near])
    t, c = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((c, t))
    return t[order].astype(np.int32), c[order].astype(np.int32)


def media_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, media``: every text's UTF-8 bytes, padded with 255 to a positive multiple of 576, as WAV."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch):
                part = batch.slice(a, b - a)
                raw = [t.as_py().encode("utf-8", "surrogatepass") for t in part.column(1)]
                media = [wav_bytes(x + b"\xff" * (UNIT * max(1, -(-len(x) // UNIT)) - len(x))) for x in raw]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], names=["id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_column(text_col).alias("text"))
    return rows.mapInArrow(store, "id long, n_bytes long, media binary")


def media_features(table: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Reads the stored files back, one row each.

    id, ``n_bytes, payload_bytes, payload_sha256, tail_crc32`` (of the last 32 payload bytes), ``media_bytes,
    media_sha256``, ``feature`` (frames, pairs and a digest of the arrays), ``pair_times, pair_codes``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, column=2):
                out = []
                for i, n, media in zip(*(batch.slice(a, b - a).column(k).to_pylist() for k in range(3)), strict=True):
                    payload = wav_samples(media)
                    t, c = peak_pairs(np.frombuffer(payload, np.uint8))
                    digest = hashlib.sha256(t.tobytes() + c.tobytes()).hexdigest()
                    feature = f"{max(0, len(payload) - FRAME) // HOP + 1}:{len(t)}:{digest[:32]}"
                    out.append((i, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, t, c))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=_NAMES)

    return table.mapInArrow(read, ", ".join(f"{n} {k}" for n, k in zip(_NAMES, ("long",) * 3 + ("string", "long", "long", "string", "string", "array<int>", "array<int>"), strict=True))).withColumnRenamed("id", id_col)


_NAMES = ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pair_times", "pair_codes"]


def media_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as WAV in a media column, read it back from the table and describe it.

    Null text is empty and stored as 576 bytes of 255.  Each row stands for itself, also where ids repeat or
    are null; equal texts give equal values.  An empty table gives none; other columns are not read.
    """
    ship(docs.sparkSession)
    return media_features(staged(media_table(docs, id_col, text_col), "media"), id_col)
