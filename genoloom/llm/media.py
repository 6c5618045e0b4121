"""Media columns: bytes stored as 8-bit WAV, read back by the ``wave`` module, transformed by a
short-time Fourier transform and reduced to spectral-peak pair fingerprints.

A fingerprint is two aligned arrays: ``times`` (frame of the first peak) and ``codes``
(``f1 << 20 | f2 << 8 | dt``), so that a match between two recordings is a constant time offset of
equal codes. Peaks are kept per band where a band's loudest bin also beats the same band's loudest
bins within ``REACH`` frames; pairs join each peak with the next ``FAN`` ones in time.

Defined results: a null or empty text is one block of zero bytes (one silent WAV without peaks);
a payload that ends inside a frame is followed by silence up to the frame's end; ties go to the lower bin and the
earlier frame; equal bytes give equal columns; columns of the input keep their place and those named like an output
column are replaced.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type, batch_with, documents, extended, pieces

RATE = 8000
BLOCK = 64
FRAME, HOP = 256, 128
BANDS = ((2, 12), (12, 30), (30, 66), (66, 129))
REACH = 3
FAN = 3
#: Frames transformed at once; a very long recording is never one matrix.
FRAMES_AT_ONCE = 4096


def padded(data: bytes) -> bytes:
    """``data`` with zero bytes up to a positive multiple of ``BLOCK``."""
    return data + bytes(max(BLOCK, -(-len(data) // BLOCK) * BLOCK) - len(data))


def to_wav(payload: bytes) -> bytes:
    """A mono 8-bit WAV file whose samples are ``payload``."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(data: bytes) -> bytes:
    """The sample bytes of an 8-bit WAV file."""
    with wave.open(io.BytesIO(data), "rb") as w:
        if w.getsampwidth() != 1:
            raise ValueError("only 8-bit WAV files hold bytes")
        return w.readframes(w.getnframes())


def band_peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each frame and band the loudest bin and its power."""
    signal = samples.astype(np.float32) - 128.0
    if len(signal) < FRAME:
        signal = np.concatenate([signal, np.zeros(FRAME - len(signal), np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP]
    window = np.hanning(FRAME).astype(np.float32)
    bins = np.empty((len(frames), len(BANDS)), np.int32)
    power = np.empty((len(frames), len(BANDS)), np.float32)
    for at in range(0, len(frames), FRAMES_AT_ONCE):
        spectrum = np.fft.rfft(frames[at : at + FRAMES_AT_ONCE] * window, axis=1)
        loud = spectrum.real**2 + spectrum.imag**2
        for k, (low, high) in enumerate(BANDS):
            part = loud[:, low:high]
            best = part.argmax(axis=1)
            bins[at : at + len(part), k] = best + low
            power[at : at + len(part), k] = part[np.arange(len(part)), best]
    return bins, power


def framed(samples: np.ndarray) -> np.ndarray:
    """``samples`` with silence up to whole frames, so that ``fingerprint`` leaves none of them out."""
    size = FRAME + max(0, -(-(len(samples) - FRAME) // HOP)) * HOP
    return np.concatenate([samples, np.full(size - len(samples), 128, np.uint8)])


def fingerprint(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Times and codes of the peak pairs of one recording."""
    bins, power = band_peaks(samples)
    peak = power > 1e-3
    n = len(power)
    for d in range(1, min(REACH, n - 1) + 1):
        peak[d:] &= power[d:] > power[:-d]
        peak[:-d] &= power[:-d] >= power[d:]
    times, bands = np.nonzero(peak)  # by time, then band
    freqs = bins[times, bands]
    out_t, out_c = [], []
    for k in range(1, FAN + 1):
        gap = times[k:] - times[:-k]
        near = gap < 256
        out_t.append(times[:-k][near])
        out_c.append((freqs[:-k][near] << 20) | (freqs[k:][near] << 8) | gap[near])
    t, c = np.concatenate(out_t), np.concatenate(out_c)
    order = np.lexsort((c, t))
    return t[order].astype(np.int32), c[order].astype(np.int32)


#: What ``add_media`` can add, with its types.
OUTPUTS = {
    "media": "binary",
    "times": "array<int>",
    "codes": "array<int>",
    "n_bytes": "bigint",
    "payload_bytes": "bigint",
    "payload_sha256": "string",
    "tail_crc32": "bigint",
    "media_bytes": "bigint",
    "media_sha256": "string",
    "feature": "string",
}


def media_row(text: str | None) -> dict:
    """Every output for one text; payload and features come from the stored bytes read back."""
    data = (text or "").encode()
    media = to_wav(padded(data))
    payload = from_wav(media)
    times, codes = fingerprint(framed(np.frombuffer(payload, np.uint8)))
    digest = hashlib.sha256(times.astype("<i4").tobytes() + codes.astype("<i4").tobytes()).hexdigest()
    return {
        "media": media,
        "times": times,
        "codes": codes,
        "n_bytes": len(data),
        "payload_bytes": len(payload),
        "payload_sha256": hashlib.sha256(payload).hexdigest(),
        "tail_crc32": zlib.crc32(payload[-BLOCK:]),
        "media_bytes": len(media),
        "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": f"{len(codes)}:{digest}",
    }


def add_media(df: DataFrame, text: str = "text", outputs: tuple[str, ...] = tuple(OUTPUTS)) -> DataFrame:
    """``df`` with the chosen ``outputs`` for its column ``text``; rows and other columns stay."""
    fields = [(name, OUTPUTS[name]) for name in outputs]
    schema = extended(df.schema, *fields)
    types = {name: arrow_type(OUTPUTS[name]) for name in outputs}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, text):
                rows = [media_row(x) for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                yield batch_with(
                    batch, **{n: pa.array([r[n] for r in rows], types[n]) for n in outputs}
                )

    return df.mapInArrow(run, schema)


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = tuple(x for x in OUTPUTS if x not in ("media", "times", "codes"))
    return add_media(documents(spark, sf_dir, "doc_id", "text"), outputs=outputs).select(
        "doc_id", *map(F.col, outputs)
    )
