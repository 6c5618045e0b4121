import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from genoloom.llm import media


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=800))
def test_lossless(text):
    row = media.media_row(text)
    data = text.encode()
    payload = media.from_wav(row["media"])
    assert payload[: len(data)] == data and not any(payload[len(data) :])
    assert len(payload) % 64 == 0 and len(payload) >= 64 and row["media_bytes"] == 44 + len(payload)


def brute(samples):
    """The same fingerprint frame by frame with plain loops."""
    signal = samples.astype(float) - 128
    signal = np.concatenate([signal, np.zeros(max(0, media.FRAME - len(signal)))])
    best = []
    for at in range(0, len(signal) - media.FRAME + 1, media.HOP):
        power = np.abs(np.fft.rfft(signal[at : at + media.FRAME] * np.hanning(media.FRAME))) ** 2
        best.append([(max(range(a, b), key=lambda i: (power[i], -i)), max(power[a:b])) for a, b in media.BANDS])
    peaks = []
    for t in range(len(best)):
        for k in range(len(media.BANDS)):
            near = [best[u][k][1] for u in range(max(0, t - media.REACH), min(len(best), t + media.REACH + 1)) if u != t]
            if best[t][k][1] > 1e-3 and all(best[t][k][1] > p for p in near):
                peaks.append((t, best[t][k][0]))
    pairs = [
        (t, f << 20 | g << 8 | u - t)
        for i, (t, f) in enumerate(peaks)
        for u, g in peaks[i + 1 : i + 1 + media.FAN]
        if u - t < 256
    ]
    return sorted(pairs)


def test_fingerprint_matches_plain_loops():
    samples = np.random.default_rng(1).integers(0, 256, 6000).astype(np.uint8)
    times, codes = media.fingerprint(samples)
    assert list(zip(times.tolist(), codes.tolist())) == brute(samples)


def test_edge_rows(spark):
    rows = [(1, None, 7), (2, "", 8), (3, "a" * 70_000, 9), (4, "a" * 70_000, 9)]
    got = media.add_media(spark.createDataFrame(rows, "doc_id long, text string, FEATURE long")).orderBy("doc_id").collect()
    assert got[0].media == got[1].media and got[0].n_bytes == 0 and got[0].payload_bytes == 64
    assert got[2].feature == got[3].feature and len(got[2].times) == len(got[2].codes)
    assert media.add_media(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_last_frame_counts():
    rng = np.random.default_rng(2)
    for size in (320, 448, 64 * 47):  # 64 bytes beyond the last whole frame
        head = "".join(map(chr, rng.integers(32, 127, size - 64)))
        ends = ["".join(map(chr, rng.integers(32, 127, 64))) for _ in range(4)]
        rows = [media.media_row(head + end) for end in ends]
        assert all(r["payload_bytes"] == size for r in rows) and len({r["feature"] for r in rows}) > 1  # peaks are few: some ends agree
        samples = np.frombuffer(media.from_wav(rows[0]["media"]), np.uint8)
        assert list(zip(rows[0]["times"].tolist(), rows[0]["codes"].tolist())) == brute(np.append(samples, np.full(64, 128, np.uint8)))
    for size in (1, 64, 255, 256, 257, 384, 385):
        padded = media.framed(np.arange(size).astype(np.uint8))
        assert len(padded) >= size and (len(padded) - media.FRAME) % media.HOP == 0 and len(padded) - size < max(media.FRAME, media.HOP)
