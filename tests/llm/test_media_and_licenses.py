import hashlib
import io
import wave
import zlib

import numpy as np

from lexloom.llm import licenses, media


def test_round_trip(messy, pairs):
    got = media.media_round_trip(messy).collect()
    want = []
    for i, t in pairs:
        data = (t or "").encode()
        padded = data + b"\xff" * (576 * max(1, -(-len(data) // 576)) - len(data))
        want.append((i, len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]), len(padded) + 44))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes)) for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.payload_sha256, (r.feature, r.media_sha256)) == (r.feature, r.media_sha256)
        assert len(r.pair_times) == len(r.pair_codes) and list(r.pair_times) == sorted(r.pair_times)


def test_empty_table(nothing):
    assert media.media_round_trip(nothing).count() == 0
    assert licenses.scan(nothing).count() == 0


def test_wav_is_a_wav():
    payload = bytes(range(256)) * 9
    with wave.open(io.BytesIO(media.wav_bytes(payload))) as w:
        assert (w.getnchannels(), w.getsampwidth(), w.readframes(w.getnframes())) == (1, 1, payload)


def test_peaks_find_a_tone():
    t = np.arange(5760)
    tone = (128 + 100 * np.sin(2 * np.pi * t * 50 / media.FRAME)).astype(np.uint8)
    times, codes = media.peak_pairs(tone)
    assert len(times) and 50 in set((codes >> 15).tolist())
    later, again = media.peak_pairs(np.concatenate([np.full(2880, 128, np.uint8), tone]))
    assert len(set(codes.tolist()) & set(again.tolist())) > 0 and later.min() >= 8


def plain_pairs(samples):
    """Peak pairs frame by frame, by a plain transform."""
    x = [float(v) - 128 for v in samples] + [0.0] * max(0, media.FRAME - len(samples))
    window = np.hanning(media.FRAME)
    top = []
    for f in range((len(x) - media.FRAME) // media.HOP + 1):
        power = np.abs(np.fft.rfft(np.array(x[f * media.HOP : f * media.HOP + media.FRAME]) * window))
        top.append([(int(np.argmax(power[lo:hi])) + lo, max(power[lo:hi])) for lo, hi in zip(media.BANDS, media.BANDS[1:])])
    peaks = []
    for f, bands in enumerate(top):
        for k, (freq, high) in enumerate(bands):
            beside = [top[g][k][1] for g in (f - 1, f + 1) if 0 <= g < len(top)]
            if high > 0 and all(high >= b for b in beside):
                peaks.append((f, freq))
    peaks.sort()
    return sorted((t, (a << 15) | (b << 5) | (u - t)) for i, (t, a) in enumerate(peaks) for u, b in peaks[i + 1 : i + 1 + media.FAN_OUT] if u - t <= media.REACH)


def test_pairs_equal_a_plain_transform_in_any_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    for n in (576, 577, 5760, 40_000):
        samples = rng.integers(0, 256, n).astype(np.uint8)
        want = plain_pairs(samples)
        for chunk in (1024, 7, 1):
            monkeypatch.setattr(media, "CHUNK", chunk)
            times, codes = media.peak_pairs(samples)
            assert list(zip(times.tolist(), codes.tolist())) == want


def test_a_long_text_needs_little_memory():
    import tracemalloc

    samples = np.random.default_rng(2).integers(32, 127, 20_000_000).astype(np.uint8)
    tracemalloc.start()
    media.peak_pairs(samples)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(samples)


def brute_scan(text, threshold):
    import re

    best = []
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if text is not None else ""
    units = {" ".join(re.findall("[a-z0-9]+", u)) for u in [*low.split("\n"), *re.split(r"\n *\n", re.sub(r"[^a-z0-9\n]+", " ", low))]}
    seen = 0
    for unit in units:
        grams = set(licenses.bigrams(unit))
        scores = [(-2 * len(grams & set(g)) / (len(grams) + len(g)), name) for name, g in licenses.template_rows() if grams]
        near = [s for s in scores if -s[0] >= threshold]
        seen += bool(near)
        best += near
    if not best:
        return None, 0.0, 0
    return min(best)[1], round(-min(best)[0], 6), seen


def test_scan_equals_brute_force(spark, messy):
    mit = licenses.TEMPLATES["MIT"][2]
    texts = [
        None, "", "no licence here", "Released under the MIT License.", "foo\n  RELEASED under the - MIT license!!\nbar", "Released under the XYZ License.",
        f"intro\n\n{mit[:200]}\n{mit[200:]}\n\nend", mit.replace("Software", "Program", 2), " ".join(mit.split()[:40]), "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.",
        "Licensed under the Apache License, Version 2.0. and more words that dilute it", "a b\n" * 50, "Licensed under CC BY-SA 4.0",
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x"), (None, texts[3], "x")], "doc_id long, text string, license string")
    got = sorted(map(repr, map(tuple, licenses.scan(df).collect())))
    assert got == sorted(repr((i, *brute_scan(t, licenses.THRESHOLD))) for i, t in [*enumerate(texts), (3, texts[3]), (None, texts[3])])
    assert licenses.scan(messy).count() == messy.count()


def test_signals_miss_no_match():
    rows = licenses.template_rows()
    signals = set(licenses.signal_bigrams(rows, 0.8))
    for _, grams in rows:
        shared = -(-len(grams) * 8 // 12)  # the least that a match shares: 0.8 / 1.2 of the template
        rest = [g for g in grams if g not in signals]
        assert len(rest) < shared
