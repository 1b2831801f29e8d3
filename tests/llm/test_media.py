import hashlib
import math
import random
import zlib

import numpy as np

from weftline.llm import media
from weftline.llm.media import clip_rows, decode, encode, op3_media, payload_of, read_media, shots, text_to_media

COLUMNS = "doc_id long, text string, media string, clips int"


def test_round_trip():
    rng = random.Random(1)
    payloads = [payload_of(t)[1] for t in (None, "", "a", "é" * 3000, "x" * 64)] + [bytes(rng.randrange(256) for _ in range(64 * n)) for n in (1, 31, 32, 33, 900)]
    files = encode(payloads)
    assert encode(payloads[::-1])[::-1] == files
    rows = decode(files)
    assert [r["payload"] for r in rows] == payloads and not any(r["error"] for r in rows)
    assert [r["hist"] for r in decode(files[::-1])][::-1] == [r["hist"] for r in rows]
    for r in rows:
        assert sum(c["frames"] for c in r["clips"]) == r["frames"] and r["clips"][0]["first_frame"] == 0


def test_inverse_dct_against_doubles():
    rng = np.random.default_rng(1)
    coefs = rng.integers(-200, 200, (40, 64))
    k = np.arange(8)
    basis = np.cos((2 * k[:, None] + 1) * k * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)
    for row, got in zip(coefs, media.pixels(coefs, bytes([1] * 64))):
        natural = np.zeros(64)
        natural[media.ZIGZAG] = row
        want = np.clip(basis @ natural.reshape(8, 8) @ basis.T + 128, 0, 255)
        assert np.abs(got.reshape(8, 8) - want).max() < 1.5


def test_zeros_and_runs_decode():
    """Frames of other writers may hold runs of zeros and ends of blocks."""
    dc = bytes([0, 2] + [0] * 14) + bytes([0, 2])
    ac = bytes([0, 3] + [0] * 14) + bytes([0x00, 0x21, 0xF0])
    bits = "01" + "10" + "01" + "1" + "00"  # 2; two zeros, then 1; end
    bits += "1" * (-len(bits) % 8)
    scan = np.frombuffer(int(bits, 2).to_bytes(len(bits) // 8, "big"), "u1")
    (row,) = media.coefficients(scan, dc, ac)
    assert row[0] == 2 and row[3] == 1 and abs(row).sum() == 3


def test_shots_follow_the_content():
    a, b = np.zeros(16, int), np.zeros(16, int)
    a[2], b[9] = 2048, 2048
    assert shots(np.array([a] * 6 + [b] * 5)) == [(0, 6), (6, 5)]
    assert shots(np.array([a] * 9)) == [(0, 9)] and shots(np.zeros((0, 16), int)) == []


def test_query_on_whole_table(spark):
    rows = {r.doc_id: r for r in op3_media(spark, "/root/testdata/sf0.001").collect()}
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        n, p = payload_of(d.text)
        r = rows[d.doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        (file,) = encode([p])
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest()) and r.feature


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "m", 1), (2, "", "m", 1), (2, "", "m", 1), (3, "long " * 60000, "m", 1), (None, "x", "m", 1)], COLUMNS)
    files = text_to_media(df)
    rows = read_media(files).collect()
    assert [r.payload_bytes for r in rows] == [64, 64, 64, 300032, 64] and not any(r.error for r in rows)
    assert rows[0].media_sha256 == rows[1].media_sha256 == rows[2].media_sha256
    assert clip_rows(files).count() == sum(len(r.clips) for r in rows)
    bad = spark.createDataFrame([(1, 1, None), (2, 1, b"RIFFxxxxAVI zz"), (3, 1, b"")], "doc_id long, n_bytes long, media binary")
    assert all(r.error and r.payload_sha256 is None for r in read_media(bad).collect())
    assert text_to_media(df.limit(0)).collect() == []


def brute_feature(payload):
    """Shots and histogram of a payload, sample by sample, from what the format says of its bytes."""
    zigzag = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    wave = [[round(1024 * math.sqrt((1 if u else 0.5) / 4) * math.cos((2 * x + 1) * u * math.pi / 16)) for x in range(8)] for u in range(8)]
    quant = media.read_jpeg(media.riff_frames(encode([payload])[0])[0][0])[0][2]
    data = payload + bytes(-len(payload) % (64 * 32))
    hist = []
    for f in range(0, len(data), 64 * 32):
        counts = [0] * 16
        for b in range(f, f + 64 * 32, 64):
            block = [[0] * 8 for _ in range(8)]
            for k, (r, c) in enumerate(zigzag):
                block[r][c] = (data[b + k] + 1) * quant[k]
            rows = [[sum(block[r][v] * wave[v][y] for v in range(8)) for y in range(8)] for r in range(8)]
            for x in range(8):
                for y in range(8):
                    v = sum(rows[u][y] * wave[u][x] for u in range(8))
                    counts[min(255, max(0, (2 * v + 257 * 2**20) // 2**21)) // 16] += 1
        hist.append(counts)
    cuts, recent = [0], []
    for k in range(1, len(hist)):
        d = sum(abs(a - b) for a, b in zip(hist[k], hist[k - 1])) / (2 * 64 * 32)
        if len(recent) >= 2 and d > max(0.08, np.mean(recent) + 2.5 * np.std(recent)):
            cuts, recent = [*cuts, k], []
        else:
            recent = [*recent, d][-8:]
    spans = ",".join(f"{a}+{b - a}" for a, b in zip(cuts, [*cuts[1:], len(hist)]))
    return f"shots={spans};histogram={','.join(str(sum(h[k] for h in hist)) for k in range(16))}"


def test_features_against_brute_force(spark, tmp_path):
    texts = [None, "", "short", "some words of prose " * 300, "\u00e9\u4e2d" * 900 + "0101" * 2500 + "zzzz" * 2000, "|" * 6000 + "and then a text again, with words " * 150]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in op3_media(spark, str(tmp_path)).collect()}
    for k, text in enumerate(texts):
        assert rows[k].feature == brute_feature(payload_of(text)[1]) and rows[k].error is None
    assert max(r.n_clips for r in rows.values()) > 1


def test_a_broken_file_leaves_others_alone():
    good = encode([b"a" * 640, b"b" * 640, b"c" * 640])
    broken = bytearray(good[1])
    at = good[1].index(b"\xff\xda")
    broken[at + 12 : at + 60] = bytes([0xAA, 0x55]) * 24
    rows = decode([good[0], bytes(broken), good[2]])
    assert rows[0]["payload"] == b"a" * 640 and rows[2]["payload"] == b"c" * 640 and rows[0]["error"] is rows[2]["error"] is None
    assert rows[1]["error"] or rows[1]["payload"] != b"b" * 640
