"""Media columns: AVI motion-JPEG.

Payload bytes become the quantised coefficients of 8x8 intra blocks (byte + 1, so that every coefficient is positive and
no zero runs occur), which baseline JPEG stores without loss. Blocks carry restart markers, so all of them decode side
by side. The reader walks the RIFF index, decodes the frames, returns the stored bytes, and cuts shots where the
histogram difference of two frames exceeds a threshold that adapts to the shot so far.

Defined results: a null text is the empty text, whose payload is one block of zeros; equal payloads give equal media and
features (all arithmetic is exact), also in repeated rows, which are stored each for itself; a null doc_id stays null; a
text of any length is one file; further columns are not looked at, whatever their names; media that are null or not such
a file give nulls with the reason in ``error``, and leave the files beside them alone; an empty table gives no rows. The
reader knows grey baseline frames with a restart marker after every block, as they are written here.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.core import load

BLOCK = 64
WIDE, HIGH = 8, 4  # blocks of a frame
PER_FRAME = WIDE * HIGH
FPS = 25
AT_ONCE = 1 << 14  # blocks coded together
BINS = 16
FLOOR, SPREAD, WINDOW = 0.08, 2.5, 8

#: Huffman code lengths 1, 2, ... go to these coefficient sizes, most frequent first in text.
SIZES_BY_LENGTH = (7, 6, 8, 4, 5, 3, 2, 1, 9)
#: The zigzag order runs along the anti-diagonals, turning at each.
ZIGZAG = np.array([r * 8 + c for r, c in sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))])
#: The inverse DCT in whole numbers: doubles hold all its products and sums exactly.
SCALE = 1 << 10
BASIS = np.array([[round(SCALE * (np.sqrt(1 / 8) if u == 0 else 0.5) * np.cos((2 * x + 1) * u * np.pi / 16)) for x in range(8)] for u in range(8)], "f8")


def _bit_rows() -> tuple[np.ndarray, np.ndarray]:
    """For each byte, and for 0 to 7 bits of padding: its bits, and which of the columns hold bits."""
    bits, used = np.zeros((264, 18), "u1"), np.zeros((264, 18), bool)
    for byte in range(256):
        size = (byte + 1).bit_length()
        n = SIZES_BY_LENGTH.index(size) + 1
        row = "1" * (n - 1) + "0" + format(byte + 1, "b")
        bits[byte, : len(row)], used[byte, : len(row)] = [int(b) for b in row], True
    for n in range(8):
        bits[256 + n, :n], used[256 + n, :n] = 1, True
    return bits, used


BITS, USED = _bit_rows()
LENGTH = USED.sum(axis=1).astype("i4")


def _jpeg_head() -> bytes:
    segment = lambda marker, body: struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body
    lengths = bytes([1] * len(SIZES_BY_LENGTH) + [0] * (16 - len(SIZES_BY_LENGTH)))
    return (
        b"\xff\xd8"
        + segment(0xDB, b"\x00" + b"\x01" * 64)
        + segment(0xC0, struct.pack(">BHHB3B", 8, HIGH * 8, WIDE * 8, 1, 1, 0x11, 0))
        + segment(0xC4, b"\x00" + lengths + bytes(SIZES_BY_LENGTH) + b"\x10" + lengths + bytes(SIZES_BY_LENGTH))
        + segment(0xDD, struct.pack(">H", 1))
        + segment(0xDA, bytes([1, 1, 0, 0, 63, 0]))
    )


JPEG_HEAD = _jpeg_head()


def scans(blocks: np.ndarray) -> list[bytes]:
    """The entropy-coded data of each frame of ``blocks`` (frames x PER_FRAME, 64 bytes each)."""
    n = len(blocks)
    rows = np.empty((n, BLOCK + 1), "i4")
    rows[:, :BLOCK] = blocks
    length = LENGTH[blocks].sum(axis=1)
    rows[:, BLOCK] = 256 + -length % 8
    coded = np.packbits(BITS[rows].reshape(-1)[USED[rows].reshape(-1)])
    ends = np.cumsum((length + 7) // 8)
    nth = np.arange(n) % PER_FRAME
    extra = (coded == 0xFF).astype("i8")
    marked = nth < PER_FRAME - 1
    extra[ends[marked] - 1] += 2
    at = np.arange(len(coded)) + np.cumsum(extra) - extra
    out = np.zeros(len(coded) + int(extra.sum()), "u1")
    out[at] = coded
    after = at[ends - 1] + 1 + (coded[ends - 1] == 0xFF)
    out[after[marked]] = 0xFF
    out[after[marked] + 1] = 0xD0 + nth[marked] % 8
    data, bounds = out.tobytes(), [0, *after[PER_FRAME - 1 :: PER_FRAME].tolist()]
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK))


def chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\x00" * (len(body) % 2)


def avi_of(frames: list[bytes], n_blocks: int) -> bytes:
    """A RIFF file of JPEG frames with its index; the number of payload blocks stands among its INFO chunks."""
    most = max(map(len, frames))
    header = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, len(frames), 0, 1, most, WIDE * 8, HIGH * 8, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<10I4H", 0, 0, 0, 1, FPS, 0, len(frames), most, 0xFFFFFFFF, 0, 0, 0, WIDE * 8, HIGH * 8)
    bitmap = struct.pack("<IiiHH4sIiiII", 40, WIDE * 8, HIGH * 8, 1, 24, b"MJPG", WIDE * HIGH * 192, 0, 0, 0, 0)
    hdrl = chunk(b"LIST", b"hdrl" + chunk(b"avih", header) + chunk(b"LIST", b"strl" + chunk(b"strh", stream) + chunk(b"strf", bitmap)))
    info = chunk(b"LIST", b"INFO" + chunk(b"ICMT", b"blocks=%d\x00" % n_blocks))
    movi, index, at = [], [], 4
    for f in frames:
        movi.append(chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(movi[-1])
    return chunk(b"RIFF", b"AVI " + hdrl + info + chunk(b"LIST", b"movi" + b"".join(movi)) + chunk(b"idx1", b"".join(index)))


def encode(payloads: list[bytes]) -> list[bytes]:
    """One AVI file for each payload (whose length is a positive multiple of 64)."""
    out: list[bytes] = []
    per = PER_FRAME * BLOCK
    padded = [p + bytes(-len(p) % per) for p in payloads]
    data = np.frombuffer(b"".join(padded), "u1").reshape(-1, BLOCK)
    step = AT_ONCE // PER_FRAME * PER_FRAME
    coded = [JPEG_HEAD + s + b"\xff\xd9" for k in range(0, len(data), step) for s in scans(data[k : k + step])]
    at = 0
    for p, q in zip(payloads, padded):
        n = len(q) // per
        out.append(avi_of(coded[at : at + n], len(p) // BLOCK))
        at += n
    return out


def chunks(data: bytes, start: int, end: int):
    """(id, start, end) of the chunks between two places."""
    while start + 8 <= end:
        name, n = data[start : start + 4], struct.unpack_from("<I", data, start + 4)[0]
        if start + 8 + n > end:
            raise ValueError(f"chunk {name!r} runs over its parent")
        yield name, start + 8, start + 8 + n
        start += 8 + n + n % 2


def riff_frames(data: bytes) -> tuple[list[bytes], int, float]:
    """The frames that the index names, the number of payload blocks, and the seconds of a frame."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    index, movi, blocks, seconds = None, None, None, 1 / FPS
    for name, a, b in chunks(data, 12, min(len(data), 8 + struct.unpack_from("<I", data, 4)[0])):
        kind = data[a : a + 4]
        if name == b"LIST" and kind == b"movi":
            movi = a
        elif name == b"LIST" and kind == b"hdrl":
            seconds = next(struct.unpack_from("<I", data, x)[0] / 1e6 for n, x, _ in chunks(data, a + 4, b) if n == b"avih")
        elif name == b"LIST" and kind == b"INFO":
            said = next((data[x:y] for n, x, y in chunks(data, a + 4, b) if n == b"ICMT"), b"")
            blocks = int(m[1]) if (m := re.match(rb"blocks=(\d+)", said)) else None
        elif name == b"idx1":
            index = [struct.unpack_from("<4sIII", data, x) for x in range(a, b - 15, 16)]
    if index is None or movi is None or blocks is None:
        raise ValueError("no index, frames or block count")
    return [data[movi + at + 8 : movi + at + 8 + n] for name, _, at, n in index if name[2:] == b"dc"], blocks, seconds


def read_jpeg(frame: bytes) -> tuple[tuple, np.ndarray]:
    """What the headers of a grey baseline frame say (tables, blocks), and its scan."""
    at, tables, blocks, restart, quant = 2, {}, 0, 0, b""
    while True:
        if frame[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker, n = frame[at + 1], struct.unpack_from(">H", frame, at + 2)[0]
        body, at = frame[at + 4 : at + 2 + n], at + 2 + n
        if marker == 0xC0:
            high, wide, parts = struct.unpack_from(">HHB", body, 1)
            if parts != 1:
                raise ValueError("only grey frames are read")
            blocks = -(-high // 8) * -(-wide // 8)
        elif marker == 0xDB:
            quant = body[1:65]
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xC4:
            x = 0
            while x < len(body):
                n_codes = sum(body[x + 1 : x + 17])
                tables[body[x]] = bytes(body[x + 1 : x + 17 + n_codes])
                x += 17 + n_codes
        elif marker == 0xDA:
            break
        elif 0xC1 <= marker <= 0xCF:
            raise ValueError("only baseline frames are read")
    if restart != 1:
        raise ValueError("a restart marker is needed after every block")
    return (tables[0x00], tables[0x10], bytes(quant), blocks), np.frombuffer(frame, "u1")[at:-2]


def peek_table(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For any 16 bits: the length of the code they begin with (0: none), and its symbol."""
    length, symbol, code, at = np.zeros(1 << 16, "u1"), np.zeros(1 << 16, "u1"), 0, 16
    for n in range(1, 17):
        for _ in range(table[n - 1]):
            a = code << (16 - n)
            length[a : a + (1 << (16 - n))], symbol[a : a + (1 << (16 - n))] = n, table[at]
            code, at = code + 1, at + 1
        code <<= 1
    return length, symbol


_PEEKS: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}


def peek(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    if table not in _PEEKS:
        _PEEKS[table] = peek_table(table)
    return _PEEKS[table]


def coefficients(scan: np.ndarray, dc: bytes, ac: bytes) -> np.ndarray:
    """The 64 quantised coefficients, in zigzag order, of every block of a scan with a restart marker between any two."""
    after_ff = np.zeros(len(scan), bool)
    after_ff[1:] = scan[:-1] == 0xFF
    stuffed = after_ff & (scan == 0)
    marker = after_ff & (scan >= 0xD0) & (scan <= 0xD7)
    keep = ~(stuffed | marker)
    keep[:-1] &= ~marker[1:]
    kept_before = np.cumsum(keep) - keep
    bit = np.concatenate([[0], kept_before[marker]]) * 8
    data = np.concatenate([scan[keep], np.full(8, 0xFF, "u1")]).astype("u4")
    word = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    last = len(word) - 1
    out = np.zeros((len(bit), BLOCK), "i4")
    lane, k = np.arange(len(bit)), np.zeros(len(bit), "i8")
    (dc_length, dc_symbol), (ac_length, ac_symbol) = peek(dc), peek(ac)
    for step in range(BLOCK):
        lengths, symbols = (ac_length, ac_symbol) if step else (dc_length, dc_symbol)
        window = word[np.minimum(bit >> 3, last)] << (bit & 7).astype("u4")
        head = window >> 16
        n, s = lengths[head], symbols[head]
        if not n.all():
            raise ValueError("a code is not in its table")
        size, run = s & 15, s >> 4
        bit = bit + n
        value = (word[np.minimum(bit >> 3, last)] << (bit & 7).astype("u4")).astype("i8") >> (32 - size.astype("i8")) & 0xFFFFFFFF
        bit = bit + size
        value = np.where((size > 0) & (value >> np.maximum(size, 1) - 1 == 0), value - (1 << size.astype("i8")) + 1, value)
        at = k + run
        done = (size == 0) & (run != 15) & (step > 0)
        if (at[~done] >= BLOCK).any():
            raise ValueError("a block has too many coefficients")
        if done.any():
            live = ~done
            out[lane[live], at[live]] = np.where(size > 0, value, 0)[live]
            lane, k, bit = lane[live], at[live] + 1, bit[live]
        else:
            out[lane, at] = np.where(size > 0, value, 0)
            k = at + 1
        if (k >= BLOCK).all():
            break
        if (k >= BLOCK).any():
            live = k < BLOCK
            lane, k, bit = lane[live], k[live], bit[live]
    return out


def pixels(coefs: np.ndarray, quant: bytes) -> np.ndarray:
    """The samples of every block, by an exact inverse DCT with the results rounded and clipped to 0..255."""
    natural = np.zeros((len(coefs), BLOCK), "f8")
    natural[:, ZIGZAG] = coefs * np.frombuffer(quant, "u1").astype("i4")
    half = natural.reshape(-1, 8) @ BASIS
    whole = half.reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, 8) @ BASIS
    whole = whole.reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, BLOCK)
    return np.clip(np.floor(whole / (SCALE * SCALE) + 128.5), 0, 255).astype("u1")


def histograms(samples: np.ndarray, blocks: int) -> np.ndarray:
    """Counts by frame (of ``blocks`` blocks each) and brightness bin."""
    frames = len(samples) // blocks
    key = (samples // (256 // BINS)).reshape(frames, -1).astype("i4") + np.arange(frames, dtype="i4")[:, None] * BINS
    return np.bincount(key.reshape(-1), minlength=frames * BINS).reshape(frames, BINS)


def shots(hist: np.ndarray) -> list[tuple[int, int]]:
    """(first frame, frames) of each shot: a cut is where the difference leaves the mean and spread of the shot's last ones."""
    if not len(hist):
        return []
    change = np.abs(np.diff(hist, axis=0)).sum(axis=1) / (2 * hist[0].sum())
    firsts, recent = [0], []
    for k, d in enumerate(change.tolist(), 1):
        mean = sum(recent) / len(recent) if recent else d
        spread = (sum((x - mean) ** 2 for x in recent) / len(recent)) ** 0.5 if recent else 0.0
        if d > max(FLOOR, mean + SPREAD * spread) and len(recent) >= 2:
            firsts.append(k)
            recent = []
        else:
            recent = [*recent[1 - WINDOW :], d]
    return [(a, b - a) for a, b in zip(firsts, [*firsts[1:], len(hist)])]


def decode(media: list[bytes | None]) -> list[dict]:
    """For each file: payload, histogram, clips, or the reason why it can't be read. Frames of like headers are decoded together."""
    out: list[dict] = []
    groups: dict[tuple, list[tuple[int, int, np.ndarray]]] = {}
    for k, data in enumerate(media):
        row = {"payload": None, "clips": None, "hist": None, "error": None, "frames": 0}
        out.append(row)
        try:
            if data is None:
                raise ValueError("no media")
            frames, row["blocks"], row["seconds"] = riff_frames(data)
            heads = [read_jpeg(f) for f in frames]
            row["parts"] = [None] * len(heads)
            for nth, (head, scan) in enumerate(heads):
                groups.setdefault(head, []).append((k, nth, scan))
        except (ValueError, IndexError, KeyError, struct.error, StopIteration) as why:
            row["error"] = str(why) or type(why).__name__
    for (dc, ac, quant, per), members in groups.items():
        step = max(1, AT_ONCE // per)
        waiting = [members[a : a + step] for a in range(0, len(members), step)]
        while waiting:
            some = waiting.pop()
            try:
                joint = np.concatenate([x for k, (_, _, scan) in enumerate(some) for x in ([np.array([0xFF, 0xD0], "u1")] * bool(k) + [scan])])
                coefs = coefficients(joint, dc, ac)
                if len(coefs) != per * len(some):
                    raise ValueError("a frame has too few or too many blocks")
                hist = histograms(pixels(coefs, quant), per)
                bytes_ = (coefs - 1).astype("u1").reshape(len(some), -1)
                for (k, nth, _), own, h in zip(some, bytes_, hist):
                    out[k]["parts"][nth] = (own.tobytes(), h)
            except (ValueError, IndexError) as why:
                if len(some) > 1:  # one by one, so that only the files that fail are marked
                    waiting += [[x] for x in some]
                else:
                    out[some[0][0]]["error"] = str(why)
    for row in out:
        parts = row.pop("parts", None)
        if row["error"] or parts is None:
            continue
        payload = b"".join(p for p, _ in parts)
        if len(payload) < row["blocks"] * BLOCK:
            row["error"] = "frames are missing"
            continue
        hist = np.array([h for _, h in parts]).reshape(-1, BINS)
        row["payload"], row["hist"], row["frames"] = payload[: row["blocks"] * BLOCK], hist.sum(axis=0).tolist(), len(parts)
        row["clips"] = [{"clip": k, "first_frame": a, "frames": n, "start_s": a * row["seconds"], "end_s": (a + n) * row["seconds"]} for k, (a, n) in enumerate(shots(hist))]
    return out


def by_bytes(values: list, least: int = 1 << 20):
    """Runs of ``values`` of about ``least`` bytes, so that memory does not follow the batch."""
    run, held = [], 0
    for v in values:
        run.append(v)
        held += len(v or b"")
        if held >= least:
            yield run
            run, held = [], 0
    if run:
        yield run


def text_to_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): every whole text stored as an AVI file."""

    def run(batches):
        for batch in batches:
            ids = batch["doc_id"]
            at = 0
            for some in by_bytes([v.as_py() for v in batch["text"]]):
                made = [payload_of(t) for t in some]
                media = encode([p for _, p in made])
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(some)), pa.array([n for n, _ in made], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])
                at += len(some)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


CLIP = pa.struct([("clip", pa.int64()), ("first_frame", pa.int64()), ("frames", pa.int64()), ("start_s", pa.float64()), ("end_s", pa.float64())])
READ = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "histogram": pa.list_(pa.int64()), "clips": pa.list_(CLIP), "error": pa.string()}


def read_media(files: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, digests of the bytes read back, brightness histogram, timed clips, error) of a table of media."""

    def run(batches):
        for batch in batches:
            at = 0
            for some in by_bytes([v.as_py() for v in batch["media"]]):
                rows = decode(some)
                for data, r in zip(some, rows):
                    p = r["payload"]
                    r |= {"payload_bytes": None if p is None else len(p), "payload_sha256": p and hashlib.sha256(p).hexdigest(), "tail_crc32": None if p is None else zlib.crc32(p[-BLOCK:])}
                    r |= {"media_bytes": None if data is None else len(data), "media_sha256": data and hashlib.sha256(data).hexdigest(), "histogram": r["hist"]}
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, len(some)), batch["n_bytes"].slice(at, len(some)), *(pa.array([r[k] for r in rows], kind) for k, kind in READ.items())], ["doc_id", "n_bytes", *READ])
                at += len(some)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, histogram array<long>, clips array<struct<clip long, first_frame long, frames long, start_s double, end_s double>>, error string"
    return files.mapInArrow(run, schema)


def clip_rows(files: DataFrame) -> DataFrame:
    """One row per shot, with its time."""
    return read_media(files).select("doc_id", F.inline("clips"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_media(text_to_media(load(spark, sf_dir, "documents")))
    spans = F.array_join(F.transform("clips", lambda c: F.concat(c["first_frame"].cast("string"), F.lit("+"), c["frames"].cast("string"))), ",")
    feature = F.concat(F.lit("shots="), spans, F.lit(";histogram="), F.array_join(F.col("histogram").cast("array<string>"), ","))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), F.size("clips").cast("long").alias("n_clips"), "error")
