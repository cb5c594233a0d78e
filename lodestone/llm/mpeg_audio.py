"""Media columns holding MPEG audio: frame parsing with resynchronisation, tags, VBR tables, checksums, durations, seek offsets.

``probe`` reads any MPEG-1/2/2.5 layer I-III stream. ``store_payload`` makes a valid silent layer III stream that carries
bytes losslessly as ancillary data: side information of zero leaves each frame's main data unused, and 192 bytes go there.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lodestone.llm.common import small_batches, table

#: Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by (version 1?, layer) and index, Hz by version and index.
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
UNIT = 192
FRAME = 240
SIDE = 17
SEEK_EVERY = 16


@lru_cache(maxsize=4096)
def header(four: bytes) -> tuple | None:
    """(version, layer, kbit/s, Hz, channels, protected, frame bytes, samples) of a frame header; None if it isn't one."""
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    version, layer = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3)
    rate, hz = four[2] >> 4, four[2] >> 2 & 3
    if version == 1 or layer == 4 or rate in (0, 15) or hz == 3 or four[3] & 3 == 2:
        return None
    kbit, hertz, pad = BITRATES[version == 3, layer][rate], RATES[version][hz], four[2] >> 1 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or version == 3 else 576
    size = (12 * kbit * 1000 // hertz + pad) * 4 if layer == 1 else samples // 8 * kbit * 1000 // hertz + pad
    return version, layer, kbit, hertz, 1 if four[3] >> 6 == 3 else 2, not four[1] & 1, size, samples


@lru_cache(maxsize=4096)
def crc16(data: bytes) -> int:
    """The frame checksum: polynomial 0x8005 from 0xFFFF, most significant bit first."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005) & 0xFFFF if crc & 0x8000 else crc << 1
    return crc


def side_bytes(version: int, channels: int) -> int:
    return (17 if channels == 1 else 32) if version == 3 else (9 if channels == 1 else 17)


def crc_of_bits(data: bytes, at: int, bits: int, crc: int) -> int:
    for i in range(bits):
        top = crc >> 15 ^ data[at + (i >> 3)] >> 7 - (i & 7) & 1
        crc = (crc << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    return crc


def layer2_widths(version: int, kbit: int, hertz: int, channels: int) -> list[int]:
    """Bits of allocation by subband: fixed values of ISO/IEC 11172-3 tables B.2a to B.2d and 13818-3 table B.1."""
    if version != 3:
        return [4] * 4 + [3] * 7 + [2] * 19
    each = kbit // channels
    if each in (32, 48):
        return [4, 4] + [3] * (10 if hertz == 32000 else 6)
    return [4] * 11 + [3] * 12 + [2] * (4 if hertz == 48000 or each in (56, 64, 80) else 7)


def guarded_bits(data: bytes, at: int, h: tuple) -> int:
    """How many bits after the checksum it covers: side information in layer III, allocation in I, that and the scale factors' selection in II."""
    version, layer, kbit, hertz, channels, *_ = h
    if layer == 3:
        return 8 * side_bytes(version, channels)
    mode, bound = data[at + 3] >> 6, 4 * ((data[at + 3] >> 4 & 3) + 1)
    if layer == 1:
        return 4 * 32 if channels == 1 else 4 * (bound + 32) if mode == 1 else 8 * 32
    widths, pos, used = layer2_widths(version, kbit, hertz, channels), 8 * (at + 6), 0
    for band, width in enumerate(widths):
        own = 1 if channels == 1 or mode == 1 and band >= bound else 2
        for _ in range(own):
            if (pos + width + 7) >> 3 > len(data):
                return 8 * len(data)
            value = int.from_bytes(data[pos >> 3 : (pos >> 3) + 2].ljust(2, b"\0"), "big") >> 16 - width - (pos & 7) & (1 << width) - 1
            used += (channels if own == 1 else 1) if value else 0
            pos += width
    return pos - 8 * (at + 6) + 2 * used


def checksum(data: bytes, at: int, h: tuple) -> bool | None:
    """Whether a protected frame's checksum holds; None without one. Bits missing at the stream's end make it bad."""
    if not h[5]:
        return None
    bits = guarded_bits(data, at, h)
    if at + 6 + (bits + 7) // 8 > len(data):
        return False
    want = struct.unpack_from(">H", data, at + 4)[0]
    if bits % 8 == 0:
        return crc16(data[at + 2 : at + 4] + data[at + 6 : at + 6 + bits // 8]) == want
    return crc_of_bits(data, at + 6, bits, crc16(data[at + 2 : at + 4])) == want


def id3(data: bytes) -> tuple[int, dict[str, str]]:
    """Where audio starts after ID3v2 tags, and their text frames."""
    at, tags = 0, {}
    while data[at : at + 3] == b"ID3" and len(data) >= at + 10:
        major = data[at + 3]
        size = sum((b & 127) << 7 * (3 - i) for i, b in enumerate(data[at + 6 : at + 10]))
        pos, end = at + 10, min(at + 10 + size, len(data))
        head, letters = (6, 3) if major == 2 else (10, 4)  # version 2.2 has short frame heads
        while pos + head <= end and data[pos : pos + 1].isalnum():
            name = data[pos : pos + letters].decode("latin-1")
            n = int.from_bytes(data[pos + 3 : pos + 6], "big") if major == 2 else struct.unpack_from(">I", data, pos + 4)[0] if major < 4 else sum((b & 127) << 7 * (3 - i) for i, b in enumerate(data[pos + 4 : pos + 8]))
            body = data[pos + head : min(pos + head + n, end)]
            if name.startswith("T") and body:
                text = body[1:].decode({1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1"), "replace")
                k, _, v = text.partition("\0") if name in ("TXXX", "TXX") else (name, "", text)
                tags[k] = v.rstrip("\0")
            pos += head + n
        at = min(at + 10 + size + (10 if data[at + 5] & 16 else 0), len(data))
    return at, tags


def vbr_table(data: bytes, at: int, h: tuple) -> dict | None:
    """The Xing, Info or VBRI table in the frame at a place: kind, frames, bytes, toc; what a short frame cuts off is None."""
    end = min(len(data), at + h[6])
    number = lambda pos: struct.unpack_from(">I", data, pos)[0] if pos + 4 <= end else None
    x = at + 4 + 2 * h[5] + side_bytes(h[0], h[4])
    if x + 4 <= end and data[x : x + 4] in (b"Xing", b"Info"):
        flags, pos, out = number(x + 4) or 0, x + 8, {"kind": data[x : x + 4].decode(), "frames": None, "bytes": None, "toc": None}
        for bit, name in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[name] = number(pos)
                pos += 4
        if flags & 4 and pos + 100 <= end:
            out["toc"] = list(data[pos : pos + 100])
        return out
    if at + 40 <= end and data[at + 36 : at + 40] == b"VBRI":
        return {"kind": "VBRI", "frames": number(at + 50), "bytes": number(at + 46), "toc": None}
    return None


def frames(data: bytes, at: int = 0) -> Iterator[tuple[int, tuple]]:
    """(offset, header) of each frame. After damage, the next frame is one that another of its kind, or the end, follows."""
    synced, size = False, len(data)
    while True:
        h = header(data[at : at + 4])
        if h and at + h[6] <= size:
            nxt = at + h[6]
            if not synced:
                n = header(data[nxt : nxt + 4])
                ok = nxt == size or data[nxt : nxt + 3] == b"TAG" or n and (n[0], n[1], n[3]) == (h[0], h[1], h[3])
            if synced or ok:
                yield at, h
                at, synced = nxt, True
                continue
        synced = False
        at = data.find(b"\xff", at + 1)
        if at < 0:
            return


def probe(data: bytes, seek_every: int = SEEK_EVERY) -> dict:
    """What a stream holds. Duration is exact: each frame's samples over its own rate, without the table's frame; bytes that are no frame count as damaged. rate is the last frame's."""
    at, tags = id3(data)
    out = {"tags": tags, "vbr": None, "frames": 0, "samples": 0, "rate": None, "channels": None, "layer": None, "version": None, "crc_ok": 0, "crc_bad": 0, "seek": [], "damaged": 0, "kbits": set()}
    end, by_rate = at, {}
    for i, (pos, h) in enumerate(frames(data, at)):
        out["damaged"] += pos - end
        end = pos + h[6]
        if i == 0 and (found := vbr_table(data, pos, h)):
            out["vbr"] = found
            continue
        ok = checksum(data, pos, h)
        out["crc_ok"] += ok is True
        out["crc_bad"] += ok is False
        if out["frames"] % seek_every == 0:
            out["seek"].append(pos)
        out["frames"] += 1
        out["samples"] += h[7]
        by_rate[h[3]] = by_rate.get(h[3], 0) + h[7]
        out["kbits"].add(h[2])
        out["version"], out["layer"], out["rate"], out["channels"] = h[0], h[1], h[3], h[4]
    out["damaged"] += len(data) - end - (128 if data[-128:-125] == b"TAG" and len(data) - end >= 128 else 0)
    out["duration"] = sum((Fraction(n, rate) for rate, n in by_rate.items()), Fraction(0))
    return out


_HEAD = bytes([0xFF, 0xFA, 0x64, 0xC4])  # version 1, layer III, protected, 80 kbit/s, 48 kHz, one channel
_FRONT = _HEAD + struct.pack(">H", crc16(_HEAD[2:] + bytes(SIDE))) + bytes(SIDE)


def store_payload(text: bytes) -> bytes:
    """A stream that carries text, padded by spaces to a positive multiple of UNIT; its length goes into the ID3v2 tag."""
    n = max(1, -(-len(text) // UNIT))
    body = np.zeros((n, FRAME), dtype=np.uint8)
    body[:, : len(_FRONT)] = np.frombuffer(_FRONT, np.uint8)
    body[:, len(_FRONT) : len(_FRONT) + UNIT] = np.frombuffer(text.ljust(n * UNIT, b" "), np.uint8).reshape(n, UNIT)
    note = b"\0payload-bytes\0" + str(len(text)).encode()
    frame = b"TXXX" + struct.pack(">IH", len(note), 0) + note
    tag = b"ID3\x03\0\0" + bytes(len(frame) >> s & 127 for s in (21, 14, 7, 0)) + frame
    toc = bytes(256 * i // 100 for i in range(100))
    info = (_FRONT + b"Info" + struct.pack(">III", 7, n, (n + 1) * FRAME) + toc).ljust(FRAME, b"\0")
    return tag + info + body.tobytes()


def load_payload(data: bytes) -> tuple[bytes, int]:
    """The padded payload of store_payload's stream, and its length without padding."""
    at, tags = id3(data)
    got = [data[p + len(_FRONT) : p + len(_FRONT) + UNIT] for i, (p, h) in enumerate(frames(data, at)) if not (i == 0 and vbr_table(data, p, h))]
    return b"".join(got), int(tags["payload-bytes"])


MEDIA = "media binary, duration_num long, duration_den long, n_frames long, sample_rate int, channels int, layer int, vbr_kind string, crc_ok long, crc_bad long, damaged_bytes long, seek_every int, seek_offsets array<long>"
DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_row(data: bytes) -> tuple:
    """A media column's values for MEDIA."""
    p = probe(data)
    return (data, p["duration"].numerator, p["duration"].denominator, p["frames"], p["rate"], p["channels"], p["layer"], p["vbr"] and p["vbr"]["kind"], p["crc_ok"], p["crc_bad"], p["damaged"], SEEK_EVERY, p["seek"])


_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]


def to_media(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, MEDIA) of each row's text as a stored stream: null is empty; repeated rows stay; other columns are left out."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [media_row(store_payload((t or "").encode())) for t in batch.column(1).to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_TYPES)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, _TYPES, strict=True))], [key, *(x.split()[0] for x in MEDIA.split(", "))])

    return docs.select(key, text).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, {MEDIA}")


def payload_digest(media: DataFrame, key: str) -> DataFrame:
    """Reads the payload back from the stored bytes of to_media's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for m, num, den, n, rate, layer, kind, ok, bad, damaged, seek in zip(*(batch.column(i).to_pylist() for i in range(1, 12)), strict=True):
                payload, size = load_payload(m)
                feature = f"layer{layer} {rate}Hz frames={n} duration={num}/{den} table={kind} crc={ok}/{ok + bad} damaged={damaged} seek={zlib.crc32(np.asarray(seek, '<i8').tobytes())}"
                out.append((size, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature))
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    cols = [key, "media", "duration_num", "duration_den", "n_frames", "sample_rate", "layer", "vbr_kind", "crc_ok", "crc_bad", "damaged_bytes", "seek_offsets"]
    return media.select(*cols).mapInArrow(run, DIGEST.replace("doc_id long", f"{key} {media.schema[key].dataType.simpleString()}"))


def op9_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as a stored stream, and what reading it back gives."""
    return payload_digest(to_media(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id")


QUERIES = {"op9_mpeg_audio": op9_mpeg_audio}
ORACLE: dict[str, str] = {}
