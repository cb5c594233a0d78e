"""MPEG streams: any bytes, mixed rates, tables, checksums of all layers, short tag frames."""

import random
import struct
from fractions import Fraction

import public_tokenizers
import tokenizers

from lodestone.llm import mpeg_audio as m
from lodestone.llm import packing


def frame(layer, rate=0, hz=1, mode=3, body=b"", protect=False):
    head = bytes([0xFF, 0xF8 | (4 - layer) << 1 | (not protect), (rate or 5) << 4 | hz << 2, mode << 6])
    size = m.header(head)[6]
    return (head + (b"\0\0" if protect else b"") + body).ljust(size, b"\0")[:size]


def test_any_bytes():
    r = random.Random(1)
    parts = [b"Xing", b"Info", b"VBRI", b"ID3", b"ID3\x02\0\0\0\0\0\x7f", b"TAG", struct.pack(">I", 7), b"\xff\xfb\x14\xc0", b"\xff\xf3\x10\xc4", b"\xff\xfd\x54\x04", b"\xff\xff\x50\xc0", b"\xff\xfa\x64\xc4"]
    for _ in range(3000):
        data = b"".join(r.choice(parts) if r.random() < 0.6 else r.randbytes(r.randrange(60)) for _ in range(r.randrange(12)))
        found = m.probe(data)
        assert 0 <= found["damaged"] <= len(data) and found["duration"] >= 0


def test_mixed_rates():
    data = b"".join(frame(3, hz=1) for _ in range(10)) + b"".join(frame(3, hz=0) for _ in range(10))
    assert m.probe(data)["duration"] == Fraction(11520, 48000) + Fraction(11520, 44100)


def test_vbri_and_short_tables():
    first = bytearray(frame(3, rate=9))
    first[36:40], first[46:54] = b"VBRI", struct.pack(">II", 4711, 2)
    found = m.probe(bytes(first) + frame(3) * 2)
    assert found["vbr"] == {"kind": "VBRI", "frames": 2, "bytes": 4711, "toc": None} and found["frames"] == 2
    h = m.header(b"\xff\xfb\x10\xc4")
    assert m.vbr_table(b"\xff\xfb\x10\xc4" + bytes(17) + b"Xing" + struct.pack(">I", 7), 0, h)["toc"] is None


def test_checksums_of_all_layers():
    for layer in (1, 2, 3):
        for mode in (0, 1, 3):
            data = bytearray(frame(layer, rate=10, mode=mode, body=random.Random(layer).randbytes(40), protect=True))
            h = m.header(bytes(data[:4]))
            bits = m.guarded_bits(bytes(data), 0, h)
            data[4:6] = struct.pack(">H", m.crc_of_bits(bytes(data), 6, bits, m.crc16(bytes(data[2:4]))))
            assert m.checksum(bytes(data), 0, h) is True
            data[4] ^= 16
            assert m.checksum(bytes(data), 0, h) is False


def test_old_tags():
    note = b"\0Title"
    body = b"TT2" + len(note).to_bytes(3, "big") + note
    assert m.id3(b"ID3\x02\0\0" + bytes([0, 0, 0, len(body)]) + body + frame(3))[1] == {"TT2": "Title"}


def test_ids_are_those_of_tokenizers():
    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.encoder("byte_bpe_50k.tiktoken")
    for text in ("a <|endoftext|> b", "<|endoftext|>", "<|endoftext| >", "é 漢 🎉\x0b  x\n\n y", "", "it's 1234's  ''"):
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids
