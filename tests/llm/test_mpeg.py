import hashlib
import random
import struct
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from conftest_llm import documents

from tarnlab.llm import mpeg


def padded(content):
    return content + b"\xff" * (max(1, -(-len(content) // 576)) * 576 - len(content))


def test_documents(docs):
    got = mpeg.digests(mpeg.read(mpeg.store(docs))).collect()
    expected = Counter()
    for i, t in documents():
        p = padded((t or "").encode())
        expected[i, len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == expected
    assert len({(r.feature, r.media_sha256) for r in got if r.doc_id in (2, 10)}) == 1


def test_empty(no_docs, spark):
    assert mpeg.read(mpeg.store(no_docs)).count() == 0
    assert mpeg.read(spark.createDataFrame([(1, None)], "doc_id long, media binary")).first().frames == 0


@pytest.mark.parametrize("content", [b"", b"x", bytes(range(256)) * 9, b"\xff" * 5000, b"\xff\xf3\xd8\xc0" * 400])
def test_round_trip(content):
    data = mpeg.encode(content)
    s = mpeg.parse(data)
    assert mpeg.payload_of(data, s) == padded(content)
    assert s.tags["content_bytes"] == str(len(content))
    assert s.tags["payload_sha256"] == hashlib.sha256(padded(content)).hexdigest()
    assert (s.table["frames"], s.table["bytes"]) == (len(s.offsets), 648 * (len(s.offsets) + 1))
    assert s.checked == len(s.offsets) + 1 and not s.bad_crc and not s.skipped
    assert s.duration == Fraction(576 * len(s.offsets), 16000)
    assert s.seek(0) == s.offsets[0] and s.seek(1e9) is None
    if len(s.offsets) > 2:
        assert s.seek(0.036 * 2.5) == s.offsets[2]


def test_checksum_is_the_formats():
    assert mpeg.crc16(b"123456789") == 0xAEE7  # CRC-16 with 0x8005, from 0xFFFF


def test_resynchronises_after_foreign_bytes():
    content = bytes(range(256)) * 9
    data = mpeg.encode(content)
    s = mpeg.parse(data)
    at = s.offsets[2]
    junk = b"\xff\xfbnoise\xff" * 9
    t = mpeg.parse(data[:at] + junk + data[at:])
    assert len(t.offsets) == len(s.offsets) and t.skipped == len(junk) and t.resyncs == 1
    lost = mpeg.parse(data[: at + 10] + data[at + 30 :])  # a frame that lost bytes
    assert len(lost.offsets) >= len(s.offsets) - 2 and lost.resyncs >= 1


def test_damage_is_counted():
    data = bytearray(mpeg.encode(bytes(3000)))
    s = mpeg.parse(bytes(data))
    data[s.offsets[1] + 7] ^= 1
    assert mpeg.parse(bytes(data)).bad_crc == 1


def test_id3v1_and_other_headers():
    frame = struct.pack(">I", 0x7FF << 21 | 3 << 19 | 1 << 17 | 1 << 16 | 9 << 12) + bytes(413)  # MPEG-1, 128 kbit/s, 44.1 kHz, no checksum
    tag = b"TAG" + b"Title".ljust(30, b"\0") + bytes(95)
    s = mpeg.parse(frame * 4 + tag)
    assert (len(s.offsets), s.checked, s.tags["v1:title"]) == (4, 0, "Title")
    assert s.duration == Fraction(4 * 1152, 44100)


def test_vbri():
    first = bytearray(struct.pack(">I", 0x7FF << 21 | 3 << 19 | 1 << 17 | 1 << 16 | 9 << 12) + bytes(413))
    first[36:62] = b"VBRI" + bytes(6) + struct.pack(">IIHHHH", 999, 3, 2, 10, 2, 1)
    first[62:66] = struct.pack(">HH", 4, 5)
    plain = bytes(first[:4]) + bytes(413)
    s = mpeg.parse(bytes(first) + plain * 3)
    assert s.table == {"kind": "VBRI", "bytes": 999, "frames": 3, "toc": [40, 50]} and len(s.offsets) == 3


def test_any_bytes():
    rng = random.Random(4)
    for _ in range(300):
        mpeg.parse(bytes(rng.choice([255, 251, 243, 0, rng.randrange(256)]) for _ in range(rng.randrange(3000))))


@pytest.mark.parametrize("content", [b"x" * 505 + b"TAG", b"x" * 505 + b"TAG" + b"y" * 68, b"x" * (576 * 3 + 505) + b"TAG!"])
def test_text_that_looks_like_a_tag(content):
    test_round_trip(content)
    data = mpeg.encode(content)
    assert not [t for t in mpeg.parse(data).tags if t.startswith("v1:")]
    tag = b"TAG" + b"Title".ljust(30, b"\0") + bytes(95)
    s = mpeg.parse(data + tag)  # and a real one behind it
    assert mpeg.payload_of(data, s) == padded(content) and s.tags["v1:title"] == "Title" and not s.skipped
    cut = mpeg.parse(data[:-40] + tag)  # a last frame cut short doesn't reach into the tag
    assert len(cut.offsets) == len(s.offsets) - 1 and cut.skipped == 608 and cut.tags["v1:title"] == "Title"


@pytest.mark.parametrize(
    "layer, version, bits, rate, samples, size",
    [(1, 3, 9, 0, 384, 4 * (12 * 288_000 // 44_100)), (1, 0, 5, 2, 384, 4 * (12 * 80_000 // 8_000)), (2, 3, 9, 1, 1152, 144 * 160_000 // 48_000), (2, 2, 8, 0, 1152, 144 * 64_000 // 22_050)],
)
def test_other_layers(layer, version, bits, rate, samples, size):
    frame = struct.pack(">I", 0x7FF << 21 | version << 19 | (4 - layer) << 17 | 1 << 16 | bits << 12 | rate << 10).ljust(size, b"\0")
    s = mpeg.parse(b"junk" + frame * 5)
    assert s.offsets == [4 + size * k for k in range(5)] and s.skipped == 4 and s.checked == 0
    assert s.duration == Fraction(5 * samples, mpeg.RATES[version][rate])
    assert mpeg.payload_of(b"junk" + frame * 5, s) == b""  # frames that encode didn't write hold nothing of it


def test_layer_one_checksum():
    head, allocation = struct.pack(">I", 0x7FF << 21 | 3 << 19 | 3 << 17 | 9 << 12 | 3 << 6), bytes(range(16))
    frame = bytearray((head + mpeg.crc16(head[2:] + allocation).to_bytes(2, "big") + allocation).ljust(4 * (12 * 288_000 // 44_100), b"\0"))
    s = mpeg.parse(bytes(frame) * 3)
    assert (len(s.offsets), s.checked, s.bad_crc) == (3, 3, 0)
    damaged = bytearray(bytes(frame) * 3)
    damaged[10] ^= 1
    assert mpeg.parse(bytes(damaged)).bad_crc == 1


@pytest.mark.parametrize("mark", [b"TAG", b"ID3\4\0\0\0\0\0\x7f", b"Xing", b"Info", b"VBRI", b"\xff\xf3\xd8\xc0", b"\xff\xfb\x90\x00"])
def test_marks_at_every_place(mark):
    for at in range(576):
        for tail in (b"", b"b" * 100):
            content = b"a" * at + mark + tail
            data = mpeg.encode(content)
            s = mpeg.parse(data)
            assert mpeg.payload_of(data, s) == padded(content) and s.tags["content_bytes"] == str(len(content)) and not s.skipped, at
