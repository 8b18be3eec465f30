"""MPEG audio columns: frame headers, tags, variable-bitrate tables, checksums, durations and seek offsets.

A reader finds the frames of MPEG-1/2/2.5 streams of Layers I, II and III again after
damage or foreign bytes: a sync word counts only if its header is valid and the next frame
(or the end) follows where the header says. Free-format frames, whose headers don't state a
bitrate, are foreign bytes; the checksums of Layer II, whose reach depends on its
allocation tables, are not verified. A writer stores bytes losslessly as
ancillary data of silent frames: MPEG-2, 16 kHz, mono, 144 kbit/s, so one frame of
648 bytes holds one unit of 576 bytes, a byte for each of its 576 samples.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Fixed values of the format (ISO 11172-3, 13818-3): kbit/s by layer, of MPEG-1 or else, and Hz.
BITRATES = {
    (1, True): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (2, True): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (3, True): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (1, False): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, False): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (3, False): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}

UNIT = 576
PAD = 255
_HEADER = struct.pack(">I", 0x7FF << 21 | 2 << 19 | 1 << 17 | 0 << 16 | 13 << 12 | 2 << 10 | 3 << 6)
_FRAME, _SIDE = 648, 9
_DATA = 4 + 2 + _SIDE


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 8
        for _ in range(8):
            c = (c << 1 ^ 0x8005 if c & 0x8000 else c << 1) & 0xFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def crc16(data: bytes, crc: int = 0xFFFF) -> int:
    for b in data:
        crc = (crc << 8 ^ _CRC[crc >> 8 ^ b]) & 0xFFFF
    return crc


@dataclass(frozen=True)
class Header:
    version: int  # 3: MPEG-1, 2: MPEG-2, 0: MPEG-2.5
    protected: bool
    bitrate: int
    rate: int
    mono: bool
    size: int
    layer: int = 3

    @property
    def samples(self) -> int:
        return 384 if self.layer == 1 else 1152 if self.layer == 2 or self.version == 3 else 576

    @property
    def side(self) -> int:
        return (17 if self.mono else 32) if self.version == 3 else (9 if self.mono else 17)


_KNOWN: dict[int, Header | None] = {}


def header(word: int) -> Header | None:
    """The frame header in 32 bits, or None if they aren't one."""
    key = word & 0xFFFFFFC0  # what follows the channel mode doesn't matter here
    if key in _KNOWN:
        return _KNOWN[key]
    version, layer = word >> 19 & 3, word >> 17 & 3
    bits, rate = word >> 12 & 15, word >> 10 & 3
    found = None
    if word >> 21 == 0x7FF and version != 1 and layer and 0 < bits < 15 and rate < 3:
        layer, padded = 4 - layer, word >> 9 & 1
        kbit, hz = BITRATES[layer, version == 3][bits], RATES[version][rate]
        if layer == 1:
            size = 4 * (12 * kbit * 1000 // hz + padded)
        else:
            size = (72 if layer == 3 and version != 3 else 144) * kbit * 1000 // hz + padded
        found = Header(version, not word >> 16 & 1, kbit, hz, word >> 6 & 3 == 3, size, layer)
    if len(_KNOWN) > 10_000:
        _KNOWN.clear()
    _KNOWN[key] = found
    return found


@dataclass
class Stream:
    """What a reader finds. offsets: of each audio frame; skipped: bytes that belong to no frame or tag."""

    tags: dict[str, str] = field(default_factory=dict)
    table: dict = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)
    headers: list[Header] = field(default_factory=list)
    checked: int = 0
    bad_crc: int = 0
    skipped: int = 0
    resyncs: int = 0

    @property
    def duration(self) -> Fraction:
        """Seconds, exactly."""
        return sum((Fraction(n, hz) for hz, n in self._samples().items()), Fraction(0))

    def _samples(self) -> dict[int, int]:
        out: dict[int, int] = {}
        for h in self.headers:
            out[h.rate] = out.get(h.rate, 0) + h.samples
        return out

    def seek(self, seconds: float) -> int | None:
        """Offset of the frame that plays at a time."""
        at = Fraction(0)
        for h, offset in zip(self.headers, self.offsets, strict=True):
            at += Fraction(h.samples, h.rate)
            if seconds < at:
                return offset
        return None


def _synchsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _id3v2(data: bytes, out: Stream) -> int:
    """Read leading ID3v2 tags; the place after them."""
    at = 0
    while data[at : at + 3] == b"ID3" and len(data) >= at + 10 and max(data[at + 6 : at + 10]) < 128:
        end = at + 10 + _synchsafe(data[at + 6 : at + 10])
        major, i = data[at + 3], at + 10
        while major in (3, 4) and i + 10 <= min(end, len(data)) and data[i : i + 1].isalnum():
            size = _synchsafe(data[i + 4 : i + 8]) if major == 4 else int.from_bytes(data[i + 4 : i + 8], "big")
            name, body = data[i : i + 4].decode("latin-1"), data[i + 10 : i + 10 + size]
            if name.startswith("T") and body:
                coding = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1")
                parts = body[1:].decode(coding, "replace").split("\0")
                if name == "TXXX" and len(parts) > 1:
                    out.tags[parts[0]] = parts[1]
                else:
                    out.tags[name] = parts[0]
            i += 10 + size
        at = end
    return min(at, len(data))


def _table(frame: bytes, h: Header) -> dict:
    """The variable-bitrate table in a frame, if it has one."""
    for shift in (0, 2 * h.protected):  # some writers leave the checksum's place out of account
        at = 4 + shift + h.side
        if frame[at : at + 4] in (b"Xing", b"Info"):
            flags = int.from_bytes(frame[at + 4 : at + 8], "big")
            out: dict = {"kind": frame[at : at + 4].decode()}
            at += 8
            for bit, name, size in ((1, "frames", 4), (2, "bytes", 4), (4, "toc", 100), (8, "quality", 4)):
                if flags & bit:
                    part = frame[at : at + size]
                    out[name] = list(part) if name == "toc" else int.from_bytes(part, "big")
                    at += size
            return out
    if frame[36:40] == b"VBRI":
        size, count, scale, width = (int.from_bytes(frame[i : i + n], "big") for i, n in ((46, 4), (54, 2), (56, 2), (58, 2)))
        frames = int.from_bytes(frame[50:54], "big")
        toc = [scale * int.from_bytes(frame[62 + k * width : 62 + (k + 1) * width], "big") for k in range(count)]
        return {"kind": "VBRI", "bytes": size, "frames": frames, "toc": toc}
    return {}


def _word(data: bytes, at: int) -> Header | None:
    return header(int.from_bytes(data[at : at + 4], "big")) if at + 4 <= len(data) else None


def parse(data: bytes) -> Stream:
    """Read a stream; never fails, whatever the bytes are."""
    out = Stream()
    at, end = _id3v2(data, out), len(data)
    tag = end - 128 if end - at >= 128 and data[end - 128 : end - 125] == b"TAG" else end
    synced, first = False, True
    while at < tag:
        h = _word(data, at)
        if h and at + h.size <= end:
            after = at + h.size
            follows = _word(data, after)
            same = after in (tag, end) or (follows is not None and (follows.version, follows.layer, follows.rate) == (h.version, h.layer, h.rate))
            if after > tag:  # a frame in its place that others or the end follow holds these bytes: they are no tag
                sound = same and (synced or not out.skipped)
            else:
                sound = same or synced and h.protected and _crc_holds(data, at, h) is True  # foreign bytes may follow a sound frame
            if sound:
                tag = tag if after <= tag else end
                frame = data[at:after]
                holds = _crc_holds(data, at, h) if h.protected else None
                if holds is not None:
                    out.checked += 1
                    out.bad_crc += not holds
                table = _table(frame, h) if first and h.layer == 3 else {}
                if table:
                    out.table = table
                else:
                    out.offsets.append(at)
                    out.headers.append(h)
                at, synced, first = after, True, False
                continue
        was = at
        at = data.find(b"\xff", at + 1, tag)
        at = tag if at < 0 else at
        out.skipped += at - was
        out.resyncs += synced
        synced = False
    if tag < end:
        for name, a, n in (("title", 3, 30), ("artist", 33, 30), ("album", 63, 30), ("year", 93, 4)):
            if text := data[tag + a : tag + a + n].split(b"\0")[0].decode("latin-1").strip():
                out.tags.setdefault(f"v1:{name}", text)
    return out


def _crc_holds(data: bytes, at: int, h: Header) -> bool | None:
    """Whether a protected frame's checksum holds; None for Layer II.

    It covers half the header and the side information (Layer III), or the bit
    allocation: four bits for each subband and channel, once for joint ones (Layer I).
    """
    if h.layer == 2:
        return None
    covered = h.side
    if h.layer == 1:
        mode, bound = data[at + 3] >> 6, 4 * ((data[at + 3] >> 4 & 3) + 1)
        covered = (32 if h.mono else 32 + bound if mode == 1 else 64) // 2
    found = data[at + 2 : at + 4] + data[at + 6 : at + 6 + covered]
    return crc16(found) == int.from_bytes(data[at + 4 : at + 6], "big")


_START = _HEADER + crc16(_HEADER[2:] + bytes(_SIDE)).to_bytes(2, "big") + bytes(_SIDE)


def _text_frame(name: str, value: str) -> bytes:
    body = b"\3" + name.encode() + b"\0" + value.encode()
    n = len(body)
    return b"TXXX" + bytes((n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127)) + b"\0\0" + body


def encode(content: bytes) -> bytes:
    """A stream that holds the bytes, padded with PAD to a positive multiple of UNIT.

    An ID3v2.4 tag holds their number and digest, an Info frame the counts and the seek table.
    """
    units = max(1, -(-len(content) // UNIT))
    payload = content + bytes([PAD]) * (units * UNIT - len(content))
    tag = _text_frame("content_bytes", str(len(content))) + _text_frame("payload_sha256", hashlib.sha256(payload).hexdigest())
    n = len(tag)
    frames = np.zeros((units, _FRAME), np.uint8)
    frames[:, :_DATA] = np.frombuffer(_START, np.uint8)
    frames[:, _DATA : _DATA + UNIT] = np.frombuffer(payload, np.uint8).reshape(units, UNIT)
    whole = (units + 1) * _FRAME
    toc = bytes(min(255, 256 * (1 + units * k // 100) * _FRAME // whole) for k in range(100))
    info = _START + b"Info" + struct.pack(">III", 7, units, whole) + toc
    return (
        b"ID3\4\0\0" + bytes((n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127)) + tag
        + info.ljust(_FRAME, b"\0") + frames.tobytes()
    )


def payload_of(data: bytes, s: Stream) -> bytes:
    """The padded bytes that a stream from encode holds: those of frames with just its header, which no other has."""
    return b"".join(data[at + _DATA : at + _DATA + UNIT] for at in s.offsets if data[at : at + 4] == _HEADER)


STREAM_FIELDS = (
    "media binary, content_bytes long, payload binary, frames long, duration_num long, duration_den long, "
    "checked long, bad_crc long, skipped long, resyncs long, table_frames long, offsets array<long>"
)


def store(df: DataFrame) -> DataFrame:
    """The text of every row of df (doc_id, text) as a stream: doc_id, media.

    A null text is empty; a very long one is stored whole. Repeated rows stay; an empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    common.small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_rows(batches):
            media = [encode((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(media, pa.binary())], names=["doc_id", "media"])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, media binary")


def read(df: DataFrame) -> DataFrame:
    """Parse the streams of df (doc_id, media).

    Null media are streams without frames. content_bytes is null without its tag.
    The duration is exact, as a fraction of seconds. Repeated rows stay; an empty
    table gives an empty result; other columns are ignored.
    """
    common.small_batches(df.sparkSession)
    long = pa.int64()
    schema = pa.schema(
        [("doc_id", long), ("media", pa.binary()), ("content_bytes", long), ("payload", pa.binary())]
        + [(c, long) for c in ("frames", "duration_num", "duration_den", "checked", "bad_crc", "skipped", "resyncs", "table_frames")]
        + [("offsets", pa.list_(long))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column("media").to_pylist():
                s = parse(data or b"")
                n, d = s.tags.get("content_bytes", ""), s.duration
                rows.append(
                    (int(n) if n.isdigit() else None, payload_of(data or b"", s), len(s.offsets), d.numerator, d.denominator,
                     s.checked, s.bad_crc, s.skipped, s.resyncs, s.table.get("frames"), s.offsets)
                )
            columns = zip(*rows, strict=True) if rows else [()] * 11
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("media"), *arrays], schema=schema)

    return df.select("doc_id", "media").mapInArrow(run, f"doc_id long, {STREAM_FIELDS}")


def digests(df: DataFrame) -> DataFrame:
    """Checksums and features of rows from read()."""
    feature = F.concat_ws(
        ";",
        *[
            F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("none")))
            for c in ("frames", "duration_num", "duration_den", "checked", "bad_crc", "skipped", "resyncs", "table_frames")
        ],
        F.concat(F.lit("seek="), F.md5(F.concat_ws(",", F.transform("offsets", lambda x: x.cast("string"))))),
    )
    return df.select(
        "doc_id",
        F.col("content_bytes").alias("n_bytes"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
    )
