"""Media columns: MPEG audio streams in a binary column.

``store_payload`` writes bytes as an MPEG-1 layer III stream (48 kHz, mono, variable bit rate, checksummed frames): a tag
with the payload's length and checksum, a table frame with counts and seek points, then silent frames that carry
the payload in their ancillary bytes, and one frame without payload, so that no payload is where a tag may be. ``parse_stream`` reads any MPEG audio stream: tags at both ends,
resynchronisation over junk, versions 1, 2 and 2.5, layers I to III, Xing/Info and VBRI tables, layer III checksums.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the format: kbit/s by index for (version 1: layers I, II, III), (version 2 and 2.5: layer I, layers II and III).
KBPS = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 25: (11025, 12000, 8000)}


@dataclass(frozen=True)
class Header:
    version: int
    layer: int
    protected: bool
    kbps: int
    hertz: int
    mono: bool
    length: int
    samples: int

    @property
    def side(self) -> int:
        """Bytes of side information."""
        if self.layer != 3:
            return 0
        return (17 if self.mono else 32) if self.version == 1 else (9 if self.mono else 17)

    @property
    def body(self) -> int:
        """Bytes before what follows the side information."""
        return 4 + 2 * self.protected + self.side


_HEADERS: dict[bytes, Header | None] = {}


def parse_header(four: bytes) -> Header | None:
    if four in _HEADERS:
        return _HEADERS[four]
    found = None
    if len(four) == 4 and four[0] == 0xFF and four[1] & 0xE0 == 0xE0:
        version, layer = {0: 25, 2: 2, 3: 1}.get(four[1] >> 3 & 3), {1: 3, 2: 2, 3: 1}.get(four[1] >> 1 & 3)
        rate, hertz = four[2] >> 4, four[2] >> 2 & 3
        if version and layer and 0 < rate < 15 and hertz < 3:
            kbps = KBPS[(1, layer) if version == 1 else (2, min(layer, 2))][rate]
            hz, pad = HERTZ[version][hertz], four[2] >> 1 & 1
            samples = 384 if layer == 1 else 576 if layer == 3 and version != 1 else 1152
            length = (12000 * kbps // hz + pad) * 4 if layer == 1 else samples // 8 * 1000 * kbps // hz + pad
            found = Header(version, layer, not four[1] & 1, kbps, hz, four[3] >> 6 == 3, length, samples)
    if len(_HEADERS) < 100_000:
        _HEADERS[four] = found
    return found


_CRC = []
for _i in range(256):
    _c = _i << 8
    for _ in range(8):
        _c = (_c << 1 ^ 0x8005 if _c & 0x8000 else _c << 1) & 0xFFFF
    _CRC.append(_c)
_SEEN: dict[bytes, int] = {}


def frame_crc(data: bytes) -> int:
    """CRC-16 of a frame's last two header bytes and side information."""
    found = _SEEN.get(data)
    if found is None:
        found = 0xFFFF
        for b in data:
            found = found << 8 & 0xFFFF ^ _CRC[found >> 8 ^ b]
        if len(_SEEN) < 100_000:
            _SEEN[data] = found
    return found


@dataclass
class Stream:
    """What a stream holds. ``seek`` are the offsets of its audio frames; exact duration is samples / hertz seconds."""

    tags: dict[str, str] = field(default_factory=dict)
    table: str | None = None
    table_frames: int | None = None
    table_bytes: int | None = None
    toc: bytes | None = None
    #: A VBRI table's offsets from its frame, one for every ``table_step`` frames.
    table_seek: list[int] = field(default_factory=list)
    table_step: int = 0
    seek: list[int] = field(default_factory=list)
    headers: list[Header] = field(default_factory=list)
    samples: int = 0
    hertz: int = 0
    crc_good: int = 0
    crc_bad: int = 0
    junk: int = 0


def _number(data: bytes, safe: bool) -> int:
    """A big-endian number; seven bits a byte where ``safe``."""
    out = 0
    for b in data:
        out = out << 7 | b & 127 if safe else out << 8 | b
    return out


def _tag_at_start(data: bytes, out: Stream) -> int:
    """Text frames of an ID3v2.3 or 2.4 tag, with extended header and unsynchronised or not; the tag's length."""
    if data[:3] != b"ID3" or len(data) < 10:
        return 0
    size, flags, newer = _number(data[6:10], True), data[5], data[3] == 4
    tag = data[10 : 10 + size]
    if flags & 128 and not newer:
        tag = tag.replace(b"\xff\0", b"\xff")
    at = 0
    if flags & 64:  # 2.4 counts the extended header's size field, 2.3 does not
        at = _number(tag[:4], True) if newer else 4 + _number(tag[:4], False)
    while at + 10 <= len(tag) and tag[at] and data[3] >= 3:
        n = _number(tag[at + 4 : at + 8], newer)
        form, body = tag[at + 9], tag[at + 10 : at + 10 + n]
        if newer and form & 1:
            body = body[4:]  # the length before unsynchronisation
        if newer and (form & 2 or flags & 128):
            body = body.replace(b"\xff\0", b"\xff")
        name = tag[at : at + 4].decode("latin-1")
        if name[0] == "T" and body:
            text = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1"), "replace")
            key, _, value = text.partition("\0") if name == "TXXX" else (name, "", text.rstrip("\0"))
            out.tags[key] = value.rstrip("\0")
        at += 10 + n
    return 10 + size + (10 if flags & 16 else 0)


def _table(frame: bytes, h: Header, out: Stream) -> bool:
    for at in (4 + h.side, h.body):
        if frame[at : at + 4] in (b"Xing", b"Info"):
            out.table = frame[at : at + 4].decode()
            flags, at = int.from_bytes(frame[at + 4 : at + 8], "big"), at + 8
            if flags & 1:
                out.table_frames, at = int.from_bytes(frame[at : at + 4], "big"), at + 4
            if flags & 2:
                out.table_bytes, at = int.from_bytes(frame[at : at + 4], "big"), at + 4
            if flags & 4:
                out.toc = frame[at : at + 100]
            return True
    if frame[36:40] == b"VBRI":
        out.table, out.table_bytes, out.table_frames = "VBRI", _number(frame[46:50], False), _number(frame[50:54], False)
        entries, scale, width, out.table_step = (_number(frame[i : i + 2], False) for i in (54, 56, 58, 60))
        at = 0
        for i in range(entries):
            at += scale * _number(frame[62 + i * width : 62 + (i + 1) * width], False)
            out.table_seek.append(at)
        return True
    return False


def parse_stream(data: bytes) -> Stream:
    """Walk a stream's frames; empty or foreign data give a stream without frames."""
    out = Stream()
    at, end = min(_tag_at_start(data, out), len(data)), len(data)
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        out.tags.setdefault("TIT2", data[end + 3 : end + 33].rstrip(b"\0 ").decode("latin-1"))
    kind, tabled = None, False  # what the stream's frames share, once one is known

    def header(at: int) -> Header | None:
        h = parse_header(data[at : at + 4]) if at + 4 <= end else None
        return h if h and (kind is None or kind == (h.version, h.layer, h.hertz)) else None

    while at + 4 <= end:
        h = header(at)
        after = at + h.length if h else 0
        # In step: a frame ends where one of its kind begins, or where the stream does. Later frames may end in junk.
        follows = parse_header(data[after : after + 4]) if h and after + 4 <= end else None
        if h is None or after > end or (kind is None and after + 4 <= end and (follows is None or (follows.version, follows.layer, follows.hertz) != (h.version, h.layer, h.hertz))):
            to = data.find(b"\xff", at + 1, end)
            to = end if to < 0 else to
            out.junk += to - at
            at = to
            continue
        kind = (h.version, h.layer, h.hertz)
        if not tabled and not out.seek and _table(data[at : at + h.length], h, out):
            tabled, at = True, after
            continue
        if h.protected and h.layer == 3:
            good = frame_crc(data[at + 2 : at + 4] + data[at + 6 : at + h.body]) == int.from_bytes(data[at + 4 : at + 6], "big")
            out.crc_good += good
            out.crc_bad += not good
        out.seek.append(at)
        out.headers.append(h)
        out.samples += h.samples
        out.hertz = out.hertz or h.hertz
        at = after
    out.junk += max(0, end - at)
    return out


def _frame_head(kbps: int) -> bytes:
    head = bytes([0xFF, 0xFA, KBPS[1, 3].index(kbps) << 4 | 1 << 2, 0xC0])
    return head + struct.pack(">H", frame_crc(head[2:] + bytes(17))) + bytes(17)


_HEADS = {k: _frame_head(k) for k in KBPS[1, 3][1:]}
_ROOM = {k: 3 * k - 23 for k in _HEADS}  # at 48 kHz a frame has 3 bytes for each kbit/s
_MOST = _ROOM[320]


def _synchsafe(n: int) -> bytes:
    return bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127])


def store_payload(payload: bytes) -> bytes:
    """A stream that holds ``payload`` losslessly."""
    frames = [_HEADS[320] + payload[i : i + _MOST] for i in range(0, len(payload) - _MOST + 1, _MOST)]
    rest = payload[len(frames) * _MOST :]
    if rest:
        kbps = next(k for k, room in _ROOM.items() if room >= len(rest))
        frames.append((_HEADS[kbps] + rest).ljust(3 * kbps, b"\0"))
    frames.append(_HEADS[48].ljust(144, b"\0"))  # longer than an ID3v1 tag
    texts = b"".join(b"TXXX" + _synchsafe(len(t) + 1) + b"\0\0\3" + t for t in (b"payload_bytes\0%d" % len(payload), b"payload_crc32\0%d" % zlib.crc32(payload)))
    tag = b"ID3\4\0\0" + _synchsafe(len(texts)) + texts
    audio = b"".join(frames)
    total = 576 + len(audio)  # the table frame has 192 kbit/s
    ends, at = [], 576
    for f in frames:
        ends.append(at)
        at += len(f)
    toc = bytes(min(255, 256 * ends[i * len(frames) // 100] // total) for i in range(100)) if frames else bytes(100)
    head = bytes([0xFF, 0xFB, KBPS[1, 3].index(192) << 4 | 1 << 2, 0xC0]) + bytes(17)
    table = (head + b"Xing" + struct.pack(">III", 7, len(frames), total) + toc).ljust(576, b"\0")
    return tag + table + audio


def read_payload(media: bytes, stream: Stream) -> bytes:
    """The payload out of a parsed stream; length and checksum are verified."""
    payload = b"".join([media[at + h.body : at + h.length] for at, h in zip(stream.seek, stream.headers, strict=True)])[: int(stream.tags["payload_bytes"])]
    if zlib.crc32(payload) != int(stream.tags["payload_crc32"]) or stream.crc_bad:
        raise ValueError("damaged media payload")
    return payload


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text").to_pylist()
        for at in range(0, len(text), 256):
            raw = [(t or "").encode() for t in text[at : at + 256]]
            media = [store_payload(r.ljust(max(64, -(-len(r) // 64) * 64), b"\0")) for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(raw)), pa.array([len(r) for r in raw], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text's UTF-8 bytes, padded to a positive multiple of 64, as a stream.

    A null text has no bytes, only padding. Repeated rows and ids stay rows of their own; other columns are not read.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_store, "doc_id long, n_bytes long, media binary")


_PROBE = "doc_id long, n_frames long, samples long, hertz int, seconds double, crc_good long, crc_bad long, junk_bytes long, table_frames long, seek array<long>"


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s = [parse_stream(m or b"") for m in batch.column("media").to_pylist()]
        cols = [[len(x.seek) for x in s], [x.samples for x in s], [x.hertz for x in s], [x.samples / x.hertz if x.hertz else 0.0 for x in s], [x.crc_good for x in s], [x.crc_bad for x in s], [x.junk for x in s], [x.table_frames for x in s], [x.seek for x in s]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", "n_frames", "samples", "hertz", "seconds", "crc_good", "crc_bad", "junk_bytes", "table_frames", "seek"])


def probe(media: DataFrame) -> DataFrame:
    """Exact durations, checksums and frame seek offsets of (doc_id, media); null media have no frames."""
    return media.select("doc_id", "media").mapInArrow(_probe, _PROBE)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for media in batch.column("media"):
            m = media.as_py()
            s = parse_stream(m)
            p = read_payload(m, s)
            kbps = [h.kbps for h in s.headers]
            feature = f"mpeg1-layer3;frames={len(s.seek)};samples={s.samples};hertz={s.hertz};kbps={min(kbps)}-{max(kbps)};table={s.table}:{s.table_frames == len(s.seek)};crc={s.crc_good}/{len(s.seek)};last_seek={s.seek[-1]}"
            out.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature))
        cols = list(zip(*out, strict=True)) if out else [()] * 6
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def media_digest(docs: DataFrame) -> DataFrame:
    """The stored column read back: one row for each row of ``docs``."""
    return store_texts(docs).mapInArrow(_digest, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
