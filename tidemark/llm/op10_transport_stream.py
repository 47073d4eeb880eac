"""Media columns of MPEG transport streams.

A payload is multiplexed into 188-byte packets: program association and map
tables, then packetized elementary packets with time stamps, each of which
begins at a random-access point. The demultiplexer parses the program tables
(over any number of packets, with their CRC), checks continuity counters (a
packet that is sent twice counts once), reassembles the elementary packets and
lists time stamps, clock references and random-access points.

Scale: row by row in Arrow batches; the stored streams are a compressed binary
column in the shared folder, with their time stamps and random-access points in
columns beside them, so a reader can seek without the stream. Both are read back
for the features. No shuffle.

Edge cases: a null or empty text is a payload of 64 zero bytes; repeated rows
give equal values; a broken stream (lost or damaged packets) is demultiplexed
with its errors counted and never raises; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_texts, pick, small_batches, written

# Fixed values of the transport stream format (ISO/IEC 13818-1).
PACKET, SYNC = 188, 0x47
PAT_PID, PMT_PID, DATA_PID = 0x0000, 0x0100, 0x0101
PROGRAM, PRIVATE_DATA, PRIVATE_STREAM = 1, 0x06, 0xBD
CLOCK = 90_000

#: Payload bytes of one elementary packet, and its length in ticks of the clock.
UNIT, TICKS = 16_384, 3_600
#: Payloads are padded to a positive multiple of this.
ALIGN = 64
HEADER, FIRST = 14, 176


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % ALIGN or (0 if data else ALIGN))


@functools.lru_cache(maxsize=1)
def _crc_table() -> list[int]:
    out = []
    for k in range(256):
        c = k << 24
        for _ in range(8):
            c = (c << 1 ^ (0x04C11DB7 if c & 0x80000000 else 0)) & 0xFFFFFFFF
        out.append(c)
    return out


@functools.lru_cache(maxsize=256)
def section_crc(data: bytes) -> int:
    table, c = _crc_table(), 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ table[c >> 24 ^ b]
    return c


def section(table: int, number: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + section_crc(head + body).to_bytes(4, "big")


@functools.lru_cache(maxsize=1)
def table_packets() -> np.ndarray:
    pat = section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
    pmt = section(2, PROGRAM, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_DATA]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00")
    out = np.full((2, PACKET), 0xFF, np.uint8)
    for row, pid, data in ((0, PAT_PID, pat), (1, PMT_PID, pmt)):
        packet = bytes([SYNC]) + (0x4000 | pid).to_bytes(2, "big") + b"\x10\x00" + data
        out[row, : len(packet)] = np.frombuffer(packet, np.uint8)
    return out


def time_stamp(ticks: int) -> bytes:
    return bytes([0x21 | ticks >> 29 & 0x0E, ticks >> 22 & 0xFF, 1 | ticks >> 14 & 0xFE, ticks >> 7 & 0xFF, 1 | ticks << 1 & 0xFE])


def mux(payload: bytes) -> bytes:
    """The transport stream of a payload."""
    blocks, counter = [table_packets()], 0
    for unit, at in enumerate(range(0, len(payload), UNIT)):
        chunk, ticks = payload[at : at + UNIT], unit * TICKS & (1 << 33) - 1
        data = np.frombuffer(b"\x00\x00\x01" + bytes([PRIVATE_STREAM]) + (len(chunk) + HEADER - 6).to_bytes(2, "big") + b"\x84\x80\x05" + time_stamp(ticks) + chunk, np.uint8)
        n = max(1, 1 + -(-(len(data) - FIRST) // 184))
        out = np.full((n, PACKET), 0xFF, np.uint8)
        out[:, 0], out[:, 1], out[:, 2] = SYNC, DATA_PID >> 8, DATA_PID & 0xFF
        out[:, 3] = 0x10 | (counter + np.arange(n)) & 15
        counter += n
        out[0, 1] |= 0x40
        out[0, 3] |= 0x20
        out[0, 4:12] = np.frombuffer(b"\x07\x50" + (ticks << 15 | 0x7E00).to_bytes(6, "big"), np.uint8)
        whole = min(len(data), FIRST + 184 * max(0, n - 2))
        if n == 1:
            _stuffed(out[0], data, 12)
        else:
            out[0, 12:] = data[:FIRST]
            out[1 : n - 1, 4:] = data[FIRST:whole].reshape(-1, 184)
            _stuffed(out[n - 1], data[whole:], 4)
        blocks.append(out)
    return np.concatenate(blocks).tobytes()


def _stuffed(packet: np.ndarray, data: np.ndarray, start: int) -> None:
    """Put the data at a packet's end; the adaptation field takes the room before it."""
    room = PACKET - start - len(data)
    if room and start == 4:
        packet[3] |= 0x20
        packet[4] = room - 1
        if room > 1:
            packet[5] = 0
    elif room:
        packet[4] += room
    packet[PACKET - len(data) :] = data


def demux(stream: bytes) -> dict:
    """Program tables, elementary data, time stamps and random-access points; errors are counted."""
    out = {"packets": len(stream) // PACKET, "sync_errors": 0, "crc_errors": 0, "programs": 0, "streams": 0, "continuity_errors": 0, "repeated": 0, "units": 0, "pts": [], "pcr": [], "access": [], "payload": b""}
    rows = np.frombuffer(stream, np.uint8)[: out["packets"] * PACKET].reshape(-1, PACKET)
    good = rows[:, 0] == SYNC
    out["sync_errors"] = int((~good).sum()) + bool(len(stream) % PACKET)
    place, rows = np.flatnonzero(good), rows[good]
    pid = (rows[:, 1].astype(np.int32) & 0x1F) << 8 | rows[:, 2]
    control = rows[:, 3] >> 4 & 3
    begin = np.where(control & 2, 5 + rows[:, 4].astype(np.int32), 4)
    maps = set()
    for body in _sections(rows[pid == PAT_PID], begin[pid == PAT_PID], 0, out):
        maps |= {int.from_bytes(body[i + 2 : i + 4], "big") & 0x1FFF for i in range(0, len(body) - 3, 4) if body[i : i + 2] != b"\0\0"}
    out["programs"] = len(maps)
    wanted = set()
    for body in (x for m in sorted(maps) for x in _sections(rows[pid == m], begin[pid == m], 2, out)):
        i = 4 + (int.from_bytes(body[2:4], "big") & 0xFFF) if len(body) >= 4 else len(body)
        while i + 5 <= len(body):
            wanted.add(int.from_bytes(body[i + 1 : i + 3], "big") & 0x1FFF)
            i += 5 + (int.from_bytes(body[i + 3 : i + 5], "big") & 0xFFF)
    out["streams"] = len(wanted)
    data = []
    for p in sorted(wanted):
        own = np.flatnonzero((pid == p) & (control & 1 > 0) & (begin < PACKET))
        # the same packet twice in a row is a repetition, which the format allows
        twice = np.concatenate([[False], (rows[own[1:]] == rows[own[:-1]]).all(1)]) if len(own) else np.zeros(0, bool)
        out["repeated"] += int(twice.sum())
        own = own[~twice]
        counters = (rows[own, 3] & 15).astype(np.int32)
        out["continuity_errors"] += int(((np.diff(counters) & 15) != 1).sum())
        mine, at = rows[own], begin[own]
        flags = np.where((control[own] & 2 > 0) & (mine[:, 4] > 0), mine[:, 5], 0)
        out["access"] += [int(x) for x in place[own[flags & 0x40 > 0]]]
        for r in mine[(flags & 0x10 > 0) & (mine[:, 4] >= 7)]:
            raw = int.from_bytes(r[6:12].tobytes(), "big")
            out["pcr"].append((raw >> 15) * 300 + (raw & 0x1FF))
        size = PACKET - at
        flat = mine[np.arange(PACKET)[None, :] >= at[:, None]].tobytes()
        ends = np.cumsum(size)
        starts = (ends - size)[mine[:, 1] & 0x40 > 0].tolist()
        for i, j in zip(starts, [*starts[1:], len(flat)]):
            if flat[i : i + 3] != b"\0\0\1" or j - i < 9:
                continue
            length = int.from_bytes(flat[i + 4 : i + 6], "big")
            end = min(j, i + 6 + length) if length else j
            out["units"] += 1
            if flat[i + 7] & 0x80:
                t = flat[i + 9 : i + 14]
                out["pts"].append((t[0] >> 1 & 7) << 30 | t[1] << 22 | t[2] >> 1 << 15 | t[3] << 7 | t[4] >> 1)
            data.append(flat[i + 9 + flat[i + 8] : end])
    out["payload"] = b"".join(data)
    return out


def _sections(rows: np.ndarray, begin: np.ndarray, table: int, out: dict) -> Iterator[bytes]:
    """The bodies of a table's sections on one stream, put together from its packets; damaged ones are counted."""
    held, last = None, None
    for row, at in zip(rows, begin.tolist(), strict=True):
        if at >= PACKET or not row[3] & 0x10:
            continue
        data, start, counter = row.tobytes()[at:], row[1] & 0x40, int(row[3] & 15)
        if held is not None and counter != (last + 1) & 15:
            held = None  # what is missing in between is not made up
        last = counter
        if start:
            if held is not None:
                yield from _finished(held + data[1 : 1 + data[0]], table, out)
            held = data[1 + data[0] :]
        elif held is not None:
            held += data
        if held is not None and len(held) >= 3 and len(held) >= 3 + (int.from_bytes(held[1:3], "big") & 0xFFF):
            yield from _finished(held, table, out)
            held = None


def _finished(raw: bytes, table: int, out: dict) -> Iterator[bytes]:
    while len(raw) >= 3 and raw[0] != 0xFF:
        size = 3 + (int.from_bytes(raw[1:3], "big") & 0xFFF)
        if size < 12 or size > len(raw):
            return
        if raw[0] == table:
            if section_crc(raw[: size - 4]) == int.from_bytes(raw[size - 4 : size], "big"):
                yield raw[8 : size - 4]
            else:
                out["crc_errors"] += 1
        raw = raw[size:]


def index_of(payload_bytes: int) -> tuple[list[int], list[int]]:
    """Time stamps of a payload's elementary packets, and the transport packets at which they begin."""
    pts, access, at = [], [], len(table_packets())
    for unit, begin in enumerate(range(0, payload_bytes, UNIT)):
        pts.append(unit * TICKS & (1 << 33) - 1)
        access.append(at)
        at += max(1, 1 + -(-(min(UNIT, payload_bytes - begin) + HEADER - FIRST) // 184))
    return pts, access


STORED = "doc_id long, n_bytes long, media binary, pts array<long>, access_points array<int>"


def stored_streams(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the transport stream of each whole text, with its time stamps and random-access points."""
    small_batches(docs.sparkSession)

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in byte_texts(b)]
            for k in range(0, len(texts), 100):
                own = texts[k : k + 100]
                pts, access = zip(*[index_of(len(padded(t))) for t in own], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(k, 100).cast(pa.int64()), pa.array([len(t) for t in own], pa.int64()), pa.array([mux(padded(t)) for t in own], pa.binary()), pa.array(pts, pa.list_(pa.int64())), pa.array(access, pa.list_(pa.int32()))],
                    ["doc_id", "n_bytes", "media", "pts", "access_points"],
                )

    return pick(docs, "doc_id", "text").mapInArrow(streams, STORED)


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pts array<long>, access_points array<int>"


def features(media: DataFrame) -> DataFrame:
    """Demultiplexes each stored stream, and holds the stored time stamps and random-access points against it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.rsplit(" ", 1)[0] for x in FEATURES.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        for b in batches:
            out = []
            for doc_id, n, raw, pts, access in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_bytes", "media", "pts", "access_points")), strict=True):
                x = demux(raw)
                index = "same" if (pts, access) == (x["pts"], x["access"]) else "other"
                p = x["payload"]
                told = f"packets={x['packets']};programs={x['programs']};streams={x['streams']};units={x['units']};access={len(x['access'])};pts={x['pts'][0] if x['pts'] else ''}-{x['pts'][-1] if x['pts'] else ''};index={index};errors={x['sync_errors']},{x['crc_errors']},{x['continuity_errors']}"
                out.append((doc_id, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-ALIGN:]), len(raw), hashlib.sha256(raw).hexdigest(), told, pts, access))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return media.mapInArrow(read, FEATURES)


def transport_streams(docs: DataFrame) -> DataFrame:
    """Store each text as a transport stream and describe what is read back."""
    return features(written(stored_streams(docs), "streams", compression="zstd"))
