"""MPEG transport streams as a media column.

A payload is stored as one private elementary stream in a single-program transport stream: one
packetised unit of ``UNIT`` bytes after the other, each with a clock reference and a presentation time.
Every 25th is marked as a random-access point and has the program association and map tables before it,
so that a reader can join the stream there. The reader parses the tables, checks their CRC, the continuity
counters and the units' lengths, reassembles the units and lists times, clock and access points. Both work
on whole arrays of packets.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stored

#: Fixed values of the transport-stream format (ISO/IEC 13818-1) and of this program's layout.
PACKET, SYNC, PAT_PID, PMT_PID, DATA_PID, PROGRAM = 188, 0x47, 0, 0x100, 0x101, 1
STREAM_TYPE, STREAM_ID, CLOCK = 0x06, 0xBD, 90_000
UNIT, UNITS_A_SECOND, ACCESS_EVERY, DELAY = 576, 25, 25, 9_000
_HEADER = 14  # of a unit: start code, stream, length, flags, presentation time
_CLOCKED = 8  # adaptation field of a unit's first packet: length, flags, clock reference
_FIRST = PACKET - 4 - _CLOCKED  # of a unit's four packets, what the first and the last hold
_LAST = UNIT + _HEADER - _FIRST - 2 * (PACKET - 4)

def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        r = n << 24
        for _ in range(8):
            r = (r << 1 ^ (0x04C11DB7 if r >> 31 else 0)) & 0xFFFFFFFF
        table.append(r)
    return table


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    r = 0xFFFFFFFF
    for b in data:
        r = (r << 8 ^ _CRC[r >> 24 ^ b]) & 0xFFFFFFFF
    return r


def _section(table: int, number: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table, 0xB000 | len(body) + 9, number, 0xC1, 0, 0) + body
    return head + struct.pack(">I", crc32_mpeg(head))


def _table_packet(pid: int, section: bytes) -> bytes:
    return (struct.pack(">BHBB", SYNC, 0x4000 | pid, 0x10, 0) + section).ljust(PACKET, b"\xff")


_TABLES = _table_packet(PAT_PID, _section(0, 1, struct.pack(">HH", PROGRAM, 0xE000 | PMT_PID))) + _table_packet(
    PMT_PID, _section(2, PROGRAM, struct.pack(">HHBHH", 0xE000 | DATA_PID, 0xF000, STREAM_TYPE, 0xE000 | DATA_PID, 0xF000))
)


def mux(payload: bytes) -> bytes:
    """A stream that holds ``payload``, whose length is a multiple of UNIT."""
    units = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    n = len(units)
    number = np.arange(n, dtype=np.int64)
    p = np.full((n, 4, PACKET), 255, np.uint8)
    p[:, :, 0] = SYNC
    p[:, :, 1] = DATA_PID >> 8
    p[:, 0, 1] |= 0x40
    p[:, :, 2] = DATA_PID & 255
    p[:, :, 3] = (number[:, None] * 4 + np.arange(4)) % 16 | np.array([0x30, 0x10, 0x10, 0x30])
    pts = number * (CLOCK // UNITS_A_SECOND) % (1 << 33)
    p[:, 0, 4] = _CLOCKED - 1
    p[:, 0, 5] = np.where(number % ACCESS_EVERY == 0, 0x50, 0x10)
    for i, shift in enumerate((25, 17, 9, 1)):  # the clock stands DELAY before the time of its unit
        p[:, 0, 6 + i] = (pts - DELAY) % (1 << 33) >> shift & 255
    p[:, 0, 10], p[:, 0, 11] = ((pts - DELAY) % (1 << 33) & 1) << 7 | 0x7E, 0
    stuffing = PACKET - 4 - _LAST
    p[:, 3, 4] = stuffing - 1
    p[:, 3, 5] = 0
    pes = np.empty((n, _HEADER + UNIT), np.uint8)
    pes[:, :9] = [0, 0, 1, STREAM_ID, (UNIT + _HEADER - 6) >> 8, (UNIT + _HEADER - 6) & 255, 0x84, 0x80, 5]
    for i, v in enumerate((0x21 | pts >> 29 & 14, pts >> 22 & 255, pts >> 14 & 254 | 1, pts >> 7 & 255, pts << 1 & 254 | 1)):
        pes[:, 9 + i] = v
    pes[:, _HEADER:] = units
    a, b = _FIRST, _FIRST + PACKET - 4
    p[:, 0, 4 + _CLOCKED :], p[:, 1, 4:], p[:, 2, 4:], p[:, 3, 4 + stuffing :] = pes[:, :a], pes[:, a:b], pes[:, b : b + PACKET - 4], pes[:, b + PACKET - 4 :]
    groups = -(-n // ACCESS_EVERY)
    out = np.empty((4 * n + 2 * groups, PACKET), np.uint8)
    data = np.arange(4 * n)
    out[data + 2 * (data // (4 * ACCESS_EVERY) + 1)] = p.reshape(-1, PACKET)
    tables = np.frombuffer(_TABLES, np.uint8).reshape(2, PACKET).repeat(groups, 0).reshape(2, groups, PACKET).copy()
    tables[:, :, 3] |= (np.arange(groups) % 16).astype(np.uint8)
    first = np.arange(groups) * (4 * ACCESS_EVERY + 2)
    out[first], out[first + 1] = tables
    return out.tobytes()


def access_offsets(units: int) -> list[int]:
    """Where in a stream of so many units a reader can join: the tables before each access point."""
    return list(range(0, PACKET * (4 * units + 2 * -(-units // ACCESS_EVERY)), PACKET * (4 * ACCESS_EVERY + 2)))


def _sections(packets: np.ndarray, pids: np.ndarray, pid: int) -> bytes:
    """The first section on a PID, its CRC checked."""
    at = np.flatnonzero((pids == pid) & (packets[:, 1] & 0x40 != 0))
    if not len(at):
        raise ValueError(f"no table on PID {pid}")
    data = packets[at[0]].tobytes()
    start = 4 + (1 + data[4] if data[3] & 0x20 else 0)
    start += 1 + data[start]
    size = 3 + (struct.unpack_from(">H", data, start + 1)[0] & 0xFFF)
    section = data[start : start + size]
    if crc32_mpeg(section):
        raise ValueError(f"the table on PID {pid} is damaged")
    return section


def _steps(packets: np.ndarray) -> tuple[int, np.ndarray]:
    """Errors of one PID's continuity counters, and which packets aren't sent a second time."""
    counters = packets[:, 3] & 15
    step = (counters[1:].astype(np.int16) - counters[:-1]) % 16
    same = (step == 0) & (packets[1:] == packets[:-1]).all(1) if (step == 0).any() else np.zeros(len(step), bool)
    return int(((step != 1) & ~same).sum()), np.concatenate([[True], ~same]) if len(packets) else np.ones(0, bool)


def demux(stream: bytes) -> dict:
    """The first program's first elementary stream, from wherever the stream begins.

    ``payload``; of each unit ``pts``, ``clock`` (in the same ticks; -1 without one) and ``sizes``, its payload's
    bytes; ``access``: numbers of the random-access units; ``continuity_errors`` of all tables and of the data;
    ``damaged``: numbers of the units that don't have the length that they state. A stream out of
    synchronisation, without tables, or with tables or unit heads that are damaged is refused (ValueError).
    """
    if len(stream) % PACKET:
        raise ValueError("not a whole number of packets")
    p = np.frombuffer(stream, np.uint8).reshape(-1, PACKET)
    if (p[:, 0] != SYNC).any():
        raise ValueError("lost synchronisation")
    pids = (p[:, 1].astype(np.int32) & 0x1F) << 8 | p[:, 2]
    pat = _sections(p, pids, PAT_PID)
    programs = [struct.unpack_from(">HH", pat, i) for i in range(8, len(pat) - 4, 4)]
    pmt_pid = next((pid & 0x1FFF for number, pid in programs if number), None)
    if pmt_pid is None:
        raise ValueError("no program")
    pmt = _sections(p, pids, pmt_pid)
    at = 12 + (struct.unpack_from(">H", pmt, 10)[0] & 0xFFF)
    clock_pid, pid = struct.unpack_from(">H", pmt, 8)[0] & 0x1FFF, struct.unpack_from(">H", pmt, at + 1)[0] & 0x1FFF
    errors = sum(_steps(p[pids == table])[0] for table in (PAT_PID, pmt_pid))
    own = p[(pids == pid) & (p[:, 3] & 0x10 != 0)]
    more, once = _steps(own)
    own = own[once]  # a packet sent twice counts once
    adapted = own[:, 3] & 0x20 != 0
    begin = np.where(adapted, own[:, 4].astype(np.int32) + 5, 4)
    starts = np.flatnonzero(own[:, 1] & 0x40)
    if not len(starts):
        raise ValueError("no unit begins")
    own, adapted, begin, starts = own[starts[0] :], adapted[starts[0] :], begin[starts[0] :], starts - starts[0]
    head, rows = begin[starts], own[starts]
    take = lambda k: rows[np.arange(len(rows)), np.minimum(head + k, PACKET - 1)].astype(np.int64)
    if (head + 13 >= PACKET).any() or ((take(0) | take(1)) != 0).any() or (take(2) != 1).any():
        raise ValueError("a unit has no start code")
    pts = (take(9) >> 1 & 7) << 30 | take(10) << 22 | take(11) >> 1 << 15 | take(12) << 7 | take(13) >> 1
    stated = (take(4) << 8 | take(5)) - 3 - take(8)
    begin[starts] = head + 9 + take(8)
    sizes = np.add.reduceat(np.maximum(PACKET - begin, 0).astype(np.int64), starts)
    flags = np.where(adapted[starts] & (rows[:, 4] > 0), rows[:, 5], 0)
    ticks = rows[:, 6].astype(np.int64) << 25 | rows[:, 7].astype(np.int64) << 17 | rows[:, 8].astype(np.int64) << 9 | rows[:, 9].astype(np.int64) << 1 | rows[:, 10] >> 7
    return {
        "payload": own[np.arange(PACKET) >= begin[:, None]].tobytes(), "pts": pts, "sizes": sizes, "access": np.flatnonzero(flags & 0x40),
        "clock": np.where((flags & 0x10 != 0) & (clock_pid == pid), ticks, -1), "continuity_errors": errors + more, "damaged": np.flatnonzero(sizes != stated),
    }


def padded(text: str | None) -> tuple[int, bytes]:
    """A text's length in UTF-8, and its bytes filled up with 255 to a positive multiple of UNIT."""
    data = (text or "").encode()
    return len(data), data + b"\xff" * (-len(data) % UNIT if data else UNIT)


def store_streams(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media, access_at, access_pts``: a stored table of the documents' transport streams,
    with the places in the stream where a reader can join, and the times there.

    A null text is the empty text, whose payload is one unit of filling. Rows stay as they are,
    repeated ones and null ids too.
    """

    def make():
        def work(columns):
            made = [padded(t) for t in columns[1]]
            units = [len(d) // UNIT for _, d in made]
            times = [[k * (CLOCK // UNITS_A_SECOND) % (1 << 33) for k in range(0, n, ACCESS_EVERY)] for n in units]
            return {"doc_id": columns[0], "n_bytes": [n for n, _ in made], "media": [mux(d) for _, d in made], "access_at": list(map(access_offsets, units)), "access_pts": times}

        return work

    rows = map_rows(docs.select(F.col(id_column).cast("long"), F.col(text_column)), make, "doc_id long, n_bytes long, media binary, access_at array<long>, access_pts array<long>")
    return stored(rows, "media", compression="zstd")


def read_streams(media: DataFrame) -> DataFrame:
    """Digests, features, times and access points of what the stored streams hold, a row a stream.

    ``damaged`` says that a packet or a part of a unit is missing, so that the payload isn't whole. A stream
    that can't be read at all stops the job, as stored media must be whole.
    """
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, damaged boolean, last_pts long, access_pts array<long>"
    names = [c.split()[0] for c in schema.split(", ")]

    def make():
        def work(columns):
            out = {c: [] for c in names}
            for i, n, stream in zip(*columns, strict=True):
                got = demux(stream)
                data = got["payload"]
                a = np.frombuffer(data, np.uint8)
                points = got["access"]
                feature = f"units={len(got['pts'])};access={len(points)};first_pts={got['pts'][0]};last_pts={got['pts'][-1]};last_access_pts={got['pts'][points[-1]]};clocks={(got['clock'] >= 0).sum()};errors={got['continuity_errors']};mean={a.mean():.4f};max={a.max()}"
                row = (i, n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(stream), hashlib.sha256(stream).hexdigest(), feature, bool(got["continuity_errors"] or len(got["damaged"])), int(got["pts"][-1]), got["pts"][points].tolist())
                for k, v in zip(names, row, strict=True):
                    out[k].append(v)
            return out

        return work

    return map_rows(media.select("doc_id", "n_bytes", "media"), make, schema)
