"""Media columns as MPEG transport streams (operator 3).

`mux` stores a payload as a single-program transport stream: a program
association table, a program map table, and one elementary stream of packets
with presentation timestamps; every eighth packet is a random-access point with
a clock reference. Bytes are 8-bit units, so the store is lossless.

`demux` reads transport streams back. It finds the packets (after a lost sync byte,
or bytes too many or too few, at the next place where three packets follow each
other), parses the tables, also where a section goes over several packets or several
lie in one, checks continuity counters (one repeat of a packet is legal and passed
over, an announced discontinuity is no loss), reassembles the elementary packets and
returns each with its timestamp, its random-access flag and whether it is whole.
Scrambled packets and those marked as erroneous are counted and passed over. Only
packets of 188 bytes are read.

Cases: null text is the empty text (64 zero bytes of payload); payloads of any
length; damaged streams are reported in `lost`, `bad_sync`, `bad_tables` and
`errors`, never an exception; null media give no row of their own but null results;
repeated rows and null doc_ids give rows like others; an empty table gives none;
extra columns are passed over.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table

# Fixed values of the format (ISO/IEC 13818-1).
PACKET, SYNC, PAT_PID, NULL_PID, CLOCK = 188, 0x47, 0, 0x1FFF, 90_000
PRIVATE_STREAM, PRIVATE_TYPE = 0xBD, 0x06
BARE_STREAMS = {0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF}  # without the optional header
CRC_POLYNOMIAL = 0x04C11DB7

PMT_PID, MEDIA_PID, PROGRAM = 0x1000, 0x100, 1
UNIT, FRAME_TICKS, ACCESS_EVERY = 8192, 3600, 8


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1 ^ CRC_POLYNOMIAL if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    return head + crc32_mpeg(head).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + section).ljust(PACKET, b"\xff")


_TABLES = _table_packet(PAT_PID, _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))) + _table_packet(
    PMT_PID, _section(2, PROGRAM, (0xE000 | MEDIA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_TYPE]) + (0xE000 | MEDIA_PID).to_bytes(2, "big") + b"\xf0\x00")
)


def _stamp(marker: int, t: int) -> bytes:
    return bytes([marker << 4 | (t >> 30 & 7) << 1 | 1, t >> 22 & 255, (t >> 15 & 127) << 1 | 1, t >> 7 & 255, (t & 127) << 1 | 1])


def _read_stamp(b) -> int:
    return (int(b[0]) >> 1 & 7) << 30 | int(b[1]) << 22 | int(b[2]) >> 1 << 15 | int(b[3]) << 7 | int(b[4]) >> 1


def _packets(pes: np.ndarray, first_field: bytes, counter: int) -> np.ndarray:
    """One elementary packet as rows of 188 bytes; the first carries first_field as adaptation, the last is stuffed."""
    head = 184 - (1 + len(first_field) if first_field else 0)
    n = 1 + max(0, -(-(len(pes) - head) // 184))
    out = np.empty((n, PACKET), np.uint8)
    out[:, 0], out[:, 1], out[:, 2] = SYNC, MEDIA_PID >> 8, MEDIA_PID & 255
    out[:, 3] = 0x10 | (counter + np.arange(n)) & 15
    out[0, 1] |= 0x40
    sizes = np.full(n, 184)
    sizes[0] = head
    used = head if n > 1 else 0
    sizes[-1] = len(pes) - used - 184 * max(0, n - 2)
    fields = [first_field if i == 0 else b"" for i in (0, n - 1)]
    at = min(head, len(pes)) if n > 1 else 0
    if n > 2:
        out[1:-1, 4:] = pes[at : at + 184 * (n - 2)].reshape(-1, 184)
    for i, f in zip((0, n - 1) if n > 1 else (0,), fields):
        size = int(sizes[i])
        room = 184 - size
        if room:
            out[i, 3] |= 0x20
            out[i, 4] = room - 1
            if room > 1:
                f = f or b"\x00"
                out[i, 5 : 4 + room] = 0xFF
                out[i, 5 : 5 + len(f)] = np.frombuffer(f, np.uint8)
        out[i, 4 + room :] = pes[:size] if i == 0 else pes[len(pes) - size :]
    return out


def mux(payload: bytes, unit: int = UNIT, start: int = CLOCK, ticks: int = FRAME_TICKS, access_every: int = ACCESS_EVERY) -> bytes:
    """A transport stream of the payload in units of at most `unit` bytes, `ticks` of the 90 kHz clock apart."""
    data, out, counter = np.frombuffer(payload, np.uint8), [np.frombuffer(_TABLES, np.uint8)], 0
    for k, i in enumerate(range(0, max(1, len(data)), unit)):
        part, t = data[i : i + unit], (start + k * ticks) % 2**33
        pes = np.concatenate([np.frombuffer(b"\0\0\1" + bytes([PRIVATE_STREAM]) + (len(part) + 8).to_bytes(2, "big") + b"\x80\x80\x05" + _stamp(2, t), np.uint8), part])
        clock = (t << 15 | 0x7E00).to_bytes(6, "big") if k % access_every == 0 else b""
        rows = _packets(pes, b"\x50" + clock if clock else b"", counter)
        counter = (counter + len(rows)) & 15
        out.append(rows.reshape(-1))
    return np.concatenate(out).tobytes()


@dataclass
class Unit:
    pid: int
    pts: int | None
    random_access: bool
    data: bytes
    whole: bool = True


@dataclass
class Stream:
    programs: dict[int, int] = field(default_factory=dict)
    kinds: dict[int, int] = field(default_factory=dict)
    units: list[Unit] = field(default_factory=list)
    packets: int = 0
    repeats: int = 0
    lost: int = 0
    bad_sync: int = 0
    bad_tables: int = 0
    errors: int = 0


def _starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Where packets begin, after which of them sync was lost (so their bytes may have shifted), and how often that was."""
    n = len(data)
    whole = n // PACKET
    if n % PACKET == 0 and (data[: whole * PACKET : PACKET] == SYNC).all():
        return np.arange(whole) * PACKET, np.zeros(whole, bool), 0
    sync = data == SYNC
    after = np.concatenate([sync, np.ones(2 * PACKET, bool)])  # beyond the end nothing speaks against a packet
    likely = np.flatnonzero(sync & after[PACKET : PACKET + n] & after[2 * PACKET :])
    out, doubtful, at, found = [], [], 0, 0
    while at + PACKET <= n:
        run = sync[at : n - PACKET + 1 : PACKET]
        good = len(run) if run.all() else int(np.argmin(run))
        out.append(at + np.arange(good) * PACKET)
        at += good * PACKET
        doubtful.append(np.arange(good) == good - 1 if at + PACKET <= n else np.zeros(good, bool))
        if at + PACKET > n:
            break
        found += 1
        k = int(np.searchsorted(likely, at + 1))
        if k == len(likely):
            break
        at = int(likely[k])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, bool), int(n > 0)
    return np.concatenate(out), np.concatenate(doubtful), found + (not found and n % PACKET > 0)


def _sections(payloads: Iterator[tuple[bytes, bool, bool]]) -> Iterator[bytes]:
    """The sections in (payload, whether one starts in it, whether a packet is missing before it); empty ones stand for broken ones."""
    held: bytes | None = None

    def cut(data: bytes) -> Iterator[bytes]:
        """Whole sections from the start of data on; what is left is held."""
        nonlocal held
        while data and data[0] != 0xFF:  # 0xFF fills up a packet
            size = 3 + ((data[1] & 15) << 8 | data[2]) if len(data) >= 3 else 0
            if not size or len(data) < size:
                held = data
                return
            yield data[:size] if size >= 12 and crc32_mpeg(data[:size]) == 0 else b""
            data = data[size:]
        held = None

    for payload, start, missing in payloads:
        if missing and held is not None:
            held = None
            yield b""
        if start and payload:
            pointer = payload[0]
            if held is not None:
                yield from cut(held + payload[1 : 1 + pointer])
                if held is not None:
                    yield b""
            yield from cut(payload[1 + pointer :])
        elif held is not None:
            yield from cut(held + payload)
    if held is not None:
        yield b""


def demux(media: bytes) -> Stream:
    """Tables, continuity, elementary packets, timestamps and random-access points of a transport stream."""
    out = Stream()
    data = np.frombuffer(media, np.uint8)
    starts, doubtful, out.bad_sync = _starts(data)
    rows = data[starts[:, None] + np.arange(PACKET)] if out.bad_sync else data.reshape(-1, PACKET)
    out.packets = len(rows)
    usable = (rows[:, 1] & 0x80 == 0) & (rows[:, 3] & 0xC0 == 0)
    out.errors = int((~usable).sum())
    rows, doubtful = rows[usable], doubtful[usable]
    pids = (rows[:, 1].astype(np.int32) & 31) << 8 | rows[:, 2]
    adapted, carries = rows[:, 3] & 0x20 > 0, rows[:, 3] & 0x10 > 0
    at = np.where(adapted, np.minimum(5 + rows[:, 4].astype(np.int32), PACKET), 4)
    flags = np.where(adapted & (rows[:, 4] > 0), rows[:, 5], 0)

    def followed(pid: int) -> tuple[np.ndarray, np.ndarray]:
        """The packets of pid with a payload, repeats left out, and before which of them some are missing."""
        own = np.flatnonzero((pids == pid) & carries)
        missing = np.zeros(len(own), bool)
        if len(own) > 1:
            step = (rows[own[1:], 3] & 15) - (rows[own[:-1], 3] & 15) & 15
            again = np.flatnonzero(step == 0)
            tail = np.arange(PACKET) >= at[own[again + 1], None]  # a repeat may carry another clock
            alike = ((rows[own[again + 1]] == rows[own[again]]) | ~tail).all(1) & (at[own[again + 1]] == at[own[again]])
            repeat = np.zeros(len(own), bool)
            repeat[again[alike] + 1] = True
            repeat[1:] &= ~repeat[:-1]  # one is legal, no more
            missing[1:] = (step != 1) & ~repeat[1:] & (flags[own[1:]] & 0x80 == 0)
            out.repeats += int(repeat.sum())
            own, missing = own[~repeat], missing[~repeat]
        out.lost += int(missing.sum())
        return own, missing

    def sections(pid: int) -> Iterator[bytes]:
        own, missing = followed(pid)
        for s in _sections((rows[i, at[i] :].tobytes(), bool(rows[i, 1] & 0x40), bool(m)) for i, m in zip(own, missing)):
            if not s:
                out.bad_tables += 1
            elif s[5] & 1:  # in force
                yield s

    for s in sections(PAT_PID):
        if s[0] == 0:
            for i in range(8, len(s) - 4, 4):
                out.programs[int.from_bytes(s[i : i + 2], "big")] = int.from_bytes(s[i + 2 : i + 4], "big") & 0x1FFF
    for pid in dict.fromkeys(pid for number, pid in out.programs.items() if number):
        for s in sections(pid):
            if s[0] == 2:
                i = 12 + (int.from_bytes(s[10:12], "big") & 0xFFF)
                while i + 5 <= len(s) - 4:
                    out.kinds[int.from_bytes(s[i + 1 : i + 3], "big") & 0x1FFF] = s[i]
                    i += 5 + (int.from_bytes(s[i + 3 : i + 5], "big") & 0xFFF)
    for pid in out.kinds:
        own, missing = followed(pid)
        if not len(own):
            continue
        keep = np.arange(PACKET) >= at[own, None]
        flat, sizes, broken = rows[own][keep], keep.sum(1), np.cumsum(missing)
        ends = np.cumsum(sizes)
        begins = np.flatnonzero(rows[own, 1] & 0x40)
        for i, j in zip(begins, np.r_[begins[1:], len(own)]):
            pes = flat[ends[i] - sizes[i] : ends[j - 1]]
            plain = len(pes) > 6 and int(pes[3]) in BARE_STREAMS
            if len(pes) < (6 if plain else 9) or bytes(pes[:3]) != b"\0\0\1":
                out.bad_tables += 1
                continue
            size = int(pes[4]) << 8 | int(pes[5])
            pts = _read_stamp(pes[9:14]) if not plain and pes[7] & 0x80 and len(pes) >= 14 else None
            body = pes[6 if plain else 9 + int(pes[8]) : 6 + size if size else len(pes)].tobytes()
            after = bool(j < len(own) and missing[j])  # what is missing before the next one may have been this one's end
            whole = bool(broken[j - 1] == broken[i]) and not doubtful[own[i:j]].any() and (len(pes) >= 6 + size if size else not after)
            out.units.append(Unit(pid, pts, bool(flags[own[i]] & 0x40), body, whole))
    return out


def feature(s: Stream) -> str:
    """What the stream holds: its structure, and of its bytes their number of kinds, mean, entropy, ASCII letters and longest unit's mean."""
    data = np.frombuffer(b"".join([u.data for u in s.units]), np.uint8)
    counts = np.bincount(data, minlength=256)
    share = counts[counts > 0] / max(1, len(data))
    letters = int(counts[65:91].sum() + counts[97:123].sum())
    stamps = [u.pts for u in s.units if u.pts is not None]
    span = sum((b - a) % 2**33 for a, b in zip(stamps, stamps[1:]))
    return (
        f"packets={s.packets};units={len(s.units)};access={sum(u.random_access for u in s.units)};ticks={span};lost={s.lost};bad={s.bad_sync + s.bad_tables + s.errors};"
        f"kinds={len(share)};mean={round(1000 * float(data.mean())) if len(data) else 0};entropy={round(1000 * float(-(share * np.log2(share)).sum())) if len(data) else 0};letters={letters};most={int(counts.argmax())}"
    )


def padded(text: bytes) -> bytes:
    return text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")


def store(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, media: each text's padded bytes as a transport stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                raw = [(x or "").encode() for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([mux(padded(x)) for x in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.selectExpr(f"cast({id_col} as long) doc_id", f"cast({text_col} as string) text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


READ = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string", "unit_pts": "array<long>", "unit_access": "array<boolean>"}


def read_back(media: DataFrame) -> DataFrame:
    """Digests, stream features, and the timestamp and random-access flag of each unit of what is stored in `media`."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for m in batch.column(2):
                if (m := m.as_py()) is None:
                    got.append((None,) * len(kinds))
                    continue
                s = demux(m)
                p = b"".join([u.data for u in s.units])
                got.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature(s), [u.pts for u in s.units], [u.random_access for u in s.units]))
            columns = list(zip(*got)) if got else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "n_bytes", *READ])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, " + ", ".join(f"{c} {k}" for c, k in READ.items()))


def op3_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(store(table(spark, sf_dir, "documents")))
