"""Transport streams: the query against plain padding, and damaged and foreign streams against a slow reader."""

import random
import zlib

import pytest
from test_queries import Q, docs, sha

from corpusloom.llm import transport as t


@pytest.mark.parametrize("which", ["odd", "repeated", "none"])
def test_query(spark, request, which):
    d = request.getfixturevalue(which)
    want = []
    for i, text, _ in docs(spark, d):
        b = (text or "").encode()
        p = b.ljust(max(64, -(-len(b) // 64) * 64), b"\0")
        want.append(str((i, len(b), len(p), sha(p), zlib.crc32(p[-64:]))))
    got = Q["op3_transport_stream"](spark, d).collect()
    assert sorted(str(tuple(r)[:5]) for r in got) == sorted(want)
    for r in got:
        n = -(-r.payload_bytes // t.UNIT)
        assert "lost=0;bad=0" in r.feature and r.media_bytes % 188 == 0
        assert list(r.unit_pts) == [t.CLOCK + k * t.FRAME_TICKS for k in range(n)] and list(r.unit_access) == [k % t.ACCESS_EVERY == 0 for k in range(n)]
    assert len({(r.payload_sha256, r.feature, r.media_sha256) for r in got}) == len({r.payload_sha256 for r in got})


def slow_demux(media):
    """One packet after the other: tables of one packet each, units as (pts, access, data)."""
    packets, at = [], 0
    while at + 188 <= len(media):
        if media[at] != 0x47 or any(media[at + k] != 0x47 for k in (188, 376) if at + k < len(media) and not (packets and packets[-1][0] == at - 188)):
            at += 1
            continue
        packets.append((at, media[at : at + 188]))
        at += 188
    pmt, media_pids, last, units, lost, repeats = set(), set(), {}, [], 0, 0
    for _, p in packets:
        pid, counter = (p[1] & 31) << 8 | p[2], p[3] & 15
        start = 5 + p[4] if p[3] & 0x20 else 4
        announced = p[3] & 0x20 and p[4] and p[5] & 0x80
        if not p[3] & 0x10 or p[1] & 0x80 or p[3] & 0xC0:
            continue
        body, before = p[start:], last.get(pid)
        if before and before[0] == counter and before[1] == body and not before[2]:
            last[pid] = (counter, body, True)
            repeats += 1
            continue
        if before and (before[0] + 1) % 16 != counter and not announced:
            lost += 1
        last[pid] = (counter, body, False)
        if pid == 0 or pid in pmt:
            s = body[1 + body[0] :]
            size = 3 + ((s[1] & 15) << 8 | s[2])
            if t.crc32_mpeg(s[:size]) == 0:
                if pid == 0:
                    pmt.add((s[10] & 31) << 8 | s[11])
                else:
                    media_pids.add((s[13] & 31) << 8 | s[14])
        if p[1] & 0x40 and pid not in pmt and pid:
            units.append([pid, p[3] & 0x20 and p[4] and p[5] & 0x40, b""])
        if pid not in pmt and pid and units:
            units[-1][2] += body
    out = []
    for pid, access, pes in units:
        if pid in media_pids and pes[:3] == b"\0\0\1":
            b = [int(x) for x in pes[9:14]]
            pts = (b[0] >> 1 & 7) << 30 | b[1] << 22 | b[2] >> 1 << 15 | b[3] << 7 | b[4] >> 1
            out.append((pts, bool(access), pes[9 + pes[8] : 6 + int.from_bytes(pes[4:6], "big")]))
    return out, lost, repeats


def damaged(r, m):
    packets = [m[i : i + 188] for i in range(0, len(m), 188)]
    for _ in range(r.randint(0, 4)):
        k, kind = r.randrange(3, len(packets)), r.randrange(6)
        if kind == 0:
            packets[k] = b""
        elif kind == 1 and len(packets[k]) == 188:
            packets[k] = packets[k] * 2
        elif kind == 2:
            packets[k] += b"\x01\x02\x03"
        elif kind == 3 and packets[k]:
            packets[k] = packets[k][:-5]
        elif kind == 4 and packets[k]:
            packets[k] = b"\x00" + packets[k][1:]
        elif packets[k]:
            packets[k] = packets[k][:1] + bytes([packets[k][1] | 0x80]) + packets[k][2:]
    return b"".join(packets)


def test_damaged_streams_against_a_slow_reader():
    r = random.Random(8)
    for _ in range(150):
        payload = bytes(r.choices(b"abcdefgh ", k=r.randint(2000, 9000)))
        m = damaged(r, t.mux(payload, unit=r.choice([300, 1000, 4000])))
        got = t.demux(m)
        want, lost, repeats = slow_demux(m)
        assert ([(u.pts, u.random_access, u.data) for u in got.units], got.lost, got.repeats) == (want, lost, repeats)
        assert all(u.data in payload for u in got.units if u.whole)


def test_a_duplicate_is_legal_and_an_inserted_byte_costs_little():
    payload = bytes(range(256)) * 600
    m = t.mux(payload)
    s = t.demux(m[: 188 * 9] + m[188 * 8 :])
    assert (s.lost, s.repeats, b"".join(u.data for u in s.units)) == (0, 1, payload)
    s = t.demux(m[: 188 * 9] + m[188 * 8 : 188 * 9] * 2 + m[188 * 9 :])  # two are not
    assert (s.lost, s.repeats) == (1, 1)
    for cut in (m[: 188 * 5 + 20] + b"\0" + m[188 * 5 + 20 :], m[: 188 * 5 + 20] + m[188 * 5 + 21 :]):
        s = t.demux(cut)
        assert s.bad_sync == 1 and s.packets >= len(m) // 188 - 3 and sum(u.whole for u in s.units) == len(s.units) - 1
    assert t.demux(m[: 188 * 5] + m[188 * 6 :]).lost == 1 and t.demux(m[:100]).bad_sync == 1 and t.demux(b"").packets == 0
    assert t.demux(m[: 188 * 6 + 50]).bad_sync == 1


def test_announced_discontinuity():
    m = bytearray(t.mux(b"x" * 100_000, unit=1000))
    at = next(i for i in range(188 * 40, len(m), 188) if m[i + 3] & 0x20 and m[i + 4] and m[i + 5] & 0x40)
    for i in range(at, len(m), 188):  # the counter starts anew
        m[i + 3] = m[i + 3] & 0xF0 | (m[i + 3] + 5) & 15
    assert t.demux(bytes(m)).lost == 1
    m[at + 5] |= 0x80
    s = t.demux(bytes(m))
    assert s.lost == 0 and all(u.whole for u in s.units) and b"".join(u.data for u in s.units) == b"x" * 100_000


def test_sections_over_packets():
    """A program table of 700 bytes in four packets, the next one in the rest of the last."""
    streams = b"".join(bytes([6]) + (0xE000 | 0x200 + k).to_bytes(2, "big") + b"\xf0\x02ab" for k in range(95))
    big = t._section(2, 1, b"\xe1\x00\xf0\x00" + streams)
    small = t._section(2, 1, b"\xe1\x00\xf0\x00\x1b" + (0xE000 | 0x1234 & 0x1FFF).to_bytes(2, "big") + b"\xf0\x00")
    both, out, counter = big + small, [], 0
    at, ends = 0, len(big)
    while at < len(both):
        starts = at == 0 or at < ends <= at + 182
        room = 183 if starts else 184
        part = both[at : at + room]
        body = (bytes([0 if at == 0 else ends - at]) if starts else b"") + part
        out.append((bytes([0x47, (0x40 if starts else 0) | 0x10, 0, 0x10 | counter]) + body).ljust(188, b"\xff"))
        at, counter = at + len(part), counter + 1
    pat = t._TABLES[:188]
    s = t.demux(pat + b"".join(out))
    assert len(big) > 600 and len(out) >= 4 and s.bad_tables == 0 and s.lost == 0
    assert set(s.kinds) == {0x200 + k for k in range(95)} | {0x1234} and s.kinds[0x1234] == 0x1B
    lossy = t.demux(pat + b"".join(out[:1] + out[2:]))
    assert lossy.bad_tables >= 1 and lossy.lost == 1


def test_timestamps_and_access_points():
    units = t.demux(t.mux(b"x" * 100_000, unit=1000)).units
    assert [u.random_access for u in units[:9]] == [True, *[False] * 7, True] and units[1].pts - units[0].pts == 3600
    wrapped = t.demux(t.mux(b"x" * 5000, unit=1000, start=2**33 - 3600))
    assert [u.pts for u in wrapped.units][:3] == [2**33 - 3600, 0, 3600] and "ticks=14400" in t.feature(wrapped)
