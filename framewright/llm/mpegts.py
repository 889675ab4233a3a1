"""MPEG transport streams as a media column.

``mux`` stores a payload as one private elementary stream: a program association table, a program map table, and access
units of ACCESS_UNIT bytes as elementary packets with 90 kHz timestamps, cut into 188-byte packets; every RANDOM_EVERY-th
unit starts with the random-access flag and a clock reference. ``demux`` is a parser for any such stream: it reads the
tables (with their checksums; a section may go over several packets), checks each PID's continuity counter (one repeat and flagged discontinuities are legal),
puts elementary packets together and gives timestamps and random-access points.

Null and empty texts are a payload of 64 zero bytes. Broken streams don't raise: bytes outside packets, wrong counters,
bad tables and cut packets are counted.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

PACKET, SYNC, PMT_PID, ES_PID, PRIVATE = 188, 0x47, 0x1000, 0x0100, 0x06
ACCESS_UNIT, RANDOM_EVERY, CLOCK, UNIT_TICKS, WRAP = 8192, 4, 90_000, 3_600, 1 << 33


@lru_cache(maxsize=4096)
def crc_mpeg(data: bytes) -> int:
    """CRC-32/MPEG-2 (polynomial 04C11DB7, no reflection); over a section with its checksum it is 0."""
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
    return crc


def _section(table: int, number: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    return head + crc_mpeg(head).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + section).ljust(PACKET, b"\xff")


@lru_cache(maxsize=1)
def _tables() -> bytes:
    pat = _section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
    pmt = _section(2, 1, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00")
    return _table_packet(0, pat) + _table_packet(PMT_PID, pmt)


def _pts(ticks: int) -> bytes:
    return bytes([0x21 | ticks >> 29 & 0x0E, ticks >> 22 & 255, 1 | ticks >> 14 & 0xFE, ticks >> 7 & 255, 1 | ticks << 1 & 0xFE])


def pad(data: bytes) -> bytes:
    """Bytes 0 up to a positive multiple of 64."""
    return data + bytes(-len(data) % 64 or 64 * (not data))


def mux(payload: bytes) -> bytes:
    out, counter = [_tables()], 0
    for unit, at in enumerate(range(0, len(payload), ACCESS_UNIT)):
        data = payload[at : at + ACCESS_UNIT]
        ticks = unit * UNIT_TICKS % WRAP
        pes = b"\x00\x00\x01\xbd" + (len(data) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _pts(ticks) + data
        field = b"" if unit % RANDOM_EVERY else b"\x50" + (ticks << 15 | 0x7E00).to_bytes(6, "big")  # random access and clock reference
        start, i = 0x40, 0
        while i < len(pes):
            room = PACKET - 4 - (len(field) + 1 if field else 0)
            part = pes[i : i + room]
            i += len(part)
            spare = room - len(part)
            if field or spare:
                if not field and spare == 1:
                    adapted = b"\x00"
                else:
                    flags = field or b"\x00"
                    spare -= 0 if field else 2
                    adapted = bytes([len(flags) + spare]) + flags + b"\xff" * spare
                out.append(bytes([SYNC, start | ES_PID >> 8, ES_PID & 255, 0x30 | counter]) + adapted + part)
            else:
                out.append(bytes([SYNC, start | ES_PID >> 8, ES_PID & 255, 0x10 | counter]) + part)
            counter, start, field = counter + 1 & 15, 0, b""
    return b"".join(out)


class _Sections:
    """Puts the sections of one PID together; one may begin anywhere in a packet and go on over several."""

    def __init__(self):
        self.held: bytearray | None = None

    def drop(self) -> bool:
        """Forget what is unfinished; whether there was such."""
        held, self.held = self.held, None
        return bool(held)

    def feed(self, body: bytes, starts: bool) -> tuple[list[bytes], bool]:
        """(finished sections, whether one was cut short by the next one's start)."""
        out, cut = [], False
        if starts and body:
            pointer = 1 + body[0]
            if self.held is not None:
                self.held += body[1:pointer]
                out += self._finished()
                cut = self.drop()
            self.held = bytearray(body[pointer:])
        elif self.held is not None:
            self.held += body
        return out + self._finished(), cut

    def _finished(self) -> list[bytes]:
        out = []
        while self.held:
            if self.held[0] == 0xFF:  # stuffing up to the packet's end
                self.held = None
            elif len(self.held) < 3 or len(self.held) < (size := 3 + (int.from_bytes(self.held[1:3], "big") & 0xFFF)):
                break
            else:
                out.append(bytes(self.held[:size]))
                del self.held[:size]
        if self.held is not None and not self.held:
            self.held = None
        return out


def demux(media: bytes) -> dict:
    """streams: for each elementary PID its type, payload, pts list, random-access unit numbers and units; and counts of faults.

    A unit is its timestamp, whether it is a random-access point, the place of its first packet and its bytes.
    """
    found = {"packets": 0, "lost_bytes": 0, "counter_errors": 0, "table_errors": 0, "unit_errors": 0, "programs": {}, "streams": {}}
    pmts, last, open_units, tables, streams = {}, {}, {}, {}, found["streams"]

    def close(pid: int) -> None:
        parts, random, packet = open_units.pop(pid)
        data, stream = b"".join(parts), streams[pid]
        if len(data) < 9 or data[:3] != b"\x00\x00\x01":
            found["unit_errors"] += 1
            return
        size, head = int.from_bytes(data[4:6], "big"), 9 + data[8]
        if size and len(data) < size + 6:
            found["unit_errors"] += 1
        if random:
            stream["random_access"].append(len(stream["pts"]))
        p = data[9:14]
        stream["pts"].append((p[0] >> 1 & 7) << 30 | p[1] << 22 | p[2] >> 1 << 15 | p[3] << 7 | p[4] >> 1 if data[7] & 0x80 and len(p) == 5 else None)
        stream["parts"].append(data[head : size + 6 if size else None])
        stream["units"].append({"pts": stream["pts"][-1], "random": random, "at": packet, "size": len(stream["parts"][-1])})

    i, n = 0, len(media)
    while i < n:
        if media[i] != SYNC or i + PACKET > n:
            nxt = media.find(b"\x47", i + 1)
            while 0 <= nxt and nxt + PACKET < n and media[nxt + PACKET] != SYNC:
                nxt = media.find(b"\x47", nxt + 1)
            nxt = n if nxt < 0 or nxt + PACKET > n else nxt
            found["lost_bytes"] += nxt - i
            i = nxt
            continue
        b1, b3 = media[i + 1], media[i + 3]
        pid, at, flags = (b1 & 31) << 8 | media[i + 2], i + 4, 0
        found["packets"] += 1
        if b3 & 0x20:
            flags = media[at + 1] if media[at] else 0
            at += 1 + media[at]
        body = media[at : i + PACKET] if b3 & 0x10 else b""
        i += PACKET
        if pid == 0x1FFF:
            continue
        if b3 & 0x10:
            counter, was = b3 & 15, last.get(pid)
            if was is not None and not flags & 0x80:
                if counter == was[0] and not was[1]:
                    last[pid] = (counter, True)
                    continue
                if counter != was[0] + 1 & 15:
                    found["counter_errors"] += 1
                    found["table_errors"] += pid in tables and tables[pid].drop()
            last[pid] = (counter, False)
        if pid == 0 or pid in pmts:
            sections, cut = tables.setdefault(pid, _Sections()).feed(body, bool(b1 & 0x40))
            found["table_errors"] += cut
            for s in sections:
                if len(s) < 12 or crc_mpeg(s):
                    found["table_errors"] += 1
                elif pid == 0 and s[0] == 0:
                    for k in range(8, len(s) - 4, 4):
                        if number := int.from_bytes(s[k : k + 2], "big"):
                            pmts[int.from_bytes(s[k + 2 : k + 4], "big") & 0x1FFF] = number
                elif pid and s[0] == 2:
                    k = 12 + (int.from_bytes(s[10:12], "big") & 0xFFF)
                    while k + 5 <= len(s) - 4:
                        es = int.from_bytes(s[k + 1 : k + 3], "big") & 0x1FFF
                        streams.setdefault(es, {"type": s[k], "program": pmts[pid], "parts": [], "pts": [], "random_access": [], "units": []})
                        found["programs"].setdefault(pmts[pid], []) if es in found["programs"].get(pmts[pid], []) else found["programs"].setdefault(pmts[pid], []).append(es)
                        k += 5 + (int.from_bytes(s[k + 3 : k + 5], "big") & 0xFFF)
        elif pid in streams:
            if b1 & 0x40:
                if pid in open_units:
                    close(pid)
                open_units[pid] = ([body], bool(flags & 0x40), i - PACKET)
            elif pid in open_units:
                open_units[pid][0].append(body)
            elif body:
                found["unit_errors"] += 1
    for pid in list(open_units):
        close(pid)
    found["table_errors"] += sum(t.drop() for t in tables.values())
    for stream in streams.values():
        stream["payload"] = b"".join(stream.pop("parts"))
    return found


def unit_at(media: bytes, place: int, pid: int) -> bytes:
    """The payload of the unit whose first packet is at a place: its packets are read, up to the next unit's, and nothing else."""
    parts, at = [], place
    while at + PACKET <= len(media) and media[at] == SYNC:
        packet = media[at : at + PACKET]
        if (packet[1] & 31) << 8 | packet[2] == pid and packet[3] & 0x10:
            if packet[1] & 0x40 and parts:
                break
            parts.append(packet[5 + packet[4] :] if packet[3] & 0x20 else packet[4:])
        at += PACKET
    data = b"".join(parts)
    size = int.from_bytes(data[4:6], "big")
    return data[9 + data[8] : size + 6 if size else None]


def seek(read: DataFrame, ticks: Column) -> DataFrame:
    """doc_id, pts, place and first_unit of each row's last random-access point at or before a time (90 kHz); none is null.

    read: rows of ``read_media``; only their units are looked at.
    """
    points = F.filter(F.transform("units", lambda u, k: F.struct(u["pts"].alias("pts"), u["at"].alias("at"), k.alias("k"), u["random"].alias("r"))), lambda u: u["r"] & (u["pts"] <= ticks))
    best = F.array_max(points)
    return read.select("doc_id", best["pts"].alias("pts"), best["at"].alias("place"), best["k"].alias("first_unit"))


def to_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): the text's UTF-8 bytes, padded, as a transport stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            raw = common.utf8(batch)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, raw), pa.int64()), pa.array([mux(pad(x)) for x in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    return common.text_rows(df, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def feature(found: dict) -> str:
    """JSON of what a stream holds: packets, faults, programs and, for each stream, timestamps and random-access points."""
    streams = {
        f"{pid:#06x}": {"type": s["type"], "units": len(s["pts"]), "pts": [s["pts"][0], s["pts"][-1]] if s["pts"] else [], "random_access": [[k, s["pts"][k]] for k in s["random_access"]]}
        for pid, s in sorted(found["streams"].items())
    }
    return json.dumps({k: found[k] for k in ("packets", "lost_bytes", "counter_errors", "table_errors", "unit_errors", "programs")} | {"streams": streams}, separators=(",", ":"))


def read_media(df: DataFrame) -> DataFrame:
    """Digests, features and units of (doc_id, n_bytes, media) rows; payload and units are those of the lowest elementary PID."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, units array<struct<pts: long, random: boolean, at: long, size: long>>"
    units = pa.list_(pa.struct([("pts", pa.int64()), ("random", pa.bool_()), ("at", pa.int64()), ("size", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "media"):
            rows = []
            for media in batch.column("media").to_pylist():
                found = demux(media)
                first = found["streams"][min(found["streams"])] if found["streams"] else {"payload": b"", "units": []}
                payload = first["payload"]
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(found), first["units"]))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), units))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "units"])

    return df.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def op4_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_media(common.stage_table(to_media(common.documents(spark, sf_dir)), "media"))
