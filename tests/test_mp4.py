"""Sample tables of made MP4 files against what was put into them."""

import struct

import pytest
from pyspark.sql import functions as F

from framewright.sources import mp4


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind.encode()) + body


def full(kind, version, *parts):
    return box(kind, struct.pack(">B3x", version), *parts)


def counted(rows, form):
    return struct.pack(">I", len(rows)) + b"".join(struct.pack(">" + form, *r) for r in rows)


def movie(sizes, deltas, per_chunk, sync=None, later=None, timescale=90000, shift=None, wide=False, front=False, number=7):
    """(bytes, the frames' rows): chunks of ``per_chunk`` samples with gaps between, tables run-length coded."""
    n = len(sizes)

    def runs(values):
        out = []
        for v in values:
            if out and out[-1][1] == v:
                out[-1][0] += 1
            else:
                out.append([1, v])
        return out

    def tables(base):
        chunks, rows, at, k = [], [], base, 0
        for c in per_chunk:
            chunks.append(at)
            for _ in range(c):
                rows.append((k, at, sizes[k]))
                at += sizes[k]
                k += 1
            at += 5
        firsts, c = [], 1
        for count, v in runs(per_chunk):
            firsts.append((c, v, 1))
            c += count
        one = len(set(sizes)) == 1
        stbl = box(
            "stbl",
            full("stsd", 0, struct.pack(">I", 1), box("avc1", bytes(24), struct.pack(">HH", 640, 360), bytes(50))),
            full("stts", 0, counted(runs(deltas), "II")),
            full("ctts", 1, counted(runs(later), "Ii")) if later else b"",
            full("stss", 0, counted([(s + 1,) for s in sync], "I")) if sync is not None else b"",
            full("stsc", 0, counted(firsts, "III")),
            full("stsz", 0, struct.pack(">I", sizes[0] if one else 0), struct.pack(">I", n) if one else counted([(s,) for s in sizes], "I")),
            full("co64", 0, counted([(c,) for c in chunks], "Q")) if wide else full("stco", 0, counted([(c,) for c in chunks], "I")),
        )
        edit = box("edts", full("elst", 0, counted([(0, -1, 1 << 16), (sum(deltas), shift, 1 << 16)], "IiI"))) if shift is not None else b""
        clock = full("mdhd", 1, bytes(16), struct.pack(">IQ", timescale, sum(deltas)), bytes(4)) if wide else full("mdhd", 0, bytes(8), struct.pack(">II", timescale, sum(deltas)), bytes(4))
        media = box("mdia", clock, full("hdlr", 0, bytes(4), b"vide", bytes(13)), box("minf", box("vmhd", bytes(12)), stbl))
        head = full("tkhd", 0, bytes(8), struct.pack(">I", number), bytes(68))
        return box("moov", full("mvhd", 0, bytes(96)), box("trak", head, edit, media), box("udta", bytes(3))), rows

    brand = box("ftyp", b"isom", bytes(12))
    room = sum(sizes) + 5 * len(per_chunk)
    head = struct.pack(">I4sQ", 1, b"mdat", 16 + room) if wide else struct.pack(">I4s", 8 + room, b"mdat")
    if front:
        length = len(tables(0)[0])
        moov, rows = tables(len(brand) + length + len(head))
        data = brand + moov + head + bytes(room)
    else:
        moov, rows = tables(len(brand) + len(head))
        data = brand + head + bytes(room) + moov
    want, t = [], 0
    for k, at, size in rows:
        shown = t + (later[k] if later else 0) - (shift or 0)
        want.append((k, pytest.approx((t - (shift or 0)) / timescale), pytest.approx(shown / timescale), pytest.approx(deltas[k] / timescale), at, size, sync is None or k in sync))
        t += deltas[k]
    return data, want


MOVIES = {
    "a.mp4": movie([100 + 7 * k % 13 for k in range(50)], [3000] * 50, [4] * 12 + [2], sync=range(0, 50, 10)),
    "b.mp4": movie([9] * 7, [1000, 1000, 1500, 1000, 1000, 1, 2], [3, 1, 3], timescale=1000, front=True),
    "c.mp4": movie([1, 0, 300, 4, 5, 6], [512] * 6, [1, 1, 2, 2], sync=[0, 3], later=[1024, 2048, 512, -512, 0, 0], shift=1024, timescale=15360, wide=True, number=2),
}


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("videos")
    for name, (data, _) in MOVIES.items():
        (at / name).write_bytes(data)
    whole = MOVIES["a.mp4"][0]
    (at / "cut.mp4").write_bytes(whole[:-40])
    (at / "still.mp4").write_bytes(box("ftyp", b"isom"))
    (at / "odd.mp4").write_bytes(whole.replace(b"stsz" + bytes(8) + struct.pack(">I", 50), b"stsz" + bytes(8) + struct.pack(">I", 49)))
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp4").load(str(at)).select("path")
    return mp4.tracks(listed).withColumn("path", F.element_at(F.split("path", "/"), -1))


def test_tracks(found):
    got = {r.path: r for r in found.collect()}
    assert (got["a.mp4"].kind, got["a.mp4"].codec, got["a.mp4"].width, got["a.mp4"].height, got["a.mp4"].timescale, got["a.mp4"].duration, got["a.mp4"].track) == ("vide", "avc1", 640, 360, 90000, 150000, 7)
    assert got["b.mp4"].size == 9 and got["b.mp4"].sizes is None and got["b.mp4"].sync is None
    assert "ends beyond" in got["cut.mp4"].error and "no movie" in got["still.mp4"].error and "samples" in got["odd.mp4"].error


def test_frames(found):
    got = {}
    for r in mp4.frames(found).orderBy("frame").collect():
        got.setdefault(r.path, []).append((r.frame, r.time, r.shown, r.duration, r.offset, r.size, r.sync))
    assert set(got) == set(MOVIES)
    for name, (_, want) in MOVIES.items():
        assert got[name] == want


def test_frame_counts(spark, found):
    wanted = spark.createDataFrame([("a.mp4", 50), ("b.mp4", 5), ("c.mp4", 7), ("still.mp4", 1)], "path string, n_steps long")
    assert {r.path: (r.n_frames, r.ok) for r in mp4.frame_counts(found, wanted).collect()} == {"a.mp4": (50, True), "b.mp4": (7, True), "c.mp4": (6, False), "still.mp4": (0, False)}
    assert {r.path: r.ok for r in mp4.frame_counts(found, wanted, 1).collect()}["b.mp4"] is False


def test_cut_points(spark, found):
    spans = [(1, "a.mp4", 0.0, 10 / 30), (2, "a.mp4", 10 / 30, 1.0), (3, "a.mp4", 0.5, 1.0), (4, "a.mp4", 1.0, 9.0), (5, "b.mp4", 2.0, 3.5), (6, "none.mp4", 0.0, 1.0)]
    got = {r.episode: r for r in mp4.cut_points(mp4.frames(found), spark.createDataFrame(spans, "episode int, path string, from_timestamp double, to_timestamp double")).collect()}
    sizes = [s for *_, s, _ in MOVIES["a.mp4"][1]]
    assert [(got[k].first_frame, got[k].last_frame, got[k].exact) for k in range(1, 7)] == [(0, 9, True), (10, 29, True), (10, 29, False), (30, 49, True), (2, 2, True), (None, None, False)]
    assert got[3].bytes == sum(sizes[10:30]) and got[3].cut_from == pytest.approx(1 / 3)
