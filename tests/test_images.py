"""Images encoded here with every filter, decoded back; turned, resized, and counted against plain versions."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.sources import images

rng = np.random.default_rng(8)


def png(image, kinds=None, palette=None, bits=None):
    """A PNG with row filters of the given kinds, in turn; plain loops over bytes."""
    height, width, channels = image.shape
    bits = bits or 8 * image.itemsize
    raw = image.astype(">u2").view(np.uint8).reshape(height, -1) if bits == 16 else image.reshape(height, -1)
    step, lines, before = channels * bits // 8, b"", [0] * raw.shape[1]
    for y, row in enumerate(raw.tolist()):
        kind = kinds[y % len(kinds)] if kinds else 0
        left = [0] * step + row[:-step]
        corner = [0] * step + before[:-step]

        def guess(k, x, a, b, c, kind=kind):
            if kind == 4:
                p = a + b - c
                near = [abs(p - a), abs(p - b), abs(p - c)]
                return (a, b, c)[near.index(min(near))]
            return (0, a, b, (a + b) // 2)[kind]

        lines += bytes([kind, *((v - guess(k, x, a, b, c)) % 256 for k, (x, v, a, b, c) in enumerate(zip(range(len(row)), row, left, before, corner)))])
        before = row
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    colour = 3 if palette is not None else {1: 0, 2: 4, 3: 2, 4: 6}[channels]
    data = zlib.compress(lines)
    cut = len(data) // 2
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, bits, colour, 0, 0, 0)) + (chunk(b"PLTE", palette.tobytes()) if palette is not None else b"") + chunk(b"IDAT", data[:cut]) + chunk(b"IDAT", data[cut:]) + chunk(b"IEND", b"")


def some(height, width, channels, kind="u1"):
    smooth = np.add.outer(np.arange(height) * 3, np.arange(width) * 5)[..., None] * np.arange(1, channels + 1)
    return (smooth + rng.integers(0, 40, (height, width, channels))).astype(kind) if kind == "u1" else (smooth * 300 + rng.integers(0, 4000, (height, width, channels))).astype("u2")


@pytest.mark.parametrize("kinds", [[0], [1], [2], [3], [4], [4, 3, 2, 1, 0]])
@pytest.mark.parametrize("channels", [1, 3, 4])
def test_every_filter(kinds, channels):
    made = [some(9, 13, channels), some(9, 13, channels), some(1, 1, channels), some(17, 2, channels)]
    got = images.decode([png(v, kinds) for v in made])
    assert all(np.array_equal(a, b) for a, b in zip(got, made))


def test_sixteen_bits_and_palettes():
    depth = some(7, 11, 1, "u2")
    palette = rng.integers(0, 256, (40, 3)).astype("u1")
    index = rng.integers(0, 40, (6, 5, 1)).astype("u1")
    got = images.decode([png(depth, [4, 1]), png(index, [2], palette=palette)])
    assert got[0].dtype == np.uint16 and np.array_equal(got[0], depth) and np.array_equal(got[1], palette[index[..., 0]])


def test_raw_buffers_and_broken_images(spark):
    image = some(4, 6, 3)
    whole = png(image, [4])
    rows = [(1, whole), (2, image.tobytes()), (3, whole[:-30]), (4, b"\xff\xd8\xff"), (5, None), (6, b""), (7, whole.replace(b"IHDR" + struct.pack(">II", 6, 4), b"IHDR" + struct.pack(">II", 6, 5)))]
    got = {r.id: r for r in images.decoded(spark.createDataFrame(rows, "id int, data binary"), "data", {72: (4, 6, 3)}, bgr=True).collect()}
    for k in (1, 2):
        assert (got[k].height, got[k].width, got[k].channels, got[k].depth, got[k].error) == (4, 6, 3, 8, None)
        assert bytes(got[k].pixels) == image[..., ::-1].tobytes()
    assert all(got[k].pixels is None and got[k].error for k in (3, 4, 6, 7)) and got[5].pixels is None and got[5].error is None
    assert {s: np.prod(v) for s, v in images.RAW_COLOUR.items()} == {s: s for s in images.RAW_COLOUR}


def test_turn_and_resize(spark):
    image = some(6, 8, 3)
    got = images.decoded(spark.createDataFrame([(png(image),)], "data binary"), "data", turn=True).first()
    assert bytes(got.pixels) == image[::-1, ::-1].tobytes()
    assert np.array_equal(images.resized(image, 6, 8), image)
    ramp = np.repeat(np.arange(8.0)[None, :, None], 4, axis=0)
    assert images.resized(ramp, 4, 4)[0, :, 0].tolist() == [0.5, 2.5, 4.5, 6.5]
    assert images.resized(ramp, 2, 16)[0, :3, 0].tolist() == [0.0, 0.25, 0.75]


def plain_resize(v, height, width):
    out = np.zeros((height, width, v.shape[2]))
    for y in range(height):
        for x in range(width):
            fy = min(max((y + 0.5) * v.shape[0] / height - 0.5, 0), v.shape[0] - 1)
            fx = min(max((x + 0.5) * v.shape[1] / width - 0.5, 0), v.shape[1] - 1)
            for c in range(v.shape[2]):
                for yy, wy in ((int(fy), 1 - fy % 1), (min(int(fy) + 1, v.shape[0] - 1), fy % 1)):
                    for xx, wx in ((int(fx), 1 - fx % 1), (min(int(fx) + 1, v.shape[1] - 1), fx % 1)):
                        out[y, x, c] += wy * wx * v[yy, xx, c]
    return out


def test_resize_against_a_plain_one():
    v = some(5, 7, 2).astype(float)
    for shape in ((3, 4), (11, 9), (1, 1)):
        assert np.allclose(images.resized(v, *shape), plain_resize(v, *shape))


def test_statistics_of_sampled_frames(spark):
    """Episodes of made images: even samples, channel statistics over 255, against numpy."""
    lengths = {1: 9, 2: 1, 3: 4}
    made = {(e, t): some(5, 7, 3) for e, n in lengths.items() for t in range(n)}
    made[1, 0] = some(310, 200, 3)
    df = spark.createDataFrame([(e, t, png(v, [4, 2])) for (e, t), v in made.items()], "episode_index long, frame_index long, data binary")
    picked = images.sampled(df, "episode_index", "frame_index", F.lit(4))
    assert sorted((r.episode_index, r.frame_index) for r in picked.collect()) == [(1, 0), (1, 3), (1, 5), (1, 8), (2, 0), (3, 0), (3, 1), (3, 2), (3, 3)]
    got = {(r.episode_index, r.channel): r for r in images.channel_sums(images.decoded(picked, "data"), ["episode_index"]).collect()}
    for e, frames in ((1, (0, 3, 5, 8)), (2, (0,)), (3, range(4))):
        pixels = np.concatenate([images.shrunk(made[e, t]).reshape(-1, 3) for t in frames]).astype(float) / 255
        for c in range(3):
            r, v = got[e, c], pixels[:, c]
            assert (r.min, r.max, r.mean, r.std, r["count"]) == pytest.approx((v.min(), v.max(), v.mean(), v.std(), len(frames)))
    assert images.shrunk(made[1, 0]).shape == (155, 100, 3)
