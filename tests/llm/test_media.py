"""Lossless WebP: round trips, and streams written here bit by bit with every transform and kind of code."""

import hashlib
import zlib

import numpy as np
import pytest

from cellweave.llm import media, webp
from cellweave.llm.webp import Writer, canonical, code_lengths, number_of, put_code


def payload(text):
    held = (text or "").encode()
    return held + bytes(max(64, -(-len(held) // 64) * 64) - len(held))


@pytest.mark.parametrize("held", [bytes(64), b"ab" * 64, bytes(range(17)) * 64, bytes(range(3)) * 64, b"abc\n" * 48, (b"one line that is long enough to be repeated\n" * 30)[:1280], bytes(63) + b"x", b"q" * 20480])
def test_grey_round_trip(held):
    image = webp.decode(webp.encode_grey(held, 64))
    assert image.shape == (len(held) // 64, 64, 4) and (image[..., 3] == 255).all()
    assert all(image[..., k].tobytes() == held for k in range(3))


def test_grey_random():
    draw = np.random.default_rng(1)
    for n in (64, 640, 64000):
        for most in (2, 5, 40, 256):
            held = (draw.integers(0, most, n) * draw.integers(0, 2, n)).astype(np.uint8).tobytes()
            assert webp.decode(webp.encode_grey(held, 64))[..., 1].tobytes() == held


def test_skewed_counts_stay_within_15_bits():
    counts = np.array([int(1.7**i) + 1 for i in range(40)])
    lengths = code_lengths(counts)
    assert max(lengths) <= 15 and sum(2.0**-n for n in lengths) == 1


# a plain writer of VP8L parts: symbols one by one, as the specification has them


def put_symbols(out, pixels, cache_bits=0, references=(), width=1):
    """One group of codes; pixels: (a, r, g, b); references: at -> (length, distance code); a pixel that the cache holds is taken from it."""
    steps, cache, at = [], {}, 0
    references = dict(references)
    key = lambda p: (((p[0] << 24 | p[1] << 16 | p[2] << 8 | p[3]) * 0x1E35A7BD) & 0xFFFFFFFF) >> (32 - cache_bits)
    while at < len(pixels):
        if at in references:
            length, code = references[at]
            steps.append(("copy", number_of(length), number_of(code)))
        elif cache_bits and cache.get(key(pixels[at])) == pixels[at]:
            length = 1
            steps.append(("cache", key(pixels[at])))
        else:
            length = 1
            steps.append(("pixel", pixels[at]))
        for p in pixels[at : at + length]:
            if cache_bits:
                cache[key(p)] = p
        at += length
    counts = [np.zeros(n, dtype=int) for n in (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)]
    for kind, *x in steps:
        if kind == "pixel":
            a, r, g, b = x[0]
            for c, v in zip(counts, (g, r, b, a), strict=False):
                c[v] += 1
        elif kind == "copy":
            counts[0][256 + x[0][0]] += 1
            counts[4][x[1][0]] += 1
        else:
            counts[0][280 + x[0]] += 1
    lengths = [code_lengths(c) for c in counts]
    codes = [canonical(x) if sum(map(bool, x)) > 1 else dict.fromkeys(range(len(x)), (0, 0)) for x in lengths]
    for x in lengths:
        put_code(out, x)
    for kind, *x in steps:
        if kind == "pixel":
            a, r, g, b = x[0]
            for c, v in zip(codes, (g, r, b, a), strict=False):
                out.put(*c[v])
        elif kind == "copy":
            for c, base, (symbol, extra, n) in ((codes[0], 256, x[0]), (codes[4], 0, x[1])):
                out.put(*c[base + symbol])
                out.put(extra, n)
        else:
            out.put(*codes[0][280 + x[0]])


def file_of(out):
    data = out.value.to_bytes(-(-out.size // 8), "little")
    return b"RIFF" + (12 + len(data) + len(data) % 2).to_bytes(4, "little") + b"WEBPVP8L" + len(data).to_bytes(4, "little") + data + bytes(len(data) % 2)


def head(width, height, alpha=1):
    out = Writer()
    for value, n in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (alpha, 1), (0, 3)):
        out.put(value, n)
    return out


def random_image(width, height, seed=0, most=256):
    return np.random.default_rng(seed).integers(0, most, (height, width, 4)).astype(np.uint8)  # r, g, b, a


def listed(image):
    return [(int(a), int(r), int(g), int(b)) for r, g, b, a in image.reshape(-1, 4)]


def finish(out, image, cache_bits=0, references=()):
    out.put(0, 1)
    out.put(cache_bits > 0, 1)
    if cache_bits:
        out.put(cache_bits, 4)
    out.put(0, 1)
    put_symbols(out, listed(image), cache_bits, references)
    return webp.decode(file_of(out))


@pytest.mark.parametrize("cache_bits", [0, 1, 4, 11])
def test_colour_cache(cache_bits):
    image = random_image(9, 7, most=3)
    assert (finish(head(9, 7), image, cache_bits) == image).all()


def test_no_alpha():
    image = random_image(5, 5)
    assert (finish(head(5, 5, alpha=0), image)[..., 3] == 255).all()


@pytest.mark.parametrize("cache_bits", [0, 3])
def test_back_references(cache_bits):
    image = random_image(8, 6, seed=3, most=4)
    flat = image.reshape(-1, 4)
    flat[10:30] = [flat[9]] * 20  # overlapping: distance 1
    flat[32:40] = flat[24:32]  # the row above
    flat[40:44] = flat[31:35]  # up and to the right
    references = {10: (20, 2), 32: (8, 1), 40: (4, 120 + 9)}
    assert (finish(head(8, 6), image, cache_bits, references) == image).all()


def test_near_distances():
    assert [webp.read_distance(c, 10) for c in (1, 2, 3, 4, 120, 121, 130)] == [10, 1, 11, 9, 78, 1, 10]
    assert webp.read_distance(4, 1) == 1 and len(webp.NEAR) == len(set(webp.NEAR)) == 120


def put_sub_image(out, pixels):
    out.put(0, 1)
    put_symbols(out, pixels)


@pytest.mark.parametrize("mode", range(14))
def test_predictors(mode):
    width, height = 11, 6
    image = random_image(width, height, seed=mode).astype(int)

    def guess(x, y):
        px = lambda dx, dy: image[y + dy, x + dx] if x + dx < width else image[y, 0]
        if x == 0 and y == 0:
            return np.array([0, 0, 0, 255])
        if y == 0:
            return px(-1, 0)
        if x == 0:
            return px(0, -1)
        left, up, up_right, up_left = px(-1, 0), px(0, -1), px(1, -1), px(-1, -1)
        half = lambda a, b: (a + b) // 2
        if mode == 11:
            p = left + up - up_left
            return left if abs(p - left).sum() < abs(p - up).sum() else up
        return [np.array([0, 0, 0, 255]), left, up, up_right, up_left, half(half(left, up_right), up), half(left, up_left), half(left, up), half(up_left, up), half(up, up_right), half(half(left, up_left), half(up, up_right)), None, np.clip(left + up - up_left, 0, 255), np.clip(half(left, up) + ((half(left, up) - up_left) / 2).astype(int), 0, 255)][mode]

    rest = np.array([[(image[y, x] - guess(x, y)) % 256 for x in range(width)] for y in range(height)]).astype(np.uint8)
    out = head(width, height)
    out.put(1, 1)
    out.put(0, 2)
    out.put(0, 3)  # blocks of 4
    put_sub_image(out, [(255, 0, mode, 0)] * (3 * 2))
    assert (finish(out, rest) == image).all()


def test_mixed_predictor_blocks():
    width, height, modes = 9, 9, [1, 11, 3, 0, 13, 2, 12, 1, 5]
    rest = random_image(width, height, seed=8)
    out = head(width, height)
    for value, n in ((1, 1), (0, 2), (0, 3)):
        out.put(value, n)
    put_sub_image(out, [(255, 0, m, 0) for m in modes])
    whole = finish(out, rest)
    numbers = rest[..., [2, 1, 0, 3]].copy().view("<u4").reshape(height, width)
    slow = np.zeros((height, width, 4), dtype=np.int64)
    for y in range(height):
        for x in range(width):
            near = lambda dx, dy: slow[y + dy, x + dx] if x + dx < width else slow[y, 0]
            p = np.array([0, 0, 0, 255]) if not x and not y else near(-1, 0) if not y else near(0, -1) if not x else webp.predict(modes[(y >> 2) * 3 + (x >> 2)], near(-1, 0), near(0, -1), near(1, -1), near(-1, -1))
            slow[y, x] = (numbers.view(np.uint8).reshape(height, width, 4)[y, x] + p) % 256
    assert (whole[..., [2, 1, 0, 3]] == slow).all()


def test_cross_colour_and_subtract_green():
    width, height = 10, 5
    image = random_image(width, height, seed=4).astype(int)
    signed = lambda v: v - 256 if v > 127 else v
    factors = [(255, 200, 20, 131), (255, 5, 250, 77), (255, 128, 127, 1)] * 2  # alpha, red to blue, green to blue, green to red
    rest = image.copy()
    for y in range(height):
        for x in range(width):
            _, red_blue, green_blue, green_red = map(signed, factors[(y >> 2) * 3 + (x >> 2)])
            r, g, b, a = map(int, image[y, x])
            rest[y, x] = [(r - (green_red * signed(g) >> 5)) % 256, g, (b - (green_blue * signed(g) >> 5) - (red_blue * signed(r) >> 5)) % 256, a]
    rest[..., 0] = (rest[..., 0] - rest[..., 1]) % 256
    rest[..., 2] = (rest[..., 2] - rest[..., 1]) % 256
    out = head(width, height)
    for value, n in ((1, 1), (1, 2), (0, 3)):
        out.put(value, n)
    put_sub_image(out, factors)
    out.put(1, 1)
    out.put(2, 2)
    assert (finish(out, rest.astype(np.uint8)) == image).all()


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 200])
def test_palette(size):
    width, height = 13, 4
    colours = random_image(size, 1, seed=size)[0]
    index = np.random.default_rng(0).integers(0, size, (height, width))
    each = 8 if size <= 2 else 4 if size <= 4 else 2 if size <= 16 else 1
    packed = np.zeros((height, -(-width // each), 4), dtype=np.uint8)
    for x in range(width):
        packed[:, x // each, 1] |= (index[:, x] << (x % each) * (8 // each)).astype(np.uint8)
    out = head(width, height)
    out.put(1, 1)
    out.put(3, 2)
    out.put(size - 1, 8)
    put_sub_image(out, listed(np.diff(colours, axis=0, prepend=np.zeros((1, 4), dtype=np.uint8))))
    assert (finish(out, packed) == colours[index]).all()


def test_groups_of_codes():
    width, height = 12, 8
    image = random_image(width, height, seed=6)
    out = head(width, height)
    out.put(0, 1)
    out.put(0, 1)
    out.put(1, 1)
    out.put(0, 3)
    groups = [0, 1, 300, 1, 0, 300]
    out.put(0, 1)
    put_symbols(out, [(255, g >> 8, g & 255, 0) for g in groups])
    counts = {}
    blocks = {(y, x): groups[(y >> 2) * 3 + (x >> 2)] for y in range(height) for x in range(width)}
    for at, g in blocks.items():
        for k, v in enumerate(image[at][[1, 0, 2, 3]]):
            counts.setdefault(g, [np.zeros(n, dtype=int) for n in (280, 256, 256, 256)])[k][v] += 1
    codes = {}
    for g in range(301):
        lengths = [code_lengths(c) for c in counts[g]] if g in counts else [[1, *[0] * 279]] + [[1, *[0] * 255]] * 3
        codes[g] = [canonical(x) if sum(map(bool, x)) > 1 else dict.fromkeys(range(280), (0, 0)) for x in lengths]
        for x in [*lengths, [0] * 40]:
            put_code(out, x)
    for at, g in blocks.items():
        for k, v in enumerate(image[at][[1, 0, 2, 3]]):
            out.put(*codes[g][k][int(v)])
    assert (webp.decode(file_of(out)) == image).all()


def test_broken_files():
    good = webp.encode_grey(b"some text that is long enough for this test, and then some more of".ljust(128, b"z"), 64)
    for bad in (b"", b"RIFF", b"x" * 50, good[:30], good[:8] + b"WAVE" + good[12:], good[:20] + b"\x00" + good[21:]):
        with pytest.raises(ValueError):
            webp.decode(bad)


def test_column(spark, make, odd, real, tmp_path):
    texts, path = odd + real.text.tolist()[:60], f"file://{tmp_path}/media"
    media.store(make(texts), path)
    stored = spark.read.parquet(path)
    files = {r.doc_id: bytes(r.media) for r in stored.collect()}
    for r in media.payloads(stored).collect():
        held = payload(texts[r.doc_id])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((texts[r.doc_id] or "").encode()), len(held), hashlib.sha256(held).hexdigest(), zlib.crc32(held[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(files[r.doc_id]), hashlib.sha256(files[r.doc_id]).hexdigest())
    for r in media.pixels(stored).collect():
        assert bytes(r.pixels)[1::4] == payload(texts[r.doc_id]) and len(r.pixels) == 4 * r.width * r.height
    assert files[3] == files[4] and media.pixels(spark.createDataFrame([(1, None)], "doc_id long, media binary")).first().pixels is None
    media.store(make([]), path + "0")
    assert media.payloads(spark.read.parquet(path + "0")).count() == 0


def test_wide_rows(monkeypatch):
    monkeypatch.setattr(media, "MOST_SIDE", 4)
    held = payload("a text of some length, " * 40)
    image = webp.decode(media.image_of(held))
    assert image.shape[1] == 256 and image[..., 1].tobytes()[: len(held)] == held


def test_shared_and_missing_ids_and_long_texts(spark, make, tmp_path):
    texts = ["one", "one", None, "line of a long text\n" * 20000]
    docs = make(texts, ids=[7, 7, None, 7]).selectExpr("*", "1 as media", "2 as n_bytes")
    media.store(docs, f"file://{tmp_path}/media")
    rows = media.payloads(spark.read.parquet(f"file://{tmp_path}/media")).collect()
    want = [(i or 0, len(t or ""), hashlib.sha256(media.padded((t or "").encode())).hexdigest()) for i, t in zip([7, 7, None, 7], texts, strict=True)]
    assert sorted((r.doc_id or 0, r.n_bytes, r.payload_sha256) for r in rows) == sorted(want)
