"""Lossless WebP (VP8L): a decoder for the whole format and an encoder for what this library stores.

`decode` reads any lossless WebP file: prefix codes (simple and normal), groups of them by block, back-references, colour cache, and the
predictor, cross-colour, subtract-green and palette transforms. Pixels come back as an array of height x width x 4 bytes, red, green, blue, alpha.

An image whose red, blue and alpha codes have one symbol each and that has no colour cache takes a fast way: at every bit position the
next symbol's end is looked up at once with numpy, and the chain of true positions is followed in strides; only back-references are
taken one by one.

`encode_grey` stores a grey image by the subtract-green transform (up to 16 values: a palette, with several pixels to a byte),
back-references to equal lines and runs, and one prefix code.

The format is described in the "WebP Lossless Bitstream Specification". Tables under "fixed values" are that specification's.
"""

from __future__ import annotations

import functools
import struct

import numpy as np

# --- fixed values of the format ---
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: (x, y) of the 120 distance codes for near pixels: x to the left, y rows up.
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3),
    (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4),
    (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2),
    (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1), (2, 6), (-2, 6), (6, 2), (-6, 2),
    (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5),
    (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7),
    (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = 0, 1, 2, 3
HASH_FACTOR = 0x1E35A7BD
SIGNATURE = 0x2F
LONGEST_CODE, LENGTH_SYMBOLS, DISTANCE_SYMBOLS, MOST_SIDE, MOST_LENGTH = 15, 24, 40, 1 << 14, 4096
# --- end of fixed values ---


class Bits:
    """Reads bits, the lowest first."""

    def __init__(self, data: bytes):
        self.data, self.at = data + bytes(16), 0

    def look(self) -> int:
        """At least 32 bits from here on."""
        byte = self.at >> 3
        return int.from_bytes(self.data[byte : byte + 8], "little") >> (self.at & 7)

    def read(self, n: int) -> int:
        value = self.look() & ((1 << n) - 1)
        self.at += n
        if self.at > (len(self.data) - 8) * 8:
            raise ValueError("the image data ends too early")
        return value


class Code:
    """A prefix code: a table from the next 15 bits to symbol and length. A single symbol takes no bits."""

    def __init__(self, lengths: list[int]):
        self.symbols = [s for s, n in enumerate(lengths) if n]
        self.single = self.symbols[0] if len(self.symbols) == 1 else None if self.symbols else 0
        if self.single is not None:
            return
        if sum(1 << (LONGEST_CODE - n) for n in lengths if n) != 1 << LONGEST_CODE:
            raise ValueError("a prefix code isn't complete")
        self.longest = max(lengths)
        self.table = np.zeros(1 << self.longest, dtype=np.uint16)
        for symbol, (bits, n) in canonical(lengths).items():
            self.table[bits :: 1 << n] = symbol << 4 | n
        self.entries: list[int] | None = None

    def read(self, bits: Bits) -> int:
        if self.single is not None:
            return self.single
        if self.entries is None:
            self.entries = self.table.tolist()
        entry = self.entries[bits.look() & ((1 << self.longest) - 1)]
        bits.at += entry & 15
        return entry >> 4


REVERSED = [int(f"{i:015b}"[::-1], 2) for i in range(1 << LONGEST_CODE)]


def canonical(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """The bits (the first one lowest) and length of each symbol."""
    out, code, last = {}, 0, 0
    for n, symbol in sorted([(n, s) for s, n in enumerate(lengths) if n]):
        code <<= n - last
        out[symbol] = (REVERSED[code] >> (LONGEST_CODE - n), n)
        code, last = code + 1, n
    return out


def read_code(bits: Bits, alphabet: int) -> Code:
    lengths = [0] * alphabet
    if bits.read(1):  # simple
        two = bits.read(1)
        first = bits.read(8 if bits.read(1) else 1)
        symbols = [first, bits.read(8)] if two else [first]
        for s in symbols:
            lengths[s] = 1
        return Code(lengths)
    of_lengths = [0] * 19
    for i in range(bits.read(4) + 4):
        of_lengths[CODE_LENGTH_ORDER[i]] = bits.read(3)
    most = alphabet
    if bits.read(1):
        most = 2 + bits.read(2 + 2 * bits.read(3))
    code, at, last = Code(of_lengths), 0, 8
    while at < alphabet and most:
        most -= 1
        n = code.read(bits)
        if n < 16:
            lengths[at] = n
            last, at = n or last, at + 1
            continue
        value, times = (last, 3 + bits.read(2)) if n == 16 else (0, 3 + bits.read(3)) if n == 17 else (0, 11 + bits.read(7))
        if at + times > alphabet:
            raise ValueError("too many code lengths")
        lengths[at : at + times] = [value] * times
        at += times
    return Code(lengths)


def read_number(symbol: int, bits: Bits) -> int:
    """The length or distance that a prefix symbol and its extra bits stand for."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def read_distance(code: int, width: int) -> int:
    if code > len(NEAR):
        return code - len(NEAR)
    x, y = NEAR[code - 1]
    return max(1, x + y * width)


def read_pixels(bits: Bits, width: int, height: int, top: bool) -> np.ndarray:
    """Entropy-coded pixels as 32-bit numbers: alpha, red, green, blue from the highest byte on."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("the colour cache is too large")
    blocks, shift, n_groups = None, 0, 1
    if top and bits.read(1):
        shift = bits.read(3) + 2
        wide = -(-width >> shift) if False else (width + (1 << shift) - 1) >> shift
        blocks = (read_pixels(bits, wide, (height + (1 << shift) - 1) >> shift, False) >> 8 & 0xFFFF).reshape(-1, wide)
        n_groups = int(blocks.max()) + 1
    groups = [[read_code(bits, n) for n in (256 + LENGTH_SYMBOLS + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_SYMBOLS)] for _ in range(n_groups)]
    if blocks is None and not cache_bits and all(c.single is not None for c in groups[0][1:4]):
        return read_fast(bits, width, width * height, groups[0])
    n, at, cached = width * height, 0, 0
    out, cache = [0] * n, [0] * (1 << cache_bits)
    while at < n:
        group = groups[0 if blocks is None else int(blocks[(at // width) >> shift, (at % width) >> shift])]
        symbol = group[0].read(bits)
        if symbol < 256:
            red, blue, alpha = (group[k].read(bits) for k in (1, 2, 3))
            out[at] = alpha << 24 | red << 16 | symbol << 8 | blue
            at += 1
        elif symbol < 256 + LENGTH_SYMBOLS:
            length = read_number(symbol - 256, bits)
            distance = read_distance(read_number(group[4].read(bits), bits), width)
            if distance > at or at + length > n:
                raise ValueError("a back-reference leaves the image")
            for k in range(at, at + length):
                out[k] = out[k - distance]
            at += length
        else:
            while cached < at:
                cache[((out[cached] * HASH_FACTOR) & 0xFFFFFFFF) >> (32 - cache_bits)] = out[cached]
                cached += 1
            out[at] = cache[symbol - 256 - LENGTH_SYMBOLS]
            at += 1
    return np.array(out, dtype=np.uint32)


def read_fast(bits: Bits, width: int, n: int, group: list[Code]) -> np.ndarray:
    """As read_pixels, where only green differs from pixel to pixel."""
    green, rest = group[0], group[3].single << 24 | group[1].single << 16 | group[2].single
    if green.single is not None and green.single < 256:
        return np.full(n, rest | green.single << 8, dtype=np.uint32)
    out, at = bytearray(), bits.at & 7
    base = bits.at - at
    held = np.frombuffer(bits.data, dtype=np.uint8)[base >> 3 :].astype(np.uint32)
    held = held[:-2] | held[1:-1] << 8 | held[2:] << 16
    symbol, step = np.zeros(0, dtype=np.uint16), np.zeros(0, dtype=np.int64)
    if green.single is None:
        entry = green.table[(held[:, None] >> np.arange(8, dtype=np.uint32) & ((1 << green.longest) - 1)).ravel()]
        symbol, size = entry >> 4, (entry & 15).astype(np.int32)
    else:
        symbol, size = np.full(8 * len(held), green.single, dtype=np.uint16), np.zeros(8 * len(held), dtype=np.int32)
    places = np.arange(len(symbol), dtype=np.int32)
    step = np.where(symbol < 256, np.minimum(places + size, len(symbol) - 1), places)  # a back-reference stays where it is
    step[-1] = len(symbol) - 1
    stride = step[step]
    stride = stride[stride]
    stride = stride[stride]
    jump = memoryview(stride)
    literal = (symbol & 255).astype(np.uint8)
    while len(out) < n:
        here, marks, left = at, [], n - len(out)
        while 8 * len(marks) < left:
            marks.append(here)
            there = jump[here]
            if there == here:
                break
            here = there
        way = np.empty((len(marks), 8), dtype=np.int32)
        way[:, 0] = marks
        for k in range(1, 8):
            way[:, k] = step[way[:, k - 1]]
        way = way.ravel()[:left]
        stop = int(np.argmax(symbol[way] >= 256)) if (symbol[way[-1]] >= 256) else len(way)
        out += literal[way[:stop]].tobytes()
        at = int(way[stop]) if stop < len(way) else int(step[way[-1]])
        if len(out) == n:
            break
        if symbol[at] < 256:
            continue
        bits.at = base + at + int(size[at])
        length = read_number(int(symbol[at]) - 256, bits)
        distance = read_distance(read_number(group[4].read(bits), bits), width)
        if distance > len(out) or len(out) + length > n:
            raise ValueError("a back-reference leaves the image")
        chunk = out[-distance:] if distance >= length else out[-distance:] * -(-length // distance)
        out += chunk[:length]
        at = bits.at - base
    if base + at > (len(bits.data) - 16) * 8:
        raise ValueError("the image data ends too early")
    bits.at = base + at
    return np.frombuffer(bytes(out), dtype=np.uint8).astype(np.uint32) << 8 | np.uint32(rest)


def channels(pixels: np.ndarray) -> np.ndarray:
    """The four bytes of 32-bit pixels, the lowest (blue) first."""
    return np.ascontiguousarray(pixels, dtype="<u4").view(np.uint8).reshape(*pixels.shape, 4)


def average(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int32) + b) >> 1


def predict(mode: int, left: np.ndarray, up: np.ndarray, up_right: np.ndarray, up_left: np.ndarray) -> np.ndarray:
    left, up, up_right, up_left = (x.astype(np.int32) for x in (left, up, up_right, up_left))
    if mode == 0 or mode > 13:
        return np.array([0, 0, 0, 255], dtype=np.int32)
    if mode <= 4:
        return (left, up, up_right, up_left)[mode - 1]
    if mode == 5:
        return average(average(left, up_right), up)
    if mode <= 10:
        return (average(left, up_left), average(left, up), average(up_left, up), average(up, up_right), average(average(left, up_left), average(up, up_right)))[mode - 6]
    if mode == 11:
        by_left, by_up = np.abs(up - up_left).sum(), np.abs(left - up_left).sum()
        return left if by_left < by_up else up
    if mode == 12:
        return np.clip(left + up - up_left, 0, 255)
    middle = average(left, up)
    half = middle - up_left
    return np.clip(middle + np.where(half < 0, -(-half // 2), half // 2), 0, 255)


def undo_predictor(pixels: np.ndarray, modes: np.ndarray, shift: int) -> np.ndarray:
    """pixels, modes: height x width; every pixel adds to a prediction from those before it."""
    height, width = pixels.shape
    out = channels(pixels).copy()
    out[0, 0] += np.array([0, 0, 0, 255], dtype=np.uint8)
    out[0] = np.cumsum(out[0], axis=0, dtype=np.uint32).astype(np.uint8)
    for y in range(1, height):
        above, row = out[y - 1], out[y]
        row[0] += above[0]
        right = np.concatenate([above[1:], row[:1]])  # beyond the last column comes this row's first pixel
        for x0 in range(0, width, 1 << shift):
            mode, a, b = int(modes[y >> shift, x0 >> shift]), max(x0, 1), min(x0 + (1 << shift), width)
            if a >= b:
                continue
            if mode == 1:
                row[a:b] = (row[a - 1] + np.cumsum(row[a:b], axis=0, dtype=np.uint32)).astype(np.uint8)
            elif mode in (0, 2, 3, 4, 8, 9, 14, 15):
                row[a:b] = (row[a:b] + predict(mode, above[a:b], above[a:b], right[a:b], above[a - 1 : b - 1])).astype(np.uint8)
            else:
                for x in range(a, b):
                    row[x] = (row[x] + predict(mode, row[x - 1], above[x], right[x], above[x - 1])).astype(np.uint8)
    return out.view("<u4").reshape(height, width)


def undo_cross_colour(pixels: np.ndarray, factors: np.ndarray, shift: int) -> np.ndarray:
    height, width = pixels.shape
    of = channels(factors)[np.arange(height)[:, None] >> shift, np.arange(width) >> shift].view(np.int8).astype(np.int32)
    out = channels(pixels).copy()
    green = out[..., 1].view(np.int8).astype(np.int32)
    red = (out[..., 2] + (of[..., 0] * green >> 5)).astype(np.uint8)
    out[..., 0] = (out[..., 0] + (of[..., 1] * green >> 5) + (of[..., 2] * red.view(np.int8).astype(np.int32) >> 5)).astype(np.uint8)
    out[..., 2] = red
    return out.view("<u4").reshape(height, width)


def undo_subtract_green(pixels: np.ndarray) -> np.ndarray:
    out = channels(pixels).copy()
    out[..., 0] += out[..., 1]
    out[..., 2] += out[..., 1]
    return out.view("<u4").reshape(pixels.shape)


def undo_palette(pixels: np.ndarray, palette: np.ndarray, width: int, shift: int) -> np.ndarray:
    """Several indices share a pixel's green byte where the palette is small, the first lowest."""
    index = pixels >> 8 & 255
    if shift:
        each = 8 >> shift
        index = (index[..., None] >> (np.arange(1 << shift, dtype=np.uint32) * each) & ((1 << each) - 1)).reshape(len(index), -1)[:, :width]
    return np.concatenate([palette, np.zeros(256, dtype=np.uint32)])[index]


def decode(data: bytes) -> np.ndarray:
    """The pixels of a lossless WebP file: height x width x 4 bytes."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    at, end = 12, min(len(data), 8 + int.from_bytes(data[4:8], "little"))
    while at + 8 <= end and data[at : at + 4] != b"VP8L":
        size = int.from_bytes(data[at + 4 : at + 8], "little")
        at += 8 + size + (size & 1)
    if at + 8 > end:
        raise ValueError("no lossless image in the file")
    bits = Bits(data[at + 8 : at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")])
    if bits.read(8) != SIGNATURE:
        raise ValueError("not a lossless image")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    has_alpha, version = bits.read(1), bits.read(3)
    if version:
        raise ValueError("an unknown version")
    undo, seen, wide = [], set(), width
    while bits.read(1):
        kind = bits.read(2)
        if kind in seen:
            raise ValueError("a transform comes twice")
        seen.add(kind)
        if kind in (PREDICTOR, CROSS_COLOUR):
            shift = bits.read(3) + 2
            block = (wide + (1 << shift) - 1) >> shift
            found = read_pixels(bits, block, (height + (1 << shift) - 1) >> shift, False).reshape(-1, block)
            undo.append(functools.partial(undo_predictor, modes=found >> 8 & 15, shift=shift) if kind == PREDICTOR else functools.partial(undo_cross_colour, factors=found, shift=shift))
        elif kind == SUBTRACT_GREEN:
            undo.append(undo_subtract_green)
        else:
            size = bits.read(8) + 1
            steps = channels(read_pixels(bits, size, 1, False))
            palette = np.cumsum(steps, axis=0, dtype=np.uint32).astype(np.uint8).view("<u4").ravel()
            shift = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
            undo.append(functools.partial(undo_palette, palette=palette, width=wide, shift=shift))
            wide = (wide + (1 << shift) - 1) >> shift
    pixels = read_pixels(bits, wide, height, True).reshape(height, wide)
    for step in reversed(undo):
        pixels = step(pixels)
    out = channels(pixels)[..., [2, 1, 0, 3]]
    if not has_alpha:
        out[..., 3] = 255
    return out


# --- writing ---


class Writer:
    """Writes bits, the lowest first."""

    def __init__(self) -> None:
        self.value, self.size = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n


def code_lengths(counts: np.ndarray, most: int = LONGEST_CODE) -> list[int]:
    """Lengths of a complete prefix code for the symbols that occur, none longer than `most`; counts are levelled until that holds."""
    lengths = [0] * len(counts)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        for s in used.tolist():
            lengths[s] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    leaves, symbols, n, least = counts[used].tolist(), used.tolist(), len(used), 1
    while True:
        # leaves and inner nodes both come in ascending order, so the two smallest are at the fronts
        weights = [max(x, least) for x in leaves]
        parents, leaf, inner = [0] * (2 * n - 1), 0, n
        for node in range(n, 2 * n - 1):
            total = 0
            for _ in range(2):
                if leaf < n and (inner >= node or weights[leaf] <= weights[inner]):
                    total += weights[leaf]
                    parents[leaf] = node
                    leaf += 1
                else:
                    total += weights[inner]
                    parents[inner] = node
                    inner += 1
            weights.append(total)
        depths = [0] * (2 * n - 1)
        for node in range(2 * n - 3, -1, -1):
            depths[node] = depths[parents[node]] + 1
        if depths[0] <= most:
            for symbol, depth in zip(symbols, depths, strict=False):
                lengths[symbol] = depth
            return lengths
        least *= 2


def put_code(out: Writer, lengths: list[int]) -> None:
    """A prefix code by its lengths."""
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and all(s < 256 for s in used):
        first = used[0] if used else 0
        out.put(1, 1)
        out.put(len(used) == 2, 1)
        out.put(first > 1, 1)
        out.put(first, 8 if first > 1 else 1)
        if len(used) == 2:
            out.put(used[1], 8)
        return
    out.put(0, 1)
    steps, at = [], 0  # symbol, extra bits, their number
    while at < len(lengths):
        same = at
        while same < len(lengths) and lengths[same] == lengths[at]:
            same += 1
        times = same - at
        if lengths[at] == 0 and times >= 3:
            times = min(times, 138)
            steps.append((17, times - 3, 3) if times <= 10 else (18, times - 11, 7))
        elif at and lengths[at] and lengths[at] == lengths[at - 1] and times >= 3:
            times = min(times, 6)
            steps.append((16, times - 3, 2))
        else:
            times = 1
            steps.append((lengths[at], 0, 0))
        at += times
    own = code_lengths(np.bincount([s for s, _, _ in steps], minlength=19), 7)
    kept = max(i for i, s in enumerate(CODE_LENGTH_ORDER) if own[s]) + 1
    out.put(max(kept, 4) - 4, 4)
    for s in CODE_LENGTH_ORDER[: max(kept, 4)]:
        out.put(own[s], 3)
    out.put(0, 1)
    bits = canonical(own) if sum(map(bool, own)) > 1 else dict.fromkeys(range(19), (0, 0))
    for s, extra, n in steps:
        out.put(*bits[s])
        out.put(extra, n)


def number_of(value: int) -> tuple[int, int, int]:
    """The prefix symbol, extra bits and their number for a length or distance."""
    value -= 1
    if value < 4:
        return value, 0, 0
    extra = value.bit_length() - 2
    return 2 * extra + (value >> extra), value & ((1 << extra) - 1), extra


def repeats(values: bytes, least: int = 24) -> list[tuple[int, int, int]]:
    """Back-references (from, length, distance) in order, for lines that came before and for runs of one value."""
    found, lines, at = [], {}, 0
    for line in values.split(b"\n"):
        if len(line) >= least:
            if (before := lines.get(line)) is not None:
                found += [(at + k, min(MOST_LENGTH, len(line) - k), at - before) for k in range(0, len(line), MOST_LENGTH)]
            else:
                lines[line] = at
        at += len(line) + 1
    run, n = len(values.rstrip(values[-1:])) if values else 0, len(values)
    if n - run > least and (not found or found[-1][0] + found[-1][1] <= run + 1):
        found += [(k, min(MOST_LENGTH, n - k), 1) for k in range(run + 1, n, MOST_LENGTH)]
    return found


def put_palette(out: Writer, levels: np.ndarray) -> None:
    """Grey levels, each less the one before, without a cache."""
    out.put(len(levels) - 1, 8)
    out.put(0, 1)
    steps = np.diff(levels, prepend=0)
    alphas = [255, *[0] * (len(levels) - 1)]
    of_step, of_alpha = (code_lengths(np.bincount(x, minlength=256)) for x in (steps, alphas))
    for lengths in ([*of_step, *[0] * LENGTH_SYMBOLS], of_step, of_step, of_alpha, [0] * DISTANCE_SYMBOLS):
        put_code(out, lengths)
    step_bits, alpha_bits = (canonical(x) if sum(map(bool, x)) > 1 else dict.fromkeys(range(256), (0, 0)) for x in (of_step, of_alpha))
    for step, alpha in zip(steps.tolist(), alphas, strict=True):
        for code, value in ((step_bits, step), (step_bits, step), (step_bits, step), (alpha_bits, alpha)):
            out.put(*code[value])


def encode_grey(values: bytes, width: int) -> bytes:
    """A lossless WebP file of a grey image, row by row; the number of values is a multiple of the width."""
    pixels = np.frombuffer(values, dtype=np.uint8)
    height = len(pixels) // width
    if not pixels.size or len(pixels) % width or width > MOST_SIDE or height > MOST_SIDE:
        raise ValueError("not the pixels of a WebP image")
    out = Writer()
    out.put(SIGNATURE, 8)
    out.put(width - 1, 14)
    out.put(height - 1, 14)
    out.put(0, 4)
    levels, index, wide, shift = np.flatnonzero(np.bincount(pixels, minlength=256)), pixels, width, 0
    out.put(1, 1)
    if len(levels) > 16:
        out.put(SUBTRACT_GREEN, 2)
    else:
        out.put(PALETTE, 2)
        put_palette(out, levels)
        shift = 3 if len(levels) <= 2 else 2 if len(levels) <= 4 else 1
        wide = (width + (1 << shift) - 1) >> shift
        packed = np.zeros((height, wide << shift), dtype=np.int64)
        packed[:, :width] = np.searchsorted(levels, pixels).reshape(height, width)
        index = (packed.reshape(height, wide, -1) << np.arange(1 << shift) * (8 >> shift)).sum(axis=2).ravel()
    out.put(0, 1)  # no more transforms
    out.put(0, 2)  # no cache, one group of codes
    found = repeats(values) if not shift else []
    plain = np.ones(len(index), dtype=bool)
    for at, length, _ in found:
        plain[at : at + length] = False
    marks = [(at, *number_of(length), *number_of(distance + len(NEAR))) for at, length, distance in found]
    symbols = index[plain]
    greens = code_lengths(np.bincount(symbols, minlength=256 + LENGTH_SYMBOLS) + np.bincount([256 + m[1] for m in marks], minlength=256 + LENGTH_SYMBOLS))
    distances = code_lengths(np.bincount([m[4] for m in marks], minlength=DISTANCE_SYMBOLS))
    one = [1, *[0] * 255]
    for lengths in (greens, one, one, [*[0] * 255, 1], distances):
        put_code(out, lengths)
    green = canonical(greens) if sum(map(bool, greens)) > 1 else dict.fromkeys(range(280), (0, 0))
    far = canonical(distances) if sum(map(bool, distances)) > 1 else dict.fromkeys(range(40), (0, 0))
    bits_of, size_of = np.zeros(280, dtype=np.uint64), np.zeros(280, dtype=np.int64)
    for s, (b, n) in green.items():
        bits_of[s], size_of[s] = b, n
    stream, size = bits_of[symbols], size_of[symbols]
    if marks:  # back-references, each as two values below 32 bits, are put in between
        parts = [p for _, symbol, extra, n, code, more, m in marks for p in ((green[256 + symbol][0] | extra << green[256 + symbol][1], green[256 + symbol][1] + n), (far[code][0] | more << far[code][1], far[code][1] + m))]
        before = np.repeat(np.cumsum(plain)[[m[0] for m in marks]], 2)
        stream = np.insert(stream, before, np.array([x for x, _ in parts], dtype=np.uint64))
        size = np.insert(size, before, np.array([n for _, n in parts], dtype=np.int64))
    head = out.value.to_bytes(-(-out.size // 8), "little")
    body = pack_bits(stream, size, out.size & 7, head[-1] if out.size & 7 else 0)
    data = (head[:-1] if out.size & 7 else head) + body
    return b"RIFF" + struct.pack("<I", 12 + len(data) + (len(data) & 1)) + b"WEBPVP8L" + struct.pack("<I", len(data)) + data + bytes(len(data) & 1)


def pack_bits(values: np.ndarray, sizes: np.ndarray, at: int, first: int) -> bytes:
    """values, each in its number of bits (32 at most), from bit `at` of a byte that begins with `first`."""
    ends = at + np.cumsum(sizes)
    starts = ends - sizes
    total = int(ends[-1]) if len(ends) else at
    word, moved = starts >> 5, values.astype(np.uint64) << (starts & 31).astype(np.uint64)
    n = (total >> 5) + 2
    low = np.bincount(word, (moved & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n)  # disjoint bits: exact
    high = np.bincount(word + 1, (moved >> np.uint64(32)).astype(np.float64), minlength=n)
    out = (low + high[: len(low)]).astype(np.uint64).astype("<u4")
    out[0] |= first
    return out.tobytes()[: -(-total // 8)]
