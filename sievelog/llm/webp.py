"""Lossless WebP (VP8L): a whole decoder in numpy, and an encoder for what the media operator stores.

Pixels are ARGB in unsigned 32-bit numbers. Where one prefix code group holds for the whole image and there's no colour
cache, the decoder looks up the code at every bit position at once and then follows the chain of positions; other images
are read pixel by pixel. Transforms are inverted with array operations, row by row where a pixel needs its neighbours.
"""

from __future__ import annotations

import struct
from functools import cache

import numpy as np

# Fixed values of the format.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEIGHBOURS = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3),
    (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0),
    (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4),
    (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
CACHE_FACTOR = 0x1E35A7BD
BLACK = 0xFF000000
LIMIT = 16384
PHASES = np.arange(8)
ORDER = np.array(LENGTH_ORDER)


class Bits:
    """Bits of a byte string, lowest first."""

    def __init__(self, data: bytes):
        self.data, self.at = data + bytes(16), 0

    def look(self) -> int:
        """At least the next 57 bits."""
        return int.from_bytes(self.data[self.at >> 3 : (self.at >> 3) + 8], "little") >> (self.at & 7)

    def read(self, n: int) -> int:
        lo = self.at >> 3
        value = int.from_bytes(self.data[lo : lo + 8], "little") >> (self.at & 7)
        self.at += n
        if self.at > 8 * (len(self.data) - 8):
            raise ValueError("the image's data ends early")
        return value & ((1 << n) - 1)


@cache
def turned(n: int) -> np.ndarray:
    """The numbers of n bits with their bits turned round."""
    out = np.zeros(1, np.int64)
    for _ in range(n):
        out = np.concatenate([2 * out, 2 * out + 1])
    return out


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """The used symbols in order of their codes, their lengths, the longest one, and how many numbers of that many bits
    begin with each code."""
    used = lengths.nonzero()[0]
    used = used[np.argsort(lengths[used], kind="stable")]
    n = lengths[used]
    top = int(n[-1])
    return used, n, top, 1 << (top - n)


def codes_of(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes of the lengths, their bits turned round (first bit lowest)."""
    codes = np.zeros(len(lengths), np.int64)
    if np.any(lengths):
        used, _, top, share = canonical(lengths)
        codes[used] = turned(top)[np.minimum(np.cumsum(share) - share, (1 << top) - 1)]
    return codes


class Code:
    """A prefix code as tables over as many bits as its longest code has: symbol and length (0 where there's only one
    symbol)."""

    def __init__(self, lengths: np.ndarray):
        used = lengths.nonzero()[0]
        self.constant, self.last = len(used) <= 1, int(used[-1]) if len(used) else 0
        if self.constant:
            self.symbol, self.length, self.mask, self.longest = np.array([self.last]), np.zeros(1, np.int64), 0, 0
            return
        used, n, top, share = canonical(lengths)
        if share.sum() != 1 << top or top > 15:
            raise ValueError("a prefix code isn't complete")
        order, self.mask, self.longest = turned(top), (1 << top) - 1, top
        self.symbol, self.length = np.repeat(used, share)[order], np.repeat(n, share)[order]

    def read(self, bits: Bits) -> int:
        at = bits.at
        w = int.from_bytes(bits.data[at >> 3 : (at >> 3) + 4], "little") >> (at & 7) & self.mask
        bits.at += int(self.length[w])
        return int(self.symbol[w])


@cache
def simple_code(*symbols: int) -> Code:
    lengths = np.zeros(max(symbols) + 1, np.int64)
    lengths[list(symbols)] = 1
    return Code(lengths)


def read_code(bits: Bits, alphabet: int) -> Code:
    w = bits.look()
    if w & 1:
        two, wide = w >> 1 & 1, w >> 2 & 1
        n = 8 if wide else 1
        bits.read(3 + n + 8 * two)
        first = w >> 3 & ((1 << n) - 1)
        return simple_code(first, w >> (3 + n) & 255) if two else simple_code(first)
    n = 4 + (w >> 1 & 15)
    bits.at += 5
    packed = bits.read(3 * n)
    own = np.zeros(19, np.int64)
    own[ORDER[:n]] = [packed >> 3 * i & 7 for i in range(n)]
    code = Code(own)
    symbol, length, mask = code.symbol.tolist(), code.length.tolist(), code.mask
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    lo, used = bits.at >> 3, bits.at & 7
    ahead = int.from_bytes(bits.data[lo : lo + 2 * alphabet + 8], "little")  # a length takes at most 7 + 7 bits
    lengths, last = [], 8
    while left and len(lengths) < alphabet:
        left -= 1
        w = ahead >> used & mask
        n = symbol[w]
        used += length[w]
        if n < 16:
            lengths.append(n)
            last = n or last
        elif n == 16:
            lengths += [last] * (3 + (ahead >> used & 3))
            used += 2
        elif n == 17:
            lengths += [0] * (3 + (ahead >> used & 7))
            used += 3
        else:
            lengths += [0] * (11 + (ahead >> used & 127))
            used += 7
    if len(lengths) > alphabet:
        raise ValueError("too many code lengths")
    bits.at = 8 * lo + used
    bits.read(0)
    return Code(np.array(lengths, np.int64))


def extra_bits(prefix: int) -> tuple[int, int]:
    """Extra bits of a length or distance prefix, and the smallest value it stands for."""
    if prefix < 4:
        return 0, prefix + 1
    n = (prefix - 2) >> 1
    return n, ((2 + (prefix & 1)) << n) + 1


EXTRA, LEAST = (np.array(x) for x in zip(*map(extra_bits, range(40))))


@cache
def near_distances(width: int) -> np.ndarray:
    """Distances of the codes from 1 to 120, after a zero."""
    return np.array([0] + [max(1, x + y * width) for x, y in NEIGHBOURS])


def distance_of(code: int, width: int) -> int:
    return code - len(NEIGHBOURS) if code > len(NEIGHBOURS) else int(near_distances(width)[code])


def read_image(bits: Bits, width: int, height: int, top: bool = False) -> np.ndarray:
    """Entropy-coded pixels, row by row."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    groups_at, shift = None, 0
    if top and bits.read(1):
        shift = bits.read(3) + 2
        w = (width + (1 << shift) - 1) >> shift
        groups_at = (read_image(bits, w, (height + (1 << shift) - 1) >> shift) >> 8 & 0xFFFF).reshape(-1, w)
    size = (1 << cache_bits) if cache_bits else 0
    groups = [[read_code(bits, n) for n in (280 + size, 256, 256, 256, 40)] for _ in range(1 + int(groups_at.max()) if groups_at is not None else 1)]
    if groups_at is None and not size:
        return _read_all(bits, groups[0], width, width * height)
    out, cache, added = [0] * (width * height), [0] * size, 0
    at = 0
    while at < len(out):
        y, x = divmod(at, width)
        green, red, blue, alpha, far = groups[int(groups_at[y >> shift, x >> shift])] if groups_at is not None else groups[0]
        s = green.read(bits)
        if s < 256:
            r, b = red.read(bits), blue.read(bits)
            out[at] = alpha.read(bits) << 24 | r << 16 | s << 8 | b
            at += 1
        elif s < 280:
            n = int(LEAST[s - 256]) + bits.read(int(EXTRA[s - 256]))
            d = far.read(bits)
            d = distance_of(int(LEAST[d]) + bits.read(int(EXTRA[d])), width)
            if d > at or at + n > len(out):
                raise ValueError("a back-reference leaves the image")
            for i in range(at, at + n):
                out[i] = out[i - d]
            at += n
        else:
            for p in out[added:at]:
                cache[(CACHE_FACTOR * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
            added = at
            out[at] = cache[s - 280]
            at += 1
    return np.array(out, np.uint32)


def _read_few(bits: Bits, group: list[Code], n: int) -> np.ndarray:
    """A few pixels without copies, one after the other."""
    lo, used, fixed, codes = bits.at >> 3, bits.at & 7, 0, []
    ahead = int.from_bytes(bits.data[lo : lo + 8 * n + 8], "little")
    for code, up in zip(group, (8, 16, 0, 24)):
        if code.constant:
            fixed |= code.last << up
        else:
            codes.append((code.symbol.tolist(), code.length.tolist(), code.mask, up))
    out = [fixed] * n
    for i in range(n):
        for symbol, length, mask, up in codes:
            w = ahead >> used & mask
            out[i] |= symbol[w] << up
            used += length[w]
    bits.at = 8 * lo + used
    bits.read(0)
    return np.array(out, np.uint32)


def _read_all(bits: Bits, group: list[Code], width: int, n: int, span: int = 1 << 15) -> np.ndarray:
    """Pixels under one code group, by looking up the codes at every bit position of a stretch."""
    green, red, blue, alpha, far = group
    out, done = np.zeros(n, np.uint32), 0
    raw = np.frombuffer(bits.data, np.uint8)
    only = red.constant and blue.constant and alpha.constant
    fixed = np.uint32(int(alpha.symbol[0]) << 24 | int(red.symbol[0]) << 16 | int(blue.symbol[0]))
    if only and green.constant and green.symbol[0] < 256:
        out[:] = fixed | np.uint32(int(green.symbol[0]) << 8)
        return out
    ahead = 256  # four steps take at most 4 * (15 + 14 + 15 + 18) bits
    copying = green.last >= 256
    if n <= 256 and not copying:
        return _read_few(bits, group, n)
    most = 64 if copying else sum(code.longest for code in group[:4])  # bits of a step
    while done < n:
        lo = bits.at >> 3
        size = min(len(raw) - lo, (min(span, (n - done) * most) + ahead) // 8)
        part = np.zeros(size + 48, np.int64)
        part[:size] = raw[lo : lo + size]
        window = ((part[:-3] | part[1:-2] << 8 | part[2:-1] << 16 | part[3:] << 24)[:, None] >> PHASES).ravel()
        at = window & green.mask
        step = green.length[at]
        place = np.arange(len(window))
        end = len(place) - 1
        if not only:
            for code in (red, blue, alpha):
                step = step + code.length[window[np.minimum(place + step, end)] & code.mask]
        if copying:
            long = (green.symbol >= 256)[at].nonzero()[0]
            b = long + step[long] if only else long + green.length[at[long]]
            b += EXTRA[green.symbol[at[long]] - 256]
            w = window[np.minimum(b, end)] & far.mask
            step[long] = b - long + far.length[w] + EXTRA[far.symbol[w]]
        left, last = n - done, min(8 * size, span) if size < len(raw) - lo else 8 * size
        if not step.min():
            raise ValueError("the image's data can't be read")
        # The chain of positions, four steps at a time.
        two = step[:-64] + step[(place + step)[:-64]]
        hop = memoryview((two[:-128] + two[(place[:-64] + two)[:-128]]).astype(np.uint16))
        chain, p, last = [], bits.at & 7, min(last, len(hop))
        for _ in range((left + 3) // 4):
            if p >= last:
                break
            chain.append(p)
            p += hop[p]
        if not chain:
            raise ValueError("the image's data ends early")
        chain = np.array(chain)
        second = chain + two[chain]
        steps = np.empty((len(chain), 4), np.int64)
        steps[:, 0], steps[:, 1], steps[:, 2], steps[:, 3] = chain, chain + step[chain], second, second + step[second]
        chain = steps.ravel()
        found = green.symbol[at[chain]]
        value = found.astype(np.uint32) << 8
        if only:
            value |= fixed
        else:
            follow = chain + green.length[at[chain]]
            for code, up in ((red, 16), (blue, 0), (alpha, 24)):
                w = window[np.minimum(follow, end)] & code.mask
                value |= code.symbol[w].astype(np.uint32) << np.uint32(up)
                follow = follow + code.length[w]
        copies = (found >= 256).nonzero()[0] if copying else ()
        if not len(copies):
            used = min(left, len(chain))
            out[done : done + used] = value[:used]
            done += used
        else:
            c, s = chain[copies], found[copies] - 256
            x = c + green.length[at[c]]
            length = LEAST[s] + (window[x] & ((1 << EXTRA[s]) - 1))
            x += EXTRA[s]
            w = window[x] & far.mask
            d = far.symbol[w]
            distance = LEAST[d] + (window[x + far.length[w]] & ((1 << EXTRA[d]) - 1))
            distance = np.where(distance > len(NEIGHBOURS), distance - len(NEIGHBOURS), near_distances(width)[np.minimum(distance, len(NEIGHBOURS))])
            pixels = np.ones(len(chain), np.int64)
            pixels[copies] = length
            first = done + np.cumsum(pixels) - pixels
            used = int(np.searchsorted(first, n))  # a copy is one step, so the image may end before the chain
            plain = found[:used] < 256
            out[first[:used][plain]] = value[:used][plain]
            for i, m, d in zip(first[copies].tolist(), length.tolist(), distance.tolist(), strict=True):
                if i >= n:
                    break
                if d > i or i + m > n:
                    raise ValueError("a back-reference leaves the image")
                while m:
                    k = min(d, m)
                    out[i : i + k] = out[i - d : i - d + k]
                    i, m = i + k, m - k
            done = int(first[used - 1] + pixels[used - 1])
        bits.at = 8 * lo + int(chain[used - 1] + step[chain[used - 1]])
    if bits.at > 8 * len(bits.data):
        raise ValueError("the image's data ends early")
    return out


def _channels(p: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(p.astype("<u4")).view(np.uint8).reshape(*p.shape, 4).astype(np.int32)


def _pixels(c: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray((c & 255).astype(np.uint8)).view("<u4").reshape(c.shape[:-1]).astype(np.uint32)


def predict(mode: int, l, t, tr, tl):  # noqa: E741
    """The predicted channels of a pixel from those left, above, above right and above left."""
    half = lambda a, b: (a + b) >> 1
    if mode == 11:
        return l if np.abs(t - tl).sum() < np.abs(l - tl).sum() else t
    if mode == 12:
        return np.clip(l + t - tl, 0, 255)
    if mode == 13:
        a = half(l, t)
        d = a - tl
        return np.clip(a + np.sign(d) * (np.abs(d) // 2), 0, 255)
    return {1: lambda: l, 2: lambda: t, 3: lambda: tr, 4: lambda: tl, 5: lambda: half(half(l, tr), t), 6: lambda: half(l, tl), 7: lambda: half(l, t), 8: lambda: half(tl, t), 9: lambda: half(t, tr), 10: lambda: half(half(l, tl), half(t, tr))}.get(mode, lambda: np.array([0, 0, 0, 255]))()


def predictor(image: np.ndarray, modes: np.ndarray, shift: int, inverse: bool) -> np.ndarray:
    """Add the predictions of each pixel (inverse), or take them away."""
    given = _channels(image)
    out = given.copy()
    known = out if inverse else given
    sign = 1 if inverse else -1
    height, width = image.shape
    for y in range(height):
        for x in range(width):
            if not y:
                guess = known[0, x - 1] if x else np.array([0, 0, 0, 255])
            elif not x:
                guess = known[y - 1, 0]
            else:
                right = known[y - 1, x + 1] if x + 1 < width else known[y, 0]
                guess = predict(int(modes[y >> shift, x >> shift] >> 8 & 15), known[y, x - 1], known[y - 1, x], right, known[y - 1, x - 1])
            out[y, x] = (given[y, x] + sign * guess) & 255
    return _pixels(out)


def cross_colour(image: np.ndarray, elements: np.ndarray, shift: int, inverse: bool) -> np.ndarray:
    c = _channels(image)
    y, x = np.indices(image.shape)
    e = _channels(elements)[y >> shift, x >> shift].astype(np.uint8).astype(np.int8).astype(np.int32)
    signed = lambda v: (v & 255).astype(np.uint8).astype(np.int8).astype(np.int32)
    part = lambda t, v: (t * signed(v)) >> 5
    sign, red = (1 if inverse else -1), c[..., 2].copy()
    c[..., 2] += sign * part(e[..., 0], c[..., 1])
    c[..., 0] += sign * (part(e[..., 1], c[..., 1]) + part(e[..., 2], c[..., 2] if inverse else red))
    return _pixels(c)


def green_from_others(image: np.ndarray, inverse: bool) -> np.ndarray:
    """Green added to red and blue (inverse), or taken from them; both lie in one number, with room for a borrow."""
    others, green = image & np.uint32(0x00FF00FF), (image >> 8 & 255) * np.uint32(0x00010001)
    others = others + green if inverse else others + np.uint32(0x01000100) - green
    return image & np.uint32(0xFF00FF00) | others & np.uint32(0x00FF00FF)


def bundle_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def decode_one(data: bytes) -> tuple[np.ndarray, int]:
    """The first image of the bytes as (height, width) ARGB, and where it ends."""
    if data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L":
        raise ValueError("not a lossless WebP file")
    total, size = struct.unpack("<I", data[4:8])[0], struct.unpack("<I", data[16:20])[0]
    bits = Bits(data[20 : 20 + size])
    if bits.read(8) != 0x2F:
        raise ValueError("no VP8L signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    steps, w = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (0, 1):
            shift = bits.read(3) + 2
            sub = (w + (1 << shift) - 1) >> shift
            steps.append((kind, shift, read_image(bits, sub, (height + (1 << shift) - 1) >> shift).reshape(-1, sub), w))
        elif kind == 2:
            steps.append((2, 0, None, w))
        else:
            n = bits.read(8) + 1
            palette = _pixels(np.cumsum(_channels(read_image(bits, n, 1)), axis=0))
            steps.append((3, bundle_bits(n), palette, w))
            w = (w + (1 << steps[-1][1]) - 1) >> steps[-1][1]
    image = read_image(bits, w, height, top=True).reshape(height, w)
    for kind, shift, extra, w in reversed(steps):
        if kind == 0:
            image = predictor(image, extra, shift, True)
        elif kind == 1:
            image = cross_colour(image, extra, shift, True)
        elif kind == 2:
            image = green_from_others(image, True)
        else:
            index = image >> 8 & 255
            if shift:
                depth = 8 >> shift
                index = (index[:, :, None] >> (np.arange(1 << shift, dtype=np.uint32) * depth) & ((1 << depth) - 1)).reshape(height, -1)[:, :w]
            image = np.append(extra, np.zeros(256, np.uint32))[index]
    return image, 8 + total + (total & 1)


def decode(data: bytes) -> list[np.ndarray]:
    """All images of a stored value."""
    out = []
    while data:
        image, end = decode_one(data)
        out.append(image)
        data = data[end:]
    return out


class Writer:
    """Collects (value, bits) pairs, lowest bit first."""

    def __init__(self):
        self.values: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.few: tuple[list[int], list[int]] = ([], [])

    def put(self, value: int, n: int) -> None:
        self.few[0].append(value)
        self.few[1].append(n)

    def many(self, values: np.ndarray, sizes: np.ndarray) -> None:
        if self.few[0]:
            few, self.few = self.few, ([], [])
            self.many(*few)
        self.values.append(np.asarray(values, np.int32))
        self.sizes.append(np.asarray(sizes, np.int32))

    def bytes(self) -> bytes:
        self.many([], [])
        values, sizes = np.concatenate(self.values), np.concatenate(self.sizes)
        out = []
        for lo in range(0, len(values), 1 << 20):
            v, s = values[lo : lo + (1 << 20)], sizes[lo : lo + (1 << 20)]
            ends = np.cumsum(s, dtype=np.int32)
            nth = np.arange(int(ends[-1]), dtype=np.int32) - np.repeat(ends - s, s)
            out.append((np.repeat(v, s) >> nth & 1).astype(np.uint8))
        return np.packbits(np.concatenate(out), bitorder="little").tobytes()


def code_lengths(counts: np.ndarray, limit: int = 15) -> np.ndarray:
    """Huffman lengths of the symbols that occur, none over ``limit``."""
    used = counts.nonzero()[0]
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    weights, n = counts[used].astype(np.int64), len(used)
    while True:
        order = np.argsort(weights, kind="stable")
        # Leaves in order of weight, then inner nodes in the order of their making, which is of weight, too.
        weight, above = weights[order].tolist(), [0] * (2 * n - 1)
        leaf, inner = 0, n
        for made in range(n, 2 * n - 1):
            total = 0
            for _ in range(2):
                if leaf < n and (inner >= made or weight[leaf] <= weight[inner]):
                    node, leaf = leaf, leaf + 1
                else:
                    node, inner = inner, inner + 1
                total += weight[node]
                above[node] = made
            weight.append(total)
        depth = [0] * (2 * n - 1)
        for node in range(2 * n - 3, -1, -1):
            depth[node] = depth[above[node]] + 1
        if max(depth) <= limit:
            lengths[used[order]] = depth[:n]
            return lengths
        weights = (weights >> 1) + 1


def length_tokens(lengths: list[int]) -> list[tuple[int, int, int]]:
    """(token, extra value, extra bits) for code lengths: runs of zeros and repeats are one token each."""
    out, at = [], 0
    while at < len(lengths):
        value, end = lengths[at], at + 1
        while end < len(lengths) and lengths[end] == value:
            end += 1
        n = end - at
        if value:
            out.append((value, 0, 0))
            n -= 1
        while n:
            most = 138 if not value else 6
            take = min(n, most)
            if take < 3:
                out += [(value, 0, 0)] * take
            elif value:
                out.append((16, take - 3, 2))
            else:
                out.append((17, take - 3, 3) if take <= 10 else (18, take - 11, 7))
            n -= take
        at = end
    return out


def write_only(out: Writer, symbol: int) -> None:
    """Write the code of one symbol below 256, which takes no bits."""
    n = 8 if symbol > 1 else 1
    out.put(1 | (n == 8) << 2 | symbol << 3, 3 + n)


def write_code(out: Writer, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Write the prefix code of the counts; returns its codes and lengths (zero for an only symbol)."""
    used = counts.nonzero()[0]
    if len(used) <= 2 and (not len(used) or used[-1] < 256):
        a = int(used[0]) if len(used) else 0
        out.put(1, 1)
        out.put(int(len(used) == 2), 1)
        out.put(int(a > 1), 1)
        out.put(a, 8 if a > 1 else 1)
        codes, lengths = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
        if len(used) == 2:
            out.put(int(used[1]), 8)
            codes[used[1]], lengths[used] = 1, 1
        return codes, lengths
    if len(used) == 1:
        counts = counts.copy()
        counts[0] += 1
    lengths = code_lengths(counts)
    tokens = length_tokens(lengths[: lengths.nonzero()[0][-1] + 1].tolist())
    if len(tokens) < 2:
        tokens.append((0, 0, 0))
    own = code_lengths(np.bincount([t[0] for t in tokens], minlength=19), 7)
    if np.count_nonzero(own) == 1:
        own[[0, 1] if not own[0] else [0, int(own.nonzero()[0][0]) or 1]] = 1
    shown = own[ORDER]
    n = max(4, int(shown.nonzero()[0][-1]) + 1)
    out.put(0, 1)
    out.put(n - 4, 4)
    out.few[0].extend(shown[:n].tolist())
    out.few[1].extend([3] * n)
    out.put(1, 1)
    wide = max(0, (len(tokens) - 2).bit_length() - 1) // 2
    out.put(wide, 3)
    out.put(len(tokens) - 2, 2 + 2 * wide)
    code, length = codes_of(own).tolist(), own.tolist()
    out.few[0].extend([code[k] | extra << length[k] for k, extra, _ in tokens])
    out.few[1].extend([length[k] + size for k, _, size in tokens])
    return codes_of(lengths), lengths


def prefix_of(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix, number of extra bits and extra bits of lengths or distances."""
    p = np.searchsorted(LEAST, value, side="right") - 1
    return p, EXTRA[p], value - LEAST[p]


def find_copies(samples: np.ndarray, gram: int = 32) -> list[tuple[int, int, int]]:
    """Copies (at, length, distance) of stretches that occur before, found from content-chosen grams; no two overlap."""
    from .suffix_dedup import gram_hashes

    if len(samples) < 2 * gram:
        return []
    h = gram_hashes(samples.astype(np.uint8), gram)
    spots = (h & np.uint64(15) == 0).nonzero()[0]
    if len(spots) < 2:
        return []
    order = spots[np.argsort(h[spots], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    pairs = sorted(zip(order[1:][same].tolist(), order[:-1][same].tolist(), strict=True))
    out, done = [], 0
    for at, source in pairs:
        if at < done:
            continue
        lo = 0
        while at - lo > done and source - lo > 0 and samples[at - lo - 1] == samples[source - lo - 1]:
            lo += 1
        room = min(len(samples) - at, 4096 - lo)
        differ = (samples[at : at + room] != samples[source : source + room]).nonzero()[0]
        n = lo + (int(differ[0]) if len(differ) else room)
        if n >= gram:
            out.append((at - lo, n, at - source))
            done = at - lo + n
    return out


def write_image(out: Writer, pixels: np.ndarray, top: bool = False, copies: list[tuple[int, int, int]] = (), cache_bits: int = 0) -> None:
    """Entropy-code a row of pixels, with the given copies; with a colour cache, literals that it holds become its index."""
    out.put(int(cache_bits > 0), 1)
    if cache_bits:
        out.put(cache_bits, 4)
    if top:
        out.put(0, 1)
    same = bool((pixels & 0xFFFF00FF == pixels[0] & 0xFFFF00FF).all())  # one symbol in each channel but green
    if not cache_bits and not len(copies) and (same or len(pixels) <= 256):
        codes = []
        for up in (8, 16, 0, 24):
            part = pixels >> up & 255
            if same and up != 8:
                write_only(out, int(part[0]))
            else:
                c, n = write_code(out, np.bincount(part, minlength=280 if up == 8 else 256))
                if n.any():
                    codes.append((c[part], n[part]))
        write_only(out, 0)
        if codes:
            out.many(*(codes[0] if len(codes) == 1 else (np.stack(x, axis=1).ravel() for x in zip(*codes))))
        return
    keep, copied = np.ones(len(pixels), bool), np.zeros(len(pixels), bool)
    for at, n, _ in copies:
        keep[at + 1 : at + n] = False  # one token each
    starts = np.array([c[0] for c in copies], np.int64)
    copied[starts] = True
    at = keep.nonzero()[0]
    copied = copied[at]
    green = (pixels[at] >> 8 & 255).astype(np.int64)
    cached = np.zeros(len(at), bool)
    if cache_bits:
        cache, spans = {}, {c[0]: c[1] for c in copies}
        for i, p in enumerate(at.tolist()):
            v = int(pixels[p])
            slot = (CACHE_FACTOR * v & 0xFFFFFFFF) >> (32 - cache_bits)
            if not copied[i] and cache.get(slot, 0) == v:
                green[i], cached[i] = 280 + slot, True
            for u in pixels[p : p + spans.get(p, 1)].tolist():
                cache[(CACHE_FACTOR * u & 0xFFFFFFFF) >> (32 - cache_bits)] = u
    lp, le, lx = prefix_of(np.array([c[1] for c in copies], np.int64))
    dp, de, dx = prefix_of(np.array([c[2] + len(NEIGHBOURS) for c in copies], np.int64))
    green[copied] = 256 + lp
    plain = ~copied & ~cached
    size = 280 + ((1 << cache_bits) if cache_bits else 0)
    gc, gl = write_code(out, np.bincount(green, minlength=size))
    if same:
        for up in (16, 0, 24):
            write_only(out, int(pixels[0]) >> up & 255)
    else:
        parts = [(pixels[at] >> up & 255).astype(np.int64) for up in (16, 0, 24)]
        codes = [write_code(out, np.bincount(p[plain], minlength=256)) for p in parts]
    dc, dl = write_code(out, np.bincount(dp, minlength=40))
    if not same:
        values, sizes = np.zeros((len(at), 4), np.int64), np.zeros((len(at), 4), np.int64)
        values[:, 0], sizes[:, 0] = gc[green], gl[green]
        for i, (p, (c, n)) in enumerate(zip(parts, codes, strict=True), 1):
            values[plain, i], sizes[plain, i] = c[p[plain]], n[p[plain]]
        values[copied, 1], sizes[copied, 1] = lx, le
        values[copied, 2], sizes[copied, 2] = dc[dp], dl[dp]
        values[copied, 3], sizes[copied, 3] = dx, de
        out.many(values.ravel(), sizes.ravel())
        return
    values, sizes = gc[green], gl[green]
    if len(starts):
        behind = np.repeat(copied.nonzero()[0] + 1, 3)
        values = np.insert(values, behind, np.stack([lx, dc[dp], dx], axis=1).ravel())
        sizes = np.insert(sizes, behind, np.stack([le, dl[dp], de], axis=1).ravel())
    out.many(values, sizes)


def encode(image: np.ndarray, palette: bool = False, back: bool = False, cache_bits: int = 0, subtract_green: bool = False, modes: np.ndarray | None = None, elements: np.ndarray | None = None, shift: int = 2) -> bytes:
    """One image as a lossless WebP file. ``modes`` and ``elements`` are the predictor's and cross-colour's own images."""
    height, width = image.shape
    if not 0 < height <= LIMIT or not 0 < width <= LIMIT:
        raise ValueError("a side has 1 to 16384 pixels")
    out = Writer()
    out.many([0x2F, width - 1, height - 1, int((image >> 24 != 255).any()), 0], [8, 14, 14, 1, 3])
    if modes is not None:
        out.many([1, 0, shift - 2], [1, 2, 3])
        write_image(out, modes.ravel())
        image = predictor(image, modes, shift, False)
    if elements is not None:
        out.many([1, 1, shift - 2], [1, 2, 3])
        write_image(out, elements.ravel())
        image = cross_colour(image, elements, shift, False)
    if subtract_green:
        out.many([1, 2], [1, 2])
        image = green_from_others(image, False)
    if palette:
        green = image >> 8 & 255
        if (image & 0xFFFF00FF == image[0, 0] & 0xFFFF00FF).all():
            present = np.bincount(green.ravel(), minlength=256) > 0
            index = (np.cumsum(present) - 1)[green]
            colours = present.nonzero()[0].astype(np.uint32) << 8 | image[0, 0] & np.uint32(0xFFFF00FF)
        else:
            colours, index = np.unique(image, return_inverse=True)
        if len(colours) > 256:
            raise ValueError("a palette holds 256 colours")
        out.many([1, 3, len(colours) - 1], [1, 2, 8])
        c = _channels(colours)
        write_image(out, _pixels(np.diff(c, axis=0, prepend=np.zeros((1, 4), np.int32))))
        index, n = index.reshape(height, width).astype(np.uint32), bundle_bits(len(colours))
        if n:
            index = np.pad(index, ((0, 0), (0, -width % (1 << n)))).reshape(height, -1, 1 << n)
            index = (index << (np.arange(1 << n, dtype=np.uint32) * (8 >> n))).sum(axis=2, dtype=np.uint32)
        image = index << 8 | np.uint32(BLACK)
    out.put(0, 1)
    flat = image.ravel()
    write_image(out, flat, True, find_copies(flat >> 8 & 255) if back and palette else (), cache_bits)
    body = out.bytes()
    chunk = b"VP8L" + struct.pack("<I", len(body)) + body + bytes(len(body) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk
