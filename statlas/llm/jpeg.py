"""Progressive JPEG in numpy: many images at once, their restart intervals decoded in step.

A scan's restart intervals do not depend on each other, so each is a lane: a step decodes one Huffman
symbol (or one refined coefficient) in every lane. Scans of many images go together, in the order in
which each image has them. All four kinds of scans are accumulated into one array of coefficients:
first and refining scans of DC, and of bands of AC coefficients, with end-of-band runs.

Coefficients are kept in zigzag order, one row of 64 per block, component after component.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

U = np.uint64


def _zigzag() -> np.ndarray:
    cells = sorted(((i, j) for i in range(8) for j in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([i * 8 + j for i, j in cells])


ZIGZAG = _zigzag()

#: Fixed-point bits of the inverse transform; products with coefficients stay exact in doubles, whatever the order of sums.
SCALE = 14


def _inverse() -> np.ndarray:
    u = np.arange(8)
    basis = np.cos((2 * u[:, None] + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(0.125), 0.5)
    full = np.einsum("yv,xu->vuyx", basis, basis).reshape(64, 64)
    return np.round(full[ZIGZAG] * (1 << SCALE))


INVERSE = _inverse()


@dataclass
class Component:
    id: int
    h: int
    v: int
    table: int
    wide: int = 0  # blocks in a row and rows of blocks, whole MCUs
    high: int = 0
    seen_wide: int = 0  # those that a scan of this component alone has
    seen_high: int = 0
    base: int = 0


@dataclass
class Scan:
    parts: list[tuple[int, int, int]]  # component, DC table, AC table
    first: int
    last: int
    above: int
    shift: int
    interval: int
    start: int
    end: int


@dataclass
class Image:
    height: int = 0
    width: int = 0
    components: list[Component] = field(default_factory=list)
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    scans: list[Scan] = field(default_factory=list)
    comments: list[bytes] = field(default_factory=list)
    mcus: tuple[int, int] = (0, 0)
    layout: tuple[tuple[int, ...], ...] = ()

    @property
    def blocks(self) -> int:
        return sum(c.wide * c.high for c in self.components)


class Tables:
    """Huffman tables as lookups by the next 16 bits: code length and symbol."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []

    def add(self, raw: bytes) -> int:
        """raw: 16 counts by length, then the symbols."""
        if raw not in self.ids:
            row, code, at = np.zeros(1 << 16, np.uint16), 0, 16
            for length in range(1, 17):
                for _ in range(raw[length - 1]):
                    low = code << (16 - length)
                    row[low : low + (1 << (16 - length))] = length | raw[at] << 8
                    code, at = code + 1, at + 1
                code <<= 1
            self.ids[raw] = len(self.rows)
            self.rows.append(row)
        return self.ids[raw]

    def all(self) -> np.ndarray:
        return np.concatenate(self.rows) if self.rows else np.zeros(1 << 16, np.uint16)


def codes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code and length of each symbol of a table."""
    value, size, code, at = np.zeros(256, U), np.zeros(256, np.int64), 0, 16
    for length in range(1, 17):
        for _ in range(raw[length - 1]):
            value[raw[at]], size[raw[at]] = code, length
            code, at = code + 1, at + 1
        code <<= 1
    return value, size


MARKER = re.compile(rb"\xff[^\x00\xff\xd0-\xd7]")


def parse(data: bytes, tables: Tables) -> Image:
    """The segments of a progressive JPEG."""
    image, at, interval = Image(), 2, 0
    huffman: dict[int, int] = {}
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    while at < len(data):
        if data[at] != 0xFF:
            raise ValueError(f"no marker at {at}")
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
            continue
        if kind == 0xD9:
            break
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if kind == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 128 if wide else 64
                image.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else "u1").astype(float)
                body = body[1 + n :]
        elif kind == 0xC4:
            while body:
                n = 17 + sum(body[1:17])
                huffman[body[0]] = tables.add(body[1:n])
                body = body[n:]
        elif kind == 0xC2:
            _, image.height, image.width, n = struct.unpack(">BHHB", body[:6])
            image.components = [Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            h, v = max(c.h for c in image.components), max(c.v for c in image.components)
            image.mcus = (-(-image.height // (8 * v)), -(-image.width // (8 * h)))
            base = 0
            for c in image.components:
                c.high, c.wide, c.base = image.mcus[0] * c.v, image.mcus[1] * c.h, base
                c.seen_high, c.seen_wide = -(-(-(-image.height * c.v // v)) // 8), -(-(-(-image.width * c.h // h)) // 8)
                base += c.high * c.wide
            image.layout = tuple((c.h, c.v, c.wide, c.base, c.seen_high, c.seen_wide) for c in image.components)
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
            raise ValueError(f"frame {kind:x} is not progressive Huffman")
        elif kind == 0xDD:
            interval = int.from_bytes(body[:2], "big")
        elif kind == 0xFE:
            image.comments.append(body)
        elif kind == 0xDA:
            of = {c.id: i for i, c in enumerate(image.components)}
            parts = [(of[body[1 + 2 * i]], huffman.get(body[2 + 2 * i] >> 4, 0), huffman.get(0x10 | body[2 + 2 * i] & 15, 0)) for i in range(body[0])]
            first, last, approx = body[-3:]
            found = MARKER.search(data, at)
            end = found.start() if found else len(data)
            image.scans.append(Scan(parts, first, last, approx >> 4, approx & 15, interval, at, end))
            at = end
    return image


@lru_cache(maxsize=1024)
def _order(layout: tuple[tuple[int, ...], ...], mcus: tuple[int, int], parts: tuple[int, ...]) -> tuple[np.ndarray, int]:
    """layout: h, v, blocks in a row, first block, and rows and columns of a lone scan, of each component."""
    if len(parts) == 1:
        _, _, wide, base, high, across = layout[parts[0]]
        return (base + np.arange(high)[:, None] * wide + np.arange(across)).ravel(), 1
    rows, columns = mcus
    out = []
    for i in parts:
        h, v, wide, base, _, _ = layout[i]
        y = np.arange(rows)[:, None, None, None] * v + np.arange(v)[:, None]
        x = np.arange(columns)[:, None, None] * h + np.arange(h)
        out.append((base + y * wide + x).reshape(rows * columns, h * v))
    order = np.concatenate(out, axis=1)
    return order.ravel(), order.shape[1]


def scan_order(image: Image, scan: Scan) -> tuple[np.ndarray, int]:
    """The blocks of a scan in its order, and how many of them an MCU has."""
    find = _order if image.blocks < 4096 else _order.__wrapped__
    return find(image.layout, image.mcus, tuple(p[0] for p in scan.parts))


class Lanes:
    """Restart intervals of several scans: their bits, tables, parameters and blocks."""

    def __init__(self, jobs: list[tuple[bytes, Image, Scan, int]]) -> None:
        orders, per, steps, bases = [], [], [], []
        for _, image, scan, base in jobs:
            order, of_mcu = scan_order(image, scan)
            orders.append(order)
            per.append(of_mcu)
            steps.append((scan.interval or -(-len(order) // of_mcu)) * of_mcu)
            bases.append(base)
        count = np.array([len(o) for o in orders])
        step, n = np.array(steps), -(-count // np.array(steps))
        self.order = np.concatenate(orders) + np.repeat(bases, count)
        self.job = np.repeat(np.arange(len(jobs)), n)
        self.per = np.array(per)[self.job]
        nth = np.arange(len(self.job)) - np.repeat(np.cumsum(n) - n, n)
        above = np.cumsum(count)
        self.begin = (above - count)[self.job] + nth * step[self.job]
        self.end = np.minimum(self.begin + step[self.job], above[self.job])
        flat = np.frombuffer(b"".join([memoryview(data)[scan.start : scan.end] for data, _, scan, _ in jobs] + [bytes(16)]), np.uint8)
        size = np.array([scan.end - scan.start for _, _, scan, _ in jobs])
        start = np.cumsum(size) - size
        after = flat[:-1] == 0xFF
        drop = np.zeros(len(flat), bool)
        drop[1:] = after & (flat[1:] == 0)
        marks = np.flatnonzero(after & (flat[1:] >= 0xD0) & (flat[1:] <= 0xD7))
        drop[marks] = drop[marks + 1] = True
        marks = marks[np.arange(len(marks)) - np.searchsorted(marks, start)[np.searchsorted(start, marks, side="right") - 1] < (n - 1)[np.searchsorted(start, marks, side="right") - 1]]
        begins = np.sort(np.concatenate([start, marks + 2]))
        if len(begins) != len(self.job):
            raise ValueError("a scan lacks restart markers")
        kept = np.cumsum(~drop) - ~drop
        self.bits = np.r_[flat[~drop], np.zeros(16, np.uint8)]
        self.words = np.ndarray((len(self.bits) - 8,), ">u8", self.bits.tobytes(), strides=(1,))
        self.pos = kept[begins] * 8

    def peek(self, pos: np.ndarray) -> np.ndarray:
        """The next bits of each lane, at least 57, from the top of a word."""
        return self.words[pos >> 3].astype(U) << (pos & 7).astype(U)


def _take(v: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The top n bits (0 to 32)."""
    return ((v >> U(1)) >> (U(63) - n.astype(U))).astype(np.int64)


def _extend(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(value < (1 << np.maximum(size - 1, 0)), value - (1 << size) + 1, value)


def _dc_first(x: Lanes, jobs: list, coef: np.ndarray, lookup: np.ndarray) -> None:
    table_of, comp_of, sizes = [], [], []
    for _, image, scan, _ in jobs:
        before = len(comp_of)
        for i, dc, _ in scan.parts:
            n = image.components[i].h * image.components[i].v if len(scan.parts) > 1 else 1
            table_of += [dc] * n
            comp_of += [i] * n
        sizes.append(len(comp_of) - before)
    table_of, comp_of = np.array(table_of), np.array(comp_of)
    offset = (np.cumsum(sizes) - sizes)[x.job]
    shift = np.array([scan.shift for _, _, scan, _ in jobs])[x.job]
    pos, blk, end, per, begin = x.pos, x.begin.copy(), x.end, x.per, x.begin
    lane = np.arange(len(pos))
    last = np.zeros((len(pos), 4), np.int64)
    while len(blk):
        at = offset + (blk - begin) % per
        comp = comp_of[at]
        v = x.peek(pos)
        e = lookup[(table_of[at] << 16) | (v >> U(48)).astype(np.int64)].astype(np.int64)
        n, s = e & 255, e >> 8
        value = _extend(_take(v << n.astype(U), s), s)
        pos = pos + n + s
        last[lane, comp] += value
        coef[x.order[blk] * 64] = last[lane, comp] << shift
        blk = blk + 1
        on = blk < end
        if not on.all():
            pos, blk, end, per, begin, offset, shift, lane = (a[on] for a in (pos, blk, end, per, begin, offset, shift, lane))


def _dc_refine(x: Lanes, jobs: list, coef: np.ndarray) -> None:
    shift = np.array([scan.shift for _, _, scan, _ in jobs])[x.job]
    n = x.end - x.begin
    lane = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(lane)) - np.repeat(np.cumsum(n) - n, n)
    pos = x.pos[lane] + at
    bit = (x.bits[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8)) & 1
    coef[x.order[x.begin[lane] + at] * 64] |= bit.astype(coef.dtype) << shift[lane].astype(coef.dtype)


def _band(x: Lanes, jobs: list) -> list[np.ndarray]:
    return [np.array([f(scan) for _, _, scan, _ in jobs])[x.job] for f in (lambda s: s.parts[0][2] << 16, lambda s: s.first, lambda s: s.last, lambda s: s.shift)]


def _ac_first(x: Lanes, jobs: list, coef: np.ndarray, lookup: np.ndarray) -> None:
    table, low, high, shift = _band(x, jobs)
    pos, blk, end, k = x.pos, x.begin.copy(), x.end, low.copy()
    while len(blk):
        v = x.peek(pos)
        e = lookup[table | (v >> U(48)).astype(np.int64)].astype(np.int64)
        n, s, r = e & 255, (e >> 8) & 15, e >> 12
        band_end = (s == 0) & (r < 15)
        extra = np.where(band_end, r, s)
        value = _take(v << n.astype(U), extra)
        pos = pos + n + extra
        k = k + r
        put = np.flatnonzero(s)
        coef[x.order[blk[put]] * 64 + k[put]] = _extend(value[put], s[put]) << shift[put]
        k = k + 1
        over = band_end | (k > high)
        blk = blk + np.where(band_end, (1 << r) + value, over)
        k = np.where(over, low, k)
        on = blk < end
        if not on.all():
            pos, blk, end, k, table, low, high, shift = (a[on] for a in (pos, blk, end, k, table, low, high, shift))


def _ac_refine(x: Lanes, jobs: list, coef: np.ndarray, lookup: np.ndarray) -> None:
    table, low, high, shift = _band(x, jobs)
    pos, blk, end, k = x.pos.copy(), x.begin.copy(), x.end, low.copy()
    run, new, rest = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
    want = np.ones(len(pos), bool)
    while len(blk):
        ask = np.flatnonzero(want & (rest == 0))
        if len(ask):
            v = x.peek(pos[ask])
            e = lookup[table[ask] | (v >> U(48)).astype(np.int64)].astype(np.int64)
            n, s, r = e & 255, (e >> 8) & 15, e >> 12
            band_end = (s == 0) & (r < 15)
            extra = np.where(band_end, r, np.minimum(s, 1))
            value = _take(v << n.astype(U), extra)
            pos[ask] += n + extra
            rest[ask] = np.where(band_end, (1 << r) + value, 0)
            run[ask] = r
            new[ask] = np.where(s > 0, (2 * value - 1) << shift[ask], 0)
            want[ask] = band_end
        at = x.order[blk] * 64 + k
        c = coef[at].astype(np.int64)
        old = np.flatnonzero(c)
        p = pos[old]
        bit = (x.bits[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1
        pos[old] += 1
        step = np.int64(1) << shift[old]
        add = (bit == 1) & ((np.abs(c[old]) & step) == 0)
        coef[at[old]] += np.where(add, np.sign(c[old]) * step, 0).astype(coef.dtype)
        zero = (c == 0) & (rest == 0)
        here = np.flatnonzero(zero & (run == 0))
        coef[at[here]] = new[here]
        want[here] = True
        run -= zero & (run > 0)
        k = k + 1
        over = k > high
        k = np.where(over, low, k)
        blk = blk + over
        ends = over & (rest > 0)
        rest -= ends
        want |= over
        on = blk < end
        if not on.all():
            pos, blk, end, k, table, low, high, shift, run, new, rest, want = (a[on] for a in (pos, blk, end, k, table, low, high, shift, run, new, rest, want))


def coefficients(files: list[bytes]) -> tuple[list[Image], list[np.ndarray]]:
    """Headers and coefficients of progressive JPEGs."""
    tables = Tables()
    images = [parse(f, tables) for f in files]
    base = np.r_[0, np.cumsum([i.blocks for i in images])].astype(np.int64)
    coef = np.zeros(base[-1] * 64, np.int16)
    lookup = tables.all()
    for turn in range(max((len(i.scans) for i in images), default=0)):
        jobs = [(f, i, i.scans[turn], int(b)) for f, i, b in zip(files, images, base, strict=False) if turn < len(i.scans)]
        for dc in (True, False):
            for refine in (False, True):
                own = [j for j in jobs if (j[2].first == 0) == dc and (j[2].above > 0) == refine and j[1].blocks]
                if not own:
                    continue
                lanes = Lanes(own)
                if dc and refine:
                    _dc_refine(lanes, own, coef)
                elif dc:
                    _dc_first(lanes, own, coef, lookup)
                else:
                    (_ac_refine if refine else _ac_first)(lanes, own, coef, lookup)
    return images, [coef[base[i] * 64 : base[i + 1] * 64].reshape(-1, 64) for i in range(len(images))]


def rgb(image: Image, coef: np.ndarray) -> np.ndarray:
    """The picture at full resolution, height x width x 3, 8 bits; grey images have equal channels."""
    top_h, top_v = max(c.h for c in image.components), max(c.v for c in image.components)
    planes = []
    for c in image.components:
        part = coef[c.base : c.base + c.wide * c.high].astype(float) * image.quant[c.table]
        pixels = np.floor((part @ INVERSE + (1 << (SCALE - 1))) / (1 << SCALE)).astype(np.int32) + 128
        plane = pixels.clip(0, 255).reshape(c.high, c.wide, 8, 8).swapaxes(1, 2).reshape(c.high * 8, c.wide * 8)
        if c.h < top_h or c.v < top_v:
            plane = plane.repeat(top_v // c.v, axis=0).repeat(top_h // c.h, axis=1)
        planes.append(plane[: image.height, : image.width])
    if len(planes) < 3:
        return np.repeat(planes[0][:, :, None], 3, axis=2).astype(np.uint8)
    y, cb, cr = planes[0] << 16, planes[1] - 128, planes[2] - 128
    half = 1 << 15
    out = np.stack([y + 91881 * cr, y - 22554 * cb - 46802 * cr, y + 116130 * cb], axis=2)
    return ((out + half) >> 16).clip(0, 255).astype(np.uint8)


# Writing


def table(lengths: dict[int, list[int]]) -> bytes:
    """A DHT body of symbols by code length."""
    return bytes(len(lengths.get(n, [])) for n in range(1, 17)) + bytes(s for n in range(1, 17) for s in lengths.get(n, []))


DC_TABLE = table({4: list(range(12))})
#: Short codes for coefficients that follow each other and for the end of a band, longer ones for gaps.
AC_TABLE = table({4: [0x00, *range(1, 9)], 7: [0x10 | s for s in range(1, 9)], 10: [s for s in range(256) if s not in (0, *range(1, 9), *(0x10 | s for s in range(1, 9))) and (s & 15) <= 10]})


@dataclass
class Bits:
    """Values of up to 32 bits with their lengths and lanes, in order."""

    value: np.ndarray
    size: np.ndarray
    lane: np.ndarray


def packed(bits: Bits, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the lanes, each filled up with ones and with zeros after 0xff, and where each lane ends."""
    length = np.bincount(bits.lane, weights=bits.size, minlength=lanes).astype(np.int64)
    whole = -(-length // 8) * 8
    n = np.bincount(bits.lane, minlength=lanes)
    ends = np.cumsum(n)
    pad = whole - length
    value = np.insert(bits.value, ends, (U(1) << pad.astype(U)) - U(1))
    size = np.insert(bits.size, ends, pad)
    start = np.cumsum(size) - size
    word = start >> 5
    shifted = value << (64 - (start & 31) - size).astype(U) if len(value) else value
    shifted[size == 0] = 0
    new = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out = np.zeros(int(whole.sum() >> 5) + 3, np.uint32)
    out[word[new]] |= np.bitwise_or.reduceat(shifted >> U(32), new).astype(np.uint32)
    out[word[new] + 1] |= np.bitwise_or.reduceat(shifted & U(0xFFFFFFFF), new).astype(np.uint32)
    data = out.byteswap().view(np.uint8)[: int(whole.sum() >> 3)]
    stuffed = np.flatnonzero(data == 0xFF) + 1
    ends = np.cumsum(whole >> 3)
    return np.insert(data, stuffed, 0), ends + np.searchsorted(stuffed, ends, side="right")


SIZES = np.array([x.bit_length() for x in range(1 << 12)])


def _magnitude(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size category and extra bits."""
    size = SIZES[np.abs(v)]
    return size, (v - (v < 0) + ((v < 0) << size)).astype(U)


def dc_first_bits(value: np.ndarray, previous: np.ndarray, lane: np.ndarray) -> Bits:
    code, length = codes(DC_TABLE)
    size, extra = _magnitude(value - previous)
    return Bits((code[size] << size.astype(U)) | extra, length[size] + size, lane)


def ac_first_bits(coef: np.ndarray, first: int, last: int, shift: int, lane: np.ndarray) -> Bits:
    """A first scan over a band of blocks (rows of 64)."""
    code, length = codes(AC_TABLE)
    band = coef[:, first : last + 1].astype(np.int64)
    band = np.sign(band) * (np.abs(band) >> shift)
    blk, k = np.nonzero(band)
    v = band[blk, k]
    before = np.where(np.r_[True, blk[1:] != blk[:-1]] if len(blk) else np.zeros(0, bool), -1, np.r_[0, k[:-1]] if len(k) else k)
    run = k - before - 1
    size, extra = _magnitude(v)
    symbol = ((run & 15) << 4) | size
    value = (code[symbol] << size.astype(U)) | extra
    bits = length[symbol] + size
    skips = run >> 4
    if skips.any():
        at = np.repeat(np.arange(len(run)), skips)
        value, bits, blk, k = np.insert(value, at, code[0xF0]), np.insert(bits, at, length[0xF0]), np.insert(blk, at, blk[at]), np.insert(k, at, k[at])
    tail = np.flatnonzero(band[:, -1] == 0)
    at = np.searchsorted(blk, tail, side="right")
    return Bits(np.insert(value, at, code[0]), np.insert(bits, at, length[0]), lane[np.insert(blk, at, tail)])


def ac_refine_bits(coef: np.ndarray, first: int, last: int, shift: int, lane: np.ndarray) -> Bits:
    """A refining scan over a band: the bit below those already sent."""
    code, length = codes(AC_TABLE)
    band = coef[:, first : last + 1].astype(np.int64)
    size = np.abs(band) >> shift
    fresh, old, zero = size == 1, size > 1, size == 0
    segment = np.cumsum(fresh, axis=1) - fresh
    total = fresh.sum(axis=1)
    zeros = np.cumsum(zero, axis=1) - zero
    since = np.maximum.accumulate(np.where(fresh, zeros, 0), axis=1)
    since = np.concatenate([np.zeros((len(band), 1), np.int64), since[:, :-1]], axis=1)
    gap = zeros - since
    group = np.where(segment < total[:, None], gap >> 4, 0)

    def key(b: np.ndarray, seg: np.ndarray, grp: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((b * 64 + seg) * 8 + grp) * 128 + at

    keys, values, sizes = [], [], []

    def add(k: np.ndarray, v: np.ndarray, n: np.ndarray) -> None:
        keys.append(k)
        values.append(v.astype(U))
        sizes.append(np.broadcast_to(n, v.shape).astype(np.int64))

    b, k = np.nonzero(fresh)
    symbol = ((gap[b, k] & 15) << 4) | 1
    add(key(b, segment[b, k], group[b, k], np.zeros(len(b), int)), (code[symbol] << U(1)) | (band[b, k] > 0).astype(U), length[symbol] + 1)
    skips = group[b, k]
    at = np.repeat(np.arange(len(b)), skips)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(skips) - skips, skips)
    add(key(b[at], segment[b[at], k[at]], nth, np.zeros(len(at), int)), np.full(len(at), code[0xF0]), length[0xF0])
    b, k = np.nonzero(old)
    add(key(b, segment[b, k], group[b, k], 1 + k), size[b, k] & 1, np.int64(1))
    tail = np.flatnonzero(~fresh[:, -1])
    add(key(tail, total[tail], np.zeros(len(tail), int), np.zeros(len(tail), int)), np.full(len(tail), code[0]), length[0])
    order = np.argsort(np.concatenate(keys), kind="stable")
    return Bits(np.concatenate(values)[order], np.concatenate(sizes)[order], lane[np.concatenate(keys)[order] // (64 * 8 * 128)])


def segment(kind: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, kind, len(body) + 2) + body
