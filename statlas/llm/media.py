"""Media columns: bytes kept losslessly in progressive JPEGs, and JPEGs read into RGB tensors.

The format's unit is the transform coefficient: a byte is one coefficient of a colour image (three
components, the two of colour at half resolution), with quantisation steps of one. An image is written in
ten scans: DC without its last bit, the low AC band of each component without its last bit, the high
band of each, then the last bit of DC and of the low bands; restart intervals let a reader decode in
parallel. The number of bytes stands in a comment.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlas.llm import jpeg
from statlas.llm._text import chunks
from statlas.llm._util import prepare

UNIT = 64
#: MCUs or blocks between restart markers.
INTERVAL = 8
LOW = (1, 5)
HIGH = (6, 63)
#: Bytes whose coefficient is zero; about the middle of the letters.
CENTRE = 104
#: Bytes of payload that are coded together, and blocks in one go of the bit packer.
CHUNK = 2 << 20
SLICE = 1 << 15
NOTE = b"payload bytes "


def padded(data: bytes) -> bytes:
    """data with zeros up to a positive multiple of UNIT."""
    return data + bytes(-len(data) % UNIT or (0 if data else UNIT))


def shape(blocks: int) -> tuple[int, int]:
    """Rows and columns of MCUs that hold so many blocks, six in each."""
    n = -(-blocks // 6)
    wide = min(4095, int(np.ceil(np.sqrt(n))))
    return -(-n // wide), wide


def _lanes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For images with so many units each: the lane of each unit, and the number of lanes of each image."""
    n = -(-counts // INTERVAL)
    at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(np.cumsum(n) - n, counts) + at // INTERVAL, n


def _cut(data: np.ndarray, ends: np.ndarray, n: np.ndarray) -> list[bytes]:
    """The scan of each image: its lanes with restart markers between them."""
    last = np.cumsum(n)
    inner = np.ones(len(ends), bool)
    inner[last - 1] = False
    number = np.arange(len(ends)) - np.repeat(last - n, n)
    at = np.repeat(ends[inner], 2)
    marks = np.stack([np.full(inner.sum(), 0xFF), 0xD0 + number[inner] % 8], axis=1).ravel()
    out = np.insert(data, at, marks)
    stop = ends[last - 1] + 2 * (np.cumsum(inner)[last - 1])
    return [out[a:b].tobytes() for a, b in zip(np.r_[0, stop[:-1]], stop, strict=True)]


def _in_slices(bits, rows: np.ndarray, lane: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed bits of many blocks, some lanes at a time."""
    if len(rows) <= SLICE:
        return jpeg.packed(bits(rows, lane), lanes)
    data, ends, size = [], [], 0
    at = 0
    while at < len(rows):
        stop = min(len(rows), at + SLICE)
        stop = len(rows) if stop == len(rows) else int(np.searchsorted(lane, lane[stop]))
        low, high = int(lane[at]), int(lane[stop - 1]) + 1
        d, e = jpeg.packed(bits(rows[at:stop], lane[at:stop] - low), high - low)
        data.append(d)
        ends.append(e + size)
        size += len(d)
        at = stop
    return np.concatenate(data), np.concatenate(ends)


HEAD = jpeg.segment(0xDB, bytes([0]) + bytes([1] * 64))
TABLES = jpeg.segment(0xC4, bytes([0]) + jpeg.DC_TABLE) + jpeg.segment(0xC4, bytes([0x10]) + jpeg.AC_TABLE) + jpeg.segment(0xDD, struct.pack(">H", INTERVAL))


def _sos(components: list[int], first: int, last: int, above: int, shift: int) -> bytes:
    return jpeg.segment(0xDA, bytes([len(components), *(x for c in components for x in (c, 0)), first, last, above << 4 | shift]))


def encode(payloads: list[bytes]) -> list[bytes]:
    """A progressive JPEG for each payload, a multiple of UNIT bytes."""
    counts = np.array([len(p) // UNIT for p in payloads], np.int64)
    grid = [shape(int(n)) for n in counts]
    rows, columns = (np.array(x, np.int64) for x in zip(*grid, strict=True))
    mcus = rows * columns
    flat = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, UNIT)
    value = ((flat.astype(np.int16) - CENTRE + 128) & 255) - 128
    first = np.cumsum(6 * mcus) - 6 * mcus
    coef = np.zeros((int(6 * mcus.sum()), UNIT), np.int16)
    coef[np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(len(flat))] = value
    # where each component's blocks are, in raster order, and all blocks by MCU
    planes = []
    for offset, n in ((0, 4 * mcus), (4 * mcus, mcus), (5 * mcus, mcus)):
        planes.append(np.repeat(first + offset - (np.cumsum(n) - n), n) + np.arange(int(n.sum())))
    image = np.repeat(np.arange(len(mcus)), mcus)
    m = np.arange(len(image)) - np.repeat(np.cumsum(mcus) - mcus, mcus)
    y, x = m // columns[image], m % columns[image]
    corner = first[image] + 2 * y * 2 * columns[image] + 2 * x
    order = np.stack([corner, corner + 1, corner + 2 * columns[image], corner + 2 * columns[image] + 1, first[image] + 4 * mcus[image] + m, first[image] + 5 * mcus[image] + m], axis=1)
    lane, n = _lanes(mcus)
    dc = (coef[:, 0].astype(np.int64) >> 1)[order]
    start = np.r_[True, lane[1:] != lane[:-1]]
    before = np.zeros_like(dc)
    before[:, 1:4] = dc[:, 0:3]
    before[1:, [0, 4, 5]] = dc[:-1, 3:6]
    before[:, 0] = np.where(start, 0, before[:, 0])
    before[np.ix_(start, [4, 5])] = 0
    six = np.repeat(lane, 6)
    scans = [(_sos([1, 2, 3], 0, 0, 0, 1), _cut(*jpeg.packed(jpeg.dc_first_bits(dc.ravel(), before.ravel(), six), int(n.sum())), n))]
    of = [_lanes(k) for k in (4 * mcus, mcus, mcus)]
    for c in range(3):
        own, lanes = of[c]
        data = _in_slices(lambda r, a: jpeg.ac_first_bits(coef[r], *LOW, 1, a), planes[c], own, int(lanes.sum()))
        scans.append((_sos([c + 1], *LOW, 0, 1), _cut(*data, lanes)))
    for c in range(3):
        own, lanes = of[c]
        data = _in_slices(lambda r, a: jpeg.ac_first_bits(coef[r], *HIGH, 0, a), planes[c], own, int(lanes.sum()))
        scans.append((_sos([c + 1], *HIGH, 0, 0), _cut(*data, lanes)))
    last = (coef[:, 0][order] & 1).ravel().astype(np.uint64)
    scans.append((_sos([1, 2, 3], 0, 0, 1, 0), _cut(*jpeg.packed(jpeg.Bits(last, np.ones(len(last), np.int64), six), int(n.sum())), n)))
    for c in range(3):
        own, lanes = of[c]
        data = _in_slices(lambda r, a: jpeg.ac_refine_bits(coef[r], *LOW, 0, a), planes[c], own, int(lanes.sum()))
        scans.append((_sos([c + 1], *LOW, 1, 0), _cut(*data, lanes)))
    out = []
    for i, p in enumerate(payloads):
        frame = struct.pack(">BHHB", 8, 16 * int(rows[i]), 16 * int(columns[i]), 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
        note = jpeg.segment(0xFE, NOTE + str(len(p)).encode())
        body = b"".join(head + scan[i] for head, scan in scans)
        out.append(b"\xff\xd8" + note + HEAD + jpeg.segment(0xC2, frame) + TABLES + body + b"\xff\xd9")
    return out


def payload(image: jpeg.Image, coef: np.ndarray) -> bytes:
    """The bytes that encode() put into an image."""
    note = next(c for c in image.comments if c.startswith(NOTE))
    return ((coef.ravel()[: int(note[len(NOTE) :])] + CENTRE) & 255).astype(np.uint8).tobytes()


def feature(picture: np.ndarray) -> str:
    """Size of a picture, and sum and sum of squares of each channel."""
    wide = picture.reshape(-1, 3).astype(np.int64)
    return ":".join(map(str, [picture.shape[0], picture.shape[1], *wide.sum(axis=0).tolist(), *(wide * wide).sum(axis=0).tolist()]))


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media) per row of docs (doc_id, text): the text's UTF-8 bytes, padded, as a progressive JPEG. Null is an empty text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in chunks(batch.column(1)):
                raw = data.tobytes()
                at = 0
                while at < len(offsets) - 1:
                    stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
                    texts = [raw[a:b] for a, b in zip(offsets[at:stop], offsets[at + 1 : stop + 1], strict=True)]
                    media = encode([padded(t) for t in texts])
                    columns = [batch.column(0).slice(row + at, stop - at), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "media"])
                    at = stop

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def load(stored: DataFrame, tensors: bool = False) -> DataFrame:
    """stored (doc_id, n_bytes, media) with the payload read back, height, width and feature; with tensors the RGB values too.

    rgb holds height x width x 3 bytes. Media that is no progressive JPEG is an error; a null medium gives nulls.
    """
    prepare(stored.sparkSession)
    schema = "doc_id long, n_bytes long, media binary, payload binary, height int, width int, feature string" + ", rgb binary" * tensors
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(m.as_buffer()) if m.is_valid else 0 for m in batch.column(2)])
            ends, at = np.cumsum(sizes), 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
                part = batch.slice(at, stop - at)
                media = part.column(2).to_pylist()
                images, coefs = jpeg.coefficients([m for m in media if m is not None])
                found = iter(zip(images, coefs, strict=True))
                rows: list[list] = [[] for _ in range(4 + tensors)]
                for m in media:
                    image, coef = next(found) if m is not None else (None, None)
                    picture = None if m is None else jpeg.rgb(image, coef)
                    values = [None] * 5 if m is None else [payload(image, coef), image.height, image.width, feature(picture), picture.tobytes() if tensors else None]
                    for r, v in zip(rows, values, strict=False):
                        r.append(v)
                kinds = [pa.binary(), pa.int32(), pa.int32(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *(pa.array(r, k) for r, k in zip(rows, kinds, strict=False))], names=names)
                at = stop

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)
