"""Cut compound images into their parts along empty rows and columns; numpy over rows of decoded images.

Images are structs as the ``image`` source reads them: origin, height, width, nChannels,
mode, data (rows of blue, green, red). Images of one size are worked on in stacks of bounded
size, a larger image alone, so memory is some images'.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

#: Blur size, the two thresholds of edges, brightness of an empty image, cell of the reading order.
BLUR, LOW, HIGH = 13, 1, 20
TOO_BRIGHT, TOO_DARK = 230, 25
CELL = 50
#: Pixels of images of one size that are worked on at once.
STACK = 1 << 16

_BOX = ["y0", "x0", "y1", "x1"]


def gray(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.float64)
    return a[:, :, 0] if channels == 1 else a[:, :, :3] @ [0.114, 0.587, 0.299]


def blur(a: np.ndarray, size: int = BLUR) -> np.ndarray:
    """Gaussian blur of one image, or of a stack of images of one size, with a deviation that follows from the size."""
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    k = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    k /= k.sum()
    for axis in (a.ndim - 2, a.ndim - 1):
        wide = np.pad(a, [(size // 2, size // 2) if i == axis else (0, 0) for i in range(a.ndim)], mode="symmetric")
        n = a.shape[axis]
        shifted = [wide[..., i : i + n, :] if axis == a.ndim - 2 else wide[..., i : i + n] for i in range(size)]
        a, one = k[0] * shifted[0], np.empty_like(a)
        for w, x in zip(k[1:], shifted[1:], strict=True):
            a += np.multiply(x, w, out=one)
    return a


def edges(a: np.ndarray, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Edges by gradient of one image or of each of a stack, thinned to ridges; weak ones stay where they touch strong ones."""
    if a.ndim == 2:
        return edges(a[None], low, high)[0]
    p = np.pad(a, [(0, 0), (1, 1), (1, 1)], mode="symmetric")
    rows, cols = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:], p[:, :, :-2] + 2 * p[:, :, 1:-1] + p[:, :, 2:]
    gx, gy = rows[:, :, 2:] - rows[:, :, :-2], cols[:, 2:] - cols[:, :-2]
    m = np.pad(np.abs(gx) + np.abs(gy), [(0, 0), (1, 1), (1, 1)])
    # Directions are needed of no other pixels than those that may be edges.
    inside = m[:, 1:-1, 1:-1] > low
    x, y = gx[inside], gy[inside]
    flat, steep = (np.abs(u) <= np.tan(np.pi / 8) * np.abs(v) for u, v in ((y, x), (x, y)))
    ahead = np.where(flat, 1, np.where(steep, m.shape[2], np.where((x > 0) == (y > 0), m.shape[2] + 1, m.shape[2] - 1)))
    weak, grown = np.zeros(m.shape, bool), np.zeros(m.shape, bool)
    weak[:, 1:-1, 1:-1] = inside
    at, size = np.flatnonzero(weak), m.ravel()
    own = size[at]
    ridge = (own >= size[at + ahead]) & (own > size[at - ahead])
    strong, left = grown.ravel(), weak.ravel()
    strong[at], left[at] = ridge & (own > high), ridge & (own <= high)
    around = np.array([y * m.shape[2] + x for y in (-1, 0, 1) for x in (-1, 0, 1)])
    rest = np.flatnonzero(left)
    front = rest[strong[rest[:, None] + around].any(axis=1)]
    while len(front):
        strong[front], left[front] = True, False
        near = (front[:, None] + around).ravel()
        front = np.unique(near[left[near]])
    return grown[:, 1:-1, 1:-1]


def closed(edge: np.ndarray, gap: int) -> np.ndarray:
    """A stack's edges, each spread by ``gap`` pixels up, down, left and right."""
    h, w = edge.shape[1:]
    wide = np.pad(edge, [(0, 0), (gap, gap), (gap, gap)])
    out = np.zeros_like(edge)
    for i in range(2 * gap + 1):
        out |= wide[:, i : i + h, gap : gap + w]
        out |= wide[:, gap : gap + h, i : i + w]
    return out


def spans(flags: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Runs of true flags of at least the length."""
    wide = np.zeros(len(flags) + 2, bool)
    wide[1:-1] = flags
    turns = np.flatnonzero(wide[1:] != wide[:-1]).tolist()
    return [(a, b) for a, b in zip(turns[::2], turns[1::2], strict=True) if b - a >= least]


def boxes(edge: np.ndarray, least: int = 30, edge_minimum: int = 1, rounds: int = 2) -> list[tuple[int, int, int, int]]:
    """Parts (y0, x0, y1, x1) in reading order: rows, then columns, with enough edges are cut out until ``rounds`` cuts change nothing."""
    known: dict[tuple[int, int, int, int], list[tuple[int, int, int, int]]] = {}

    def parts(box: tuple[int, int, int, int]) -> list[tuple[int, int, int, int]]:
        """What one cut makes of a box; later rounds meet most boxes again."""
        if box not in known:
            y0, x0, y1, x1 = box
            rows = spans(np.count_nonzero(edge[y0:y1, x0:x1], axis=1) >= edge_minimum, least)
            known[box] = [(y0 + a, x0 + c, y0 + b, x0 + d) for a, b in rows for c, d in spans(np.count_nonzero(edge[y0 + a : y0 + b, x0:x1], axis=0) >= edge_minimum, least)]
        return known[box]

    found, still = [(0, 0, *edge.shape)], 0
    while found and still < rounds:
        cut = [c for box in found for c in parts(box)]
        still = still + 1 if len(cut) == len(found) else 0
        found = cut
    return sorted(found, key=lambda b: (b[0] // CELL, b[1] // CELL, b))


def is_empty(a: np.ndarray) -> bool:
    return bool(a.size == 0 or a.min() >= TOO_BRIGHT or a.max() <= TOO_DARK)


def _slices(b: pa.RecordBatch, image: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch's rows in slices of at most ``limit`` bytes of images; a larger image is a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(pc.struct_field(b.column(b.schema.get_field_index(image)), "data")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < b.num_rows:
        until = max(at + 1, int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + limit, side="right")))
        yield b.slice(at, until - at)
        at = until


def split_images(images: DataFrame, image: str = "image", least: int = 30, edge_minimum: int = 1, rounds: int = 2, gap: int = 3) -> DataFrame:
    """One row per part of each image: the other columns, part (from 1), y0, x0, y1, x1, data (its bytes, rows first).

    Gaps of up to ``gap`` rows or columns without edges don't cut. Parts that are almost
    white or almost black are left out. A null image, one of no pixels or one whose bytes
    don't fit its size has no parts.
    """
    others = [f for f in images.schema.fields if f.name != image]
    names = [f.name for f in others]
    schema = StructType([*others, *[StructField(n, IntegerType()) for n in ("part", *_BOX)], StructField("data", BinaryType())])
    kinds = [pa.int32()] * 5 + [pa.binary()]

    def parts(images: list[bytes], h: int, w: int, n: int) -> Iterator[list[tuple]]:
        """The parts of each image of a stack."""
        a = np.stack([gray(x, h, w, n) for x in images])
        close = closed(edges(blur(a)), gap)
        for i, x in enumerate(images):
            whole = np.frombuffer(x, np.uint8).reshape(h, w, n)
            kept = [b for b in boxes(close[i], least, edge_minimum, rounds) if not is_empty(a[i, b[0] : b[2], b[1] : b[3]])]
            yield [(k + 1, y0, x0, y1, x1, whole[y0:y1, x0:x1].tobytes()) for k, (y0, x0, y1, x1) in enumerate(kept)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Once a block this large was freed, glibc keeps the memory of a stack's arrays instead of fetching its pages anew for each.
        np.empty(3 << 20)
        for whole in batches:
            for b in _slices(whole, image):
                column = b.column(b.schema.get_field_index(image))
                h, w, n, data = (pc.struct_field(column, f).to_pylist() for f in ("height", "width", "nChannels", "data"))
                sizes: dict[tuple[int, int, int], list[int]] = {}
                for i, x in enumerate(data):
                    if x and None not in (h[i], w[i], n[i]) and h[i] * w[i] * n[i] == len(x):
                        sizes.setdefault((h[i], w[i], n[i]), []).append(i)
                found: dict[int, list[tuple]] = {}
                for size, at in sizes.items():
                    step = max(1, STACK // (size[0] * size[1]))
                    for lo in range(0, len(at), step):
                        some = at[lo : lo + step]
                        found.update(zip(some, parts([data[i] for i in some], *size), strict=True))
                rows = [i for i in sorted(found) for _ in found[i]]
                if rows:
                    same = b.select(names).take(pa.array(rows))
                    made = [pa.array(c, t) for c, t in zip(zip(*[p for i in sorted(found) for p in found[i]], strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*same.columns, *made], names=schema.names)

    return images.mapInArrow(run, schema)


def split_status(found: Column, wanted: Column) -> Column:
    """ok only if an image gave as many parts as its caption has; null ``found``: the image is missing."""
    return F.when(found.isNull(), "image-not-found").when(found == 0, "zero-output-amount").when(found == wanted, "ok").otherwise("incorrect-output-amount")
