"""Vectorised (numpy over Arrow list offsets) versions of the geometry tests,
for ``mapInArrow``. Same floating-point formulas as ``geometry.py``, so both
paths give identical answers; this one avoids per-row lambda evaluation.

No Spark objects are created at import time (executors import this module).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARGIN = 1e-9       # of the largest coordinate or the cell
TABLE = 1 << 18     # entries a worker holds at a time


def _ring_arrays(rings: pa.ListArray):
    rings = rings.combine_chunks() if isinstance(rings, pa.ChunkedArray) else rings
    offsets = np.asarray(rings.offsets, dtype=np.int64)
    # offsets are relative to the (possibly sliced) values buffer
    flat = rings.values
    xs = np.asarray(pc.struct_field(flat, "x"), dtype=np.float64)
    ys = np.asarray(pc.struct_field(flat, "y"), dtype=np.float64)
    return offsets, xs, ys


def _clip(ax, ay, bx, by, lo_y, hi_y, margin):
    """Per edge: the range of x it covers between the two heights."""
    dy = by - ay
    flat = np.abs(dy) <= margin
    slope = (bx - ax) / np.where(flat, 1.0, dy)
    low = slope * (np.maximum(np.minimum(ay, by), lo_y) - ay) + ax
    high = slope * (np.minimum(np.maximum(ay, by), hi_y) - ay) + ax
    return (np.where(flat, np.minimum(ax, bx), np.minimum(low, high)),
            np.where(flat, np.maximum(ax, bx), np.maximum(low, high)))


def _ring_cells(xs, ys, cell):
    """Cells (cx, cy, seed, steps, near edges) of one ring that are not outside it."""
    ax, ay, bx, by = xs, ys, np.roll(xs, 1), np.roll(ys, 1)
    margin = MARGIN * max(cell, np.abs(xs).max(), np.abs(ys).max())
    top, bottom = np.maximum(ay, by), np.minimum(ay, by)
    first, last = int(np.floor(xs.min() / cell)), int(np.floor(xs.max() / cell))
    for cy in range(int(np.floor(ys.min() / cell)), int(np.floor(ys.max() / cell)) + 1):
        lo_y, hi_y = cy * cell - margin, (cy + 1) * cell + margin
        row = np.flatnonzero((top >= lo_y) & (bottom <= hi_y))
        rax, ray, rbx, rby = ax[row], ay[row], bx[row], by[row]
        lo, hi = _clip(rax, ray, rbx, rby, lo_y, hi_y, margin)
        flips = ((ray > hi_y) != (rby > hi_y)).astype(np.int64)
        width = max(1, TABLE // max(1, len(row)))       # edges by cells, a bounded table at a time
        for start in range(first, last + 1, width):
            cx = np.arange(start, min(start + width, last + 1))
            lo_x, hi_x = cx * cell - margin, (cx + 1) * cell + margin
            near = (hi[:, None] >= lo_x) & (lo[:, None] <= hi_x)
            right = lo[:, None] > hi_x
            seed = flips @ right % 2
            edged = near.any(axis=0)
            for k in np.flatnonzero(edged | (seed == 1)):
                at, steps = np.flatnonzero(near[:, k]), ()
                if edged[k]:
                    ends = np.concatenate([ray[right[:, k]], rby[right[:, k]]])
                    heights, times = np.unique(ends[(ends >= lo_y) & (ends <= hi_y)], return_counts=True)
                    steps = heights[times % 2 == 1]
                yield int(cx[k]), cy, int(seed[k]), steps, np.column_stack([rax[at], ray[at], rbx[at], rby[at]])


def clipped_batches(kept: pa.RecordBatch, rings: pa.ListArray, cells: pa.Array):
    """Batches of the kept columns, once per cell of each row's ring, with ``_cx, _cy,
    _seed, _steps, _near`` (see ``operators.spatial``)."""
    offsets, xs, ys = _ring_arrays(rings)
    out = []

    def flush():
        rows, cx, cy, seed, steps, near = zip(*out)
        edges = pa.StructArray.from_arrays([pa.array(c) for c in np.concatenate(near).T.copy()], ["ax", "ay", "bx", "by"])
        lists = lambda parts, values: pa.ListArray.from_arrays(
            pa.array(np.cumsum([0] + [len(p) for p in parts]), pa.int32()), values)
        table = kept.take(pa.array(rows, pa.int64()))
        arrays = [pa.array(cx, pa.int64()), pa.array(cy, pa.int64()), pa.array(seed, pa.int32()),
                  lists(steps, pa.array(np.concatenate([np.asarray(s, np.float64) for s in steps]))), lists(near, edges)]
        return pa.RecordBatch.from_arrays(table.columns + arrays,
                                          names=table.schema.names + ["_cx", "_cy", "_seed", "_steps", "_near"])

    held = 0
    for i, cell in enumerate(cells.to_pylist()):
        x, y = xs[offsets[i]:offsets[i + 1]], ys[offsets[i]:offsets[i + 1]]
        if len(x) == 0 or not (np.isfinite(x).all() and np.isfinite(y).all()):
            continue
        for part in _ring_cells(x, y, cell):
            out.append((i, *part))
            held += 1 + len(part[3]) + len(part[4])
            if held >= TABLE:
                yield flush()
                out, held = [], 0
    if out:
        yield flush()


def inside_cells(px: np.ndarray, py: np.ndarray, seed: pa.Array, steps: pa.ListArray, near: pa.ListArray) -> np.ndarray:
    """Per row: the point lies strictly inside the polygon whose cell state it met."""
    n = len(px)
    lists = lambda a: (np.asarray(a.offsets, dtype=np.int64), a.values)
    at, heights = lists(steps)
    row = np.repeat(np.arange(n), np.diff(at))
    above = np.asarray(heights, dtype=np.float64)[at[0]:at[-1]] > py[row]
    crossed = np.asarray(seed, dtype=np.int64) + np.bincount(row, weights=above, minlength=n).astype(np.int64)
    at, edges = lists(near)
    row = np.repeat(np.arange(n), np.diff(at))
    ax, ay, bx, by = (np.asarray(pc.struct_field(edges, c), dtype=np.float64)[at[0]:at[-1]] for c in ("ax", "ay", "bx", "by"))
    qx, qy = px[row], py[row]
    with np.errstate(divide="ignore", invalid="ignore"):
        dy = by - ay
        x_at = (bx - ax) * (qy - ay) / np.where(dy == 0, np.nan, dy) + ax
        crossing = ((ay > qy) != (by > qy)) & (qx < x_at)
    cross = (bx - ax) * (qy - ay) - (by - ay) * (qx - ax)
    on_edge = ((cross == 0) & (qx >= np.minimum(ax, bx)) & (qx <= np.maximum(ax, bx))
               & (qy >= np.minimum(ay, by)) & (qy <= np.maximum(ay, by)))
    crossed += np.bincount(row, weights=crossing, minlength=n).astype(np.int64)
    border = np.bincount(row, weights=on_edge, minlength=n) > 0
    return (crossed % 2 == 1) & ~border


def polyline_centroid_np(lines: pa.ListArray):
    """Per row: length-weighted mean of segment midpoints (x, y); zero length
    -> first vertex; empty -> NaN."""
    offsets, xs, ys = _ring_arrays(lines)
    start, end = offsets[:-1], offsets[1:]
    n = len(start)
    cx = np.full(n, np.nan)
    cy = np.full(n, np.nan)
    nonempty = end > start
    cx[nonempty] = xs[start[nonempty]]
    cy[nonempty] = ys[start[nonempty]]
    lengths = end - start
    if (lengths > 1).sum() == 0:
        return cx, cy
    k = np.arange(start[0], end[-1])                      # every vertex, list order
    row_k = np.repeat(np.arange(n), lengths)
    not_first = k != np.repeat(start, lengths)
    b = k[not_first]
    row = row_k[not_first]
    a = b - 1
    dx, dy = xs[b] - xs[a], ys[b] - ys[a]
    seg = np.sqrt(dx * dx + dy * dy)
    # bincount adds in index order: the same left fold as the expression
    tot = np.bincount(row, weights=seg, minlength=n)
    sx = np.bincount(row, weights=seg * (xs[a] + xs[b]) / 2, minlength=n)
    sy = np.bincount(row, weights=seg * (ys[a] + ys[b]) / 2, minlength=n)
    ok = tot > 0
    cx[ok] = sx[ok] / tot[ok]
    cy[ok] = sy[ok] / tot[ok]
    return cx, cy
