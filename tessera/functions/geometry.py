"""Planar geometry as pure Spark expressions (no geometry type assumed).

A ring is ``array<struct<x:double, y:double>>`` (closing vertex optional); a
polyline is the same type read as connected segments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edges(ring: Column) -> Column:
    """array<struct<ax, ay, bx, by>>: each vertex with its predecessor (wrapping)."""
    n = F.size(ring)

    def edge(i):
        a = F.get(ring, i)
        b = F.get(ring, F.when(i == 0, n - 1).otherwise(i - 1))
        return F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"))

    return F.transform(F.sequence(F.lit(0), n - 1), edge)


def _on_edge(e, px, py):
    cross = (e["bx"] - e["ax"]) * (py - e["ay"]) - (e["by"] - e["ay"]) * (px - e["ax"])
    return ((cross == 0)
            & (px >= F.least(e["ax"], e["bx"])) & (px <= F.greatest(e["ax"], e["bx"]))
            & (py >= F.least(e["ay"], e["by"])) & (py <= F.greatest(e["ay"], e["by"])))


def _crosses(e, px, py):
    straddles = (e["ay"] > py) != (e["by"] > py)
    x_at = (e["bx"] - e["ax"]) * (py - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"]
    return straddles & (px < x_at)


def strictly_within(px: Column, py: Column, ring: Column) -> Column:
    """Point strictly inside the polygon: even-odd rule, border points excluded.
    One pass over the edges accumulates (crossings, on_border)."""
    init = F.struct(F.lit(0).alias("n"), F.lit(False).alias("border"))

    def step(acc, e):
        return F.struct((acc["n"] + F.when(_crosses(e, px, py), 1).otherwise(0)).alias("n"),
                        (acc["border"] | F.coalesce(_on_edge(e, px, py), F.lit(False))).alias("border"))

    res = F.aggregate(edges(ring), init, step)
    return ((res["n"] % 2) == 1) & ~res["border"]


def bbox(ring: Column) -> Column:
    xs = F.transform(ring, lambda p: p["x"])
    ys = F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"),
                    F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def polyline_centroid(line: Column) -> Column:
    """Length-weighted mean of segment midpoints: struct<x, y>, from one pass
    over the segments. A zero-length line falls back to its first vertex."""
    n = F.size(line)
    init = F.struct(F.lit(0.0).alias("l"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))

    def step(acc, i):
        a, b = F.get(line, i - 1), F.get(line, i)
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        seg = F.sqrt(dx * dx + dy * dy)
        return F.struct((acc["l"] + seg).alias("l"),
                        (acc["sx"] + seg * (a["x"] + b["x"]) / 2).alias("sx"),
                        (acc["sy"] + seg * (a["y"] + b["y"]) / 2).alias("sy"))

    tot = F.aggregate(F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: i < n), init, step)
    first = F.get(line, 0)
    return F.struct(F.when(tot["l"] > 0, tot["sx"] / tot["l"]).otherwise(first["x"]).alias("x"),
                    F.when(tot["l"] > 0, tot["sy"] / tot["l"]).otherwise(first["y"]).alias("y"))
