"""Point-in-polygon join as a grid-cell equi join over clipped polygons.

Each polygon (the small side) is cut along a grid. What a cell keeps of it is the
answer for the cell's points, not the ring: nothing where the cell lies outside, a
parity where it lies inside, and else the few edges that pass through the cell,
together with the parity of everything to its right. A point gets exactly one cell,
so the join is an ordinary hash join - broadcast when the cell table is small at
runtime, shuffled when not - and points in inner cells need no test.

The even-odd rule counts edges crossed by the ray from the point to the right:

* edges that stay above, below or left of a cell are crossed by no ray from it;
* an edge that stays right of it is crossed if the point's y lies between its ends,
  ``(ay > y) != (by > y)``. Over a chain of such edges the inner vertices cancel, so
  the chain is known by its ends: an end above the row flips the cell's parity, an
  end within the row is kept as a *step* (its y), one below does nothing;
* the others are kept as they are and tested with the formula of
  ``strictly_within``, so both give the same answer to the last bit.

Cells are compared with a margin far above rounding: an edge near a cell's rim is kept.
Cutting and testing run vectorised (numpy over Arrow batches), a bounded batch at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.geometry import bbox

NO_CELL = -(2 ** 62)


def median_cell(zones: DataFrame, ring: str) -> Column:
    """Half the longer side of the median bounding box (a scalar subquery): most
    polygons then have a handful of cells. 1.0 without polygons or with points only."""
    b = zones.select(bbox(F.col(ring)).alias("b")).select("b.*")
    side = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))
    half = F.percentile_approx(F.when((side > 0) & (side < float("inf")), side), 0.5, F.lit(1000)) / 2
    return b.agg(F.coalesce(half, F.lit(1.0)).alias("cell")).scalar()


def _cell_batches(batches, ring, keep, cell):
    from tessera.functions.geometry_arrow import clipped_batches
    for b in batches:
        yield from clipped_batches(b.select(keep), b.column(ring), b.column(cell))


def _inside_batches(batches, x, y, keep):
    import pyarrow as pa

    from tessera.functions.geometry_arrow import inside_cells
    for b in batches:
        px = b.column(x).to_numpy(zero_copy_only=False).astype("float64")
        py = b.column(y).to_numpy(zero_copy_only=False).astype("float64")
        mask = inside_cells(px, py, b.column("_seed"), b.column("_steps"), b.column("_near"))
        yield b.filter(pa.array(mask)).select(keep)


def zone_cells(zones: DataFrame, ring: str, cell: Column) -> DataFrame:
    """Polygons cut to grid cells: ``_cx, _cy``, the parity ``_seed``, the ``_steps``
    (heights where it flips) and the ``_near`` edges. Cells outside are left out, and
    so are rings that are empty or hold a missing or non-finite vertex."""
    keep = [c for c in zones.columns if c != ring]
    schema = T.StructType(zones.select(*keep).schema.fields + T.StructType.fromDDL(
        "_cx LONG, _cy LONG, _seed INT, _steps ARRAY<DOUBLE>, "
        "_near ARRAY<STRUCT<ax: DOUBLE, ay: DOUBLE, bx: DOUBLE, by: DOUBLE>>").fields)
    return zones.withColumn("_cell", cell).mapInArrow(lambda it: _cell_batches(it, ring, keep, "_cell"), schema)


def within(points: DataFrame, x: str, y: str, zones: DataFrame, ring: str = "ring", cell: float | None = None,
           slices: int = 8) -> DataFrame:
    """Inner join of points with the polygons that strictly contain them
    (points on a border belong to no polygon, like a 'within' predicate).

    ``cell`` is the grid's width, by default taken from the polygons
    (``median_cell``). A cell's points are dealt into ``slices`` by a hash of the row,
    and the cell table is listed once per slice, so a hot cell is no single join key
    (AQE splits what is still skewed). Points without coordinates lie in no polygon;
    polygons that overlap each give a row; the ring is not part of the result."""
    width = median_cell(zones, ring) if cell is None else F.lit(float(cell))
    cells = zone_cells(zones, ring, width).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    px, py = F.col(x), F.col(y)
    # points without coordinates get a cell no polygon has; keys stay non-null,
    # so the optimizer infers no null filter that would re-evaluate x and y
    at = lambda v: F.when(F.isnan(v), NO_CELL).otherwise(F.coalesce(F.floor(v / width), F.lit(NO_CELL)))
    hashed = [f.name for f in points.schema.fields if "map<" not in f.dataType.simpleString()]   # maps have no hash
    pts = (points.withColumn("_slice", F.pmod(F.xxhash64(*hashed), F.lit(slices)).cast("int"))
                 .withColumn("_cx", at(px)).withColumn("_cy", at(py)))
    cand = pts.join(cells, ["_cx", "_cy", "_slice"])
    keep = [c for c in cand.columns if c not in ("_cx", "_cy", "_slice", "_seed", "_steps", "_near")]
    return cand.drop("_cx", "_cy", "_slice").mapInArrow(lambda it: _inside_batches(it, x, y, keep), cand.select(*keep).schema)
