"""Radius join, point-in-rectangle join and inverse-distance weighting.

Both joins become equi-joins on grid cells, so the big side is never compared
with the whole other side.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airway.functions.geo import EARTH_RADIUS_M, haversine_m
from airway.operators import tiles
from airway.operators.cleaning import sortable
from airway.operators.joining import estimated_bytes, fits_broadcast, lookup_join
from airway.sources.staging import Work, staged

RADIUS_M = 5000
METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180.0


class CellGrid:
    """Global grid whose cells are ``edge_m`` metres high and about as wide at any
    latitude: rows nearer to a pole have fewer columns. Methods give SQL text."""

    def __init__(self, edge_m: float):
        self.columns = max(1, math.floor(360.0 * METRES_PER_DEGREE / edge_m))
        self.degrees = 360.0 / self.columns

    def row_of(self, lat: str) -> str:
        return f"floor(({lat} + 90.0D) / {self.degrees!r}D)"

    def columns_in(self, row: str) -> str:
        middle = f"radians(({row} + 0.5D) * {self.degrees!r}D - 90.0D)"
        return f"greatest(1L, floor({self.columns} * cos({middle})))"

    def key(self, row: str, columns: str, column: str) -> str:
        return f"{row} * {self.columns} + pmod({column}, {columns})"

    def place(self, points: DataFrame, lon: str, lat: str) -> DataFrame:
        """Add the ``_cell`` of each point; rows without a position are dropped."""
        column = f"least(floor(pmod({lon} + 180.0D, 360.0D) * _columns / 360.0D), _columns - 1)"
        return (
            points.where(f"{lon} IS NOT NULL AND {lat} IS NOT NULL")
            .withColumn("_row", F.expr(self.row_of(lat)))
            .withColumn("_columns", F.expr(self.columns_in("_row")))
            .withColumn("_cell", F.expr(self.key("_row", "_columns", column)))
            .drop("_row", "_columns")
        )


def covering_cells(centers: DataFrame, grid: CellGrid, radius_m: float, lon: str, lat: str) -> DataFrame:
    """One row per center and cell its circle may touch: ``_cell`` and ``_inside``
    (the whole cell lies within the circle, so its points need no distance test).
    Cells at the corners of the box around a circle that it cannot reach are left out."""
    reach = (math.ceil(radius_m) + 1.0) / EARTH_RADIUS_M
    reach_deg = math.degrees(reach) + 1e-9
    half_width = (
        f"if(abs({lat}) + {reach_deg!r}D >= 90.0D, 180.0D,"
        f" degrees(asin(least(1.0D, {math.sin(reach)!r}D / cos(radians({lat}))))) + 1e-9D)"
    )
    rows = f"sequence({grid.row_of(f'{lat} - {reach_deg!r}D')}, {grid.row_of(f'{lat} + {reach_deg!r}D')})"
    first = f"floor(({lon} - _half + 180.0D) * _columns / 360.0D)"
    last = f"floor(({lon} + _half + 180.0D) * _columns / 360.0D)"
    # Farthest latitude and longitude of the cell and its widest parallel bound
    # the distance of every point in it from above.
    south = f"(_row * {grid.degrees!r}D - 90.0D)"
    north = f"({south} + {grid.degrees!r}D)"
    west = "(_column * 360.0D / _columns - 180.0D)"
    east = "((_column + 1) * 360.0D / _columns - 180.0D)"
    widest = f"greatest(cos(radians({south})), cos(radians({north})))"
    high = f"greatest(abs({south} - {lat}), abs({north} - {lat}))"
    wide = f"least(greatest(abs({west} - {lon}), abs({east} - {lon})), 180.0D)"
    chord = (
        f"pow(sin(radians({high}) / 2.0D), 2.0D)"
        f" + cos(radians({lat})) * {widest} * pow(sin(radians({wide}) / 2.0D), 2.0D)"
    )
    safe = math.sin(max(radius_m - 1.0, 0.0) / (2.0 * EARTH_RADIUS_M)) ** 2
    # The same from below by the nearest edges and the narrowest parallel; a column that
    # reaches past the opposite meridian comes nearer again on its far side.
    narrowest = f"greatest(least(cos(radians({south})), cos(radians({north}))), 0.0D)"
    low = f"greatest({south} - {lat}, {lat} - {north}, 0.0D)"
    far_side = f"360.0D - greatest(abs({west} - {lon}), abs({east} - {lon}))"
    near = f"greatest(least(greatest({west} - {lon}, {lon} - {east}), {far_side}), 0.0D)"
    least_chord = (
        f"pow(sin(radians({low}) / 2.0D), 2.0D)"
        f" + cos(radians({lat})) * {narrowest} * pow(sin(radians({near}) / 2.0D), 2.0D)"
    )
    return (
        centers.where(f"{lon} IS NOT NULL AND {lat} IS NOT NULL")
        .withColumn("_half", F.expr(half_width))
        .withColumn("_row", F.expr(f"explode({rows})"))
        .withColumn("_columns", F.expr(grid.columns_in("_row")))
        .withColumn("_column", F.expr(f"explode(sequence({first}, least({last}, {first} + _columns - 1)))"))
        .where(f"{least_chord} <= {math.sin(reach / 2.0) ** 2!r}D")
        .withColumns({"_inside": F.expr(f"{chord} < {safe!r}D"), "_cell": F.expr(grid.key("_row", "_columns", "_column"))})
        .drop("_half", "_row", "_columns", "_column")
    )


def radius_join(
    points: DataFrame,
    centers: DataFrame,
    radius_m: float = RADIUS_M,
    point_xy: tuple[str, str] = ("lon", "lat"),
    center_xy: tuple[str, str] = ("center_lon", "center_lat"),
    cells_per_radius: int = 4,
    crowded_rows: int | None = None,
    work: Work | None = None,
) -> DataFrame:
    """Every (point, center) pair closer than ``radius_m`` whole metres (strict).

    Column names of the two sides must differ. Small cells keep the candidate
    area close to the circle even when points and centers crowd one spot. With
    ``crowded_rows`` the points of cells are counted first; those of a cell with more points are
    dealt into parts of about so many, and each part meets the centers of the cell, equal ones once.
    """
    shared = set(points.columns) & set(centers.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    grid = CellGrid(radius_m / cells_per_radius)
    cells = covering_cells(centers, grid, radius_m, *center_xy)
    placed = grid.place(points, *point_xy)
    # About (2k+2)^2 cells per center, and not three times as many even at a pole.
    copies = 3 * (2 * cells_per_radius + 2) ** 2
    close = haversine_m(*point_xy, *center_xy) < F.lit(radius_m)

    # Catalyst does not see how many cells a center has, and would broadcast them; what a few files
    # of points hold is spread over all tasks, as the pairs are many times the points.
    small = estimated_bytes(points) >= WIDE_BYTES and fits_broadcast(centers, copies)

    def meet(rows: DataFrame, of_centers: DataFrame, on: list[str]) -> DataFrame:
        pairs = rows.join(F.broadcast(of_centers) if small else of_centers.hint("merge"), on)
        return pairs.where(F.col("_inside") | close).drop(*on, "_inside")

    if crowded_rows is None:
        return meet(placed, cells, ["_cell"])
    full = grid.place(points.select(*point_xy), *point_xy).groupBy("_cell").agg(F.count("*").alias("_n"))
    parts = F.ceil(F.col("_n") / crowded_rows).cast("int").alias("_parts")
    full = staged(full.where(F.col("_n") > crowded_rows).select("_cell", parts), "crowded", work)
    part = F.pmod(F.xxhash64(*[sortable(points, c) for c in points.columns]), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = lookup_join(placed, full, "_cell", "left").withColumn("_part", part).drop("_parts")
    touching = lookup_join(cells, full, "_cell").distinct()
    copied = touching.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    copied = copied.unionByName(lookup_join(cells, full, "_cell", "left_anti").withColumn("_part", F.lit(0)))
    return meet(dealt, copied, ["_cell", "_part"])


# Points of fewer bytes are in too few files for a task each.
WIDE_BYTES = 1 << 30

# Columns of a location that one or more centers share.
SITE = ["center_lon", "center_lat"]


def sites_of(centers: DataFrame) -> DataFrame:
    """Distinct locations of centers with ``lon`` and ``lat``."""
    return centers.select(F.col("lon").alias(SITE[0]), F.col("lat").alias(SITE[1])).distinct()


def site_summary(
    points: DataFrame,
    sites: DataFrame,
    aggregates: list[Column],
    by: list[str] | None = None,
    radius_m: float = RADIUS_M,
) -> DataFrame:
    """Aggregate the points around each location, per ``by`` value. Any aggregate of Spark will
    do, at a row per pair; :func:`site_totals` makes sums and distinct counts without."""
    return radius_join(points, sites, radius_m).groupBy(*SITE, *(by or [])).agg(*aggregates)


# Width of a tile in radii: a point goes to about four of them. A bucket of a tile is one group of rows,
# there are BUCKETS of them and one more for so many bytes of points, up to MOST_BUCKETS.
TILE = 2
BUCKETS, BUCKET_BYTES, MOST_BUCKETS = 64, 4_000_000, 512


def by_tiles(points: DataFrame, sites: DataFrame, by: list[str], spread: list[str], make, fields: list[T.StructField], radius_m: float) -> DataFrame:
    """The points near the locations of each tile through a function of :mod:`airway.operators.tiles`
    (``make(schema)``); gives ``SITE, by, fields``.

    ``sites`` are distinct. Points are dealt into buckets by the columns ``spread``; if these are
    not ``by``, a location may have a row from each bucket. The rows of one bucket of a
    tile are one group: points are sent once per tile, locations once per bucket."""
    schema = T.StructType([*[T.StructField(c, T.DoubleType()) for c in SITE], *[points.schema[c] for c in by], *fields])
    grid, size = CellGrid(TILE * radius_m), estimated_bytes(points)
    buckets = BUCKETS if size >= 1 << 60 else min(MOST_BUCKETS, BUCKETS + size // BUCKET_BYTES)
    on_earth = "abs(lon) <= 3600.0D AND abs(lat) <= 3600.0D"
    dealt = points.where(on_earth).withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int"))
    dealt = covering_cells(dealt, grid, radius_m, "lon", "lat").drop("_inside")
    filed = grid.place(sites.select(*SITE), *SITE).withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    key = ["_cell", "_bucket"]
    return dealt.groupBy(*key).cogroup(filed.groupBy(*key)).applyInArrow(make(to_arrow_schema(schema)), schema)


def site_totals(
    points: DataFrame,
    sites: DataFrame,
    sums: dict[str, Column],
    by: list[str],
    radius_m: float = RADIUS_M,
    cells_per_radius: int = 8,
    distinct: tuple[str, list[str]] | None = None,
) -> DataFrame:
    """Sums over the points around each location, per ``by`` values: ``sums`` names them
    and gives what each point adds. The result equals :func:`site_summary` with these sums and,
    with ``distinct`` (a name and columns), a count of distinct values without nulls.

    Made tile by tile (:func:`by_tiles`), so points and results are shuffled, and pairs are not.
    Sums that are neither whole numbers nor doubles take a row per pair, in cells of
    ``cells_per_radius``.
    """
    of_sums = points.select(*[F.sum(x).alias(name) for name, x in sums.items()]).schema if sums else T.StructType([])
    if any(f.dataType not in (T.LongType(), T.DoubleType()) for f in of_sums):
        added = [F.sum(x).alias(name) for name, x in sums.items()]
        added += [F.count_distinct(*distinct[1]).alias(distinct[0])] if distinct else []
        pairs = radius_join(points, sites, radius_m, cells_per_radius=cells_per_radius)
        return pairs.groupBy(*SITE, *by).agg(*added)
    name, of = distinct or (None, [])
    # Numbered, as a sum may be named like a column it is made of.
    values = {f"_sum{i}": x.cast(f.dataType) for i, (x, f) in enumerate(zip(sums.values(), of_sums, strict=True))}
    shown = points.select("lon", "lat", *dict.fromkeys([*by, *of]), *[x.alias(n) for n, x in values.items()])
    fields = [*of_sums, *([T.StructField(name, T.LongType())] if name else [])]
    spread = by or of or shown.columns

    def make(schema):
        return tiles.totals(by, list(values), of, radius_m, schema)

    found = by_tiles(shown, sites, by, spread, make, fields, radius_m)
    return found if by else found.groupBy(*SITE).agg(*[F.sum(f.name).alias(f.name) for f in fields])


def radius_summary(
    points: DataFrame,
    centers: DataFrame,
    keys: list[str],
    aggregates: list[Column] | dict[str, Column],
    by: list[str] | None = None,
    radius_m: float = RADIUS_M,
    distinct: tuple[str, list[str]] | None = None,
) -> DataFrame:
    """Aggregate the points around each center.

    ``centers`` has ``lon``, ``lat`` and the unique ``keys``. Centers at one
    spot share their work. ``aggregates`` are columns of any kind, at a row per pair of point
    and location, or, by name, what each point adds to a sum; these and ``distinct`` are made
    as by :func:`site_totals`.
    """
    sites = sites_of(centers)
    if isinstance(aggregates, dict):
        found = site_totals(points, sites, aggregates, by or [], radius_m, distinct=distinct)
    else:
        found = site_summary(points, sites, aggregates, by, radius_m)
    return spread_to_centers(found, centers, keys)


def spread_to_centers(per_site: DataFrame, centers: DataFrame, keys: list[str], keep_site: bool = False) -> DataFrame:
    """Give each center the rows of its location; ``keep_site`` keeps the location.

    The rows may be shuffled by location. Pairs are many more than locations: spread the
    locations before the pairs are made."""
    labels = centers.select(*keys, F.col("lon").alias(SITE[0]), F.col("lat").alias(SITE[1]))
    kept = [c for c in per_site.columns if keep_site or c not in SITE]
    return lookup_join(per_site, labels, SITE).select(*keys, *kept)


# Cells along the longer side of a rectangle, at most.
SPLIT = 4
# Rectangle columns.
RECT = ("bottom_left_lon", "bottom_left_lat", "top_right_lon", "top_right_lat")


def _scale(extent: Column, base: float) -> Column:
    """Smallest n >= 0 with ``extent <= base * 2**n``."""
    return F.greatest(F.ceil(F.log2(extent / F.lit(base))), F.lit(0)).cast("int")


def rect_join(
    points: DataFrame,
    rects: DataFrame,
    point_xy: tuple[str, str] = ("lon", "lat"),
    base_degrees: float = 0.001,
) -> DataFrame:
    """Every (point, rectangle) pair with ``bl < p <= tr`` on both axes.

    A rectangle is filed under cells of its size: its longer side is more than half of and at
    most SPLIT cells, so it takes at most SPLIT + 1 on either axis. Points of cells between its
    edges need no test. Cells are squares of one of a few sizes, each twice the last; a point
    looks up one cell per size in use.
    """
    west, south, east, north = (F.col(c) for c in RECT)
    proper = rects.where((east > west) & (north > south)).withColumns(
        {"_s": _scale(F.greatest(east - west, north - south), base_degrees)}
    )

    def cell(value: Column, scale: Column) -> Column:
        return F.floor(value / (F.lit(base_degrees / SPLIT) * F.pow(F.lit(2.0), scale)))

    s = F.col("_s")
    filed = proper.withColumn("_x", F.explode(F.sequence(cell(west, s), cell(east, s)))).withColumn(
        "_y", F.explode(F.sequence(cell(south, s), cell(north, s)))
    )
    x, y = F.col("_x"), F.col("_y")
    between = (x > cell(west, s)) & (x < cell(east, s)) & (y > cell(south, s)) & (y < cell(north, s))
    filed = filed.withColumn("_inside", between)
    # The sizes in use: a few small integers, read as one scalar.
    sizes = proper.agg(F.collect_set("_s")).scalar()
    px, py = F.col(point_xy[0]), F.col(point_xy[1])
    looked_up = (
        points.where(~F.isnan(px) & ~F.isnan(py)).withColumn("_s", F.explode(sizes)).withColumns({"_x": cell(px, s), "_y": cell(py, s)})
    )
    small = estimated_bytes(points) >= WIDE_BYTES and fits_broadcast(rects, (SPLIT + 1) ** 2)
    pairs = looked_up.join(F.broadcast(filed) if small else filed.hint("merge"), ["_s", "_x", "_y"])
    inside = (px > west) & (py > south) & (px <= east) & (py <= north)
    return pairs.where(F.col("_inside") | inside).drop("_s", "_x", "_y", "_inside")


def idw(
    centers: DataFrame,
    samples: DataFrame,
    on: list[str],
    keys: list[str],
    value: str,
    default: float = 0.0,
) -> DataFrame:
    """Inverse-square-distance mean of ``samples`` at each center.

    Both sides have ``lon`` and ``lat`` and share the ``on`` columns (the hour).
    A sample less than a metre away has no weight; no usable sample gives
    ``default``. Samples at one spot are summed first. A null value still
    weighs in the denominator, as in ``sum(v * w) / sum(w)``.

    Centers often are a short list times many hours, made by a single task; they
    are spread by the grouping columns before the join, which saves the shuffle
    of the aggregation.
    """
    spots = samples.groupBy(*on, F.col("lon").alias("_lon"), F.col("lat").alias("_lat")).agg(
        F.sum(value).alias("_total"), F.count("*").alias("_n")
    )
    metres = haversine_m("_lon", "_lat", "lon", "lat").cast("double")
    weight = F.try_divide(F.lit(1.0), metres * metres)
    mean = F.try_divide(F.sum(F.col("_total") * F.col("_w")), F.sum(F.col("_n") * F.col("_w")))
    return (
        lookup_join(centers.repartition(*keys, *on), spots, on, "left", size_of=samples)
        .withColumn("_w", weight)
        .groupBy(*keys, *on)
        .agg(F.coalesce(mean.try_cast("decimal(8,2)").cast("double"), F.lit(default)).alias(value))
    )


def spot_weights(sites: DataFrame, spots: DataFrame, blocks: int = 16) -> DataFrame:
    """Inverse square of the distance of every location to every spot (``_lon, _lat``) not
    within a metre of it, as ``_w``. Spots are dealt into blocks, and each location goes to
    each block, so pairs are made by as many tasks."""
    block = F.pmod(F.xxhash64("_lon", "_lat"), F.lit(blocks)).cast("int")
    dealt = sites.select(*SITE, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    metres = haversine_m("_lon", "_lat", *SITE).cast("double")
    pairs = spots.withColumn("_block", block).join(dealt, "_block")
    return pairs.withColumn("_w", F.try_divide(F.lit(1.0), metres * metres)).where("_w IS NOT NULL").drop("_block")


def idw_over_time(
    sites: DataFrame,
    slots: Column,
    samples: DataFrame,
    time: str,
    value: str,
    default: float = 0.0,
    work: Work | None = None,
) -> DataFrame:
    """:func:`idw` of ``samples`` at each location and every time of ``slots`` (an array).

    Samples at one spot and time are summed first and staged. How much a spot weighs at a
    location does not depend on the time, so the weights are computed once for each pair of
    places and staged as well; the times are a join with them and a sum."""
    spots = samples.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).groupBy(
        time, F.col("lon").alias("_lon"), F.col("lat").alias("_lat")
    )
    spots = staged(spots.agg(F.sum(value).alias("_total"), F.count("*").alias("_n")), "spots", work)
    weights = staged(spot_weights(sites, spots.select("_lon", "_lat").distinct()), "weights", work)
    # Spots are few, so a join by them would be few tasks: one side is broadcast, weights if they fit.
    if fits_broadcast(weights):
        met = spots.repartition(time).join(F.broadcast(weights), ["_lon", "_lat"])
    else:
        met = lookup_join(weights.repartition(*SITE), spots, ["_lon", "_lat"])
    parts = met.select(*SITE, time, (F.col("_total") * F.col("_w")).alias("_up"), (F.col("_n") * F.col("_w")).alias("_down"))
    # Every location and time is there, weighed or not.
    nothing = F.lit(None).cast("double")
    every = sites.select(*SITE, F.explode(slots).alias(time), nothing.alias("_up"), nothing.alias("_down"))
    mean = F.try_divide(F.sum("_up"), F.sum("_down"))
    total = parts.unionByName(every).groupBy(*SITE, time)
    return total.agg(F.coalesce(mean.try_cast("decimal(8,2)").cast("double"), F.lit(default)).alias(value))
