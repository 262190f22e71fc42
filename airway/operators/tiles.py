"""Aggregates around locations, made tile by tile.

Every location lies in one tile. A point goes to each tile that its circle touches, so a
tile holds all points near its locations, and what is near a location is aggregated where
the tile is, without a row per pair: distances of a tile are one product of unit vectors.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from airway.functions.geo import EARTH_RADIUS_M

# Executors need not have this package: functions of this module travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs that are looked at in one go.
PAIRS = 2_000_000
# An edge is told from its neighbours by the exact distance where the product is this close, in metres.
DOUBT_M, DOUBT = 1e-3, 8e-15


def _vectors(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    x, y = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(y) * np.cos(x), np.cos(y) * np.sin(x), np.sin(y)], 1)


def whole_metres(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """As :func:`airway.functions.geo.haversine_m`."""
    deg = math.pi / 180.0
    chord = np.sin((lat1 - lat2) * deg / 2.0) ** 2
    chord = chord + np.cos(lat1 * deg) * np.cos(lat2 * deg) * np.sin((lon1 - lon2) * deg / 2.0) ** 2
    metres = 2.0 * np.arcsin(np.sqrt(np.minimum(chord, 1.0))) * float(EARTH_RADIUS_M)
    return np.floor(np.floor(metres * 10000.0 + 0.5) / 10000.0)


class Near:
    """Which locations of a tile are closer to points than ``radius_m`` whole metres."""

    def __init__(self, lon: np.ndarray, lat: np.ndarray, radius_m: float):
        self.lon, self.lat, self.radius_m = lon, lat, radius_m
        self.vectors = np.ascontiguousarray(_vectors(lon, lat).T)
        angle = min(math.ceil(radius_m) / EARTH_RADIUS_M, math.pi)
        self.edge, self.doubt = math.cos(angle), math.sin(angle) * DOUBT_M / EARTH_RADIUS_M + DOUBT

    def parts(self, lon: np.ndarray, lat: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """First point and the matrix (points, locations) of successive points."""
        step = max(1, PAIRS // len(self.lon))
        for start in range(0, len(lon), step):
            x, y = lon[start : start + step], lat[start : start + step]
            product = _vectors(x, y) @ self.vectors
            near = product > self.edge
            i, j = np.nonzero(np.abs(product - self.edge) <= self.doubt)
            if len(i):
                near[i, j] = whole_metres(x[i], y[i], self.lon[j], self.lat[j]) < self.radius_m
            yield start, near


def codes(table: pa.Table, names: list[str]) -> np.ndarray:
    """A number for each different value of the columns; null is a value."""
    found = np.zeros(table.num_rows, np.int64)
    for name in names:
        column = table.column(name).combine_chunks()
        if pa.types.is_floating(column.type):
            column = pc.if_else(pc.equal(column, 0.0), pa.scalar(0.0, column.type), column)
        encoded = pc.dictionary_encode(column, null_encoding="encode")
        encoded = encoded.combine_chunks() if isinstance(encoded, pa.ChunkedArray) else encoded
        place = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found = np.unique(found * (len(encoded.dictionary) + 1) + place, return_inverse=True)[1]
    return found


def _starts(*sorted_codes: np.ndarray) -> np.ndarray:
    change = np.ones(len(sorted_codes[0]), bool)
    change[1:] = np.any([c[1:] != c[:-1] for c in sorted_codes], axis=0)
    return np.flatnonzero(change)


def _numbers(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 for null) and which are not null."""
    column = table.column(name).combine_chunks()
    known = pc.is_valid(column).to_numpy(zero_copy_only=False)
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False), known


def _groups(code: np.ndarray) -> Iterator[slice]:
    """Rows of equal codes, which are sorted."""
    begins = [*_starts(code).tolist(), len(code)]
    return (slice(a, b) for a, b in zip(begins, begins[1:], strict=False) if b > a)


def _result(points: pa.Table, by: list[str], lon, lat, firsts: list[int], reached: list[np.ndarray], columns: list, schema: pa.Schema) -> pa.Table:
    """Rows of the locations ``reached`` by each group, whose first point tells the ``by`` values."""
    places = np.concatenate(reached) if reached else np.empty(0, np.int64)
    rows = np.repeat(np.array(firsts, np.int64), [len(r) for r in reached])
    made = [pa.array(lon[places]), pa.array(lat[places])]
    made += [points.column(name).combine_chunks().take(pa.array(rows)) for name in by]
    for found in columns:
        values, known = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.empty(0), np.empty(0, bool))
        made.append(pa.array(values, mask=~known))
    return pa.Table.from_arrays([x.cast(f.type) for x, f in zip(made, schema, strict=True)], schema=schema)


class _Distinct:
    """How many different vehicles are near each location; points come in the order of vehicles,
    and those below 0 do not count."""

    def __init__(self, n: int):
        self.count, self.last, self.reached = np.zeros(n, np.int64), None, None

    def add(self, vehicle: np.ndarray, near: np.ndarray) -> None:
        vehicle, near = vehicle[vehicle >= 0], near[vehicle >= 0]
        if not len(vehicle):
            return
        reached = np.logical_or.reduceat(near, _starts(vehicle), axis=0)
        if vehicle[0] == self.last:
            # Where it was before it has been counted.
            before, first = self.reached, reached[0] | self.reached
            self.count -= before
            reached[0] = first
        self.count += np.count_nonzero(reached, axis=0)
        self.last, self.reached = vehicle[-1], reached[-1]


def totals(by: list[str], sums: list[str], distinct: list[str] | None, radius_m: float, schema: pa.Schema) -> Callable:
    """Function of the points and locations of a tile to ``location, by, sums, distinct`` of what is near."""

    def work(points: pa.Table, sites: pa.Table) -> pa.Table:
        if not points.num_rows or not sites.num_rows:
            return schema.empty_table()
        at = [c.to_numpy() for c in sites.select(["center_lon", "center_lat"]).columns]
        near_sites, n = Near(*at, radius_m), sites.num_rows
        lon, lat = (points.column(c).to_numpy() for c in ("lon", "lat"))
        code, vehicle = codes(points, by), np.zeros(points.num_rows, np.int64)
        if distinct:
            vehicle = codes(points, distinct)
            for name in distinct:
                vehicle[pc.is_null(points.column(name)).to_numpy()] = -1
        order = np.lexsort((vehicle, code))
        code, vehicle, lon, lat = code[order], vehicle[order], lon[order], lat[order]
        numbers = [tuple(x[order] for x in _numbers(points, name)) for name in sums]
        firsts, reached, columns = [], [], [[] for _ in [*sums, *([1] if distinct else [])]]
        for rows in _groups(code):
            mine = [(v[rows], k[rows]) for v, k in numbers]
            # Whole numbers add exactly in doubles while all together stay below 2 ** 53.
            large = [i for i, (v, _) in enumerate(mine) if v.dtype.kind == "i" and np.abs(v.astype(np.float64)).sum() >= 2.0**53]
            if any(np.abs(mine[i][0].astype(np.float64)).sum() >= 2.0**63 for i in large):
                raise OverflowError("a sum may exceed 64 bits")
            odd = [(i, np.flatnonzero(~np.isfinite(v))) for i, (v, _) in enumerate(mine) if v.dtype.kind == "f"]
            every = np.ones(rows.stop - rows.start)
            matrix = [np.where(np.isfinite(v), v, 0) if v.dtype.kind == "f" else v for v, _ in mine]
            matrix = np.stack([*matrix, *[k for _, k in mine], every]).astype(np.float64)
            total, whole, seen = np.zeros((len(matrix), n)), {i: np.zeros(n, np.int64) for i in large}, _Distinct(n)
            for start, near in near_sites.parts(lon[rows], lat[rows]):
                stop = start + len(near)
                total += matrix[:, start:stop] @ near.astype(np.float64)
                for i, places in odd:
                    # What is not finite reaches no other location.
                    for place in places[(places >= start) & (places < stop)]:
                        total[i, near[place - start]] += mine[i][0][place]
                for i in large:
                    whole[i] += np.where(near, mine[i][0][start:stop, None], 0).sum(0)
                if distinct:
                    seen.add(vehicle[rows][start:stop], near)
            some = np.flatnonzero(total[-1])
            firsts.append(int(order[rows.start]))
            reached.append(some)
            for i, (values, _) in enumerate(mine):
                sum_of = whole[i] if i in whole else np.rint(total[i]).astype(np.int64) if values.dtype.kind == "i" else total[i]
                columns[i].append((sum_of[some], total[len(sums) + i, some] > 0))
            if distinct:
                columns[-1].append((seen.count[some], np.ones(len(some), bool)))
        return _result(points, by, *at, firsts, reached, columns, schema)

    return work


def sums_of_means(by: list[str], group: list[str], thing: list[str], value: str, radius_m: float, schema: pa.Schema) -> Callable:
    """Function of the points and locations of a tile to ``location, by, value``: a ``thing`` is
    near if any of its points is, the value is averaged over the things of each ``group``
    that are near, and the means are summed. The points of a thing have one value."""

    def work(points: pa.Table, sites: pa.Table) -> pa.Table:
        if not points.num_rows or not sites.num_rows:
            return schema.empty_table()
        at = [c.to_numpy() for c in sites.select(["center_lon", "center_lat"]).columns]
        code, groups, things = codes(points, by), codes(points, group), codes(points, [*group, *thing])
        order = np.lexsort((things, groups, code))
        code, groups, things = code[order], groups[order], things[order]
        lon, lat = (points.column(c).to_numpy()[order] for c in ("lon", "lat"))
        amount, known = (x[order] for x in _numbers(points, value))
        # Locations in blocks, so that things times locations stay few.
        most = max(rows.stop - rows.start for rows in _groups(code))
        block = max(1, PAIRS // most)
        firsts, reached, column = [], [], []
        for left in range(0, sites.num_rows, block):
            near_sites = Near(at[0][left : left + block], at[1][left : left + block], radius_m)
            for rows in _groups(code):
                near = np.concatenate([part for _, part in near_sites.parts(lon[rows], lat[rows])])
                begins = _starts(things[rows])
                near = np.logical_or.reduceat(near, begins, axis=0)
                counts = near & known[rows][begins][:, None]
                kinds = _starts(groups[rows][begins])
                n = np.add.reduceat(counts.astype(np.int64), kinds, axis=0)
                total = np.add.reduceat(np.where(counts, amount[rows][begins][:, None], 0.0), kinds, axis=0)
                means = np.where(n > 0, total / np.maximum(n, 1), 0.0).sum(0)
                some = np.flatnonzero(near.any(0))
                firsts.append(int(order[rows.start]))
                reached.append(some + left)
                column.append((means[some], n.any(0)[some]))
        return _result(points, by, *at, firsts, reached, [column], schema)

    return work
