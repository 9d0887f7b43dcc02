"""Grid cells, boxes and raster pixels.

Positions meet through square tiles whose sides double from level to level, so
the index of a tile is that of its parent shifted by one bit. Tiles of cells form
a pyramid in which far and near places are searched alike; boxes are covered by
a bounded number of tiles, large ones by large tiles, and sums in them meet only
the pixels of the strips that their edges run through. Joins carry no hints and no
fixed salts: Spark broadcasts what it measures as small and splits skewed
partitions of sorted joins, and crowded tiles of places are parted by their count.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ridgeline.functions import midpoint_lat, midpoint_lon, squared_distance, tile
from ridgeline.session import cut_lineage

# Fixed order of the eight cells around a cell, as (dy, dx).
NEIGHBOURS = [(-1, 0), (-1, -1), (0, -1), (1, -1), (1, 0), (1, 1), (0, 1), (-1, 1)]

#: Bits between two levels of the pyramid: a tile has 64 children.
_FANOUT = 3
#: Places of a tile that are searched together; a tile with more is parted.
_CROWD = 4096
#: Pixels and edges of a strip that meet in one task.
_CROWD_PIXELS, _CROWD_EDGES = 1 << 18, 1 << 17


def _finite(c: str) -> Column:
    return F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c)


def _bounds(rows: DataFrame, *keys: str) -> DataFrame:
    """Tight bounds of the positions of each group."""
    return rows.groupBy(*keys).agg(
        F.min("lat").alias("lat_lo"), F.max("lat").alias("lat_hi"), F.min("lon").alias("lon_lo"), F.max("lon").alias("lon_hi")
    )


def _wider(tiles: DataFrame, bits: int) -> DataFrame:
    """The tiles some levels up, with the bounds of what is in them."""
    up = tiles.withColumns({"_ty": F.shiftright("_ty", bits), "_tx": F.shiftright("_tx", bits)})
    return up.groupBy("_ty", "_tx").agg(
        F.min("lat_lo").alias("lat_lo"), F.max("lat_hi").alias("lat_hi"), F.min("lon_lo").alias("lon_lo"), F.max("lon_hi").alias("lon_hi")
    )


def _apart(axis: str) -> tuple[Column, Column]:
    """Least and greatest distance along an axis between a group of places and a tile of cells."""
    lo, hi, own_lo, own_hi = (F.col(c) for c in (f"{axis}_lo", f"{axis}_hi", f"own_{axis}_lo", f"own_{axis}_hi"))
    return F.greatest(lo - own_hi, own_lo - hi, F.lit(0.0)), F.greatest(hi - own_lo, own_hi - lo)


def nearest_cell(points: DataFrame, cells: DataFrame, side: float) -> DataFrame:
    """Cell with the smallest planar distance, the first index on a tie.

    ``side`` is the width of the finest tiles in degrees, best near the grid
    spacing; it does not change the answer. Occupied tiles of cells form a
    pyramid with the tight bounds of their cells. Places go down it by groups of
    one tile: at each level a tile stays if its least distance to the group is
    not above the smallest greatest distance of any tile, which holds a cell that
    near for certain. Only cells of the tiles that are left are compared. Equal
    coordinates are searched once. The number of jobs is fixed: tiles are
    written, their extent is read, and the search is one query.

    Points without finite coordinates have null cells; cells without finite
    coordinates are never found.
    """
    grid = cells.filter(_finite("lat") & _finite("lon")).groupBy("lat", "lon").agg(F.min(F.struct("iy", "ix")).alias("_c"))
    grid = grid.withColumns({"_ty": tile(F.col("lat"), side), "_tx": tile(F.col("lon"), side)})
    base = cut_lineage(_bounds(grid, "_ty", "_tx"), "cell_tiles")
    south, north, west, east = base.agg(F.min("_ty"), F.max("_ty"), F.min("_tx"), F.max("_tx")).first()
    if south is None:
        raise ValueError("the grid has no cells with coordinates")
    levels = 0
    while max((north >> levels) - (south >> levels), (east >> levels) - (west >> levels)) > 1:
        levels += _FANOUT

    own = ["_py", "_px", "_part"]
    places = points.filter(_finite("lat") & _finite("lon")).select("lat", "lon").distinct()
    places = places.withColumns({"_py": tile(F.col("lat"), side), "_px": tile(F.col("lon"), side)})
    crowds = places.groupBy("_py", "_px").agg(F.ceil(F.count("*") / _CROWD).alias("_parts")).filter("_parts > 1")
    places = places.join(crowds, ["_py", "_px"], "left").withColumn("_part", F.pmod(F.xxhash64("lat", "lon"), F.coalesce("_parts", F.lit(1).cast("bigint"))))
    groups = _bounds(places, *own).withColumnsRenamed({c: f"own_{c}" for c in ("lat_lo", "lat_hi", "lon_lo", "lon_hi")})

    # At most four tiles at the top; each level below asks the children of the tiles that are left.
    top = [F.struct(F.lit(y).cast("bigint").alias("_uy"), F.lit(x).cast("bigint").alias("_ux"))
           for y in range(south >> levels, (north >> levels) + 1) for x in range(west >> levels, (east >> levels) + 1)]
    left = groups.select("*", F.inline(F.array(*top)))
    for bits in range(levels, -1, -_FANOUT):
        above = 0 if bits == levels else _FANOUT
        tiles = (_wider(base, bits) if bits else base).withColumns({"_uy": F.shiftright("_ty", above), "_ux": F.shiftright("_tx", above)})
        (near_y, far_y), (near_x, far_x) = _apart("lat"), _apart("lon")
        asked = left.join(tiles, ["_uy", "_ux"]).withColumns({"_near": near_y * near_y + near_x * near_x, "_far": far_y * far_y + far_x * far_x})
        sure = F.min("_far").over(Window.partitionBy(*own))
        asked = asked.withColumn("_sure", sure).filter("_near <= _sure")
        left = asked.select(*groups.columns, F.col("_ty").alias("_uy"), F.col("_tx").alias("_ux"))
    candidates = left.select(*own, F.col("_uy").alias("_ty"), F.col("_ux").alias("_tx")).join(
        grid.select("_ty", "_tx", F.col("lat").alias("cell_lat"), F.col("lon").alias("cell_lon"), "_c.iy", "_c.ix"), ["_ty", "_tx"]
    )
    gap = squared_distance(F.col("lat"), F.col("lon"), F.col("cell_lat"), F.col("cell_lon"))
    best = F.min(F.struct(gap.alias("d2"), "iy", "ix", "cell_lat", "cell_lon"))
    found = places.join(candidates, own).groupBy("lat", "lon").agg(best.alias("near")).select("lat", "lon", "near.*")
    return points.join(found, ["lat", "lon"], "left").withColumn("distance", F.sqrt("d2")).drop("d2")


def pick_cells(values: DataFrame, points_with_cell: DataFrame) -> DataFrame:
    """Grid values at the nearest cell of each point."""
    where = points_with_cell.select("id", "iy", "ix")
    return values.join(where, ["iy", "ix"])


def neighbour_midpoints(points_with_cell: DataFrame, cells: DataFrame) -> DataFrame:
    """Points half way to the cells around the nearest cell, one row each.

    A cell on the rim of the grid has fewer neighbours.
    """
    offsets = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(dy).alias("dy"), F.lit(dx).alias("dx"))
        for i, (dy, dx) in enumerate(NEIGHBOURS)
    ])
    wanted = points_with_cell.select("id", "lat", "lon", "iy", "ix", F.inline(offsets)).select(
        "id", "lat", "lon", "ord",
        (F.col("iy") + F.col("dy")).alias("index_y"), (F.col("ix") + F.col("dx")).alias("index_x"),
    )
    grid = cells.select(
        F.col("iy").alias("index_y"), F.col("ix").alias("index_x"),
        F.col("lat").alias("_lat"), F.col("lon").alias("_lon"),
    )
    ends = [F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")]
    return wanted.join(grid, ["index_y", "index_x"]).select(
        "id", "ord", "index_y", "index_x",
        midpoint_lat(*ends).alias("lat"), midpoint_lon(*ends).alias("lon"),
    )


def box_rings(midpoints: DataFrame) -> DataFrame:
    """The same points as one ring per point, in the fixed order of eight."""
    ring = F.array_sort(F.collect_list(F.struct("ord", "lon", "lat")))
    return midpoints.groupBy("id").agg(F.transform(ring, lambda p: F.struct(p.lon, p.lat)).alias("ring"))


def boxes(midpoints: DataFrame) -> DataFrame:
    """Smallest box around the midpoints of a point."""
    return midpoints.groupBy("id").agg(
        F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
        F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
    )


#: Tiles along a box: for listing its pixels, and for sums, where only the outermost are looked into.
_ALONG, _RIM = 16, 1024
#: Tile indices beyond this all count as the outermost tile.
_EDGE = 1 << 40


def _index(c: Column, side: float) -> Column:
    return F.least(F.greatest(tile(F.least(F.greatest(c, F.lit(-_EDGE * float(side))), F.lit(_EDGE * float(side))), side), F.lit(-_EDGE)), F.lit(_EDGE))


def _spans(box_table: DataFrame, side: float, most: int) -> DataFrame:
    """Boxes with the level at which they are ``most`` tiles wide, about, and their tile range there."""
    corners = ["min_lat", "max_lat", "min_lon", "max_lon"]
    rows = box_table
    for c in corners:
        rows = rows.filter(F.col(c).isNotNull() & ~F.isnan(c))
    rows = rows.filter("min_lat <= max_lat and min_lon <= max_lon").withColumns({f"_{c}": _index(F.col(c), side) for c in corners})
    widest = F.greatest(F.col("_max_lat") - F.col("_min_lat"), F.col("_max_lon") - F.col("_min_lon")) + 1
    # Whole bits of the quotient: exact, and no less than needed.
    rows = rows.withColumn("level", F.when(widest <= most, 0).otherwise(F.length(F.bin(F.floor((widest - 1) / most)))).cast("int"))
    ends = {"y0": "_min_lat", "y1": "_max_lat", "x0": "_min_lon", "x1": "_max_lon"}
    return rows.withColumns({k: F.expr(f"shiftright({c}, level)") for k, c in ends.items()}).drop(*[f"_{c}" for c in corners])


def _levels(cover: DataFrame) -> list[int]:
    """The levels that occur, at most some dozens."""
    return sorted(r["level"] for r in cover.select("level").distinct().collect())


def _at_levels(rows: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Rows with base tiles (_ty, _tx) once for each level, with the tiles there."""
    if list(levels) == [0]:
        return rows.withColumn("level", F.lit(0))
    rows = rows.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels])))
    return rows.withColumns({"_ty": F.expr("shiftright(_ty, level)"), "_tx": F.expr("shiftright(_tx, level)")})


def _placed(pixels: DataFrame, side: float) -> DataFrame:
    known = pixels.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    return known.withColumns({"_ty": _index(F.col("y"), side), "_tx": _index(F.col("x"), side)})


def _inside() -> Column:
    return F.col("y").between(F.col("min_lat"), F.col("max_lat")) & F.col("x").between(F.col("min_lon"), F.col("max_lon"))


def pixels_in_boxes(box_table: DataFrame, pixels: DataFrame, side: float) -> DataFrame:
    """Pixels inside a box, rim included, one row for each pair.

    ``side`` is the width of the finest tiles. A box is covered by at most 17 x
    17 tiles of a level that suits its size, so one huge box adds no more rows
    than a small one. Pixels carry a tile for each level that occurs.
    """
    wide = F.explode(F.sequence("y0", "y1"))
    cover = _spans(box_table, side, _ALONG).withColumn("_ty", wide).withColumn("_tx", F.explode(F.sequence("x0", "x1"))).drop("y0", "y1", "x0", "x1")
    # Written first: the planner does not see that rows were repeated.
    cover = cut_lineage(cover, "cover")
    hit = _at_levels(_placed(pixels, side), _levels(cover)).join(cover, ["level", "_ty", "_tx"])
    return hit.filter(_inside()).drop("level", "_ty", "_tx")


def _rim(spans: DataFrame) -> DataFrame:
    """Tiles that the edge of a box runs through, at the level of the box."""
    rows = spans.withColumn("_ty", F.explode(F.sequence("y0", "y1")))
    across = F.when((F.col("_ty") == F.col("y0")) | (F.col("_ty") == F.col("y1")), F.sequence("x0", "x1")).otherwise(F.array_distinct(F.array("x0", "x1")))
    return rows.withColumn("_tx", F.explode(across)).drop("y0", "y1", "x0", "x1")


def _whole(spans: DataFrame) -> DataFrame:
    """Tiles inside the rim as a quadtree has them: the largest that fit, (id, level, _ty, _tx).

    At each level up, the tiles that lie inside form a rectangle; those whose
    parents do not lie inside are one row or column of it along each edge.
    """
    inner = spans.select("id", F.col("level").alias("_k"), *[(F.col(c) + d).alias(c) for c, d in (("y0", 1), ("y1", -1), ("x0", 1), ("x1", -1))]).filter("y0 <= y1 and x0 <= x1")
    steps = F.length(F.bin(F.least(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")) + 1))
    rows = inner.withColumn("_j", F.explode(F.sequence(F.lit(0), steps)))
    for lo, hi in (("y0", "y1"), ("x0", "x1")):
        for name, j in (("", "_j"), ("up_", "_j + 1")):
            rows = rows.withColumns({
                f"{name}{lo}_": F.expr(f"-shiftright(-{lo}, cast({j} as int))"),
                f"{name}{hi}_": F.expr(f"shiftright({hi} + 1, cast({j} as int)) - 1"),
            })
    rows = rows.filter("y0_ <= y1_ and x0_ <= x1_")
    parents = F.expr("up_y0_ <= up_y1_ and up_x0_ <= up_x1_")
    rows = rows.withColumn("_parents", parents).withColumn("_ty", F.explode(F.sequence("y0_", "y1_")))
    covered = F.col("_parents") & F.col("_ty").between(F.col("up_y0_") * 2, F.col("up_y1_") * 2 + 1)
    ends = F.expr("concat(if(x0_ < up_x0_ * 2, array(x0_), array()), if(x1_ > up_x1_ * 2 + 1, array(x1_), array()))")
    rows = rows.withColumn("_tx", F.explode(F.when(covered, ends).otherwise(F.sequence("x0_", "x1_"))))
    return rows.select("id", (F.col("_k") + F.col("_j")).cast("int").alias("level"), "_ty", "_tx")


def _aligned(rows: DataFrame, lo: str, hi: str, level: str, place: str) -> DataFrame:
    """One row for each of the largest aligned runs of tiles that make up ``lo`` to ``hi``: two a level at most.

    A run of level j is 2 ** j tiles long and begins at a multiple of that; ``place`` is its index there.
    """
    rows = rows.filter(f"{lo} <= {hi}").withColumn(level, F.explode(F.sequence(F.lit(0), F.length(F.bin(F.col(hi) - F.col(lo) + 1)))))
    ends = {}
    for name, j in (("", level), ("_up", f"{level} + 1")):
        ends[f"_lo{name}"] = F.expr(f"-shiftright(-{lo}, cast({j} as int))")
        ends[f"_hi{name}"] = F.expr(f"shiftright({hi} + 1, cast({j} as int)) - 1")
    rows = rows.withColumns(ends).filter("_lo <= _hi")
    # Where the level above has runs too, those that they do not cover are the first and the last.
    rest = F.expr("concat(if(_lo < _lo_up * 2, array(_lo), array()), if(_hi > _hi_up * 2 + 1, array(_hi), array()))")
    return rows.withColumn(place, F.explode(F.when(F.expr("_lo_up <= _hi_up"), rest).otherwise(F.sequence("_lo", "_hi")))).drop(*ends)


def _inner(spans: DataFrame) -> DataFrame:
    """The tiles inside the rim as oblongs, (id, _ly, _lx, _ty, _tx): the runs of rows by the runs of columns."""
    inner = spans.select("id", F.col("level").alias("_k"), *[(F.col(c) + d).alias(c) for c, d in (("y0", 1), ("y1", -1), ("x0", 1), ("x1", -1))])
    rows = _aligned(_aligned(inner.filter("x0 <= x1"), "y0", "y1", "_ly", "_ty"), "x0", "x1", "_lx", "_tx")
    return rows.select("id", (F.col("_ly") + F.col("_k")).alias("_ly"), (F.col("_lx") + F.col("_k")).alias("_lx"), "_ty", "_tx")


def _oblongs(tiles: DataFrame, wanted: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Sums of tiles at the pairs of levels that occur, at most some hundreds; rows first, then columns."""
    pairs = wanted.select("_ly", "_lx").distinct().collect()
    for level, place in (("_ly", "_ty"), ("_lx", "_tx")):
        tiles = tiles.withColumn(level, F.explode(F.array(*[F.lit(k) for k in sorted({r[level] for r in pairs}) or [0]])))
        tiles = tiles.withColumn(place, F.expr(f"shiftright({place}, {level})"))
        keys = [*by, "_ly", "_ty", "_tx"] + ["_lx"] * (level == "_lx")
        tiles = tiles.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return tiles


_STRIP = ["level", "_axis", "_strip"]


def _strips(pixels: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Pixels in the column (axis 0) and the row (axis 1) of their tile: by ``_pos`` along it, with ``_val`` across."""
    tile_x = F.col("_tx").cast("double")
    both = F.array(
        F.struct(F.lit(0).alias("_axis"), F.col("_tx").alias("_strip"), F.col("y").alias("_pos"), F.col("x").alias("_val")),
        F.struct(F.lit(1).alias("_axis"), F.col("_ty").alias("_strip"), tile_x.alias("_pos"), F.col("y").alias("_val")),
    )
    return _at_levels(pixels, levels).select("*", F.inline(both)).drop("x", "y", "_ty", "_tx")


def _edges(spans: DataFrame) -> DataFrame:
    """What a box takes of the strips its edges run through, at most four rows.

    Columns are taken from the lower to the upper edge, rows between the two columns, so no pixel counts twice.
    """
    inf, c = F.lit(float("inf")), F.col

    def ask(axis: int, strip: str, along: tuple[Column, Column], across: tuple[Column, Column]) -> Column:
        names = ("_from", "_to", "_least", "_most")
        return F.struct(F.lit(axis).alias("_axis"), c(strip).alias("_strip"), *[v.cast("double").alias(k) for k, v in zip(names, (*along, *across))])

    def pair(axis: int, lo: str, hi: str, along: tuple[Column, Column], least: str, most: str) -> Column:
        one = F.array(ask(axis, lo, along, (c(least), c(most))))
        two = F.array(ask(axis, lo, along, (c(least), inf)), ask(axis, hi, along, (-inf, c(most))))
        return F.when(c(lo) == c(hi), one).otherwise(two)

    columns = pair(0, "x0", "x1", (c("min_lat"), c("max_lat")), "min_lon", "max_lon")
    rows = pair(1, "y0", "y1", (c("x0") + 1, c("x1") - 1), "min_lat", "max_lat")
    return spans.select("id", "level", F.inline(F.when(c("x1") - c("x0") > 1, F.concat(columns, rows)).otherwise(columns)))


def _at_least(key: np.ndarray, total: np.ndarray, n: np.ndarray, first: np.ndarray, last: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over places ``first`` to ``last`` (left out) of what has a key of ``least`` or more, for many queries.

    Places are cut into blocks that double in length, each in order of its keys with sums from its end; a query
    takes two blocks of a length at most. Sums are only ever added, so a pixel touches no query that lacks it.
    """
    size = 1 << max(0, len(key) - 1).bit_length()
    ranks = np.sort(key)
    rank = np.full((size, 1), len(key))
    rank[: len(key), 0] = np.searchsorted(ranks, key)
    low = np.searchsorted(ranks, least)
    sums = [np.zeros((size, 1), t.dtype) for t in (total, n)]
    for s, t in zip(sums, (total, n)):
        s[: len(key), 0] = t
    out = [np.zeros(len(first), s.dtype) for s in sums]
    l, r = first.copy(), last.copy()
    while (l < r).any():
        left, right = (l < r) & (l % 2 == 1), (l < r) & (r % 2 == 1)
        order = rank.argsort(axis=1, kind="stable")
        rank, sums = np.take_along_axis(rank, order, 1), [np.take_along_axis(s, order, 1) for s in sums]
        flat = (rank + np.arange(len(rank))[:, None] * (size + 1)).ravel()
        tails = [np.pad(s[:, ::-1].cumsum(axis=1)[:, ::-1], ((0, 0), (0, 1))).ravel() for s in sums]
        for which, block in ((left, l), (right, r - 1)):
            k = block[which]
            at = np.searchsorted(flat, k * (size + 1) + low[which]) + k
            for o, t in zip(out, tails):
                o[which] += t[at]
        l, r = (l + left) >> 1, (r - right) >> 1
        if len(rank) > 1:
            rank, sums = rank.reshape(len(rank) // 2, -1), [s.reshape(len(s) // 2, -1) for s in sums]
    return out[0], out[1]


def _strip_sums(pos: np.ndarray, val: np.ndarray, total: np.ndarray, n: np.ndarray, asked: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the pixels of a strip for queries (from, to, least, most)."""
    start, end, least, most = asked
    order = pos.argsort(kind="stable")
    pos, val, total, n = pos[order], val[order], total[order], n[order]
    first, last = np.searchsorted(pos, start, "left"), np.searchsorted(pos, end, "right")
    out = np.zeros(len(start)), np.zeros(len(start), np.int64)
    some, above, below = first < last, np.isposinf(most), np.isneginf(least)
    for ask, key, bound in ((some & above, val, least), (some & below & ~above, -val, -most)):
        if ask.any():
            for o, found in zip(out, _at_least(key, total, n, first[ask], last[ask], bound[ask])):
                o[ask] = found
    for i in np.flatnonzero(some & ~above & ~below):  # a box inside one strip
        cut = slice(first[i], last[i])
        hit = (val[cut] >= least[i]) & (val[cut] <= most[i])
        out[0][i], out[1][i] = total[cut][hit].sum(), n[cut][hit].sum()
    return out


def _edge_sums(pixels: DataFrame, spans: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Sums of the pixels in the outermost tiles of each box: strips of pixels meet the edges in them.

    Strips with many pixels or edges are parted by their counts, so no task holds more than ``_CROWD_PIXELS`` and ``_CROWD_EDGES``.
    """
    strips, edges = _strips(pixels, _levels(spans) or [0]), _edges(spans)
    counts = strips.groupBy(*_STRIP).agg(F.ceil(F.count("*") / _CROWD_PIXELS).alias("_p")).join(
        edges.groupBy(*_STRIP).agg(F.ceil(F.count("*") / _CROWD_EDGES).alias("_e")), _STRIP
    )
    counts = cut_lineage(counts, "strips")
    dealt = []
    for rows, own, other in ((strips, "_p", "_e"), (edges, "_e", "_p")):
        place = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in _STRIP]), F.col(own))
        repeated = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))
        dealt.append(rows.join(counts, _STRIP).withColumns({f"{own}_part": place, f"{other}_part": repeated}).drop("_p", "_e"))
    keys = [*_STRIP, "_p_part", "_e_part"]
    fields = [spans.schema["id"], *[pixels.schema[c] for c in by]]
    schema = StructType([*[StructField(f.name, f.dataType) for f in fields], StructField("total", DoubleType()), StructField("n", LongType())])

    empty = pa.table({f.name: pa.array([], to_arrow_type(f.dataType)) for f in schema.fields})

    def met(held: pa.Table, asked: pa.Table) -> pa.Table:
        group = held.select(list(by)).to_pandas().groupby(list(by), dropna=False).ngroup().to_numpy() if by else np.zeros(len(held), np.int64)
        columns = [held[c].to_numpy() for c in ("_pos", "_val", "total", "n")]
        bounds = [asked[c].to_numpy() for c in ("_from", "_to", "_least", "_most")]
        found = []
        for k in range(group.max(initial=-1) + 1):
            own = np.flatnonzero(group == k)
            total, n = _strip_sums(*[c[own] for c in columns], bounds)
            hit = np.flatnonzero(n)
            parts = [asked["id"].take(hit), *[held[c].take(np.full(len(hit), own[0])) for c in by], total[hit], n[hit]]
            found.append(pa.table(dict(zip(schema.names, parts))))
        return pa.concat_tables(found) if found else empty

    return dealt[0].groupBy(*keys).cogroup(dealt[1].groupBy(*keys)).applyInArrow(met, schema)


def box_sums(box_table: DataFrame, pixels: DataFrame, side: float, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum and count of the non-negative pixels in each box.

    The tiles inside a box are taken as oblongs of aligned rows and columns, some
    dozens for a box of any size, and add their sums. Its outermost tiles are read
    as two columns and two rows: each strip of tiles sorts its pixels once for all
    edges in it, so an edge costs the logarithm of the pixels there and pixels
    are not paired with boxes. Only boxes inside one strip look at the pixels
    beside them. Larger boxes have larger tiles, a box is some thousand tiles long
    at most. Equal positions are added up first. Best with tiles several times
    smaller than a box.
    """
    usable = _placed(pixels.filter(F.col("elevation_m") >= 0).select(*by, "x", "y", "elevation_m"), side)
    placed = usable.groupBy(*by, "x", "y", "_ty", "_tx").agg(F.sum("elevation_m").alias("total"), F.count("elevation_m").alias("n"))
    placed = cut_lineage(placed, "placed")
    spans = cut_lineage(_spans(box_table.select("id", "min_lat", "max_lat", "min_lon", "max_lon"), side, _RIM), "spans")
    inner = cut_lineage(_inner(spans), "inner")
    both = [F.sum("total").alias("total"), F.sum("n").alias("n")]
    tiles = placed.groupBy(*by, "_ty", "_tx").agg(*both)
    inside = _oblongs(tiles, inner, by).join(inner, ["_ly", "_lx", "_ty", "_tx"]).select("id", *by, "total", "n")
    return inside.unionByName(_edge_sums(placed, spans, by)).groupBy("id", *by).agg(*both)


def zonal_mean(box_table: DataFrame, pixels: DataFrame, side: float) -> DataFrame:
    """Mean of the non-negative pixels in each box, -1 without any."""
    means = box_sums(box_table, pixels, side).select("id", (F.col("total") / F.col("n")).alias("elevation"))
    return box_table.select("id").join(means, "id", "left").withColumn(
        "elevation", F.coalesce("elevation", F.lit(-1.0))
    )


def point_elevation(
    points: DataFrame, cache: DataFrame, box_table: DataFrame, pixels: DataFrame, side: float
) -> tuple[DataFrame, DataFrame]:
    """(elevation of each point, points no raster covers).

    A cached elevation wins; else the first file by name with a usable pixel in
    the box. Only boxes without a cached value reach the pixel join.
    """
    known = points.select("id").join(cache.select("id", "elevation", "file"), "id")
    open_boxes = box_table.join(cache, "id", "left_anti")
    per_file = box_sums(open_boxes, pixels, side, ("file",))
    first = per_file.groupBy("id").agg(F.min(F.struct("file", "total", "n")).alias("m")).select(
        "id", (F.col("m.total") / F.col("m.n")).alias("elevation"), "m.file"
    )
    found = known.unionByName(points.select("id").join(first, "id"))
    return found, points.join(found, "id", "left_anti")


def raster_pixels(rasters: DataFrame) -> DataFrame:
    """Pixel centres and values of raster strips.

    A row holds ``file, x0, y0, dx, dy, row0`` and ``strip``, rows of values;
    ``row0`` is the raster row the strip starts with. Cutting rasters into
    strips keeps each row small and lets tasks share one raster.
    """
    rows = rasters.select("file", "x0", "y0", "dx", "dy", "row0", F.posexplode("strip").alias("_r", "_values"))
    cells = rows.select("*", F.posexplode("_values").alias("_c", "elevation_m"))
    return cells.select(
        "file",
        (F.col("x0") + (F.col("_c") + 0.5) * F.col("dx")).alias("x"),
        (F.col("y0") + (F.col("row0") + F.col("_r") + 0.5) * F.col("dy")).alias("y"),
        "elevation_m",
    )
