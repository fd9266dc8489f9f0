"""Nearest centroid and distance joins (JN-12..JN-14, WN-4)."""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.geo import chord_of_km, haversine_km, unit_vector
from martkit.session import staged

# Up to this many centroids become constants of the plan; the count is checked.
MAX_CONSTANT_CENTROIDS = 64
# The tree of cells for larger tables: children of a cell per axis, levels, the
# length up to which a list is compared, that for cells of a few places, how many
# places are few, and what rounding may hide.
FANOUT, LEVELS, SHORT_LIST, LONG_LIST, FEW_PLACES, SLACK = 4, 10, 24, 4096, 16, 1e-9
_AXES = ("x", "y", "z")
_CELL = ("_cx", "_cy", "_cz")
# A cell itself and half of its 26 neighbours: each pair of cells once.
_VISITED = [step for step in product((-1, 0, 1), repeat=3) if step >= (0, 0, 0)]


def nearest(
    points: DataFrame,
    centroids: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    max_constants: int = MAX_CONSTANT_CENTROIDS,
) -> DataFrame:
    """Each point with the ``city_id``, ``city`` and ``distance_km`` of its
    nearest centroid; equal distances go to the smaller id. Points without
    coordinates get nulls. Points may repeat and need no key; which way the
    centroids are searched does not change the result.

    ``centroids`` has id, city, lat, lon. A small table is compared inside the
    projection, so points are neither shuffled nor multiplied. A large one is
    searched by a tree of cells.
    """
    rows = centroids.select("id", "city", "lat", "lon").dropna().limit(max_constants + 1).collect()
    if not rows:
        raise ValueError("no centroids")
    if len(rows) <= max_constants:
        return _nearest_constant(points, sorted(rows, key=lambda r: r["id"]), lat, lon)
    return _nearest_by_tree(points, centroids, lat, lon)


def _nearest_constant(points: DataFrame, rows, lat: str, lon: str) -> DataFrame:
    vector = [f"_{a}" for a in _AXES]
    placed = points.select(
        "*", *[v.alias(name) for v, name in zip(unit_vector(F.col(lat), F.col(lon)), vector)]
    )
    candidates = []
    for place, row in enumerate(rows):
        center = _unit(row["lat"], row["lon"])
        gap = sum((F.col(name) - F.lit(c)) * (F.col(name) - F.lit(c)) for name, c in zip(vector, center))
        candidates.append(F.struct(gap.alias("gap"), F.lit(place).alias("place")))
    winner = F.least(*candidates) if len(candidates) > 1 else candidates[0]
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    chosen = placed.withColumn("_place", F.when(known, winner["place"])).drop(*vector)

    def pick(field: str) -> Column:
        return F.get(F.array(*[F.lit(r[field]) for r in rows]), F.col("_place"))

    return chosen.select(
        *points.columns,
        pick("id").alias("city_id"),
        pick("city").alias("city"),
        haversine_km(F.col(lat), F.col(lon), pick("lat"), pick("lon")).alias("distance_km"),
    )


def _unit(lat: float, lon: float) -> tuple[float, float, float]:
    phi, lam = math.radians(lat), math.radians(lon)
    return math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi)


def _nearest_by_tree(points: DataFrame, centroids: DataFrame, lat: str, lon: str) -> DataFrame:
    """Search down a tree of cells. A cell has a list of centroids: those that
    can be nearest to some place in it, because they are no farther from its
    nearest corner than another is from its farthest. Cells of many places and a
    long list are split, and the lists of their children are cut down again; the
    places of other cells compare their list, which is one row. A list is not
    split for fewer places than there would be lists, so lists do not outgrow the
    places. Places are searched once each and joined back: keys of points may
    repeat or be null."""
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    place = F.col("lat").alias("_clat"), F.col("lon").alias("_clon")
    centers = centroids.select("id", "city", *place).dropna().groupBy("_clat", "_clon").agg(F.min(F.struct("id", "city")).alias("_who"))
    lists = _with_vector(centers, "_clat", "_clon", "c").withColumns({c: F.lit(0).cast("long") for c in _CELL})
    left = staged(points.filter(known).select(lat, lon).distinct(), "places")
    up = [f"_up{c}" for c in _CELL]
    parts = []
    for level in range(1, LEVELS + 1):
        cells = FANOUT**level
        placed = _with_vector(left, lat, lon, "p").withColumns(
            {c: F.least(F.floor((F.col(f"p{a}") + 1) / 2 * cells), F.lit(cells - 1)) for c, a in zip(_CELL, _AXES)}
        )
        parents = [F.floor(F.col(c) / FANOUT).alias(u) for c, u in zip(_CELL, up)]
        children = placed.groupBy(*_CELL).agg(F.count("*").alias("_places")).select("*", *parents)
        above = lists.withColumnsRenamed(dict(zip(_CELL, up))).repartition(*up)
        # The lists are opened twice, so that only bounds are shuffled in between.
        bounds = children.join(above, up).groupBy(*_CELL, *up, "_places").agg(F.min(_to_cell(cells, True)).alias("_bound"))
        opened = staged(bounds, "cells").join(above, up)
        kept = staged(opened.filter(_to_cell(cells, False) <= F.col("_bound") + SLACK).drop(*up, "_bound"), "lists")
        sizes = kept.groupBy(*_CELL).agg(F.count("*").alias("_n"), F.max("_places").alias("_places"))
        few = (F.col("_places") <= FEW_PLACES) & (F.col("_n") <= LONG_LIST)
        leaves = sizes.filter((F.col("_n") <= SHORT_LIST) | few).select(*_CELL)
        parts.append(staged(_hits(placed, kept.join(leaves, list(_CELL)), lat, lon), "nearest"))
        lists = kept.join(leaves, list(_CELL), "left_anti").drop("_places")
        rest = placed.join(leaves, list(_CELL), "left_anti")
        if level < LEVELS:
            left = staged(rest.select(lat, lon), "places")
        else:  # lists of any length, row by row
            hit = F.struct(_gap(F.col).alias("gap"), "_who.id", "_who.city", "_clat", "_clon")
            met = rest.join(lists, list(_CELL)).groupBy(lat, lon).agg(F.min(hit).alias("_hit"))
            parts.append(staged(met.select(lat, lon, "_hit.id", "_hit.city", "_hit._clat", "_hit._clon"), "nearest"))
        if left.isEmpty():
            break
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    hits = hits.select(
        F.col(lat).alias("_lat"),
        F.col(lon).alias("_lon"),
        F.col("id").alias("city_id"),
        "city",
        haversine_km(F.col(lat), F.col(lon), F.col("_clat"), F.col("_clon")).alias("distance_km"),
    )
    here = (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon"))
    return points.join(hits, here, "left").select(*points.columns, "city_id", "city", "distance_km")


def _hits(placed: DataFrame, lists: DataFrame, lat: str, lon: str) -> DataFrame:
    """Places with the nearest centroid of their cell's list. The list is one row
    in the order of ids, so of equal distances the first is taken."""
    entry = F.struct("_who.id", "_who.city", "_clat", "_clon", "cx", "cy", "cz")
    rows = lists.groupBy(*_CELL).agg(F.array_sort(F.collect_list(entry)).alias("_list"))
    best = F.array_min(F.transform("_list", lambda c, at: F.struct(_gap(lambda n: c[n] if n.startswith("c") else F.col(n)).alias("gap"), at.alias("at"))))
    won = placed.join(rows, list(_CELL)).withColumn("_hit", F.get("_list", best["at"]))
    return won.select(lat, lon, "_hit.id", "_hit.city", "_hit._clat", "_hit._clon")


def _gap(of) -> Column:
    """Squared distance of the vectors ``p`` and ``c``."""
    return sum((of(f"p{a}") - of(f"c{a}")) * (of(f"p{a}") - of(f"c{a}")) for a in _AXES)


def _with_vector(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    vector = unit_vector(F.col(lat), F.col(lon))
    return df.select("*", *[v.alias(f"{prefix}{a}") for v, a in zip(vector, _AXES)])


def _with_cell(df: DataFrame, prefix: str, size: float) -> DataFrame:
    return df.select(
        "*", *[F.floor(F.col(f"{prefix}{a}") / F.lit(size)).alias(f"_c{a}") for a in _AXES]
    )


def _to_cell(cells: int, far: bool) -> Column:
    """Squared distance of a centroid to the nearest or farthest corner or side
    of a cell, of which the cube around the sphere has ``cells`` per axis."""
    total = F.lit(0.0)
    for cell, axis in zip(_CELL, _AXES):
        low, at = F.col(cell) * (2 / cells) - 1, F.col(f"c{axis}")
        high = low + 2 / cells
        off = F.greatest(F.abs(at - low), F.abs(at - high)) if far else F.greatest(F.lit(0.0), low - at, at - high)
        total = total + off * off
    return total


def pairs_within(pairs: DataFrame, positions: DataFrame, km: float) -> DataFrame:
    """Given pairs (user_left, user_right) at most ``km`` apart, with distance.

    ``positions`` has user_id, lat, lon. Distances are compared in whole
    hundredths of a km.
    """
    left = positions.select(
        F.col("user_id").alias("user_left"), F.col("lat").alias("_la"), F.col("lon").alias("_lo")
    )
    right = positions.select(
        F.col("user_id").alias("user_right"), F.col("lat").alias("_ra"), F.col("lon").alias("_ro")
    )
    away = haversine_km(F.col("_la"), F.col("_lo"), F.col("_ra"), F.col("_ro"))
    return (
        pairs.join(left, "user_left")
        .join(right, "user_right")
        .withColumn("distance_km", F.round(away, 2))
        .filter(F.col("distance_km") <= km)
        .drop("_la", "_lo", "_ra", "_ro")
        .select("user_left", "user_right", *[c for c in pairs.columns if not c.startswith("user_")], "distance_km")
    )


def near_pairs(positions: DataFrame, km: float) -> DataFrame:
    """All pairs of users at most ``km`` apart (JN-14), without comparing all
    pairs: only users in the same or adjacent cells meet."""
    return near_members(positions.withColumn("_all", F.lit(0)), "_all", km).drop("_all")


def near_members(
    members: DataFrame, group: str, km: float, rows_per_task: int = 20_000, once: bool = False, carry: list[str] = ()
) -> DataFrame:
    """Pairs of the same group at most ``km`` apart: group, user_left,
    user_right (the greater id is left), distance_km.

    ``members`` has the group, user_id, lat, lon, one row per group and user.
    The join key is group and cells together, so members of a large group who
    live apart never meet. Each pair of neighbouring cells is visited once, and
    both sides of a crowded cell are cut into parts that meet part by part, so a
    task holds about ``rows_per_task`` rows of either side.

    With ``once`` a pair comes in the smallest of its common groups only: each
    member's row brings its user's smaller groups along, so that pairs, of which
    there are many more than members, need no shuffle to be told apart. Columns
    named in ``carry`` come with both users, as ``{name}_left`` and
    ``{name}_right``.
    """
    known = members.dropna(subset=[group, "user_id", "lat", "lon"])
    carry = list(carry)
    if once:
        groups = known.groupBy("user_id").agg(F.collect_set(group).alias("_groups"))
        known = known.join(groups, "user_id").withColumn("_less", F.filter("_groups", lambda g: g < F.col(group)))
        carry = [*carry, "_less"]
    placed = _with_vector(known.select(group, "user_id", "lat", "lon", *carry), "lat", "lon", "p")
    # Half a hundredth more than km, since distances are rounded.
    celled = staged(_with_cell(placed, "p", chord_of_km(km + 0.005)).drop("px", "py", "pz"), "celled")
    cell = [group, *_CELL]
    crowded = (
        celled.groupBy(*cell)
        .agg(F.ceil(F.count("*") / F.lit(rows_per_task)).cast("int").alias("_parts"))
        .filter(F.col("_parts") > 1)
    )
    # The parts that rows of a cell may come in from it and the cells that visit it.
    steps = F.explode(F.array(*[F.struct(*[F.lit(v).alias(a) for a, v in zip(_AXES, step)]) for step in _VISITED]))
    beyond = [group, *[(F.col(f"_c{a}") + F.col(f"_step.{a}")).alias(f"_c{a}") for a in _AXES]]
    visits = crowded.withColumn("_step", steps).select(*beyond, "_parts").groupBy(*cell).agg(F.max("_parts").alias("_visits"))
    one = F.lit(1)
    own = F.pmod(F.xxhash64("user_id"), F.coalesce("_parts", one)).cast("int").alias("_own")
    split = celled.join(crowded, cell, "left").select(*celled.columns, own)
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, one) - 1))

    def named(at: str) -> list[Column]:
        return [F.col("user_id").alias(f"_{at}"), F.col("lat").alias(f"_{at}_lat"), F.col("lon").alias(f"_{at}_lon"), *[F.col(c).alias(f"_{at}_{c}") for c in carry]]

    # One side goes to the cells it visits and all their parts, the other stays.
    sent = split.withColumn("_step", steps).withColumn("_same", F.expr("_step.x = 0 AND _step.y = 0 AND _step.z = 0"))
    sent = sent.select(*beyond, "_same", "_own", "user_id", "lat", "lon", *carry).join(crowded, cell, "left")
    left = sent.select(*cell, "_same", F.col("_own").alias("_p"), upto("_parts").alias("_q"), *named("a"))
    right = split.join(visits, cell, "left").select(*cell, F.col("_own").alias("_q"), upto("_visits").alias("_p"), *named("b"))
    away = haversine_km(F.col("_a_lat"), F.col("_a_lon"), F.col("_b_lat"), F.col("_b_lon"))
    # Files of members are much smaller than their rows: by its files a side would be
    # broadcast that the driver cannot hold.
    near = (
        left.join(right.hint("merge"), [*cell, "_p", "_q"])
        .filter((F.col("_a") > F.col("_b")) | (~F.col("_same") & (F.col("_a") < F.col("_b"))))
        .withColumn("distance_km", F.round(away, 2))
        .filter(F.col("distance_km") <= km)
    )
    if once:
        near = near.filter(~F.arrays_overlap("_a__less", "_b__less"))
        carry.remove("_less")
    greater = F.col("_a") > F.col("_b")
    sides = [F.when(greater if side == "left" else ~greater, F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(f"{c}_{side}") for side in ("left", "right") for c in carry]
    return near.select(group, F.greatest("_a", "_b").alias("user_left"), F.least("_a", "_b").alias("user_right"), "distance_km", *sides)
