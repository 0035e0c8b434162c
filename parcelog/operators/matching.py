"""Joins that need more than an equality: overlaps, memberships, places in polygons, state comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DAYS = 30


def overlapping_pairs(df: DataFrame, keys: list[str], id_: str, start: str, end: str, days: int = DAYS) -> DataFrame:
    """Pairs (a, b) with a < b of the same keys whose closed intervals overlap.

    Intervals are dealt into time buckets; a pair meets in each bucket it shares and counts in the bucket where the
    later of the two begins, so hot keys are split by time and no pair comes twice.
    """
    bucket = lambda ts: F.floor(F.datediff(F.to_date(ts), F.lit("1970-01-01")) / days)
    own = df.select(*keys, F.col(id_).alias("i"), F.col(start).alias("s"), F.col(end).alias("e"))
    met = own.withColumn("at", F.explode(F.sequence(bucket("s"), bucket("e"))))
    a, b = met.select(*keys, "at", *[F.col(x).alias(f"a_{x}") for x in "ise"]), met.select(*keys, "at", *[F.col(x).alias(f"b_{x}") for x in "ise"])
    pairs = a.join(b, [*keys, "at"]).filter("a_i < b_i and a_s <= b_e and b_s <= a_e")
    return pairs.filter(F.col("at") == F.greatest(bucket("a_s"), bucket("b_s"))).select(*keys, F.col("a_i").alias("a"), F.col("b_i").alias("b"))


def segment_members(units: DataFrame, segments: DataFrame) -> DataFrame:
    """Units of each segment: equal region, room key among the segment's, and the segment's age if it names one."""
    wide = segments.withColumn("room_key", F.explode("room_keys"))
    return units.join(wide, ["region", "room_key"]).filter(F.col("wanted_new").isNull() | (F.col("wanted_new") == F.col("is_new")))


def _edges(ring: Column) -> Column:
    """Pairs of neighbouring points of a ring, which closes itself."""
    return F.zip_with(ring, F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _rays(x: Column, y: Column, edges: Column) -> Column:
    """How many edges a ray from (x, y) to the right crosses."""

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])

    return F.size(F.filter(edges, crosses))


def inside(x: Column, y: Column, ring: Column) -> Column:
    """True if (x, y) lies in the ring of points (x, y): a ray to the right crosses it an odd number of times."""
    return _rays(x, y, _edges(ring)) % 2 == 1


def area_cells(areas: DataFrame, cell: float) -> DataFrame:
    """Grid cells (cx, cy) that areas (name, ``rings`` by the even-odd rule: holes and further parts are rings like others) touch.

    A cell that no edge passes lies wholly inside or outside its area: such cells carry no edges (``edges`` is null), and those
    outside are left out. The others carry the edges that can matter to points in them: of the cell's rows, not wholly to its left.
    """
    edges = F.flatten(F.transform("rings", _edges))
    flat = F.flatten(F.col("rings"))
    low = lambda k: F.floor(F.array_min(F.transform(flat, lambda p: p[k])) / cell)
    high = lambda k: F.floor(F.array_max(F.transform(flat, lambda p: p[k])) / cell)
    rows = areas.filter(F.size(flat) > 0).select(
        "name",
        edges.alias("all_"),
        low("x").alias("x0"),
        high("x").alias("x1"),
        F.explode(F.sequence(low("y"), high("y"))).alias("cy"),
    )

    def between(e: Column, k: str, at: Column) -> Column:
        """True if an edge reaches into the band of a row or column of cells (a little widened)."""
        a, b, slack = e["a"][k], e["b"][k], cell * 1e-9
        return (F.greatest(a, b) >= at * cell - slack) & (F.least(a, b) <= (at + 1) * cell + slack)

    rows = rows.withColumn("row_", F.filter("all_", lambda e: between(e, "y", F.col("cy")))).drop("all_")
    cells = rows.select("name", "cy", "row_", F.explode(F.sequence("x0", "x1")).alias("cx"))
    right = F.filter("row_", lambda e: F.greatest(e["a"]["x"], e["b"]["x"]) >= F.col("cx") * cell)

    def crosses(e: Column) -> Column:
        """False if a cell's corners lie on one side of the edge's line (by more than a rounding error)."""
        a, b = e["a"], e["b"]
        side = lambda dx, dy: (b["x"] - a["x"]) * ((F.col("cy") + dy) * cell - a["y"]) - (b["y"] - a["y"]) * ((F.col("cx") + dx) * cell - a["x"])
        corners, slack = [side(dx, dy) for dx in (0, 1) for dy in (0, 1)], cell * 1e-9 * (F.abs(b["x"] - a["x"]) + F.abs(b["y"] - a["y"]))
        return (F.greatest(*corners) >= -slack) & (F.least(*corners) <= slack)

    passed = F.exists("row_", lambda e: between(e, "x", F.col("cx")) & crosses(e))
    middle = _rays((F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell, F.col("row_")) % 2 == 1
    return cells.withColumns({"passed_": passed, "middle_": middle}).filter("passed_ or middle_").select(
        "name",
        "cx",
        "cy",
        F.when(F.col("passed_"), right).alias("edges"),
    )


def points_in_polygons(points: DataFrame, polygons: DataFrame, id_: str, cell: float = 0.25) -> DataFrame:
    """``name`` of the first polygon (by name) that holds each point, null for none.

    Polygons have ``rings`` (any number, even-odd rule) or one ``ring``. They are dealt into grid cells: points in cells wholly
    inside need no test, others meet the edges of their cell's row only.
    """
    areas = polygons if "rings" in polygons.columns else polygons.select("name", F.array("ring").alias("rings"))
    own = points.withColumns({"cx": F.floor(F.col("x") / cell), "cy": F.floor(F.col("y") / cell)})
    met = own.join(area_cells(areas, cell), ["cx", "cy"])
    hits = met.filter(F.col("edges").isNull() | (_rays(F.col("x"), F.col("y"), F.col("edges")) % 2 == 1)).groupBy(id_).agg(F.min("name").alias("name"))
    return points.join(hits, id_, "left")


def classify_sightings(cards: DataFrame, state: DataFrame, key: str = "listing_id") -> DataFrame:
    """``outcome`` of each sighting of one run (key, scraped_at, obs_id, price) against the state when it began (key, price).

    Listings that the state hasn't got are new once, then dup. Of the others, the first sighting with a price that differs from
    the state's is repriced, once a run, and all else is known. The batch twin of the streaming ``card_states``.
    """
    order = F.struct("scraped_at", "obs_id")
    known = state.select(key, F.col("price").alias("price_known_"), F.lit(True).alias("there_"))
    joined = cards.join(known, key, "left")
    other = (F.coalesce("price", F.lit(0)) != 0) & ~F.col("price").eqNullSafe(F.col("price_known_"))
    # One sighting a listing decides: the first of all for new listings, the first with another price for others.
    turn = joined.filter(F.col("there_").isNull() | other).groupBy(key).agg(F.min(order).alias("turn_"))
    found = joined.join(turn, key, "left").withColumn("is_turn_", F.coalesce(F.col("turn_") == order, F.lit(False)))
    outcome = F.when(F.col("there_").isNull(), F.when(F.col("is_turn_"), "new").otherwise("dup")).when(F.col("is_turn_"), "repriced").otherwise("known")
    return found.select(*cards.columns, outcome.alias("outcome"))


def not_yet(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't among those done."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")
