"""Point in polygon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.operators.joins import lookup
from panelspark.workspace import stored

RING = "array<struct<x:double,y:double>>"


def rings_from_wkt(wkt: str | Column) -> Column:
    """The rings of a POLYGON or MULTIPOLYGON text: each innermost parenthesis is one ring."""
    texts = F.regexp_extract_all(col(wkt), F.lit(r"\(([^()]+)\)"), F.lit(1))

    def vertex(pair: Column) -> Column:
        xy = F.split(F.trim(pair), r"\s+")
        return F.struct(xy[0].cast("double").alias("x"), xy[1].cast("double").alias("y"))

    return F.transform(texts, lambda ring: F.transform(F.split(ring, ","), vertex))


def edges(rings: str | Column) -> Column:
    """The sides of all rings as structs (x1, y1, x2, y2); a ring not closed by its data is closed."""

    def sides(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
        )

    return F.flatten(F.transform(col(rings), sides))


def cross(e: Column, x: Column, y: Column) -> Column:
    """Above zero where (x, y) lies to the left of the side, looking along it."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def is_left(e: Column, x: Column, y: Column) -> Column:
    """The same for a point moved up by next to nothing and right by far less still, which no side's line goes through."""
    c, dx, dy = cross(e, x, y), e["x2"] - e["x1"], e["y2"] - e["y1"]
    return F.when(c != 0, c > 0).when(dx != 0, dx > 0).otherwise(dy < 0)


def on_side(e: Column, x: Column, y: Column) -> Column:
    inside_x = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
    inside_y = y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    return (cross(e, x, y) == 0) & inside_x & inside_y


def strictly_within(x: Column, y: Column, sides: Column, corner_x: Column, corner_y: Column, corner_is_in: Column) -> Column:
    """Even-odd rule from a corner whose side is known: along the corner's height to below the point, then up to it.

    Every side that meets either leg changes inside to outside. All three points are moved by the same tiny amount,
    so legs meet no side's end, and whether the turning point is left of a side is decided once for both legs. A
    point on a side is not within.
    """

    def meets(e: Column) -> Column:
        turn = is_left(e, x, corner_y)
        along = ((e["y1"] > corner_y) != (e["y2"] > corner_y)) & (is_left(e, corner_x, corner_y) != turn)
        up = ((e["x1"] > x) != (e["x2"] > x)) & ((cross(e, x, y) > 0) != turn)
        return along != up

    changes = F.size(F.filter(sides, meets)) % 2 == 1
    return (corner_is_in != changes) & ~F.exists(sides, lambda e: on_side(e, x, y))


def cells_of(polygons: DataFrame, polygon_id: str, cell: float, rings: str = "rings") -> DataFrame:
    """``polygon_id, _cx, _cy, _sides, _in``: the cells that a polygon has a part in.

    A cell has the sides that meet it and no others, so what it holds is bounded by them, however many sides the
    polygon has. ``_in`` says whether its lower left corner (moved a little into the cell) is within: for each row of
    cells, sides that meet the row's lower edge switch it, counted from the right.
    """

    def index(v: Column) -> Column:
        return F.floor(v / F.lit(cell)).cast("bigint")

    e = F.col("_e")
    pid = col(polygon_id)
    sides = stored(polygons.select(pid, F.explode(edges(rings)).alias("_e")), "polygon-sides")
    rows = F.sequence(index(F.least(e["y1"], e["y2"])), index(F.greatest(e["y1"], e["y2"])))
    columns = F.sequence(index(F.least(e["x1"], e["x2"])), index(F.greatest(e["x1"], e["x2"])))
    boxed = sides.withColumn("_cy", F.explode(rows)).withColumn("_cx", F.explode(columns))
    corners = [cross(e, (F.col("_cx") + i) * cell, (F.col("_cy") + j) * cell) for i in (0, 1) for j in (0, 1)]
    passed = (F.least(*corners) > 0) | (F.greatest(*corners) < 0)  # all of the cell is on one side of the line
    meeting = boxed.filter(~passed).groupBy(pid, "_cx", "_cy").agg(F.collect_list("_e").alias("_sides"))

    low = F.col("_cy") * cell
    at = e["x1"] + (low - e["y1"]) * ((e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))
    # the corners that a side is to the right of: those up to about its place, made sure of by the same test as above
    upward = e["y2"] > e["y1"]
    guess = index(at)
    last = F.when(is_left(e, (guess + 1) * cell, low) == upward, guess + 1)
    last = last.when(is_left(e, guess * cell, low) == upward, guess).otherwise(guess - 1)
    crossing = sides.withColumn("_cy", F.explode(rows)).filter((e["y1"] > low) != (e["y2"] > low))
    switches = crossing.select(pid, "_cy", last.alias("_last")).groupBy(pid, "_cy", "_last").agg((F.count(F.lit(1)) % 2).alias("_n"))
    from_right = W.partitionBy(pid, "_cy").orderBy(F.col("_last").desc())
    runs = switches.filter("_n = 1").select(
        pid, "_cy", "_last", (F.row_number().over(from_right) % 2 == 1).alias("_in"), F.lead("_last").over(from_right).alias("_next")
    )
    within = runs.filter(F.col("_in") & (F.col("_next") < F.col("_last")))
    inside = within.select(pid, F.explode(F.sequence(F.col("_next") + 1, F.col("_last"))).alias("_cx"), "_cy", F.lit(True).alias("_in"))
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    return meeting.join(inside, [polygon_id, "_cx", "_cy"], "full").select(
        pid, "_cx", "_cy", F.coalesce("_sides", none).alias("_sides"), F.coalesce("_in", F.lit(False)).alias("_in")
    )


def locate(
    points: DataFrame,
    polygons: DataFrame,
    polygon_id: str,
    x: str,
    y: str,
    cell: float,
    rings: str = "rings",
) -> DataFrame:
    """Every point with the polygon it lies strictly within; null when there is none.

    Both sides get the square cells of a grid: a point its own cell, a polygon each cell it has a part
    in, with the sides that meet that cell. Cells are matched by equality, so the join is an ordinary
    lookup whose polygon side is size-checked, and the exact test runs inside the join on few sides.
    A ``cell`` about as wide as a typical polygon gives few cells per polygon; one much smaller than
    a polygon of many sides spreads them over cells.
    """
    px, py = col(x).cast("double"), col(y).cast("double")
    placed = points.withColumn("_cx", F.floor(px / F.lit(cell)).cast("bigint")).withColumn("_cy", F.floor(py / F.lit(cell)).cast("bigint"))
    shapes = stored(cells_of(polygons, polygon_id, cell, rings), "polygon-cells")
    # the cells' own numbers again under names of their own, so that the test reads one side only
    shapes = shapes.withColumn("_x0", F.col("_cx") * cell).withColumn("_y0", F.col("_cy") * cell)
    inside = strictly_within(px, py, F.col("_sides"), F.col("_x0"), F.col("_y0"), F.col("_in"))
    return lookup(placed, shapes, ["_cx", "_cy"], "left", inside).drop("_cx", "_cy", "_sides", "_in", "_x0", "_y0")
