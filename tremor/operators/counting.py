"""How many points each of many boxes holds, without a row per point and box.

Points get their places in two global orders, by layer and longitude and by latitude, and a box's corners
the numbers of points before them. A box then holds what lies below its corners in both orders, added and subtracted.
The plane of places is cut into columns and rows of equally many points: whole cells come from a summed table,
the rest from the corner's own column and row, each of which one task counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.operators.ranking import running_totals
from tremor.workspace import new_folder, ship_package

#: Columns and rows that the plane of places is cut into, and points in one of them at least.
STRIPS = 512
STRIP_POINTS = 256
#: Corners that a task counts at most, about.
STRIP_CORNERS = 1 << 20


def counts_in_boxes(points: DataFrame, boxes: DataFrame, layer: list[str]) -> DataFrame:
    """``(box_id, n)``: the sum of ``n`` over points ``(*layer, lon, lat, n)`` in each box ``(box_id, *layer, west, south,
    east, north)`` of the same layer, borders included; no row for a box without any.

    NULLs of the layer's columns are equal. Points and boxes with a NULL side hold nothing, and neither does a box
    whose east or north is before its west or south. Rows that share a ``box_id`` are added up; they may have a
    ``sign``, 1 or -1.
    """
    spark = points.sparkSession
    ship_package(spark)
    if "sign" not in boxes.columns:
        boxes = boxes.withColumn("sign", F.lit(1))
    none = F.lit(None)
    # 0.0 is added since -0.0 is another value where rows are sorted.
    placed = points.where("lon IS NOT NULL AND lat IS NOT NULL").groupBy(
        *layer, (F.col("lon") + 0.0).alias("x"), (F.col("lat") + 0.0).alias("y")
    ).agg(F.sum("n").alias("n"))
    placed = placed.select(
        *layer, "x", "y", F.lit(0).alias("x_side"), F.lit(0).alias("y_side"), "n",
        none.cast(boxes.schema["box_id"].dataType).alias("box_id"), none.cast("int").alias("sign"), F.lit(1).alias("is_point"),
    )
    sides = [("west", -1, "south", -1, 1), ("east", 1, "south", -1, -1), ("west", -1, "north", 1, -1), ("east", 1, "north", 1, 1)]
    corner = F.explode(
        F.array(*[
            F.struct((F.col(x) + 0.0).alias("x"), F.lit(sx).alias("x_side"), (F.col(y) + 0.0).alias("y"), F.lit(sy).alias("y_side"),
                     (F.col("sign") * sign).cast("int").alias("sign"))
            for x, sx, y, sy, sign in sides
        ])
    )
    corners = boxes.where("west <= east AND south <= north").select("box_id", *layer, corner.alias("at")).select(
        *layer, "at.x", "at.y", "at.x_side", "at.y_side", none.cast("bigint").alias("n"), "box_id", "at.sign", F.lit(0).alias("is_point")
    )
    rows = placed.unionByName(corners)
    # Places in both orders: the number of points before. An edge in the west or south comes before equal points.
    for order, place in ([*layer, "x", "x_side"], "x_at"), (["y", "y_side"], "y_at"):
        counted = running_totals(rows, order, "is_point", 0)
        at = (F.col("running") - F.col("is_point")).cast("bigint")
        rows = counted.withColumn(place, at).drop(*order, "rank", "running")
    folder = new_folder(spark, "corners")
    rows.write.parquet(folder)
    rows = spark.read.parquet(folder)
    points = rows.where("is_point = 1").select("x_at", "y_at", "n")
    corners = rows.where("is_point = 0").select("box_id", "sign", "x_at", "y_at")
    size = max(STRIP_POINTS, -(-points.count() // STRIPS))
    shared = spark.sparkContext.broadcast(_cells_before(points, size))

    def strips(rows: DataFrame) -> DataFrame:
        """Every row once with its column and once with its row; by row, only the column of a place counts."""
        column, row = F.floor(F.col("x_at") / size), F.floor(F.col("y_at") / size)
        both = F.array(
            F.struct(F.lit(0).alias("axis"), column.alias("strip"), F.col("x_at").alias("u"), F.col("y_at").alias("v")),
            F.struct(F.lit(1).alias("axis"), row.alias("strip"), column.alias("u"), F.col("y_at").alias("v")),
        )
        return rows.withColumn("at", F.explode(both)).select(*rows.columns, "at.*")

    asked = strips(corners)
    # A row per strip: how many tasks share its corners, as many boxes may begin at the same place.
    loads = asked.groupBy("axis", "strip").agg(F.ceil(F.count(F.lit(1)) / STRIP_CORNERS).alias("shares")).collect()
    shares = F.broadcast(spark.createDataFrame(loads, "axis int, strip bigint, shares bigint"))
    asked = asked.join(shares, ["axis", "strip"]).withColumn("share", F.pmod(F.xxhash64("box_id", "u", "v"), "shares"))
    asked = asked.select("axis", "strip", "share", "u", "v", "x_at", "y_at", "box_id", "sign")
    held = strips(points).join(shares, ["axis", "strip"])
    held = held.withColumn("share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)))
    held = held.select("axis", "strip", "share", "u", "v", "n")

    def counted(own: pa.Table, corners: pa.Table) -> pa.Table:
        get = lambda table, name: table.column(name).to_numpy()
        n = below(get(own, "u"), get(own, "v"), get(own, "n"), get(corners, "u"), get(corners, "v"))
        by_column = get(corners, "axis") == 0
        cells = shared.value
        n += np.where(by_column, cells[get(corners, "x_at") // size, get(corners, "y_at") // size], 0)
        return pa.table({"box_id": corners.column("box_id"), "n": pa.array(n * get(corners, "sign"), pa.int64())})

    keys = ["axis", "strip", "share"]
    kind = boxes.schema["box_id"].dataType.simpleString()
    parts = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(counted, f"box_id {kind}, n bigint")
    return parts.groupBy("box_id").agg(F.sum("n").alias("n")).where("n <> 0")


def _cells_before(points: DataFrame, size: int) -> np.ndarray:
    """``[column, row]``: the sum of ``n`` over the cells before both; a row per cell passes through the driver."""
    column, row = F.floor(F.col("x_at") / size).alias("c"), F.floor(F.col("y_at") / size).alias("r")
    cells = np.zeros((STRIPS + 2, STRIPS + 2), np.int64)
    for cell in points.groupBy(column, row).agg(F.sum("n").alias("n")).toLocalIterator():
        cells[cell.c + 1, cell.r + 1] = cell.n
    return cells.cumsum(axis=0).cumsum(axis=1)


def below(u: np.ndarray, v: np.ndarray, n: np.ndarray, of_u: np.ndarray, of_v: np.ndarray) -> np.ndarray:
    """For each corner the sum of ``n`` over points that are less in both: bit by bit of the ranks by ``u``, the
    points in the order of ``v`` are parted, and a corner's run of them is followed."""
    order = np.argsort(v, kind="stable")
    last = np.searchsorted(v[order], of_v, "left")
    first = np.zeros_like(last)
    kinds, rank = np.unique(u[order], return_inverse=True)
    limit = np.searchsorted(kinds, of_u, "left")
    n = n[order].astype(np.int64)
    total = np.zeros(len(of_u), np.int64)
    for bit in range(len(kinds).bit_length() - 1, -1, -1):
        high = (rank >> bit) & 1 == 1
        lows = np.concatenate(([0], np.cumsum(~high)))
        sums = np.concatenate(([0], np.cumsum(np.where(high, 0, n))))
        above = (limit >> bit) & 1 == 1
        total += np.where(above, sums[last] - sums[first], 0)
        first = np.where(above, lows[-1] + first - lows[first], lows[first])
        last = np.where(above, lows[-1] + last - lows[last], lows[last])
        parted = np.concatenate((np.flatnonzero(~high), np.flatnonzero(high)))
        rank, n = rank[parted], n[parted]
    return total
