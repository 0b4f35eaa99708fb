"""Exact quantiles of groups of any size, without a list of a group's values.

A group of more than ``SLICE_ROWS`` rows is cut into slices at approximate quantiles next to the wanted ranks, so a row is
compared with two bounds a rank, however many slices there could be.  The counts of the slices tell which of them holds a
wanted rank, and only these are shuffled, each distinct value once a task, and sorted, each slice by a task of its own.
The result is exact wherever the cuts lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.exprs import join_on
from tickloom.sources.scratch import Scratch

#: Rows of a slice, roughly; groups of at most so many are one slice.
SLICE_ROWS = 1_000_000
#: Slices of a group at most, had it been cut everywhere.
SLICES = 4096


def _sliced(rows: DataFrame, by: Sequence[str], value: str, ranks: dict[str, Column], slice_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with ``__slice``, ascending with the value in each group, and the bounds of the groups of several slices.

    Of the approximate quantiles only two a rank are kept, a cell before and a cell behind the rank's own.
    """
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > slice_rows)
    most = sizes.agg(F.max("__n")).first()[0]
    if most is None:
        return rows.withColumn("__slice", F.lit(0)), None
    cuts = min(SLICES, -(-most // slice_rows))
    points = F.array(*[F.lit(k / cuts) for k in range(1, cuts)])
    big = join_on(rows, F.broadcast(sizes.select(*by)), by)  # rows over slice_rows of them at most
    grid = big.groupBy(*by).agg(F.percentile_approx(value, points, 20 * cuts).alias("__grid"), F.count(F.lit(1)).alias("__n"))
    cell = [F.floor(place * cuts / F.col("__n")).cast("int") for place in ranks.values()]
    near = [F.get("__grid", k) for c in cell for k in (c - 2, c + 1)]  # null beyond the ends
    # Written, so that every reader has the same: approximate quantiles may differ from run to run.
    bounds = Scratch(rows.sparkSession).write(grid.select(*by, *[b.alias(f"__b{k}") for k, b in enumerate(near)]))
    below = reduce(add, [F.when(F.col(f"__b{k}") < F.col(value), 1).otherwise(0) for k in range(len(near))])
    sliced = join_on(rows, F.broadcast(bounds.withColumn("__big", F.lit(True))), by, "left")
    return sliced.select(*by, value, below.alias("__slice"), "__big"), bounds


def at_ranks(df: DataFrame, by: Sequence[str], value: str, ranks: dict[str, Column], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """For each group the values at wanted places (from 0) of its sorted non-null values: a column for each of ``ranks``, expressions of ``__n``, the group's number of values."""
    rows = df.where(F.col(value).isNotNull()).select(*by, value)
    sliced, bounds = _sliced(rows, by, value, ranks, slice_rows)
    slices = sliced.groupBy(*by, "__slice").agg(F.count(F.lit(1)).alias("__in"))
    group = Window.partitionBy(*by)
    slices = slices.withColumns({"__n": F.sum("__in").over(group), "__before": F.sum("__in").over(group.orderBy("__slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__in")})
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), place.cast("long").alias("place")) for name, place in ranks.items()])
    wanted = slices.select(*by, "__slice", "__in", "__before", F.explode(wanted).alias("__w")).where((F.col("__w.place") >= F.col("__before")) & (F.col("__w.place") < F.col("__before") + F.col("__in")))
    asked = wanted.groupBy(*by, "__slice").agg(F.collect_list(F.struct(F.col("__w.name").alias("name"), (F.col("__w.place") - F.col("__before")).alias("at"))).alias("__asked"))  # no more than ``ranks``
    if bounds is not None:  # of large groups only the rows of wanted slices go on; these are ``ranks`` a large group at most
        held = join_on(asked, F.broadcast(bounds.select(*by)), by).select(*by, "__slice", F.lit(True).alias("__held"))
        sliced = join_on(sliced, F.broadcast(held), [*by, "__slice"], "left").where("__big is null or __held")
    counted = sliced.groupBy(*by, "__slice", value).agg(F.count(F.lit(1)).alias("__c"))
    inside = Window.partitionBy(*by, "__slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = join_on(counted, asked, [*by, "__slice"]).withColumn("__to", F.sum("__c").over(inside))
    hit = F.filter("__asked", lambda a: (a["at"] < F.col("__to")) & (a["at"] >= F.col("__to") - F.col("__c")))
    found = placed.select(*by, value, F.explode(hit).alias("__a"))
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("__a.name") == name, F.col(value))).alias(name) for name in ranks])


def nearest(q: float) -> Column:
    """Place of the nearest-rank quantile."""
    return F.floor((F.col("__n") - 1) * F.lit(q) + F.lit(0.5))


def nearest_quantiles(df: DataFrame, by: Sequence[str], value: str, points: dict[str, float], slice_rows: int = SLICE_ROWS) -> DataFrame:
    return at_ranks(df, by, value, {name: nearest(q) for name, q in points.items()}, slice_rows)


def linear_quantiles(df: DataFrame, by: Sequence[str], value: str, points: dict[str, float], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Quantiles with linear interpolation between the two neighbouring places, and ``__n``."""
    at = {name: (F.col("__n") - 1) * F.lit(q) for name, q in points.items()}
    places = {k: v for name, x in at.items() for k, v in ((f"__lo_{name}", F.floor(x)), (f"__hi_{name}", F.ceil(x)))}
    n = df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    both = join_on(at_ranks(df, by, value, places, slice_rows), n, by)
    share = {name: x - F.floor(x) for name, x in at.items()}
    return both.select(*by, "__n", *[(F.col(f"__lo_{name}") + (F.col(f"__hi_{name}") - F.col(f"__lo_{name}")) * share[name]).alias(name) for name in points])
