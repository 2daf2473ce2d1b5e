"""Shapes that keep every task bounded when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorwarden.session import cut_lineage


#: Cut points are taken from a grid of this many quantiles.
GRID = 1024

#: Borders that are compared at once when a row looks for its span.
BLOCK = 32

#: A message takes at least so many bytes of a table, a row of a keyed table at most so many while it is small.
LEAST_ROW_BYTES, KEYED_ROW_BYTES = 8, 10


def estimated_bytes(frame: DataFrame) -> int:
    """Size of a frame as the planner knows it from file sizes and literals, without a job; huge where it knows nothing."""
    return int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_spans(rows: DataFrame, key: str, order: str, limit: int, width: int) -> DataFrame | bool:
    """(key, tops, borders) of every key with more than ``limit`` rows, False if there is none.

    A table too small to hold that many rows is not counted at all. Otherwise the keys are counted (combined map-side),
    and for hot ones approximate quantiles of ``order`` become the borders of spans of about ``width`` rows, twice that
    at most, however the values are spread. A key with more than ``GRID`` times ``width`` rows gets ``GRID`` spans.
    ``order`` is unique. Which borders are chosen never changes a result.
    """
    if estimated_bytes(rows) < limit * LEAST_ROW_BYTES:
        return False
    sizes = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = cut_lineage(sizes.filter(F.col("n") > limit))
    if hot.isEmpty():
        return False
    grid = F.percentile_approx(order, F.array(*[F.lit(i / GRID) for i in range(1, GRID)]), 10_000)
    quantiles = rows.select(key, order).join(hot, key).groupBy(key).agg(F.first("n").alias("n"), grid.alias("grid"))
    spans = F.least(F.expr(f"(n + {width - 1}) div {width}"), F.lit(GRID)).cast("int")
    cuts = F.filter(F.sequence(F.lit(1), F.lit(GRID - 1)), lambda i: (i * F.col("spans")) % GRID < F.col("spans"))
    borders = F.array_distinct(F.transform(cuts, lambda i: F.element_at("grid", i)))
    tops = F.filter("borders", lambda _, i: i % BLOCK == BLOCK - 1)
    table = quantiles.withColumn("spans", spans).withColumn("borders", borders).select(key, tops.alias("tops"), "borders")
    return cut_lineage(table)


def with_span(rows: DataFrame, key: str, order: str, hot: DataFrame | bool, limit: int) -> DataFrame:
    """Adds ``span`` (0 for keys that are not cut) and ``hot``: the borders at or below the row's value, in two steps."""
    # rows without a key have no sequence: they are spread
    whole = F.when(F.col(key).isNull(), F.pmod(F.col(order), F.lit(GRID))).otherwise(F.lit(0)).cast("bigint")
    if hot is False:
        return rows.withColumns({"span": whole, "hot": F.lit(False)})
    table = hot.select(key, F.col("tops").alias("_tops"), F.col("borders").alias("_borders"))
    joined = rows.join(F.broadcast(table) if is_small(table, limit) else table, key, "left")
    at = F.col(order)
    joined = joined.withColumn("_blocks", F.size(F.filter("_tops", lambda b: b <= at)))
    rest = F.slice("_borders", F.col("_blocks") * BLOCK + 1, BLOCK)
    span = F.col("_blocks") * BLOCK + F.size(F.filter(rest, lambda b: b <= at))
    return joined.withColumns(
        {
            "span": F.when(F.col("_borders").isNotNull(), span).otherwise(whole).cast("bigint"),
            "hot": F.col("_borders").isNotNull(),
        }
    ).drop("_tops", "_borders", "_blocks")


def is_small(table: DataFrame, limit: int) -> bool:
    """Whether a table has at most ``limit`` rows; only counted, up to there, where its size does not show it."""
    return estimated_bytes(table) <= limit * KEYED_ROW_BYTES or table.limit(limit + 1).count() <= limit


def lookup(rows: DataFrame, table: DataFrame, key: str, limit: int) -> DataFrame:
    """Left join of a table with unique keys: broadcast up to ``limit`` rows, beyond that a join whose skewed partitions
    adaptive execution splits.
    """
    return rows.join(F.broadcast(table) if is_small(table, limit) else table, key, "left")


def ranked(rows: DataFrame, order: str, name: str, start: Column | int = 0) -> DataFrame:
    """1-based rank by a unique BIGINT column without sorting everything in one task.

    The rows are dealt to value ranges and kept; they are numbered inside each range and moved by the sizes of the ranges
    before it. What meets in one task is a row per range.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, order).withColumn("_range", F.spark_partition_id())
    dealt = cut_lineage(dealt)
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return (
        dealt.withColumn("_within", within)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_offset") + F.col("_within") + start).cast("bigint"))
        .drop("_range", "_offset", "_within")
    )


#: Keys that a sketch follows, and keys it may name: a bound of the table that is broadcast.
SKETCHED, HEAVY = 10_000, 1_000


def heavy_keys(rows: DataFrame, key: str, width: int) -> DataFrame:
    """(key, slices) of keys with more than about ``width`` rows, at most ``HEAVY`` of them, from a sketch.

    One pass over one column that combines map-side; a key the sketch misses only stays whole.
    """
    sketch = rows.filter(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k({key}, {HEAVY}, {SKETCHED})").alias("top"))
    top = sketch.select(F.explode("top").alias("t")).select(F.col("t.item").alias(key), F.col("t.count").alias("n"))
    return top.filter(F.col("n") > width).select(key, F.ceil(F.col("n") / width).cast("int").alias("slices"))


def sliced_join(rows: DataFrame, table: DataFrame, key: str, spread: str, width: int, how: str = "inner") -> DataFrame:
    """Join of a table with unique keys that is too large to broadcast: heavy keys are cut into slices by a sketch of the
    rows, and only their table rows are repeated, once per slice.
    """
    heavy = F.broadcast(cut_lineage(heavy_keys(rows, key, width)))
    one = F.coalesce("slices", F.lit(1))
    sliced = rows.join(heavy, key, "left").withColumn("_slice", F.pmod(F.xxhash64(spread), one).cast("int")).drop("slices")
    copies = table.join(heavy, key, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), one - 1))).drop("slices")
    return sliced.join(copies, [key, "_slice"], how).drop("_slice")
