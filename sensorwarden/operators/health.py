"""Device health: offline detection, status timeline, liveness sessions, counters and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorwarden.config import Rules


def _column(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("bigint")


def scan_after_timeout(received_at: Column, rules: Rules) -> Column:
    """First scan (epoch multiple of the interval) strictly later than the timeout."""
    every = rules.scan_interval_s
    due = received_at + rules.offline_timeout_s
    return (F.floor(due / F.lit(every)) + 1) * every


def offline_at(as_of: Column | int, rules: Rules = Rules()) -> Column:
    """Scan at which the node is found silent after this accepted message, else NULL.

    The next fresh message decides: an accepted one ends the silence, a NOT_OPERATING one makes the node
    FAULTY, and both count as arrived when they share the second of the scan.
    """
    at = scan_after_timeout(F.col("received_at"), rules)
    silent = at < F.coalesce(F.col("next_at"), _column(as_of) + 1)
    return F.when(F.col("accepted") & ~F.col("faulty") & (F.col("received_at") > 0) & silent, at)


def offline_rows(traced: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    return traced.withColumn("offline_at", offline_at(as_of, rules)).filter(F.col("offline_at").isNotNull())


def closed_silences(traced: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Silences that a later message of the same frame ended; what is still open at its end is left to whoever goes on."""
    return offline_rows(traced.filter(F.col("next_at").isNotNull()), 0, rules)


def recoveries(traced: DataFrame) -> DataFrame:
    return traced.filter("recovered").select("seq", "node_id", "msg_id", "received_at")


def effective_status() -> Column:
    """Status after a fresh message: FAULTY until recovery, else what the device reports."""
    return F.when(F.col("faulty"), F.lit("FAULTY")).otherwise(F.col("status"))


def status_timeline(traced: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    """(seq, node_id, at, status, step): one row per status write; step 1 is the scan after the message."""
    reported = F.struct(
        F.col("received_at").alias("at"), effective_status().alias("status"), F.lit(0).alias("step")
    )
    at = offline_at(as_of, rules)
    offline = F.when(at.isNotNull(), F.struct(at.alias("at"), F.lit("OFFLINE").alias("status"), F.lit(1).alias("step")))
    return (
        traced.filter("fresh")
        .select("seq", "node_id", F.explode(F.array(reported, offline)).alias("s"))
        .filter(F.col("s").isNotNull())
        .select("seq", "node_id", "s.at", "s.status", "s.step")
    )


def status_as_of(timeline: DataFrame, at: Column | int) -> DataFrame:
    """Status of every node at a moment; combined map-side."""
    return (
        timeline.filter(F.col("at") <= _column(at))
        .groupBy("node_id")
        .agg(F.max_by(F.struct("status", "at"), F.struct("seq", "step")).alias("s"))
        .select("node_id", "s.status", F.col("s.at").alias("since"))
    )


def liveness_sessions(traced: DataFrame, rules: Rules = Rules(), spanned: bool = True) -> DataFrame:
    """Stretches of accepted messages without a gap above the timeout.

    A session is named by its first message, so it is a plain aggregation where the rows of a node lie. Sessions that run
    on from an earlier span of a hot node look their first message up; without hot nodes (not ``spanned``) there are none.
    """
    gap = F.col("received_at") - F.col("prev.received_at")
    starts = F.col("prev").isNull() | (gap > rules.offline_timeout_s)
    inside = (
        Window.partitionBy("node_id", "span").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pieces = (
        traced.filter("accepted")
        .withColumn("_start", F.when(starts, F.col("seq")))
        .withColumn("first_seq", F.max("_start").over(inside))
        .groupBy("node_id", "span", "first_seq")
        .agg(
            F.min("received_at").alias("started_at"),
            F.max("received_at").alias("last_at"),
            F.count(F.lit(1)).alias("messages"),
        )
    )
    if not spanned:
        return pieces.drop("span")
    earlier = Window.partitionBy("node_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    running = (
        pieces.groupBy("node_id", "span")
        .agg(F.max("first_seq").alias("_start"))
        .select("node_id", "span", F.max("_start").over(earlier).alias("_running"))
    )
    return (
        pieces.join(running, ["node_id", "span"], "left")
        .groupBy("node_id", F.coalesce("first_seq", "_running").alias("first_seq"))
        .agg(
            F.min("started_at").alias("started_at"),
            F.max("last_at").alias("last_at"),
            F.sum("messages").alias("messages"),
        )
    )


def node_metrics(traced: DataFrame, as_of: Column | int, rules: Rules = Rules()) -> DataFrame:
    """Running totals per node, over all its messages; one aggregation that combines map-side."""
    at = offline_at(as_of, rules)
    status = F.when(at.isNotNull(), F.lit("OFFLINE")).otherwise(effective_status())
    with_gas = F.when(F.col("accepted") & F.col("gas").isNotNull(), F.col("seq"))
    return (
        traced.groupBy("node_id")
        .agg(
            F.max("msg_id").alias("max_msg_id"),
            F.max("seed").alias("seed"),
            F.count_if("replay").alias("replay_count"),
            F.max_by(F.struct("gas", F.col("prev.gas").alias("prev_gas")), with_gas).alias("g"),
            F.count(F.lit(1)).alias("total_packets"),
            F.count_if("accepted").alias("valid_packets"),
            F.max_by(status, F.when(F.col("fresh"), F.col("seq"))).alias("current_status"),
            F.max("received_at").alias("last_seen_at"),
        )
        .select(
            "node_id",
            F.greatest(F.col("max_msg_id"), F.col("seed")).alias("last_msg_id"),
            "replay_count",
            F.coalesce("g.gas", F.lit(-1)).alias("gas"),
            F.coalesce("g.prev_gas", F.lit(-1)).alias("prev_gas"),
            "total_packets",
            "valid_packets",
            F.coalesce("current_status", F.lit("UNKNOWN")).alias("current_status"),
            "last_seen_at",
        )
    )
