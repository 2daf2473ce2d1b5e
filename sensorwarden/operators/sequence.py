"""Per-node message sequence: whitelist, replay marks, previous reading, fault and recovery.

Everything downstream (events, health, counters) reads the columns produced here, so the messages are
shuffled and sorted once, on (node_id, span), with seq as the arrival order. ``seq`` must be unique.

A node that owns a large part of the rows is cut into seq spans (see ``skew``), and the sequence becomes a
segmented scan: every span is followed on its own, its rows are kept, summarised to one row per span, and what
earlier spans hand over - highest id, last accepted reading, run of good messages, fault flag - is worked into
the rows by arithmetic. The state of the previous micro-batch is an opening row of a cold node and a span before
all others of a hot one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sensorwarden.config import Rules
from sensorwarden.operators.skew import hot_spans, is_small, lookup, with_span
from sensorwarden.schemas import LAST_FIELDS, LAST_READING
from sensorwarden.session import cut_lineage

FIRST_SEQ = -(2**63)

# Columns of the opening rows that messages do not have.
EDGE_COLUMNS = {
    "opens": "boolean",
    "streak_in": "int",
    "faulty_in": "boolean",
    "last_in": f"struct<{LAST_READING}>",
}


def _before() -> WindowSpec:
    return Window.partitionBy("node_id", "span").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)


def _up_to() -> WindowSpec:
    whole = Window.partitionBy("node_id", "span").orderBy("seq")
    return whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def screen(readings: DataFrame, devices: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Whitelist check: ``known`` is true for nodes in ``devices``; also their stored id mark."""
    listed = devices.select(
        "node_id", F.col("id").alias("device_id"), F.col("last_msg_id").alias("seed"), F.lit(True).alias("_listed")
    )
    joined = lookup(readings, listed, "node_id", rules.broadcast_rows)
    return joined.withColumn("known", _true(F.col("_listed"))).drop("_listed")


def mark_replays(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds ``mark`` (highest id seen before), ``replay`` and ``fresh`` (known and not a replay).

    Replayed ids never exceed the mark, so the running maximum over all known rows equals the mark of the
    accepted ones. A mark of 0 means no history and accepts anything.
    """
    seen = F.max(F.when(F.col("known"), F.col("msg_id"))).over(_before())
    mark = F.greatest(F.coalesce("seen", F.lit(0)), F.coalesce(F.col("seed"), F.lit(0)))
    replay = F.col("known") & (F.col("mark") != 0) & (F.col("msg_id") <= F.col("mark"))
    is_row = F.col("opens").isNull()
    return (
        rows.withColumn("seen", seen)
        .withColumn("mark", mark)
        .withColumn("replay", is_row & (replay if rules.replay_detection else F.lit(False)))
        .withColumn("fresh", is_row & F.col("known") & ~F.col("replay"))
    )


def _last_reading() -> Column:
    return F.struct(*[F.col(name) for name in LAST_FIELDS])


def _in_fault(fault_at: Column, healed_at: Column) -> Column:
    return fault_at.isNotNull() & (healed_at.isNull() | (healed_at < fault_at))


def follow(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds the state around each fresh message.

    ``accepted``   fresh and not NOT_OPERATING
    ``prev``       last accepted reading before this row
    ``next_at``    arrival of the next fresh message of the node
    ``streak``     length of the run of OPERATIONAL messages ending here
    ``recovered``  this message completes the run that ends a fault
    ``faulty``     node is in a fault after this message
    """
    opening = _true(F.col("opens"))
    fresh, good, fault = F.col("fresh"), F.col("good"), F.col("fault")
    full_run = good & (F.col("streak") >= rules.recovery_count)
    flagged = (
        rows.withColumn("good", fresh & _true(F.col("status") == "OPERATIONAL"))
        .withColumn("fault", fresh & _true(F.col("status") == "NOT_OPERATING"))
        .withColumn("accepted", fresh & ~fault)
        .withColumn("_arrival", F.when(fresh, F.col("received_at")))
    )
    # everything that depends on single rows, then run lengths, then completed runs: same partitioning and sort
    last_seen = F.when(opening, F.col("last_in")).when(F.col("accepted"), _last_reading())
    return (
        flagged.withColumns(
            {
                "prev": F.last(last_seen, ignorenulls=True).over(_before()),
                "next_at": F.expr("lead(_arrival) ignore nulls over (partition by node_id, span order by seq)"),
                "ordinal": F.coalesce(
                    F.sum(F.when(opening, F.col("streak_in")).when(fresh, F.lit(1))).over(_up_to()), F.lit(0)
                ),
                "fault_at": F.max(F.when(fault | (opening & F.col("faulty_in")), F.col("seq"))).over(_up_to()),
            }
        )
        .withColumn("broken_at", F.max(F.when(fresh & ~good, F.col("ordinal"))).over(_up_to()))
        .withColumn("streak", (F.col("ordinal") - F.coalesce(F.col("broken_at"), F.lit(0))).cast("int"))
        .withColumn("healed_at", F.max(F.when(full_run, F.col("seq"))).over(_before()))
        .withColumn("recovered", full_run & _in_fault(F.col("fault_at"), F.col("healed_at")))
        .withColumn("faulty", _in_fault(F.col("fault_at"), F.col("healed_at")) & ~F.col("recovered"))
    )


def count_hot(readings: DataFrame, rules: Rules = Rules()) -> DataFrame | bool:
    """The nodes that are cut into spans of about ``chunk_rows`` rows; False if no node is that large."""
    return hot_spans(readings, "node_id", "seq", rules.hot_rows, rules.chunk_rows)


def spans(readings: DataFrame, devices: DataFrame, rules: Rules, hot: DataFrame | bool) -> DataFrame:
    return with_span(screen(readings, devices, rules), "node_id", "seq", hot, rules.broadcast_rows)


def trace(
    readings: DataFrame,
    devices: DataFrame,
    rules: Rules = Rules(),
    state: DataFrame | None = None,
    hot: DataFrame | bool | None = None,
) -> DataFrame:
    """All readings, each with the verdict columns of ``screen``, ``mark_replays`` and ``follow``.

    ``state`` is what ``node_state`` returned for all earlier messages; ``hot`` may be what ``count_hot`` returned when
    the caller has it, otherwise nodes are counted.
    """
    if hot is None:
        hot = count_hot(readings, rules)
    rows = spans(readings, devices, rules, hot)
    followed = follow(mark_replays(_opened(rows, state, hot), rules), rules)
    if hot is not False:
        followed = cut_lineage(followed)  # read by the summaries and by the result
        followed = _continued(followed, _handed_over(followed, state, hot, rules), rules)
    return _messages(followed)


def replays(
    readings: DataFrame,
    devices: DataFrame,
    rules: Rules = Rules(),
    state: DataFrame | None = None,
    hot: DataFrame | bool | None = None,
) -> DataFrame:
    """Like ``trace`` but only up to the replay verdict."""
    if hot is None:
        hot = count_hot(readings, rules)
    rows = spans(readings, devices, rules, hot)
    marked = mark_replays(_opened(rows, state, hot), rules)
    if hot is not False:
        # the marks of spans need no order: a narrow aggregation of the rows as they come
        marked = _with_table(marked, _marks_before(rows.filter(F.col("known") & F.col("hot")), state, hot, rules), rules)
        past = F.coalesce(_past(), F.lit(True))
        marked = marked.withColumns(
            {
                "mark": F.greatest("mark", "carried"),
                "replay": F.when(past, F.col("replay")).otherwise(F.col("known")),
                "fresh": F.col("fresh") & past,
            }
        ).drop("carried")
    return _messages(marked)


def node_state(traced: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """What has to be remembered per node after these messages; combined map-side."""
    fresh_seq, accepted_seq = F.when(F.col("fresh"), F.col("seq")), F.when(F.col("accepted"), F.col("seq"))
    after = (
        traced.filter("known")
        .groupBy("node_id")
        .agg(
            F.max(F.when(F.col("fresh"), F.col("msg_id"))).alias("mark"),
            F.max_by("streak", fresh_seq).alias("streak"),
            F.max_by("faulty", fresh_seq).alias("faulty"),
            F.max_by(_last_reading(), accepted_seq).alias("last"),
        )
    )
    if state is None:
        return after
    new, old = after.alias("new"), state.alias("old")
    return new.join(old, "node_id", "full_outer").select(
        "node_id",
        F.greatest("new.mark", "old.mark").alias("mark"),
        F.coalesce("new.streak", "old.streak").alias("streak"),
        F.coalesce("new.faulty", "old.faulty").alias("faulty"),
        F.coalesce("new.last", "old.last").alias("last"),
    )


# --- state of earlier batches --------------------------------------------------------------------------


def _opened(rows: DataFrame, state: DataFrame | None, hot: DataFrame | bool) -> DataFrame:
    """The rows with an opening row before the first message of every cold node that has a state."""
    if state is None:
        return rows.withColumns({name: F.lit(None).cast(kind) for name, kind in EDGE_COLUMNS.items()})
    cold = state if hot is False else state.join(hot.select("node_id"), "node_id", "left_anti")
    opening = cold.select(
        "node_id",
        F.lit(0).cast("bigint").alias("span"),
        F.lit(True).alias("known"),
        F.lit(FIRST_SEQ).alias("seq"),
        F.col("mark").alias("msg_id"),
        F.lit(None).cast("bigint").alias("received_at"),
        F.lit(True).alias("opens"),
        F.col("streak").alias("streak_in"),
        F.col("faulty").alias("faulty_in"),
        F.col("last").alias("last_in"),
    )
    return rows.unionByName(opening, allowMissingColumns=True)


def _messages(rows: DataFrame) -> DataFrame:
    working = [*EDGE_COLUMNS, "hot", "seen", "_arrival", "ordinal", "fault_at", "broken_at", "healed_at"]
    return rows.filter(F.col("opens").isNull()).drop(*working)


def _hot_state(state: DataFrame | None, hot: DataFrame | bool) -> DataFrame | None:
    """Earlier state of the hot nodes as a span before all others."""
    if state is None:
        return None
    return state.join(hot.select("node_id"), "node_id", "left_semi").withColumn("span", F.lit(FIRST_SEQ))


# --- what spans of hot nodes hand over -----------------------------------------------------------------


def _spans() -> WindowSpec:
    return Window.partitionBy("node_id").orderBy("span")


def _earlier_spans() -> WindowSpec:
    return _spans().rowsBetween(Window.unboundedPreceding, -1)


def _up_to_span() -> WindowSpec:
    return _spans().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _with_table(rows: DataFrame, table: DataFrame, rules: Rules) -> DataFrame:
    """Left join of a table with one row per span."""
    small = is_small(table, rules.broadcast_rows)
    return rows.join(F.broadcast(table) if small else table, ["node_id", "span"], "left")


def _marks_before(hot_rows: DataFrame, state: DataFrame | None, hot: DataFrame | bool, rules: Rules) -> DataFrame:
    """(node_id, span, carried): the highest id in earlier spans, 0 if there is none."""
    highest = hot_rows.groupBy("node_id", "span").agg(F.max("msg_id").alias("top"))
    initial = _hot_state(state, hot)
    if initial is not None:
        highest = highest.unionByName(initial.select("node_id", "span", F.col("mark").alias("top")))
    earlier = F.greatest(F.coalesce(F.max("top").over(_earlier_spans()), F.lit(0)), F.lit(0))
    carried = earlier if rules.replay_detection else F.lit(0).cast("bigint")
    return cut_lineage(highest.select("node_id", "span", carried.alias("carried")))


def _past() -> Column:
    """Whether the span has left behind the ids it was handed over.

    All rows before its first id above ``carried`` are replays, and from that row on the ids of the span itself decide:
    so the verdict of the span on its own is right for the rows after this point, and all others are replays.
    """
    return (F.col("carried") == 0) | (F.greatest("seen", "msg_id") > F.col("carried"))


def _handed_over(followed: DataFrame, state: DataFrame | None, hot: DataFrame | bool, rules: Rules) -> DataFrame:
    """One row per span of a hot node: what it needs from earlier spans, and where its own sequence begins.

    Two aggregations over the kept rows that combine map-side (ids, then the rest), and running values over the small
    table of spans.
    """
    part = followed.filter(F.col("known") & F.col("hot") & F.col("opens").isNull())
    part = _with_table(part, _marks_before(part, state, hot, rules), rules).withColumn("past", _past())
    fresh = F.col("past") & F.col("fresh")

    def seq_of(condition: Column) -> Column:
        return F.when(F.col("past") & condition, F.col("seq"))

    broken = F.struct("seq", "ordinal")
    full_run = F.col("good") & (F.col("streak") >= rules.recovery_count)
    summary = part.groupBy("node_id", "span").agg(
        F.first("carried").alias("carried"),
        F.coalesce(F.max(F.when(~F.col("past"), F.col("ordinal"))), F.lit(0)).alias("skipped"),
        F.min(seq_of(F.lit(True))).alias("begins"),
        F.max("ordinal").alias("ordinals"),
        F.min(F.when(fresh & ~F.col("good"), broken)).alias("break"),
        F.max_by("streak", seq_of(F.col("fresh"))).alias("last_run"),
        F.max(seq_of(full_run)).alias("full_end"),
        F.max(seq_of(F.col("fault"))).alias("fault_at"),
        F.max_by(_last_reading(), seq_of(F.col("accepted"))).alias("last"),
        F.min_by("received_at", seq_of(F.col("fresh"))).alias("first_at"),
    )
    leading_end = F.when(F.col("break").isNotNull(), F.col("break.ordinal") - 1).otherwise(F.col("ordinals"))
    summary = summary.withColumn("broken", F.col("break").isNotNull()).withColumn("leading_run", leading_end - F.col("skipped"))
    initial = _hot_state(state, hot)
    if initial is not None:
        before = initial.select(
            "node_id",
            "span",
            "last",
            F.lit(True).alias("broken"),
            F.lit(0).cast("bigint").alias("leading_run"),
            F.col("streak").alias("last_run"),
            F.when(F.col("faulty"), F.lit(FIRST_SEQ)).alias("fault_at"),
        )
        summary = summary.unionByName(before, allowMissingColumns=True)
    run_total = F.sum(F.when(F.col("broken"), F.col("last_run")).otherwise(F.col("leading_run"))).over(_up_to_span())
    run_base = F.max(F.when(F.col("broken"), F.col("run_total") - F.col("last_run"))).over(_up_to_span())
    # a fault of the span comes after its leading run, so any seq of that run may stand for the end of the old fault
    leading_heals = (F.col("leading_run") > 0) & (F.col("run_in") + F.col("leading_run") >= rules.recovery_count)
    own_heals = F.col("full_end") > F.col("break.seq")
    carried = (
        summary.withColumn("run_total", run_total)
        .withColumn("run_out", F.col("run_total") - F.coalesce(run_base, F.lit(0)))
        .withColumn("run_in", F.lag("run_out", 1, 0).over(_spans()))
        .withColumn("healed_at", F.greatest(F.when(own_heals, F.col("full_end")), F.when(leading_heals, F.col("begins"))))
        .withColumn("fault_in", F.max("fault_at").over(_earlier_spans()))
        .withColumn("healed_in", F.max("healed_at").over(_earlier_spans()))
        .withColumn("last_before", F.last("last", ignorenulls=True).over(_earlier_spans()))
        .withColumn("next_in", F.expr("lead(first_at) ignore nulls over (partition by node_id order by span)"))
        .filter(F.col("span") > FIRST_SEQ)
    )
    return cut_lineage(
        carried.select(
            "node_id",
            "span",
            "carried",
            "skipped",
            "begins",
            F.col("break.seq").alias("break_seq"),
            F.col("break.ordinal").alias("break_ordinal"),
            "run_in",
            _in_fault(F.col("fault_in"), F.col("healed_in")).alias("fault_before"),
            "last_before",
            "first_at",
            "next_in",
        )
    )


def _continued(followed: DataFrame, table: DataFrame, rules: Rules) -> DataFrame:
    """The rows of hot nodes as they are after all earlier spans: arithmetic on each row, no further order needed.

    ``skipped`` fresh rows of the span alone are replays, and its sequence ``begins`` at a seq. What happened after its
    first break, or after a fault of its own, does not depend on earlier spans; before that their run and fault go on.
    """
    joined = _with_table(followed, table, rules)
    mine = F.col("carried").isNotNull()
    past = _past()
    fresh = F.col("fresh") & past
    broke = _true(F.col("broken_at") > F.col("skipped"))
    run = F.col("ordinal") - F.col("skipped")
    streak = F.when(broke, F.col("streak")).otherwise(F.when(past, F.col("run_in") + run).otherwise(F.col("run_in")))
    full_run = F.col("good") & past & (F.col("run") >= rules.recovery_count)
    lead = F.when(broke, F.col("break_ordinal") - 1 - F.col("skipped")).otherwise(run - fresh.cast("int"))
    healed = ((lead > 0) & (F.col("run_in") + lead >= rules.recovery_count)) | _true(F.col("healed_at") > F.col("break_seq"))
    own_fault = _true(F.col("fault_at") >= F.col("begins"))
    in_fault = F.when(own_fault, _in_fault(F.col("fault_at"), F.col("healed_at"))).otherwise(
        F.col("fault_before") & ~(past & healed)
    )
    joined = joined.withColumn("run", streak).withColumn("in_fault", in_fault)
    new = {
        "mark": F.greatest("mark", "carried"),
        "replay": F.when(past, F.col("replay")).otherwise(F.col("known")),
        "fresh": fresh,
        "good": F.col("good") & past,
        "fault": F.col("fault") & past,
        "accepted": F.col("accepted") & past,
        "prev": F.when(F.col("prev.seq") >= F.col("begins"), F.col("prev")).otherwise(F.col("last_before")),
        "next_at": F.coalesce(F.when(past, F.col("next_at")).otherwise(F.col("first_at")), F.col("next_in")),
        "streak": F.col("run").cast("int"),
        "recovered": full_run & F.col("in_fault"),
        "faulty": F.col("in_fault") & ~(full_run & F.col("in_fault")),
    }
    replaced = {name: F.when(mine, value).otherwise(F.col(name)) for name, value in new.items()}
    return joined.withColumns(replaced).select(*followed.columns)
