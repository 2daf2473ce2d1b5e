"""Topic filters and node names taken from topics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The subscribed topic filters.
TOPIC_DATA = "factory/sensors/+/data"
TOPIC_ALERT = "factory/sensors/+/alert"


def filter_to_regex(topic_filter: str) -> str:
    """A subscription filter as a regular expression; '+' is one level, a final '#' is all that follow."""
    levels = []
    for level in topic_filter.split("/"):
        if level == "+":
            levels.append("[^/]*")
        elif level == "#":
            levels.append(".*")
        else:
            levels.append("\\Q" + level + "\\E")
    return "^" + "/".join(levels) + "$"


def topic_matches(topic: Column, *topic_filters: str) -> Column:
    hit = F.lit(False)
    for topic_filter in topic_filters:
        hit = hit | topic.rlike(filter_to_regex(topic_filter))
    return hit


def usable_message(topic: Column, payload: Column, retain: Column) -> Column:
    """Retained messages and messages without topic or payload are not counted at all."""
    return (
        ~F.coalesce(retain, F.lit(False))
        & (F.coalesce(F.length(topic), F.lit(0)) > 0)
        & (F.coalesce(F.length(payload), F.lit(0)) > 0)
    )


def node_from_topic(topic: Column) -> Column:
    """Third level of a topic of at least four levels, else empty."""
    return F.when(F.size(F.split(topic, "/")) >= 4, F.split_part(topic, F.lit("/"), F.lit(3))).otherwise("")


def node_from_topic_prefix(topic: Column) -> Column:
    """Third level of a topic of at least three levels, else empty."""
    return F.split_part(topic, F.lit("/"), F.lit(3))


def command_topic(node_id: Column) -> Column:
    return F.concat(F.lit("factory/sensors/"), node_id, F.lit("/cmd"))
