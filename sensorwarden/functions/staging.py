"""Projection steps the optimizer does not merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(rows: DataFrame, *columns: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Projection whose costly columns are computed once.

    Filters on the result would otherwise be pushed below the projection and repeat the expressions; a
    one-element explode is a step they are not pushed through.
    """
    computed = rows.select(*keep, F.struct(*columns).alias("_once"))
    return computed.select(*keep, F.explode(F.array("_once")).alias("_row")).select(*keep, "_row.*")
