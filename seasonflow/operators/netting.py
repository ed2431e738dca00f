"""Offset netting (M21): coincident opposing penalties cancel.

Per (group, side, clock, duration) count the eligible events; pair with the
other sides' count at the same (group, clock, duration); the side keeps
``n - least(n, opp_n)`` of them.  The events are read once: an aggregate per slot
and side, a window sum per slot and an aggregate per side (no self-join, no
per-group collection), all in place where events lie by ``group``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def offset_netting(events: DataFrame, group: Sequence[str], side: str,
                   clock: Sequence[str], duration: str, weight: str,
                   eligible: Column, out_prefix: str = "") -> DataFrame:
    """Return (group..., side, total_weight, n_events, n_net).

    * ``total_weight`` — sum of ``weight`` over all events of the side,
    * ``n_events``     — number of events,
    * ``n_net``        — eligible events left after cancelling against the
      opponent's eligible events at the same clock and duration.
    """
    g, slot = list(group), [*group, *clock, duration]
    slots = events.groupBy(*slot, side).agg(
        F.sum(weight).alias("__weight"), F.count(F.lit(1)).alias("__all"), F.count_if(eligible).alias("__n"))

    def known(cols: Sequence[str]) -> Column:
        return reduce(and_, [F.col(c).isNotNull() for c in cols])
    # several opposing sides at the same clock are summed (two sides in practice); a NULL meets nobody
    n = F.col("__n")
    met = F.sum(F.when(F.col(side).isNotNull(), n)).over(Window.partitionBy(*slot)) - n
    opp = F.when(known([*slot, side]), met).otherwise(F.lit(0))
    net = F.when(known([*g, side]), n - F.least(n, opp)).otherwise(F.lit(0))
    return (slots.withColumn("__net", net).groupBy(*g, side).agg(
        F.sum("__weight").alias(out_prefix + "total_weight"), F.sum("__all").alias(out_prefix + "n_events"),
        F.sum("__net").cast("bigint").alias(out_prefix + "n_net")))
