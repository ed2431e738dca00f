"""Join patterns.

Broadcast policy: only one-row aggregates are broadcast by a hint.  Every other
side is joined plainly, and Spark broadcasts it only if its *measured* size is
under ``autoBroadcastJoinThreshold`` — the size check happens on real statistics,
with sort-merge as the fallback.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Attribute lookup."""
    return fact.join(dim, on, how)


def role_playing(fact: DataFrame, dim: DataFrame, dim_key: str,
                 roles: dict[str, str], attrs: Sequence[str], how: str = "left") -> DataFrame:
    """Join the same dimension once per role.

    ``roles`` maps a prefix to the fact column holding the key, e.g.
    ``{"home": "home_team", "away": "away_team"}``; attributes arrive as
    ``{prefix}_{attr}``.
    """
    out = fact
    for prefix, fk in roles.items():
        d = dim.select(F.col(dim_key).alias(f"__{prefix}_k"),
                       *[F.col(a).alias(f"{prefix}_{a}") for a in attrs])
        out = out.join(d, F.col(fk) == F.col(f"__{prefix}_k"), how).drop(f"__{prefix}_k")
    return out


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """``x IN (subquery)`` / EXISTS."""
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """NOT EXISTS."""
    return df.join(keys, on, "left_anti")


def not_in(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """SQL ``col NOT IN (select sub_col ...)`` with its NULL semantics.

    A NULL on the left qualifies only when the subquery is empty; a NULL
    anywhere in the subquery makes the predicate unknown for every row, so the
    result is empty.  Both facts are a one-row global aggregate (bounded,
    broadcast), and the anti join itself is a regular shuffle/broadcast join
    chosen by AQE.
    """
    sub_keys = sub.select(F.col(sub_col).alias("__k"))
    facts = sub_keys.agg(F.count(F.lit(1)).alias("__rows"), F.count_if(F.col("__k").isNull()).alias("__nulls"))
    kept = df.join(sub_keys.filter(F.col("__k").isNotNull()), F.col(col) == F.col("__k"), "left_anti")
    return (kept.crossJoin(F.broadcast(facts))
                .filter((F.col("__nulls") == 0) & (F.col(col).isNotNull() | (F.col("__rows") == 0)))
                .drop("__rows", "__nulls"))


def both_sides_in(games: DataFrame, participants: DataFrame, period_col: str,
                  home_col: str, away_col: str, team_col: str) -> DataFrame:
    """Keep a game only when both sides are participants of its period.

    Two left-semi joins against the distinct (period, team) list.
    """
    p = participants.select(period_col, team_col).distinct()
    ph = p.select(F.col(period_col).alias("__p"), F.col(team_col).alias("__t"))
    g = games.join(ph, (F.col(period_col) == F.col("__p")) & (F.col(home_col) == F.col("__t")), "left_semi")
    return g.join(ph, (F.col(period_col) == F.col("__p")) & (F.col(away_col) == F.col("__t")), "left_semi")


def opponent_join(df: DataFrame, group: Sequence[str], side: str,
                  cols: Sequence[str], prefix: str = "opp_",
                  how: str = "left") -> DataFrame:
    """Pair each side of a group with the other side(s).

    An equi-join on ``group`` with a ``side <> side`` residual.  As a left or inner
    join the frame is derived and shuffled once: a window lists the sides of the row's
    group (two in practice) and each row meets the others of that list.  A NULL in the
    group or the side meets nobody.
    """
    if how in ("left", "inner"):
        known = F.col(side).isNotNull()
        for g in group:
            known = known & F.col(g).isNotNull()
        peer = F.struct(F.col(side).alias(f"{prefix}{side}"), *[F.col(c).alias(f"{prefix}{c}") for c in cols])
        peers = F.collect_list(F.when(known, peer)).over(Window.partitionBy(*group))
        others = F.filter("__peers", lambda p: p[f"{prefix}{side}"] != F.col(side))
        meet = F.inline_outer if how == "left" else F.inline
        return df.withColumn("__peers", peers).select(*df.columns, meet(others))
    other = df.select(*[F.col(g).alias(f"__g_{g}") for g in group],
                      F.col(side).alias(f"{prefix}{side}"),
                      *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    cond = None
    for g in group:
        e = F.col(g) == F.col(f"__g_{g}")
        cond = e if cond is None else cond & e
    cond = cond & (F.col(side) != F.col(f"{prefix}{side}"))
    out = df.join(other, cond, how)
    return out.drop(*[f"__g_{g}" for g in group])


def within(df: DataFrame, other: DataFrame, place: str, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``place`` and ``keys`` of two frames that both lie by ``place`` (a game, with
    few rows each).  With every key in the equi-join Spark would place both frames anew by all
    of them; here the keys are compared among the rows of a place, so neither is moved."""
    o = {k: f"__o_{k}" for k in (place, *keys)}
    cond = F.col(place) == F.col(o[place])
    for k in keys:
        cond = cond & F.col(k).between(F.col(o[k]), F.col(o[k]))
    return df.join(other.withColumnsRenamed(o), cond, how).drop(*o.values())


def scalar_join(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row scalar result to every row.

    The scalar side is folded into exactly one row, whose values are NULL when it
    has none; with more than one row the query fails, as a SQL scalar subquery does.
    """
    cols = one_row.columns
    folded = one_row.agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in cols])
    checked = folded.select(*[F.when(F.col("__n") > 1, F.raise_error(F.lit("a scalar subquery gave more than one row")))
                              .otherwise(F.col(c)).alias(c) for c in cols])
    return df.crossJoin(F.broadcast(checked))


def key_by_case(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Materialise a CASE-chosen join key (J17) so the join stays an equi-join."""
    return df.withColumn(name, expr)


def keep_max(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` equals its global maximum (J16 ``= (select max ...)``).

    Written as an equi-join with the one-row maximum (broadcast), so when
    ``col`` is a partition column dynamic partition pruning skips the other
    partitions of the scan.
    """
    top = df.agg(F.max(col).alias(col))
    return df.join(F.broadcast(top), col, "inner")
