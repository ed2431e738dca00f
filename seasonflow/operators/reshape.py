"""Unpivots, role unions and pivots.

Unpivots are one narrow pass: ``inline(array(struct(...), struct(...)))``
turns a wide row into N rows without a shuffle or a second scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unpivot_structs(df: DataFrame, keep: Sequence[str],
                    branches: Sequence[Mapping[str, object]]) -> DataFrame:
    """One output row per branch; each branch maps output column -> Column/name/literal.

    All branches must produce the same column names (types are unified by
    ``array``'s element type).
    """
    names = list(branches[0].keys())
    structs = []
    for b in branches:
        if list(b.keys()) != names:
            raise ValueError("every branch must produce the same columns in the same order")
        fields = []
        for n in names:
            v = b[n]
            fields.append((_col(v) if isinstance(v, (str, Column)) else F.lit(v)).alias(n))
        structs.append(F.struct(*fields))
    return df.select(*keep, F.inline(F.array(*structs)))


def two_sided_unpivot(df: DataFrame, keep: Sequence[str], home: Mapping[str, str],
                      away: Mapping[str, str], side_col: str = "is_home") -> DataFrame:
    """Home/away wide game row -> two team rows with own/opponent columns swapped.

    ``home`` maps output names to the home-side input columns and ``away`` to
    the away-side ones; for every output ``x`` an ``opp_x`` column carries the
    other side's value.
    """
    outs = list(home.keys())
    h = {side_col: F.lit(True)}
    a = {side_col: F.lit(False)}
    for o in outs:
        h[o] = F.col(home[o])
        a[o] = F.col(away[o])
    for o in outs:
        h["opp_" + o] = F.col(away[o])
        a["opp_" + o] = F.col(home[o])
    return unpivot_structs(df, keep, [h, a])


def union_roles(frames: Mapping[str, DataFrame], role_col: str = "role") -> DataFrame:
    """UNION ALL of role-specific frames by name, tagging each with its role."""
    out = None
    for role, f in frames.items():
        f = f.withColumn(role_col, F.lit(role))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def role_unpivot_counts(df: DataFrame, keep: Sequence[str], roles: Mapping[str, str],
                        entity: str = "entity", role_col: str = "role",
                        count_col: str = "n") -> DataFrame:
    """Several id columns (e.g. assist1, assist2) -> (entity, role) counts.

    NULL ids are dropped.  Pre-aggregated with a partial hash aggregate, so a
    hot entity never lands whole in one task.
    """
    branches = [{entity: F.col(c), role_col: F.lit(r)} for r, c in roles.items()]
    long = unpivot_structs(df, keep, branches).filter(F.col(entity).isNotNull())
    return long.groupBy(*keep, entity, role_col).agg(F.count(F.lit(1)).alias(count_col))


def conditional_pivot(df: DataFrame, group: Sequence[str], on: str,
                      values: Sequence, measures: Mapping[str, str],
                      agg: str = "sum") -> DataFrame:
    """``sum(case when on = v then m end) as {v}_{name}`` for each v and measure.

    Equivalent to ``groupBy().pivot(on, values)`` but keeps the names explicit
    and NULL when no row matches.
    """
    fn = getattr(F, agg)
    cols = []
    for v in values:
        for name, m in measures.items():
            cols.append(fn(F.when(F.col(on) == F.lit(v), F.col(m))).alias(f"{v}_{name}"))
    return df.groupBy(*group).agg(*cols)
