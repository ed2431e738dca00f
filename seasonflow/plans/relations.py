"""Join, set and nested-data patterns (J02, J03, J05, J06, J12, J17, J18, U01,
U03, U04, S03; M11–M16, M43, M64; C05, C10, C11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonflow.operators import joins as J
from seasonflow.operators.reshape import role_unpivot_counts, union_distinct, union_roles
from seasonflow.plans.registry import register, sql
from seasonflow.plans.testbed import Bed

AS_OF = dt.date(2000, 1, 1)   # dashboard "today" parameter for the upcoming-games cards


def semi_join(spark: SparkSession, root: str) -> DataFrame:
    """``o_orderkey IN (select l_orderkey from returned lines)``."""
    bed = Bed(spark, root)
    o = bed.t("orders", "o_orderkey", "o_custkey", "o_orderstatus")
    r = bed.t("lineitem", "l_orderkey", "l_returnflag").filter(F.col("l_returnflag") == "R")
    return J.semi(o, r, o.o_orderkey == r.l_orderkey)


register("semi_join", sql("""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
"""))(semi_join)


def anti_join(spark: SparkSession, root: str) -> DataFrame:
    """Null-aware ``NOT IN`` — orders that have no line."""
    bed = Bed(spark, root)
    o = bed.t("orders", "o_orderkey", "o_custkey", "o_orderstatus")
    return J.not_in(o, "o_orderkey", bed.t("lineitem", "l_orderkey"), "l_orderkey")


register("anti_join", sql("""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
"""))(anti_join)


def dim_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Games left-joined to the (fixed-size, broadcast) team dimension."""
    bed = Bed(spark, root)
    t = bed.teams().select(F.col("team").alias("home_team"), F.col("team_name").alias("home_name"),
                           F.col("conference").alias("home_conference"))
    return J.lookup(bed.games().select("game_id", "season", "home_team"), t, "home_team")


register("dim_lookup", sql("""
SELECT game_id, season, home_team, t.team_name AS home_name, t.conference AS home_conference
FROM games LEFT JOIN teams t ON home_team = t.team
"""))(dim_lookup)


def role_playing_join(spark: SparkSession, root: str) -> DataFrame:
    """The team dimension joined once as home and once as away."""
    bed = Bed(spark, root)
    g = bed.universe().select("game_id", "game_date", "home_team", "away_team")
    out = J.role_playing(g, bed.teams(), "team", {"home": "home_team", "away": "away_team"},
                         ["team_name", "conference"])
    return out.withColumn("same_conference", F.col("home_conference") == F.col("away_conference"))


register("role_playing_join", sql("""
SELECT game_id, game_date, home_team, away_team, h.team_name AS home_team_name, h.conference AS home_conference,
       a.team_name AS away_team_name, a.conference AS away_conference, h.conference = a.conference AS same_conference
FROM universe LEFT JOIN teams h ON home_team = h.team LEFT JOIN teams a ON away_team = a.team
"""))(role_playing_join)


def opponent_key_case(spark: SparkSession, root: str) -> DataFrame:
    """The opponent key is chosen by CASE on the player's side, then an
    equi-join to the team dimension."""
    bed = Bed(spark, root)
    pg = bed.player_games().select("game_id", "player", "team")
    u = bed.universe().select("game_id", "home_team", "away_team")
    j = pg.join(u, "game_id", "inner")
    j = J.key_by_case(j, "opponent", F.when(F.col("team") == F.col("home_team"), F.col("away_team"))
                                     .otherwise(F.col("home_team")))
    t = bed.teams().select(F.col("team").alias("opponent"), F.col("team_name").alias("opponent_name"))
    return J.lookup(j.select("game_id", "player", "team", "opponent"), t, "opponent")


register("opponent_key_case", sql("""
SELECT game_id, player, p.team,
       CASE WHEN p.team = home_team THEN away_team ELSE home_team END AS opponent, t.team_name AS opponent_name
FROM player_games p JOIN universe USING (game_id)
LEFT JOIN teams t ON t.team = CASE WHEN p.team = home_team THEN away_team ELSE home_team END
"""))(opponent_key_case)


def right_join_roster(spark: SparkSession, root: str) -> DataFrame:
    """Latest-season player totals RIGHT JOIN the roster (all kept)."""
    bed = Bed(spark, root)
    pg = bed.player_games()
    latest = pg.agg(F.max("season").alias("__s"))
    cur = (J.scalar_join(pg, latest).filter(F.col("season") == F.col("__s"))
             .groupBy("player").agg(F.count(F.lit(1)).alias("gp"), F.sum("goals").alias("goals")))
    roster = bed.t("supplier", "s_suppkey", "s_name")
    return cur.join(roster, cur.player == roster.s_suppkey, "right").select("s_suppkey", "s_name", "gp", "goals")


register("right_join_roster", sql("""
, cur AS (SELECT player, count(*) AS gp, CAST(sum(goals) AS BIGINT) AS goals FROM player_games
          WHERE season = (SELECT max(season) FROM player_games) GROUP BY player)
SELECT s_suppkey, s_name, gp, goals FROM cur RIGHT JOIN supplier ON player = s_suppkey
"""))(right_join_roster)


def _selected_team(bed: Bed) -> DataFrame:
    """Dashboard default: the team with the most regular home games (lowest id on ties)."""
    g = bed.games().filter(F.col("game_type") == 2).groupBy("home_team").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.col("n").desc(), F.col("home_team")).limit(1).select(F.col("home_team").alias("__sel"))


def either_side_filter(spark: SparkSession, root: str) -> DataFrame:
    """Games on or after ``as_of`` where the selected team plays on either side,
    with days until the game."""
    bed = Bed(spark, root)
    g = J.scalar_join(bed.games().filter(F.col("game_date") >= F.lit(AS_OF)), _selected_team(bed))
    g = g.filter((F.col("home_team") == F.col("__sel")) | (F.col("away_team") == F.col("__sel")))
    return g.select("game_id", "game_date", "home_team", "away_team",
                    (F.col("home_team") == F.col("__sel")).alias("is_home"),
                    F.datediff("game_date", F.lit(AS_OF)).alias("days_until"))


register("either_side_filter", sql(f"""
, sel AS (SELECT home_team AS s FROM games WHERE game_type = 2 GROUP BY home_team
          ORDER BY count(*) DESC, home_team LIMIT 1)
SELECT game_id, game_date, home_team, away_team, home_team = s AS is_home,
       CAST(date_diff('day', DATE '{AS_OF}', game_date) AS INTEGER) AS days_until
FROM games, sel WHERE game_date >= DATE '{AS_OF}' AND (home_team = s OR away_team = s)
"""))(either_side_filter)


def same_group_as_selected(spark: SparkSession, root: str) -> DataFrame:
    """The latest-season table of every team in the selected team's conference
    (``conference = (scalar subquery)``)."""
    from seasonflow.plans.league import latest_season_table
    bed = Bed(spark, root)
    t = latest_season_table(bed)
    sel = (t.orderBy(F.col("points").desc(), F.col("team")).limit(1)
             .select(F.col("conference").alias("__conf")))
    return (J.scalar_join(t, sel).filter(F.col("conference") == F.col("__conf"))
              .select("team", "conference", "gp", "points", "goal_diff"))


register("same_group_as_selected", sql("""
, lt AS (SELECT team, count(*) AS gp,
                count(*) FILTER (WHERE goals_for > goals_against) * 2 + count(*) FILTER (WHERE goals_for = goals_against) AS points,
                CAST(sum(goals_for) - sum(goals_against) AS BIGINT) AS goal_diff
         FROM sides WHERE game_type = 2 AND season = (SELECT max(season) FROM sides WHERE game_type = 2)
         GROUP BY team)
, lc AS (SELECT lt.*, t.conference FROM lt LEFT JOIN teams t USING (team))
SELECT team, conference, gp, points, goal_diff FROM lc
WHERE conference = (SELECT conference FROM lc ORDER BY points DESC, team LIMIT 1)
"""))(same_group_as_selected)


# ------------------------------------------------------------------ set ops
def union_all_roles(spark: SparkSession, root: str) -> DataFrame:
    """Role-specific listings stacked by name with a role tag."""
    bed = Bed(spark, root)
    c = bed.t("customer", "c_custkey", "c_name", "c_nationkey").toDF("person_id", "name", "team")
    s = bed.t("supplier", "s_suppkey", "s_name", "s_nationkey").toDF("person_id", "name", "team")
    return union_roles({"customer": c, "supplier": s})


register("union_all_roles", sql("""
SELECT c_custkey AS person_id, c_name AS name, c_nationkey AS team, 'customer' AS role FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, 'supplier' FROM supplier
"""))(union_all_roles)


def union_distinct_q(spark: SparkSession, root: str) -> DataFrame:
    """UNION (distinct) of the teams seen on either roster."""
    bed = Bed(spark, root)
    return union_distinct(bed.t("customer", "c_nationkey").toDF("team"),
                          bed.t("supplier", "s_nationkey").toDF("team"))


register("union_distinct", sql("""
SELECT c_nationkey AS team FROM customer UNION SELECT s_nationkey FROM supplier
"""))(union_distinct_q)


# ------------------------------------------------------------- nested data
SLOT_SCHEMA = T.ArrayType(T.StructType([T.StructField("slot", T.IntegerType()),
                                        T.StructField("v", T.IntegerType())]))


def array_unnest(spark: SparkSession, root: str) -> DataFrame:
    """A JSON array per row (bounded: built from that row),
    parsed with an explicit schema and unnested; empty arrays vanish (inner)."""
    p = Bed(spark, root).plays()
    arr = F.when(F.col("k") % 3 == 0, F.array().cast(SLOT_SCHEMA)).otherwise(
        F.array(F.struct(F.lit(1).alias("slot"), (F.col("k") % 10).alias("v")),
                F.struct(F.lit(2).alias("slot"), (F.col("k") / 10).cast("int").alias("v"))))
    landed = p.select("play_id", F.to_json(arr).alias("slots_json"))
    parsed = landed.select("play_id", F.from_json("slots_json", SLOT_SCHEMA).alias("slots"))
    return parsed.select("play_id", F.inline("slots"))


register("array_unnest", sql("""
SELECT play_id, 1 AS slot, k % 10 AS v FROM plays WHERE k % 3 <> 0
UNION ALL
SELECT play_id, 2, CAST(k // 10 AS INTEGER) FROM plays WHERE k % 3 <> 0
"""))(array_unnest)


PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


def json_props_agg(spark: SparkSession, root: str) -> DataFrame:
    """Typed JSON parse (PERMISSIVE: bad text -> NULL) and group by a field."""
    e = Bed(spark, root).t("events", "props", "value", "event_type")
    p = e.select(F.from_json("props", PROPS_SCHEMA).alias("p"), "value", "event_type")
    return p.groupBy((F.col("p.k") % 10).alias("k_bucket"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))


register("json_props_agg", sql("""
SELECT CAST(json_extract(props, '$.k') AS INTEGER) % 10 AS k_bucket, event_type, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY 1, 2
"""))(json_props_agg)


def role_unpivot_counts_q(spark: SparkSession, root: str) -> DataFrame:
    """Scorer, first and second assist columns unpivoted to
    (player, role) counts; NULL assists dropped."""
    bed = Bed(spark, root)
    p = J.scalar_join(bed.plays().filter(F.col("type") == "purchase"), bed.player_range())
    n = F.col("n_players")
    p = p.select("play_date", F.col("player").alias("scorer"),
                 ((F.col("player") + F.col("k")) % n).alias("assist1"),
                 F.when(F.col("k") % 2 == 1, (F.col("player") + 2 * F.col("k")) % n).alias("assist2"))
    return role_unpivot_counts(p, [], {"goal": "scorer", "assist1": "assist1", "assist2": "assist2"},
                               entity="player")


register("role_unpivot_counts", sql("""
, plays_n AS (SELECT plays.*, (SELECT max(user_id) + 1 FROM events) AS n FROM plays)
, r AS (SELECT player AS e, 'goal' AS role FROM plays WHERE type = 'purchase'
        UNION ALL SELECT (player + k) % n, 'assist1' FROM plays_n WHERE type = 'purchase'
        UNION ALL SELECT (player + 2 * k) % n, 'assist2' FROM plays_n WHERE type = 'purchase' AND k % 2 = 1)
SELECT e AS player, role, count(*) AS n FROM r WHERE e IS NOT NULL GROUP BY 1, 2
"""))(role_unpivot_counts_q)
