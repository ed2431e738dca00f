"""Play-by-play family on the events table: offset netting, actor attribution,
strength decode, shot-share rollup (M21, M39, M40, M55; A10, U04, J13).

Mapping of events to plays: ``purchase`` = goal, ``click`` = shot on goal,
``view`` = missed shot, ``error`` = penalty (and blocked shot for the
shot-share rollup), ``signup`` = faceoff.  The small integer ``k`` from the
JSON props drives secondary actors, durations and situation codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import joins as J
from seasonflow.operators.netting import offset_netting
from seasonflow.operators.reshape import unpivot_structs
from seasonflow.plans.registry import register, rr, sql
from seasonflow.plans.testbed import Bed


def _penalties(bed: Bed) -> DataFrame:
    p = bed.plays().filter(F.col("type") == "error")
    dur = (F.when(F.col("k") % 4 == 0, 2).when(F.col("k") % 4 == 1, 4)
            .when(F.col("k") % 4 == 2, 5).otherwise(10))
    return p.select((F.col("player") % 10).alias("game_id"),
                    ((F.col("player") / 10).cast("bigint") % 2).alias("side"),
                    F.col("play_date").alias("clock"), dur.alias("duration"))


def offset_netting_q(spark: SparkSession, root: str) -> DataFrame:
    """PIM, penalties and times short-handed after coincident minors/majors
    (2, 4, 5 min) cancel against the other side's at the same clock."""
    pen = _penalties(Bed(spark, root))
    out = offset_netting(pen, ["game_id"], "side", ["clock"], "duration", "duration",
                         F.col("duration").isin(2, 4, 5))
    return out.select("game_id", "side", F.col("total_weight").cast("bigint").alias("pim"),
                      F.col("n_events").alias("penalties"), F.col("n_net").alias("times_shorthanded"))


register("offset_netting", sql("""
, pen AS (SELECT player % 10 AS game_id, (player // 10) % 2 AS side, play_date AS clock,
                 CASE k % 4 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 5 ELSE 10 END AS duration
          FROM plays WHERE type = 'error')
, pp AS (SELECT game_id, side, clock, duration, count(*) AS n FROM pen WHERE duration IN (2, 4, 5) GROUP BY ALL)
, net AS (SELECT o.game_id, o.side, o.n - least(o.n, coalesce(x.n, 0)) AS v
          FROM pp o LEFT JOIN pp x ON x.game_id = o.game_id AND x.clock = o.clock AND x.duration = o.duration
                                   AND x.side <> o.side)
SELECT p.game_id, p.side, CAST(sum(duration) AS BIGINT) AS pim, count(*) AS penalties,
       CAST(coalesce((SELECT sum(v) FROM net WHERE net.game_id = p.game_id AND net.side = p.side), 0) AS BIGINT)
         AS times_shorthanded
FROM pen p GROUP BY p.game_id, p.side
"""))(offset_netting_q)


# -------------------------------------------------------------- attribution
def attributed_plays(bed: Bed) -> DataFrame:
    """Primary / secondary / tertiary actor by event type."""
    p = J.scalar_join(bed.plays(), bed.player_range())
    t, u, k, n = F.col("type"), F.col("player"), F.col("k"), F.col("n_players")
    primary = (F.when(t.isin("purchase", "click", "view", "signup"), u)
                .when(t == "error", F.when(k % 5 == 0, F.lit(None)).otherwise(u)))
    served = F.when((t == "error") & (k % 5 == 0), (u + 1) % n)
    secondary = (F.when(t == "purchase", (u + k) % n).when(t == "click", (u + 75) % n)
                  .when(t == "view", (u + k) % n).when(t == "error", (u + 2 * k) % n)
                  .when(t == "signup", (u + 1) % n))
    tertiary = F.when((t == "purchase") & (k % 2 == 1), (u + 2 * k) % n)
    return p.select("play_id", "play_date", "type",
                    F.coalesce(primary, served).alias("primary_player"),
                    secondary.alias("secondary_player"), tertiary.alias("tertiary_player"))


# Role names per (event type, actor slot).
ROLE_BY_SLOT = {
    "purchase": ("goal", "assist", "assist"),
    "click": ("shot", "shot_faced", None),
    "view": ("hit", "hit_taken", None),
    "error": ("penalty", "penalty_drawn", None),
    "signup": ("faceoff_won", "faceoff_lost", None),
}


def event_attribution(spark: SparkSession, root: str) -> DataFrame:
    """Actors unpivoted to (player, day) stat lines via role-tagged structs."""
    a = attributed_plays(Bed(spark, root))

    def role(slot):
        e = None
        for typ, roles in ROLE_BY_SLOT.items():
            if roles[slot] is None:
                continue
            e = (F.when(F.col("type") == typ, F.lit(roles[slot])) if e is None
                 else e.when(F.col("type") == typ, F.lit(roles[slot])))
        return e
    long = unpivot_structs(a, ["play_date"], [
        {"player": F.col("primary_player"), "role": role(0)},
        {"player": F.col("secondary_player"), "role": role(1)},
        {"player": F.col("tertiary_player"), "role": role(2)},
    ]).filter(F.col("player").isNotNull() & F.col("role").isNotNull())
    roles = ["goal", "assist", "shot", "shot_faced", "hit", "hit_taken", "penalty", "penalty_drawn",
             "faceoff_won", "faceoff_lost"]
    return long.groupBy("player", "play_date").agg(
        *[F.count_if(F.col("role") == r).alias(r + "s") for r in roles])


register("event_attribution", sql("""
, plays_n AS (SELECT plays.*, (SELECT max(user_id) + 1 FROM events) AS n FROM plays)
, r AS (
  SELECT play_date, player AS p, CASE type WHEN 'purchase' THEN 'goal' WHEN 'click' THEN 'shot' WHEN 'view' THEN 'hit'
         WHEN 'error' THEN 'penalty' ELSE 'faceoff_won' END AS role
  FROM plays_n WHERE NOT (type = 'error' AND k % 5 = 0)
  UNION ALL SELECT play_date, (player + 1) % n, 'penalty' FROM plays_n WHERE type = 'error' AND k % 5 = 0
  UNION ALL SELECT play_date, (player + k) % n, 'assist' FROM plays_n WHERE type = 'purchase'
  UNION ALL SELECT play_date, (player + 2 * k) % n, 'assist' FROM plays_n WHERE type = 'purchase' AND k % 2 = 1
  UNION ALL SELECT play_date, (player + 75) % n, 'shot_faced' FROM plays_n WHERE type = 'click'
  UNION ALL SELECT play_date, (player + k) % n, 'hit_taken' FROM plays_n WHERE type = 'view'
  UNION ALL SELECT play_date, (player + 2 * k) % n, 'penalty_drawn' FROM plays_n WHERE type = 'error'
  UNION ALL SELECT play_date, (player + 1) % n, 'faceoff_lost' FROM plays_n WHERE type = 'signup')
SELECT p AS player, play_date, count_if(role = 'goal') AS goals, count_if(role = 'assist') AS assists,
       count_if(role = 'shot') AS shots, count_if(role = 'shot_faced') AS shot_faceds,
       count_if(role = 'hit') AS hits, count_if(role = 'hit_taken') AS hit_takens,
       count_if(role = 'penalty') AS penaltys, count_if(role = 'penalty_drawn') AS penalty_drawns,
       count_if(role = 'faceoff_won') AS faceoff_wons, count_if(role = 'faceoff_lost') AS faceoff_losts
FROM r WHERE p IS NOT NULL GROUP BY 1, 2
"""))(event_attribution)


# ---------------------------------------------------------------- strength
def situation_plays(bed: Bed) -> DataFrame:
    """Situation code [away goalie][away skaters][home skaters][home goalie]:
    away skaters 3 + k%3, home skaters 3 + (k/3)%3, a goalie pulled when k%17 = 0
    (away) or k%19 = 0 (home); NULL code when k%23 = 0.  Event team: home
    (1) for even players, away (2) for odd."""
    p = bed.plays()
    k = F.col("k")
    code = F.concat(F.when(k % 17 == 0, "0").otherwise("1"), (3 + k % 3).cast("string"),
                    (3 + (k / 3).cast("int") % 3).cast("string"), F.when(k % 19 == 0, "0").otherwise("1"))
    code = F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(code)
    team = F.when(F.col("player") % 2 == 0, F.lit(1)).otherwise(F.lit(2))
    return p.select("play_id", "type", "player", "play_date", code.alias("situation_code"),
                    team.alias("event_team"))


def strength_decode(spark: SparkSession, root: str) -> DataFrame:
    """Strength state and power-play / short-handed / empty-net flags
    from the event team's point of view."""
    s = situation_plays(Bed(spark, root))
    cols = X.strength_columns("situation_code", "event_team", F.lit(1), F.lit(2))
    return s.select("play_id", "situation_code", "event_team", *[c.alias(n) for n, c in cols.items()])


_SITUATION_SQL = """
, sit AS (
  SELECT play_id, type, player, play_date,
         CASE WHEN k % 23 = 0 THEN NULL ELSE
           (CASE WHEN k % 17 = 0 THEN '0' ELSE '1' END) || CAST(3 + k % 3 AS VARCHAR) ||
           CAST(3 + (k // 3) % 3 AS VARCHAR) || (CASE WHEN k % 19 = 0 THEN '0' ELSE '1' END) END AS situation_code,
         CASE WHEN player % 2 = 0 THEN 1 ELSE 2 END AS event_team
  FROM plays)
, dec AS (
  SELECT sit.*,
    CASE WHEN length(situation_code) <> 4 THEN NULL WHEN event_team = 1 THEN TRY_CAST(substr(situation_code, 3, 1) AS INTEGER)
         ELSE TRY_CAST(substr(situation_code, 2, 1) AS INTEGER) END AS own_n,
    CASE WHEN length(situation_code) <> 4 THEN NULL WHEN event_team = 1 THEN TRY_CAST(substr(situation_code, 2, 1) AS INTEGER)
         ELSE TRY_CAST(substr(situation_code, 3, 1) AS INTEGER) END AS opp_n
  FROM sit)
, strength AS (
  SELECT dec.*,
    CASE WHEN length(situation_code) <> 4 OR event_team IS NULL THEN 'Other' WHEN own_n > opp_n THEN 'PP'
         WHEN own_n < opp_n THEN 'SH' ELSE 'Even' END AS strength_state,
    CASE WHEN length(situation_code) <> 4 OR event_team IS NULL THEN false ELSE own_n > opp_n END AS is_powerplay,
    CASE WHEN length(situation_code) <> 4 OR event_team IS NULL THEN false ELSE own_n < opp_n END AS is_shorthanded,
    CASE WHEN length(situation_code) <> 4 OR event_team IS NULL THEN false
         WHEN event_team = 1 THEN substr(situation_code, 1, 1) = '0'
         WHEN event_team = 2 THEN substr(situation_code, 4, 1) = '0' ELSE false END AS is_empty_net
  FROM dec)
"""
register("strength_decode", sql(_SITUATION_SQL + """
SELECT play_id, situation_code, event_team, strength_state, is_powerplay, is_shorthanded, is_empty_net FROM strength
"""))(strength_decode)


# --------------------------------------------------------------- shot share
def shot_share_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Corsi (goal, shot, missed, blocked), Fenwick (no blocked), the
    even-strength Corsi, and PDO per (season, team).  Games are (day, player%5),
    side = (player/5)%2, team = game slot * 2 + side; a blocked attempt belongs
    to the *other* side.  Attempts unpivot to a for-row and an against-row, then
    aggregate once (partial aggregation before the shuffle)."""
    bed = Bed(spark, root)
    s = situation_plays(bed)
    cols = X.strength_columns("situation_code", "event_team", F.lit(1), F.lit(2))
    s = s.withColumn("strength_state", cols["strength_state"])
    att = s.filter(F.col("type").isin("purchase", "click", "view", "error"))
    slot = F.col("player") % 5
    side = (F.col("player") / 5).cast("bigint") % 2
    own = slot * 2 + side
    other = slot * 2 + (1 - side)
    blocked = F.col("type") == "error"
    att = att.select(F.year("play_date").alias("season"),
                     F.when(blocked, other).otherwise(own).alias("shooter_team"),
                     F.when(blocked, own).otherwise(other).alias("defending_team"),
                     F.col("type"), (F.col("strength_state") == "Even").alias("even"))
    long = unpivot_structs(att, ["season", "type", "even"], [
        {"team": F.col("shooter_team"), "is_for": F.lit(True)},
        {"team": F.col("defending_team"), "is_for": F.lit(False)}])
    f, a = F.col("is_for"), ~F.col("is_for")
    fen = F.col("type") != "error"
    t = long.groupBy("season", "team").agg(
        F.count_if(f).alias("cf"), F.count_if(a).alias("ca"),
        F.count_if(f & fen).alias("ff"), F.count_if(a & fen).alias("fa"),
        F.count_if(f & F.col("even")).alias("cf_even"), F.count_if(a & F.col("even")).alias("ca_even"),
        F.count_if(f & (F.col("type") == "purchase")).alias("gf"),
        F.count_if(a & (F.col("type") == "purchase")).alias("ga"),
        F.count_if(f & (F.col("type") == "click")).alias("sf"),
        F.count_if(a & (F.col("type") == "click")).alias("sa"))
    num = (F.col("gf") * (F.col("ga") + F.col("sa")) + F.col("sa") * (F.col("gf") + F.col("sf"))) * 1000
    den = (F.col("gf") + F.col("sf")) * (F.col("ga") + F.col("sa"))
    return t.select("season", "team", "cf", "ca", "ff", "fa",
                    X.round_ratio(F.col("cf") * 100, F.col("cf") + F.col("ca"), 1).alias("corsi_pct"),
                    X.round_ratio(F.col("ff") * 100, F.col("ff") + F.col("fa"), 1).alias("fenwick_pct"),
                    X.round_ratio(F.col("cf_even") * 100, F.col("cf_even") + F.col("ca_even"), 1).alias("corsi_even_pct"),
                    X.round_ratio(num, den, 1).alias("pdo"))


register("shot_share_rollup", sql(_SITUATION_SQL + """
, att AS (
  SELECT CAST(year(play_date) AS INTEGER) AS season, type, strength_state = 'Even' AS even,
         CASE WHEN type = 'error' THEN (player % 5) * 2 + (1 - (player // 5) % 2) ELSE (player % 5) * 2 + (player // 5) % 2 END AS shooter_team,
         CASE WHEN type = 'error' THEN (player % 5) * 2 + (player // 5) % 2 ELSE (player % 5) * 2 + (1 - (player // 5) % 2) END AS defending_team
  FROM strength WHERE type IN ('purchase', 'click', 'view', 'error'))
, teams_x AS (SELECT DISTINCT season, shooter_team AS team FROM att UNION SELECT DISTINCT season, defending_team FROM att)
, t AS (
  SELECT x.season, x.team,
    (SELECT count(*) FROM att WHERE att.season = x.season AND shooter_team = x.team) AS cf,
    (SELECT count(*) FROM att WHERE att.season = x.season AND defending_team = x.team) AS ca,
    (SELECT count(*) FROM att WHERE att.season = x.season AND shooter_team = x.team AND type <> 'error') AS ff,
    (SELECT count(*) FROM att WHERE att.season = x.season AND defending_team = x.team AND type <> 'error') AS fa,
    (SELECT count(*) FROM att WHERE att.season = x.season AND shooter_team = x.team AND even) AS cfe,
    (SELECT count(*) FROM att WHERE att.season = x.season AND defending_team = x.team AND even) AS cae,
    (SELECT count(*) FROM att WHERE att.season = x.season AND shooter_team = x.team AND type = 'purchase') AS gf,
    (SELECT count(*) FROM att WHERE att.season = x.season AND defending_team = x.team AND type = 'purchase') AS ga,
    (SELECT count(*) FROM att WHERE att.season = x.season AND shooter_team = x.team AND type = 'click') AS sf,
    (SELECT count(*) FROM att WHERE att.season = x.season AND defending_team = x.team AND type = 'click') AS sa
  FROM teams_x x)
SELECT season, team, cf, ca, ff, fa, """ + rr("cf * 100", "cf + ca", 1) + """ AS corsi_pct,
       """ + rr("ff * 100", "ff + fa", 1) + """ AS fenwick_pct,
       """ + rr("cfe * 100", "cfe + cae", 1) + """ AS corsi_even_pct,
       """ + rr("(gf * (ga + sa) + sa * (gf + sf)) * 1000", "(gf + sf) * (ga + sa)", 1) + """ AS pdo
FROM t
"""))(shot_share_rollup)
