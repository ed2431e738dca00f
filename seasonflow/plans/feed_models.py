"""Season models of play-by-play and team grain on feed-shaped frames derived from the given
tables, each against an oracle written from the model's definition (M01, M08, M18, M20,
M21, M28-M30, M33, M37, M39, M40, M42, M55, M62, M63).

An order of the league is a game, its lines are the events of the feed: lines that share a
line number are loads of one event, of which the last shipped one holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.operators import joins as J
from seasonflow.plans.models import goalie_lines
from seasonflow.plans.registry import register, rr, sql
from seasonflow.plans.season import dims, facts, marts, published
from seasonflow.plans.season import intermediate as I
from seasonflow.plans.season import schemas as S
from seasonflow.plans.season import staging as ST
from seasonflow.plans.testbed import Bed
from seasonflow.session import written

# Fixed values of the analogue: event names by part, durations and codes by tax, situations by discount
EVENTS = ("goal", "goal", "shot-on-goal", "missed-shot", "blocked-shot", "faceoff", "penalty", "penalty", "penalty", "hit")
DURATIONS = (2, 4, 5, 10)
PENALTY_CODES = ("MIN", "MIN", "MAJ", "MIS")
SITUATIONS = ("1551", "1451", "1541", "0651", "1560", None)


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _sql_pick(values, index: str) -> str:
    listed = ", ".join("NULL" if v is None else repr(v) for v in values)
    return f"([{listed}])[CAST({index} AS INTEGER) + 1]"


def league_feed(bed: Bed) -> DataFrame:
    """The league's games with ids and text names of both teams."""
    return bed.written("universe").select(
        "game_id", "season", "game_date", F.col("home_team").alias("home_team_id"), F.col("away_team").alias("away_team_id"))


def play_feed(bed: Bed) -> DataFrame:
    """The raw play-by-play feed: a row per load of an event."""
    li = bed.t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate")
    games = league_feed(bed).select("game_id", "home_team_id", "away_team_id")
    j = li.join(games, F.col("l_orderkey") == F.col("game_id"))
    c, k, s = F.col, F.col("l_partkey") % 10, F.col("l_suppkey")
    tax = F.round(c("l_tax") * 100).cast("int") % 4
    kind = _pick(EVENTS, k)
    overtime = F.when(c("l_tax") > 0.05, "SO").otherwise("OT")
    feed = {
        "GAME_ID": c("game_id"), "EVENTID": c("l_linenumber"), "SORTORDER": c("l_partkey").cast("int"),
        "PERIODDESCRIPTOR_NUMBER": ((c("l_linenumber") + 1) / 2).cast("int"),
        "PERIODDESCRIPTOR_PERIODTYPE": F.when(c("l_linenumber") >= 7, overtime).otherwise("REG"),
        "SITUATIONCODE": _pick(SITUATIONS, F.round(c("l_discount") * 100).cast("int") % 6),
        "TIMEINPERIOD": F.concat(F.lit("0"), (c("l_quantity").cast("int") % 2).cast("string"), F.lit(":00")),
        "TYPEDESCKEY": kind,
        "DETAILS_EVENTOWNERTEAMID": F.when(s % 13 != 0, F.when(s % 2 == 0, c("home_team_id")).otherwise(c("away_team_id"))),
        "DETAILS_XCOORD": F.when(s % 17 != 0, (c("l_partkey") % 200 - 100).cast("double")),
        "DETAILS_YCOORD": (s % 80 - 40).cast("double"), "DETAILS_SHOTTYPE": c("l_returnflag"),
        "DETAILS_DURATION": F.when(kind == "penalty", _pick(DURATIONS, tax)),
        "DETAILS_TYPECODE": F.when((kind == "penalty") & (c("l_linestatus") == "F"), _pick(PENALTY_CODES, tax)),
        "DETAILS_SCORINGPLAYERID": s, "DETAILS_ASSIST1PLAYERID": F.when(c("l_partkey") % 4 != 0, s + 1),
        "DETAILS_ASSIST2PLAYERID": F.when(c("l_partkey") % 4 == 3, s + 2), "DETAILS_GOALIEINNETID": s + 3,
        "DETAILS_SHOOTINGPLAYERID": s + 4, "DETAILS_BLOCKINGPLAYERID": s + 5, "DETAILS_WINNINGPLAYERID": s + 6,
        "DETAILS_LOSINGPLAYERID": s + 7, "DETAILS_COMMITTEDBYPLAYERID": F.when(c("l_returnflag") != "R", s + 8),
        "DETAILS_SERVEDBYPLAYERID": s + 9, "DETAILS_DRAWNBYPLAYERID": s + 10, "DETAILS_HITTINGPLAYERID": s + 11,
        "DETAILS_HITTEEPLAYERID": s + 12, "_loaded_at": c("l_shipdate")}
    return j.select(*[feed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.PLAY_BY_PLAY])


# what the models below read of the staged plays
TEAM_COLUMNS = ("game_id", "event_id", "description", "play_team_id", "period", "period_type", "time_in_period",
                "elapsed_seconds", "situation_code", "penalty_duration")
ACTOR_COLUMNS = ("event_player_id", "scoring_player_id", "assist1_player_id", "assist2_player_id", "shooting_player_id",
                 "goalie_in_net_id", "hitting_player_id", "hittee_player_id", "blocking_player_id", "committed_by_player_id",
                 "drawn_by_player_id", "served_by_player_id", "faceoff_winner_player_id", "faceoff_loser_player_id")


def staged_plays(bed: Bed, columns: Sequence[str]) -> DataFrame:
    """The staged plays (M08), derived once and written with the columns that the model
    reads, so only these are sorted for the last load.  The other columns keep their
    place in the frame; reading one is an error."""
    staged = ST.stg_plays(play_feed(bed))
    kept = written(staged.select(*columns), "run-plays")
    unread = F.raise_error(F.lit("this column of the plays was not written"))
    return kept.select(*[F.col(f.name) if f.name in columns else unread.cast(f.dataType).alias(f.name) for f in staged.schema])


PLAYS_CTE = f"""
, loaded AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey) AS back
             FROM lineitem)
, ev AS (SELECT u.game_id, u.season, u.game_date, u.home_team, u.away_team, l_linenumber AS event_id, l_suppkey AS s,
                CAST((l_linenumber + 1) // 2 AS INTEGER) AS period, 60 * CAST(CAST(floor(l_quantity) AS INTEGER) % 2 AS INTEGER) AS clock,
                CASE WHEN l_linenumber < 7 THEN 'REG' WHEN l_tax > 0.05 THEN 'SO' ELSE 'OT' END AS period_type,
                {_sql_pick(EVENTS, 'l_partkey % 10')} AS kind, l_partkey AS part, l_returnflag AS flag, l_linestatus AS status,
                CASE WHEN l_suppkey % 13 <> 0 THEN CASE WHEN l_suppkey % 2 = 0 THEN home_team ELSE away_team END END AS team,
                {_sql_pick(SITUATIONS, 'round(l_discount * 100) % 6')} AS code,
                CAST(round(l_tax * 100) % 4 AS INTEGER) AS tax,
                CASE WHEN l_suppkey % 17 <> 0 THEN CAST(l_partkey % 200 - 100 AS DOUBLE) END AS x,
                CAST(l_suppkey % 80 - 40 AS DOUBLE) AS y
         FROM loaded JOIN universe u ON u.game_id = l_orderkey WHERE back = 1)
, fev AS (SELECT *, CASE WHEN kind = 'penalty' THEN {_sql_pick(DURATIONS, 'tax')} END AS minutes,
                 CASE WHEN kind = 'penalty' AND status = 'F' THEN {_sql_pick(PENALTY_CODES, 'tax')} END AS penalty_code,
                 CASE period WHEN 1 THEN 0 WHEN 2 THEN 1200 WHEN 3 THEN 2400 ELSE 3600 END + clock AS game_clock,
                 CASE WHEN period_type = 'SO' THEN 'Shootout' WHEN period > 3 THEN 'Overtime' ELSE 'Regulation' END AS category,
                 CASE WHEN team = home_team THEN CAST(code[3] AS INTEGER) ELSE CAST(code[2] AS INTEGER) END AS own,
                 CASE WHEN team = home_team THEN CAST(code[2] AS INTEGER) ELSE CAST(code[3] AS INTEGER) END AS opp
          FROM ev)
"""


def plays_model(spark: SparkSession, root: str) -> DataFrame:
    """M08 + M40: the last load of each event; its actors, strength, distance, penalty
    and period category (distances and angles to 6 decimals)."""
    bed = Bed(spark, root)
    out = facts.fct_plays(ST.stg_plays(play_feed(bed)), league_feed(bed))
    return out.select(
        "game_id", "event_id", "season", "date_key", "period", "elapsed_seconds", "game_elapsed_seconds", "event_type_name",
        "event_team_key", "primary_player_key", "secondary_player_key", "tertiary_player_key", "goalie_player_key", "shot_type",
        F.round("shot_distance", 6).alias("shot_distance"), F.round("shot_angle", 6).alias("shot_angle"), "shot_distance_band",
        "is_goal", "is_penalty", "penalty_severity", "penalty_minutes", "strength_state", "is_powerplay", "is_shorthanded",
        "is_empty_net", "period_category", "event_side")


register("plays_model", sql(PLAYS_CTE + """
, d AS (SELECT *, kind IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot') AS shot,
               CASE WHEN kind IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot') AND x IS NOT NULL
                    THEN sqrt(power(89 - abs(x), 2) + power(y, 2)) END AS dist FROM fev)
SELECT game_id, event_id, season, CAST(strftime(game_date, '%Y%m%d') AS INTEGER) AS date_key, period,
       clock AS elapsed_seconds, CAST(game_clock AS INTEGER) AS game_elapsed_seconds, kind AS event_type_name, team AS event_team_key,
       CASE kind WHEN 'goal' THEN s WHEN 'shot-on-goal' THEN s + 4 WHEN 'missed-shot' THEN s + 4 WHEN 'blocked-shot' THEN s + 5
                 WHEN 'faceoff' THEN s + 6 WHEN 'hit' THEN s + 11
                 WHEN 'penalty' THEN CASE WHEN flag <> 'R' THEN s + 8 ELSE s + 9 END END AS primary_player_key,
       CASE kind WHEN 'goal' THEN CASE WHEN part % 4 <> 0 THEN s + 1 END WHEN 'shot-on-goal' THEN s + 3
                 WHEN 'blocked-shot' THEN s + 4 WHEN 'faceoff' THEN s + 7 WHEN 'hit' THEN s + 12
                 WHEN 'penalty' THEN s + 10 END AS secondary_player_key,
       CASE WHEN kind = 'goal' AND part % 4 = 3 THEN s + 2 END AS tertiary_player_key,
       CASE WHEN kind IN ('goal', 'shot-on-goal', 'missed-shot') THEN s + 3 END AS goalie_player_key,
       CASE WHEN shot THEN flag END AS shot_type, round(dist, 6) AS shot_distance,
       CASE WHEN dist IS NOT NULL THEN round(degrees(atan2(y, abs(89 - abs(x)))), 6) END AS shot_angle,
       CASE WHEN dist <= 10 THEN 'Close' WHEN dist <= 25 THEN 'Medium' WHEN dist > 25 THEN 'Long' END AS shot_distance_band,
       kind = 'goal' AS is_goal, kind = 'penalty' AS is_penalty,
       CASE WHEN kind = 'penalty' THEN CASE minutes WHEN 2 THEN 'Minor' WHEN 5 THEN 'Major' WHEN 10 THEN 'Misconduct'
            ELSE CASE WHEN penalty_code = 'MIN' THEN 'Minor' ELSE 'Double Minor' END END END AS penalty_severity,
       CAST(minutes AS INTEGER) AS penalty_minutes,
       CASE WHEN team IS NULL THEN 'Other' WHEN own > opp THEN 'PP' WHEN own < opp THEN 'SH' ELSE 'Even' END AS strength_state,
       CASE WHEN team IS NULL THEN false ELSE own > opp END AS is_powerplay,
       CASE WHEN team IS NULL THEN false ELSE own < opp END AS is_shorthanded,
       CASE WHEN team IS NULL THEN false WHEN team = home_team THEN code[1] = '0' ELSE code[4] = '0' END AS is_empty_net,
       category AS period_category, CASE WHEN team = home_team THEN 'home' WHEN team = away_team THEN 'away' END AS event_side
FROM d
"""))(plays_model)


def summary_feed(bed: Bed) -> DataFrame:
    """Staged summaries: two rows a game; a game whose id is divisible by four went to overtime."""
    s = bed.sides(bed.written("universe"))
    return s.select(
        "game_id", "season", F.when(F.col("game_type") == 2, "regular").otherwise("playoff").alias("game_type"), "game_date",
        F.col("team").alias("team_id"), F.col("team").cast("string").alias("team_abv"), "is_home", F.col("goals_for").alias("goals"),
        "goals_against", (F.col("goals_for") + 5).alias("shots"),
        F.when(F.col("game_id") % 4 == 0, "OT").otherwise("REG").alias("last_period_type"))


def skater_lines(bed: Bed) -> DataFrame:
    pg = bed.written("player_games")
    return pg.select("game_id", F.col("team").cast("string").alias("team_abv"), (F.col("goals") % 2).alias("pp_goals"),
                     F.col("shots").alias("hits"), F.col("assists").alias("blocked_shots"), F.col("pim").alias("giveaways"),
                     F.col("points").alias("takeaways"))


def team_lines(bed: Bed) -> tuple[DataFrame, DataFrame]:
    """The staged plays and the team game line (M20, M21, M28) over them.  Frames with
    several readers are derived once and written; the line has one reader in most models."""
    league, staged = league_feed(bed), staged_plays(bed, TEAM_COLUMNS)
    lines = I.team_game_line(summary_feed(bed), I.game_faceoffs(staged, league), I.game_penalties(staged, league),
                             goalie_lines(bed, bed.written("player_games")), league, skater_lines(bed))
    return staged, lines


def team_game_model(spark: SparkSession, root: str) -> DataFrame:
    """Penalties with offsetting, faceoffs, goalies' and skaters' sums;
    result, points, first goal, leads and comebacks from the goals of the feed (a first goal
    without a team leaves the flag NULL)."""
    bed = Bed(spark, root)
    staged, lines = team_lines(bed)
    out = facts.fct_team_game(lines, facts.fct_plays(staged, league_feed(bed)))
    return out.withColumns({c: F.round(c, 8) for c in ("shot_share", "save_pct")}).drop("team_game_key")


LINES_CTE = PLAYS_CTE + """
, pen AS (SELECT game_id, team, period, clock, minutes FROM fev WHERE kind = 'penalty')
, slot AS (SELECT game_id, team, period, clock, minutes, count(*) AS n FROM pen WHERE minutes IN (2, 4, 5) AND team IS NOT NULL GROUP BY ALL)
, short AS (SELECT a.game_id, a.team, sum(a.n - least(a.n, coalesce(b.n, 0))) AS shorthanded
            FROM slot a LEFT JOIN slot b ON b.game_id = a.game_id AND b.period = a.period AND b.clock = a.clock
                 AND b.minutes = a.minutes AND b.team <> a.team GROUP BY a.game_id, a.team)
, pims AS (SELECT game_id, team, sum(minutes) AS pim FROM pen GROUP BY ALL)
, won AS (SELECT game_id, team, count(*) AS n FROM fev WHERE kind = 'faceoff' AND team IS NOT NULL GROUP BY ALL)
, held AS (SELECT game_id, sum(n) AS n FROM won GROUP BY game_id)
, nets AS (SELECT game_id, team, sum(shots - goals) AS saves, sum(shots) AS faced FROM player_games WHERE game_type IN (2, 3) GROUP BY ALL)
, skate AS (SELECT game_id, team, sum(goals % 2) AS ppg, sum(shots) AS hits, sum(assists) AS blocks, sum(pim) AS giveaways,
                   sum(points) AS takeaways FROM player_games GROUP BY ALL)
, line AS (
  SELECT s.*, CASE game_type WHEN 2 THEN 'regular' ELSE 'playoff' END AS kind_of_game, s.game_id % 4 = 0 AS late,
         coalesce(short.shorthanded, 0) AS pk_attempts, coalesce(os.shorthanded, 0) AS pp_attempts, coalesce(pims.pim, 0) AS pim,
         coalesce(skate.ppg, 0) AS pp_goals, coalesce(ok.ppg, 0) AS pk_goals_against, skate.hits, skate.blocks, skate.giveaways,
         skate.takeaways, coalesce(won.n, 0) AS faceoffs_won,
         CASE WHEN won.n IS NULL THEN 0 ELSE held.n END AS faceoffs_in_game, coalesce(nets.saves, 0) AS saves,
         coalesce(nets.faced, 0) AS faced, CAST(nets.saves AS DOUBLE) / nullif(nets.faced, 0) AS save_pct
  FROM sides s LEFT JOIN short ON short.game_id = s.game_id AND short.team = s.team
  LEFT JOIN short os ON os.game_id = s.game_id AND os.team = s.opponent
  LEFT JOIN pims ON pims.game_id = s.game_id AND pims.team = s.team
  LEFT JOIN skate ON skate.game_id = s.game_id AND skate.team = s.team
  LEFT JOIN skate ok ON ok.game_id = s.game_id AND ok.team = s.opponent
  LEFT JOIN won ON won.game_id = s.game_id AND won.team = s.team LEFT JOIN held ON held.game_id = s.game_id
  LEFT JOIN nets ON nets.game_id = s.game_id AND nets.team = s.team)
"""

register("team_game_model", sql(LINES_CTE + """
, goals AS (SELECT game_id, team, period, row_number() OVER (PARTITION BY game_id ORDER BY game_clock, event_id) AS n
            FROM fev WHERE kind = 'goal' AND category <> 'Shootout')
, per AS (SELECT game_id, team, count_if(period = 1) AS p1, count_if(period <= 2) AS p2 FROM goals GROUP BY ALL)
SELECT l.game_id, l.team AS team_id, CAST(l.team AS VARCHAR) AS team_abv, l.opponent AS opponent_team_id, l.season,
       kind_of_game AS game_type, l.game_date, l.is_home,
       CASE WHEN goals_for > goals_against THEN 'W' WHEN late THEN 'OTL' ELSE 'L' END AS game_result,
       CAST(CASE WHEN goals_for > goals_against THEN 2 WHEN late THEN 1 ELSE 0 END AS INTEGER) AS points,
       goals_for AS goals, goals_against, goals_for + 5 AS shots, CAST(faced AS BIGINT) AS shots_against,
       round(CAST(goals_for + 5 AS DOUBLE) / (goals_for + 5 + faced), 8) AS shot_share, first.team = l.team AS score_first_flag,
       coalesce(a.p1, 0) > coalesce(b.p1, 0) AS lead_after_1st, coalesce(a.p2, 0) > coalesce(b.p2, 0) AS lead_after_2nd,
       goals_for > goals_against AND (coalesce(a.p1, 0) < coalesce(b.p1, 0) OR coalesce(a.p2, 0) < coalesce(b.p2, 0)) AS comeback_win_flag,
       CAST(pp_goals AS BIGINT) AS pp_goals, CAST(pp_attempts AS BIGINT) AS pp_attempts, CAST(pk_attempts AS BIGINT) AS pk_attempts,
       CAST(pk_goals_against AS BIGINT) AS pk_goals_against, CAST(l.pim AS BIGINT) AS pim, CAST(hits AS BIGINT) AS hits,
       CAST(blocks AS BIGINT) AS blocks, CAST(giveaways AS BIGINT) AS giveaways, CAST(takeaways AS BIGINT) AS takeaways,
       CAST(faceoffs_won AS BIGINT) AS faceoffs_won, CAST(faceoffs_in_game AS BIGINT) AS faceoffs_in_game,
       CAST(saves AS BIGINT) AS saves, round(save_pct, 8) AS save_pct, CASE WHEN late THEN 'OT' ELSE 'REG' END AS game_outcome
FROM line l LEFT JOIN per a ON a.game_id = l.game_id AND a.team = l.team
LEFT JOIN per b ON b.game_id = l.game_id AND b.team = l.opponent
LEFT JOIN goals first ON first.game_id = l.game_id AND first.n = 1
"""))(team_game_model)


def games_model(spark: SparkSession, root: str) -> DataFrame:
    """Both teams' lines in one row a game, regulation score, winner and loser, result flags."""
    bed = Bed(spark, root)
    _, lines = team_lines(bed)
    u = bed.written("universe")
    league = league_feed(bed).join(u.select("game_id", F.when(F.col("game_type") == 2, "regular").otherwise("playoff").alias("game_type"),
                                            F.when(F.col("game_id") % 4 == 0, "OT").otherwise("REG").alias("last_period_type")), "game_id")
    league = league.withColumns({f"{s}_team_abv": F.col(f"{s}_team_id").cast("string") for s in ("home", "away")})
    return facts.fct_games(lines, league)


register("games_model", sql(LINES_CTE + """
, g AS (SELECT h.game_id, h.season, h.kind_of_game AS game_type, h.game_date, h.late, h.team AS home_team_id, a.team AS away_team_id,
               h.goals_for AS hg, a.goals_for AS ag, h.pim AS hp, a.pim AS ap, h.pp_goals AS hpp, a.pp_goals AS app,
               h.faceoffs_won AS hf, a.faceoffs_won AS af
        FROM line h JOIN line a ON a.game_id = h.game_id WHERE h.is_home AND NOT a.is_home)
SELECT game_id, season, upper(game_type[1]) || substr(game_type, 2) AS game_type_display, game_type, game_date,
       CAST(strftime(game_date, '%Y%m%d') AS INTEGER) AS date_key, home_team_id, away_team_id,
       CAST(home_team_id AS VARCHAR) AS home_team_abv, CAST(away_team_id AS VARCHAR) AS away_team_abv,
       hg AS home_goals, ag AS away_goals, hg + 5 AS home_shots, ag + 5 AS away_shots, CAST(hp AS BIGINT) AS home_pim,
       CAST(ap AS BIGINT) AS away_pim, CAST(hpp AS BIGINT) AS home_pp_goals, CAST(app AS BIGINT) AS away_pp_goals,
       CAST(hf AS BIGINT) AS home_faceoffs_won, CAST(af AS BIGINT) AS away_faceoffs_won,
       hg - CASE WHEN late AND hg > ag THEN 1 ELSE 0 END AS home_regulation_goals,
       ag - CASE WHEN late AND ag > hg THEN 1 ELSE 0 END AS away_regulation_goals,
       CASE WHEN hg > ag THEN home_team_id WHEN ag > hg THEN away_team_id END AS winning_team_id,
       CASE WHEN hg > ag THEN away_team_id WHEN ag > hg THEN home_team_id END AS losing_team_id,
       CASE WHEN late THEN 'OT' ELSE 'REG' END AS game_outcome, CAST(CASE WHEN late THEN 65 ELSE 60 END AS INTEGER) AS duration_minutes,
       abs(hg - ag) >= 5 AS is_blowout, hg + ag >= 10 AS is_high_scoring, hg + ag <= 3 AS is_low_scoring, late AS went_to_overtime
FROM g
"""))(games_model)


def player_game_model(spark: SparkSession, root: str) -> DataFrame:
    """A skater's line with assists by order, special goals, the winning goal and faceoffs
    counted from the feed's plays."""
    bed = Bed(spark, root)
    league, pg = league_feed(bed), bed.player_games()
    staged = staged_plays(bed, (*TEAM_COLUMNS, *ACTOR_COLUMNS))
    none = {c: F.lit(None).cast(t) for c, t in (("position", "string"), ("plus_minus", "int"), ("shifts", "int"),
                                                ("faceoff_pct", "double"), ("type", "string"))}
    skaters = J.semi(pg, league.select("game_id"), "game_id").select(
        "game_id", "season", F.when(F.col("game_type") == 2, "regular").otherwise("playoff").alias("game_type"),
        F.col("team").cast("string").alias("team_abv"), F.col("player").alias("player_id"), F.col("player_name").alias("name"),
        "goals", "assists", "points", "shots", "pim", "toi_seconds", F.col("shots").alias("hits"), (F.col("goals") % 2).alias("pp_goals"),
        F.col("pim").alias("giveaways"), F.col("points").alias("takeaways"), F.col("assists").alias("blocked_shots"))
    out = facts.fct_player_game(skaters.withColumns(none), facts.fct_plays(staged, league), summary_feed(bed))
    return out.drop("player_game_key", *none)


register("player_game_model", sql(PLAYS_CTE + """
, goal AS (SELECT *, CASE WHEN team IS NULL THEN 'Other' WHEN own > opp THEN 'PP' WHEN own < opp THEN 'SH' ELSE 'Even' END AS state,
                  CASE WHEN team = home_team THEN code[1] = '0' WHEN team = away_team THEN code[4] = '0' END AS empty_net,
                  row_number() OVER (PARTITION BY game_id, team ORDER BY game_clock, event_id) AS nth
           FROM fev WHERE kind = 'goal' AND category <> 'Shootout')
, scored AS (SELECT game_id, s AS player, count_if(state = 'SH') AS sh, count_if(category = 'Overtime') AS ot, count_if(empty_net) AS en
             FROM goal GROUP BY ALL)
, helped AS (SELECT game_id, player, count_if(slot = 1) AS a1, count_if(slot = 2) AS a2, count_if(state = 'PP') AS pp, count_if(state = 'SH') AS sh
             FROM (SELECT game_id, s + 1 AS player, 1 AS slot, state FROM goal WHERE part % 4 <> 0
                   UNION ALL SELECT game_id, s + 2, 2, state FROM goal WHERE part % 4 = 3) GROUP BY ALL)
, winner AS (SELECT g.game_id, g.s AS player FROM goal g JOIN sides w ON w.game_id = g.game_id AND w.team = g.team
             WHERE goals_for > goals_against AND nth = goals_against + 1)
, drawn AS (SELECT game_id, player, count_if(won) AS won, count_if(NOT won) AS lost
            FROM (SELECT game_id, s + 6 AS player, true AS won FROM fev WHERE kind = 'faceoff'
                  UNION ALL SELECT game_id, s + 7, false FROM fev WHERE kind = 'faceoff') GROUP BY ALL)
SELECT p.game_id, p.player AS player_id, CAST(p.team AS VARCHAR) AS team_abv, p.season,
       CASE p.game_type WHEN 2 THEN 'regular' ELSE 'playoff' END AS game_type, p.goals, p.assists, p.points,
       coalesce(h.a1, 0) AS primary_assists, coalesce(h.a2, 0) AS secondary_assists, p.shots, p.shots AS hits, p.pim, p.toi_seconds,
       coalesce(c.sh, 0) AS shorthanded_goals, coalesce(c.en, 0) AS empty_net_goals,
       CAST(CASE WHEN w.player IS NULL THEN 0 ELSE 1 END AS INTEGER) AS game_winning_goals, coalesce(d.won, 0) AS faceoffs_won,
       coalesce(d.lost, 0) AS faceoffs_lost, coalesce(h.pp, 0) AS pp_assists, coalesce(h.sh, 0) AS sh_assists,
       coalesce(c.ot, 0) AS overtime_goals, player_name AS name, p.goals % 2 AS pp_goals, p.pim AS giveaways, p.points AS takeaways,
       p.assists AS blocked_shots, p.goals >= 3 AS is_hat_trick, p.points >= 4 AS is_four_point_game, p.goals >= 4 AS is_four_goal_game
FROM player_games p LEFT JOIN scored c ON c.game_id = p.game_id AND c.player = p.player
LEFT JOIN helped h ON h.game_id = p.game_id AND h.player = p.player
LEFT JOIN winner w ON w.game_id = p.game_id AND w.player = p.player
LEFT JOIN drawn d ON d.game_id = p.game_id AND d.player = p.player
WHERE EXISTS (SELECT 1 FROM universe u WHERE u.game_id = p.game_id)
"""))(player_game_model)


def stints_model(spark: SparkSession, root: str) -> DataFrame:
    """Stints by player, team and season.  A player is all suppliers with one remainder
    by forty, so players change teams within and between seasons."""
    bed = Bed(spark, root)
    league = league_feed(bed)
    lines = J.semi(bed.player_games(), league.select("game_id"), "game_id").select(
        "game_id", "season", (F.col("player") % 40).alias("player_id"), F.col("team").cast("string").alias("team_abv"))
    return dims.dim_player_team_bridge(lines, league).drop("bridge_key")


register("stints_model", sql("""
, a AS (SELECT p.player % 40 AS player_id, CAST(p.team AS VARCHAR) AS team_abv, p.season, game_id, u.game_date
        FROM player_games p JOIN universe u USING (game_id))
, st AS (SELECT player_id, team_abv, season, count(*) AS gp, min(game_id) AS first_game, max(game_id) AS last_game FROM a GROUP BY ALL)
, day AS (SELECT DISTINCT game_id, game_date FROM a)
, d AS (SELECT st.*, f.game_date AS start_date, l.game_date AS end_date FROM st JOIN day f ON f.game_id = first_game JOIN day l ON l.game_id = last_game)
, x AS (SELECT *, count(*) OVER (PARTITION BY player_id, season) AS teams_in_season,
               row_number() OVER (PARTITION BY player_id, season ORDER BY start_date, first_game, team_abv) AS nth,
               lag(team_abv) OVER (PARTITION BY player_id ORDER BY season, start_date, first_game, team_abv) AS before FROM d)
SELECT player_id, team_abv, season, start_date, end_date,
       CASE WHEN teams_in_season > 1 AND nth > 1 THEN 'Trade' WHEN before IS NULL THEN 'Draft/Entry' WHEN before <> team_abv THEN 'Free Agent'
            ELSE 'Retained' END AS acquisition_type,
       season = (SELECT max(season) FROM d) AND end_date = (SELECT max(end_date) FROM d y WHERE y.player_id = x.player_id) AS is_current_team,
       gp AS games_played_for_team, teams_in_season > 1 AS traded_mid_season, teams_in_season,
       CAST(date_diff('day', start_date, end_date) + 1 AS INTEGER) AS stint_length_days,
       CASE WHEN gp >= 41 THEN 'Full Season' WHEN gp >= 20 THEN 'Significant' WHEN gp >= 10 THEN 'Regular' ELSE 'Limited' END AS participation_level
FROM x
"""))(stints_model)


def shot_metrics_model(spark: SparkSession, root: str) -> DataFrame:
    """Attempts of the feed by shooting team (a blocked shot is the other side's), their
    shares overall, unblocked and at even strength, and PDO from the team lines."""
    bed = Bed(spark, root)
    staged, lines = team_lines(bed)
    plays = facts.fct_plays(staged, league_feed(bed))
    return marts.team_shot_metrics(plays, facts.fct_team_game(lines, plays))


register("shot_metrics_model", sql(LINES_CTE + f"""
, att AS (SELECT game_id, CASE WHEN kind <> 'blocked-shot' THEN team WHEN team = home_team THEN away_team ELSE home_team END AS shooter,
                 kind <> 'blocked-shot' AS free, own IS NOT DISTINCT FROM opp OR own IS NULL OR opp IS NULL AS even
          FROM fev WHERE kind IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot') AND category <> 'Shootout' AND team IS NOT NULL)
, per AS (SELECT game_id, shooter, count(*) AS c, count_if(free) AS f, count_if(even) AS e FROM att GROUP BY ALL)
, t AS (SELECT l.season, CAST(l.team AS VARCHAR) AS team_abv, CAST(sum(coalesce(a.c, 0)) AS BIGINT) AS cf,
               CAST(sum(coalesce(b.c, 0)) AS BIGINT) AS ca, CAST(sum(coalesce(a.f, 0)) AS BIGINT) AS ff,
               CAST(sum(coalesce(b.f, 0)) AS BIGINT) AS fa, CAST(sum(coalesce(a.e, 0)) AS BIGINT) AS cf_even,
               CAST(sum(coalesce(b.e, 0)) AS BIGINT) AS ca_even, CAST(sum(goals_for) AS BIGINT) AS gf,
               CAST(sum(goals_against) AS BIGINT) AS ga, CAST(sum(goals_for + 5) AS BIGINT) AS sf, CAST(sum(faced) AS BIGINT) AS sa,
               CAST(sum(saves) AS BIGINT) AS saves
        FROM line l LEFT JOIN per a ON a.game_id = l.game_id AND a.shooter = l.team
        LEFT JOIN per b ON b.game_id = l.game_id AND b.shooter = l.opponent GROUP BY l.season, l.team)
SELECT t.*, {rr('cf', 'cf + ca', 4)} AS corsi_pct, {rr('ff', 'ff + fa', 4)} AS fenwick_pct,
       {rr('cf_even', 'cf_even + ca_even', 4)} AS even_corsi_pct, {rr('gf', 'sf', 4)} AS shooting_pct, {rr('saves', 'sa', 4)} AS save_pct,
       round((coalesce(CAST(gf AS DOUBLE) / nullif(sf, 0), 0) + coalesce(CAST(saves AS DOUBLE) / nullif(sa, 0), 0)) * 1000, 1) AS pdo
FROM t
"""))(shot_metrics_model)


def team_season_model(spark: SparkSession, root: str) -> DataFrame:
    """Both kinds of game, with the published columns (shares to 8 decimals)."""
    bed = Bed(spark, root)
    lines = written(team_lines(bed)[1], "run-lines")
    teams = bed.teams().select(F.col("team").cast("string").alias("team_abv"), F.col("team_name").alias("logo_url"))
    parts = [published.team_season(lines, teams, kind).withColumn("game_type", F.lit(kind)) for kind in ("regular", "playoff")]
    out = parts[0].unionByName(parts[1])
    return out.withColumns({c: F.round(c, 8) for c in ("pp_pct", "pk_pct")})


def _season_sql() -> str:
    sums = [("goals", "goals_for"), ("goals_against", "goals_against"), ("shots", "goals_for + 5"), ("pp_goals", "pp_goals"),
            ("pp_attempts", "pp_attempts"), ("pim", "pim"), ("pk_attempts", "pk_attempts"), ("hits", "hits"), ("blocks", "blocks"),
            ("giveaways", "giveaways"), ("takeaways", "takeaways")]
    means = [("goals_per_game", "goals_for"), ("goals_against_average", "goals_against"), ("shots_per_game", "goals_for + 5"),
             ("pim_per_game", "pim"), ("hits_per_game", "hits"), ("blocks_per_game", "blocks"), ("giveaways_per_game", "giveaways"),
             ("takeaways_per_game", "takeaways")]
    return ", ".join([f"CAST(sum({e}) AS BIGINT) AS {n}" for n, e in sums]
                     + [f"{rr(f'sum({e})', f'count({e})')} AS {n}" for n, e in means])


register("team_season_model", sql(LINES_CTE + f"""
, t AS (SELECT season, team, kind_of_game AS game_type, count(*) AS games_played, {_season_sql()},
               round(CAST(sum(line.pp_goals) AS DOUBLE) / nullif(sum(line.pp_attempts), 0), 8) AS pp_pct,
               round(CAST(sum(line.pk_attempts) - sum(line.pk_goals_against) AS DOUBLE) / nullif(sum(line.pk_attempts), 0), 8) AS pk_pct
        FROM line GROUP BY season, team, kind_of_game)
SELECT t.* EXCLUDE (team), CAST(t.team AS VARCHAR) AS team_abv,
       substr(CAST(season AS VARCHAR), 1, 4) || '-' || substr(CAST(season AS VARCHAR), 7, 2) AS season_display, team_name AS logo_url
FROM t JOIN teams USING (team)
"""))(team_season_model)


def current_feed(bed: Bed) -> DataFrame:
    """The raw current table: a load a season, of the season's regular games; the last
    season a team plays is its current row."""
    s = bed.sides().filter(F.col("game_type") == 2)
    win, tie = F.col("goals_for") > F.col("goals_against"), F.col("goals_for") == F.col("goals_against")
    counts = {"": F.lit(True), "HOME": F.col("is_home"), "ROAD": ~F.col("is_home")}
    agg = {}
    for side, here in counts.items():
        own, other = ("GOALFOR", "GOALAGAINST") if not side else (f"{side}GOALSFOR", f"{side}GOALSAGAINST")
        agg |= {f"{side}GAMESPLAYED": F.count_if(here), f"{side}WINS": F.count_if(here & win),
                f"{side}LOSSES": F.count_if(here & ~win & ~tie), f"{side}OTLOSSES": F.count_if(here & tie),
                own: F.sum(F.when(here, F.col("goals_for"))), other: F.sum(F.when(here, F.col("goals_against"))),
                f"{side}GOALDIFFERENTIAL": F.sum(F.when(here, F.col("goals_for") - F.col("goals_against")))}
    t = s.groupBy("season", "team").agg(*[v.alias(k) for k, v in agg.items()]).join(bed.teams(), "team")
    t = t.withColumns({f"{side}POINTS": F.col(f"{side}WINS") * 2 + F.col(f"{side}OTLOSSES") for side in counts})
    t = t.withColumns({"TEAMABBREV_DEFAULT": F.col("team").cast("string"), "TEAMNAME_DEFAULT": F.col("team_name"),
                       "CONFERENCENAME": F.col("conference"), "POINTPCTG": F.col("POINTS") / (F.col("GAMESPLAYED") * 2),
                       "STREAKCODE": F.lit("W"), "STREAKCOUNT": F.col("WINS") % 7,
                       "_loaded_at": F.make_timestamp(F.col("season"), *[F.lit(n) for n in (7, 1, 0, 0, 0)])})
    return t.select(*[F.col(f.name).cast(f.dataType) if f.name in t.columns else F.lit(None).cast(f.dataType).alias(f.name)
                      for f in S.CURRENT_STANDINGS])


CURRENT = ("team", "team_abv", "conference", "points", "wins", "losses", "ot_losses", "games_played", "record", "point_pct",
           "goals_for", "goals_against", "goal_diff", "goal_diff_string", "streak_string", "waiver", "l10_record",
           *(f"{side}_{c}" for side in ("home", "road") for c in (
               "wins", "losses", "ot_l", "points", "record", "gp", "goals", "goals_against", "goal_diff", "goal_diff_string")))


def current_standings_model(spark: SparkSession, root: str) -> DataFrame:
    """M01 + M18: the last load of each team with record texts and signed differentials,
    overall, at home and on the road (the columns that the analogue's feed fills, and two it does not)."""
    out = published.current_standings(ST.stg_current_standings(current_feed(Bed(spark, root))))
    return out.withColumn("point_pct", F.round("point_pct", 8)).select(*CURRENT)


def _side_sql(prefix: str, here: str) -> str:
    name = (lambda c: f"{prefix}_{c}") if prefix else (lambda c: {"gp": "games_played", "goals": "goals_for", "ot_l": "ot_losses"}.get(c, c))
    w, lo, t, d = (f"count_if({here} AND goals_for {op} goals_against)" for op in (">", "<", "=", "<>"))
    diff = f"sum(CASE WHEN {here} THEN goals_for - goals_against END)"
    texts = f"CASE WHEN {diff} > 0 THEN '+' ELSE '' END || CAST({diff} AS VARCHAR)"
    ints = {"wins": w, "losses": lo, "ot_l": t, "points": f"2 * {w} + {t}", "gp": f"{d} + {t}",
            "goals": f"sum(CASE WHEN {here} THEN goals_for END)", "goals_against": f"sum(CASE WHEN {here} THEN goals_against END)",
            "goal_diff": diff}
    return ", ".join([f"CAST({e} AS INTEGER) AS {name(c)}" for c, e in ints.items()]
                     + [f"{texts} AS {name('goal_diff_string')}", f"concat_ws('-', {w}, {lo}, {t}) AS {name('record')}"])


register("current_standings_model", sql(f"""
, mine AS (SELECT s.* FROM sides s WHERE game_type = 2
           AND season = (SELECT max(season) FROM sides x WHERE x.team = s.team AND x.game_type = 2))
, t AS (SELECT team, {_side_sql('', 'true')}, {_side_sql('home', 'is_home')}, {_side_sql('road', 'NOT is_home')} FROM mine GROUP BY team)
SELECT t.* EXCLUDE (team), team_name AS team, CAST(t.team AS VARCHAR) AS team_abv, conference,
       round(CAST(points AS DOUBLE) / (2 * games_played), 8) AS point_pct, 'W' || (wins % 7) AS streak_string,
       CAST(NULL AS INTEGER) AS waiver, CAST(NULL AS VARCHAR) AS l10_record
FROM t JOIN teams USING (team)
"""))(current_standings_model)
