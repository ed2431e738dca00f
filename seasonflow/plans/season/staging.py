"""Staging models (M01–M10): one typed frame per raw table, deduplicated to the
latest load per natural key (append-only feeds: the latest re-extraction
wins), never filtered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonflow.functions import exprs as X
from seasonflow.operators.dedup import dedup_latest
from seasonflow.operators.reshape import two_sided_unpivot
from seasonflow.plans.season import schemas as S
from seasonflow.sources.shaping import parse_json


def _latest():
    return F.col("_loaded_at").desc()


def game_type_label(code, with_else: bool = True):
    c = F.col(code) if isinstance(code, str) else code
    e = F.when(c == 1, "preseason").when(c == 2, "regular").when(c == 3, "playoff")
    return e.otherwise("other") if with_else else F.when(c == 2, "regular").when(c == 3, "playoff")


def stg_current_standings(raw: DataFrame) -> DataFrame:
    """Latest load per team."""
    return dedup_latest(raw, ["TEAMABBREV_DEFAULT"], [_latest()])


def stg_current_teams(raw: DataFrame) -> DataFrame:
    """Renamed team listing, latest load per team id."""
    t = dedup_latest(raw, ["ID"], [_latest()])
    return t.select(F.col("ID").alias("team_id"), F.col("ABBREV").alias("team_abv"),
                    F.col("NAME_DEFAULT").alias("team_name"), F.col("PLACENAME_DEFAULT").alias("place_name"),
                    F.col("COMMONNAME_DEFAULT").alias("common_name"),
                    X.text_to_bool("FRENCH").alias("is_french"), F.col("LOGO").alias("logo_url"))


def stg_daily_standings(raw: DataFrame) -> DataFrame:
    """Latest load per (date, team)."""
    return dedup_latest(raw, ["DATE", "TEAMABBREV_DEFAULT"], [_latest()])


def stg_boxscore(raw: DataFrame) -> DataFrame:
    """Latest load per game (a final snapshot beats an in-progress one)."""
    return dedup_latest(raw, ["ID"], [_latest()])


def stg_game_summaries(raw: DataFrame) -> DataFrame:
    """Latest load per game, unpivoted to two team rows with own and
    opponent scores swapped (one pass, no second scan)."""
    g = dedup_latest(raw, ["ID"], [_latest()])
    g = g.select(F.col("SEASON").try_cast("int").alias("season"), F.col("ID").alias("game_id"),
                 game_type_label("GAMETYPE").alias("game_type"), F.col("GAMEDATE").alias("game_date"),
                 F.col("STARTTIMEUTC").alias("start_time_utc"), F.col("VENUE_DEFAULT").alias("venue"),
                 F.col("PERIODDESCRIPTOR_PERIODTYPE").alias("last_period_type"),
                 *[F.col(f"{side}TEAM_{c}") for side in ("HOME", "AWAY") for c in ("ABBREV", "ID", "SCORE", "SOG")])
    out = two_sided_unpivot(
        g, ["season", "game_id", "game_type", "game_date", "start_time_utc", "venue", "last_period_type"],
        home={"team_abv": "HOMETEAM_ABBREV", "team_id": "HOMETEAM_ID", "goals": "HOMETEAM_SCORE",
              "shots": "HOMETEAM_SOG"},
        away={"team_abv": "AWAYTEAM_ABBREV", "team_id": "AWAYTEAM_ID", "goals": "AWAYTEAM_SCORE",
              "shots": "AWAYTEAM_SOG"})
    return (out.withColumn("type", F.when(F.col("is_home"), "home").otherwise("away"))
               .withColumnRenamed("opp_goals", "goals_against")
               .drop("opp_team_abv", "opp_team_id", "opp_shots"))


def stg_three_stars(raw: DataFrame) -> DataFrame:
    """Latest load per game, three-stars JSON unnested (empty/NULL -> no rows)."""
    g = dedup_latest(raw, ["ID"], [_latest()])
    e = g.select(F.col("ID").alias("game_id"), F.col("SEASON").try_cast("int").alias("season"),
                 F.col("GAMEDATE").alias("game_date"), F.explode(parse_json("SUMMARY_THREESTARS", T.ArrayType(S.THREE_STAR))).alias("s"))
    return e.select("game_id", "season", "game_date", F.col("s.goalsAgainstAverage").alias("gaa"),
                    F.col("s.savePctg").alias("save_pct"), F.col("s.star").alias("star"), F.col("s.playerId").alias("player_id"),
                    F.col("s.name.default").alias("name"), F.col("s.teamAbbrev").alias("team_abv"),
                    F.col("s.position").alias("position"), F.col("s.goals").alias("goals"),
                    F.col("s.assists").alias("assists"), F.col("s.points").alias("points"))


def stg_games(raw: DataFrame) -> DataFrame:
    """Latest load per game id."""
    return dedup_latest(raw, ["ID"], [_latest()])


def stg_plays(raw: DataFrame) -> DataFrame:
    """Typed play-by-play; clock parsed to seconds; latest load per
    (game, event), ties broken by sort order."""
    d = dedup_latest(raw, ["GAME_ID", "EVENTID"], [_latest(), F.col("SORTORDER").asc()])
    ren = {
        "GAME_ID": "game_id", "EVENTID": "event_id", "HOMETEAMDEFENDINGSIDE": "home_side",
        "PERIODDESCRIPTOR_NUMBER": "period", "PERIODDESCRIPTOR_PERIODTYPE": "period_type",
        "SITUATIONCODE": "situation_code", "SORTORDER": "sort_order", "TIMEINPERIOD": "time_in_period",
        "TIMEREMAINING": "time_remaining", "TYPECODE": "type_code", "DETAILS_EVENTOWNERTEAMID": "play_team_id",
        "TYPEDESCKEY": "description", "DETAILS_XCOORD": "x_pos", "DETAILS_YCOORD": "y_pos",
        "DETAILS_ZONECODE": "zone_code", "DETAILS_SHOTTYPE": "shot_type", "DETAILS_PLAYERID": "event_player_id",
        "DETAILS_REASON": "penalty_reason", "DETAILS_TYPECODE": "penalty_type_code",
        "DETAILS_DESCKEY": "penalty_desc_key", "DETAILS_DURATION": "penalty_duration",
        "DETAILS_SCORINGPLAYERID": "scoring_player_id", "DETAILS_ASSIST1PLAYERID": "assist1_player_id",
        "DETAILS_ASSIST2PLAYERID": "assist2_player_id", "DETAILS_SHOOTINGPLAYERID": "shooting_player_id",
        "DETAILS_GOALIEINNETID": "goalie_in_net_id", "DETAILS_HITTINGPLAYERID": "hitting_player_id",
        "DETAILS_HITTEEPLAYERID": "hittee_player_id", "DETAILS_BLOCKINGPLAYERID": "blocking_player_id",
        "DETAILS_COMMITTEDBYPLAYERID": "committed_by_player_id", "DETAILS_DRAWNBYPLAYERID": "drawn_by_player_id",
        "DETAILS_SERVEDBYPLAYERID": "served_by_player_id", "DETAILS_WINNINGPLAYERID": "faceoff_winner_player_id",
        "DETAILS_LOSINGPLAYERID": "faceoff_loser_player_id", "DETAILS_AWAYSCORE": "away_score",
        "DETAILS_HOMESCORE": "home_score", "DETAILS_AWAYSOG": "away_sog", "DETAILS_HOMESOG": "home_sog",
    }
    cols = [F.col(k).alias(v) for k, v in ren.items() if k in d.columns]
    return d.select(*cols, X.clock_to_seconds("TIMEINPERIOD").alias("elapsed_seconds"), "_loaded_at")


def stg_schedules(raw: DataFrame) -> DataFrame:
    """Typed schedule; the latest game state per game wins."""
    d = dedup_latest(raw, ["ID"], [_latest()])
    return d.select(F.col("ID").alias("game_id"), F.col("SEASON").alias("season"),
                    game_type_label("GAMETYPE").alias("game_type"), F.col("GAMESTATE").alias("game_state"),
                    F.col("GAMEDATE").alias("game_date"), F.col("HOMETEAM_ID").alias("home_team_id"),
                    F.col("HOMETEAM_ABBREV").alias("home_team_abv"), F.col("AWAYTEAM_ID").alias("away_team_id"),
                    F.col("AWAYTEAM_ABBREV").alias("away_team_abv"),
                    F.col("NEUTRALSITE").cast("boolean").alias("neutral_site"), F.col("VENUE_DEFAULT").alias("venue"),
                    F.col("STARTTIMEUTC").alias("start_time_utc"), F.col("EASTERNUTCOFFSET").alias("eastern_offset"),
                    F.col("VENUETIMEZONE").alias("venue_tz"), F.col("SPECIALEVENT_NAME_DEFAULT").alias("special_event"),
                    F.col("GAMETYPE").cast("int").alias("game_type_code"),
                    F.col("WINNINGGOALIE_PLAYERID").alias("winning_goalie_id"),
                    F.col("WINNINGGOALSCORER_PLAYERID").alias("winning_scorer_id"))


def stg_rosters(raw: DataFrame) -> DataFrame:
    """Three JSON role arrays parsed with an explicit schema; latest load per team."""
    d = dedup_latest(raw, ["TEAM_ABV"], [_latest()])
    arr = T.ArrayType(S.ROSTER_PLAYER)
    return d.select(F.col("TEAM_ABV").alias("team_abv"), parse_json("FORWARDS", arr).alias("forwards"),
                    parse_json("DEFENSEMEN", arr).alias("defensemen"), parse_json("GOALIES", arr).alias("goalies"))
