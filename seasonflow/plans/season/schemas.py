"""Explicit raw-feed schemas (flattened landing layout) and nested JSON element
schemas.  Declaring them skips footer inference and pins types; raw numerics
may arrive as text, so staging uses ``try_cast``."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D, DT, B, TS = (T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.DateType(),
                         T.BooleanType(), T.TimestampType())


def _st(spec: str) -> T.StructType:
    """'NAME type, NAME type, ...' -> StructType (all nullable)."""
    m = {"long": L, "int": I, "string": S, "double": D, "date": DT, "boolean": B, "timestamp": TS}
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, m[typ], True))
    return T.StructType(fields)


LOADED = "_loaded_at timestamp"

GAMES = _st("ID long, SEASON int, GAMETYPE int, GAMEDATE date, STARTTIMEUTC string, GAMESTATE string, "
            "GAMEOUTCOME_LASTPERIODTYPE string, HOMETEAM_ID long, HOMETEAM_ABBREV string, AWAYTEAM_ID long, "
            "AWAYTEAM_ABBREV string, VENUE_DEFAULT string, VENUETIMEZONE string, VENUEUTCOFFSET string, "
            "EASTERNUTCOFFSET string, NEUTRALSITE boolean, " + LOADED)

GAME_SUMMARIES = _st("ID long, SEASON string, GAMETYPE int, GAMEDATE date, STARTTIMEUTC string, "
                     "VENUE_DEFAULT string, PERIODDESCRIPTOR_PERIODTYPE string, HOMETEAM_ID long, "
                     "HOMETEAM_ABBREV string, HOMETEAM_SCORE int, HOMETEAM_SOG int, AWAYTEAM_ID long, "
                     "AWAYTEAM_ABBREV string, AWAYTEAM_SCORE int, AWAYTEAM_SOG int, SUMMARY_THREESTARS string, "
                     + LOADED)

_SIDES = [f"PLAYERBYGAMESTATS_{s}_{r} string" for s in ("HOMETEAM", "AWAYTEAM")
          for r in ("FORWARDS", "DEFENSE", "GOALIES")]
GAME_BOXSCORE = _st("ID long, SEASON int, GAMETYPE int, HOMETEAM_ABBREV string, AWAYTEAM_ABBREV string, "
                    + ", ".join(_SIDES) + ", " + LOADED)

_DETAIL_IDS = ["EVENTOWNERTEAMID", "PLAYERID", "SCORINGPLAYERID", "ASSIST1PLAYERID", "ASSIST2PLAYERID",
               "SHOOTINGPLAYERID", "GOALIEINNETID", "HITTINGPLAYERID", "HITTEEPLAYERID", "BLOCKINGPLAYERID",
               "COMMITTEDBYPLAYERID", "DRAWNBYPLAYERID", "SERVEDBYPLAYERID", "WINNINGPLAYERID", "LOSINGPLAYERID"]
PLAY_BY_PLAY = _st(
    "GAME_ID long, EVENTID int, SORTORDER int, HOMETEAMDEFENDINGSIDE string, PERIODDESCRIPTOR_NUMBER int, "
    "PERIODDESCRIPTOR_PERIODTYPE string, SITUATIONCODE string, TIMEINPERIOD string, TIMEREMAINING string, "
    "TYPECODE int, TYPEDESCKEY string, "
    + ", ".join(f"DETAILS_{c} long" for c in _DETAIL_IDS)
    + ", DETAILS_XCOORD double, DETAILS_YCOORD double, DETAILS_ZONECODE string, DETAILS_SHOTTYPE string, "
      "DETAILS_REASON string, DETAILS_TYPECODE string, DETAILS_DESCKEY string, DETAILS_DURATION int, "
      "DETAILS_AWAYSCORE int, DETAILS_HOMESCORE int, DETAILS_AWAYSOG int, DETAILS_HOMESOG int, " + LOADED)

_STAND_INTS = ("GAMESPLAYED POINTS WINS LOSSES OTLOSSES REGULATIONWINS REGULATIONPLUSOTWINS GOALFOR GOALAGAINST "
               "HOMEWINS HOMELOSSES HOMEOTLOSSES ROADWINS ROADLOSSES ROADOTLOSSES SHOOTOUTWINS SHOOTOUTLOSSES "
               "L10WINS L10LOSSES L10OTLOSSES L10POINTS L10GOALSFOR L10GOALSAGAINST L10GOALDIFFERENTIAL "
               "STREAKCOUNT DIVISIONSEQUENCE WILDCARDSEQUENCE CONFERENCESEQUENCE LEAGUESEQUENCE").split()
STANDING_INT_COLS = tuple(_STAND_INTS)
DAILY_STANDINGS = _st(
    "DATE date, SEASONID int, TEAMNAME_DEFAULT string, TEAMABBREV_DEFAULT string, PLACENAME_DEFAULT string, "
    "TEAMCOMMONNAME_DEFAULT string, TEAMLOGO string, DIVISIONNAME string, DIVISIONABBREV string, "
    "CONFERENCENAME string, CONFERENCEABBREV string, STREAKCODE string, "
    + ", ".join(f"{c} int" for c in _STAND_INTS) + ", " + LOADED)

# the current table has percentages, differentials, splits and places by split as well
_SPLIT_INTS = [f"{side}{c}" for side in ("HOME", "ROAD") for c in (
    "POINTS", "GAMESPLAYED", "GOALSFOR", "GOALSAGAINST", "GOALDIFFERENTIAL", "REGULATIONWINS", "REGULATIONPLUSOTWINS")]
_SPLIT_PLACES = [f"{scope}{split}SEQUENCE" for split in ("HOME", "ROAD", "L10") for scope in ("LEAGUE", "DIVISION", "CONFERENCE")]
CURRENT_STANDINGS = T.StructType([*DAILY_STANDINGS.fields, *_st(
    "WAIVERSSEQUENCE int, GOALDIFFERENTIAL int, L10GAMESPLAYED int, L10REGULATIONWINS int, L10REGULATIONPLUSOTWINS int, "
    + ", ".join(f"{c} int" for c in (*_SPLIT_INTS, *_SPLIT_PLACES))
    + ", WINPCTG double, POINTPCTG double, REGULATIONPLUSOTWINPCTG double, REGULATIONWINPCTG double, GOALSFORPCTG double, "
      "GOALDIFFERENTIALPCTG double").fields])

CURRENT_TEAMS = _st("ID long, ABBREV string, NAME_DEFAULT string, PLACENAME_DEFAULT string, "
                    "COMMONNAME_DEFAULT string, FRENCH string, LOGO string, " + LOADED)

TEAM_ROSTERS = _st("TEAM_ABV string, FORWARDS string, DEFENSEMEN string, GOALIES string, " + LOADED)

SEASON_SCHEDULES = _st(
    "ID long, SEASON int, GAMETYPE int, GAMESTATE string, GAMEDATE date, HOMETEAM_ID long, HOMETEAM_ABBREV string, "
    "AWAYTEAM_ID long, AWAYTEAM_ABBREV string, WINNINGGOALIE_PLAYERID long, WINNINGGOALSCORER_PLAYERID long, "
    "NEUTRALSITE boolean, VENUE_DEFAULT string, STARTTIMEUTC string, EASTERNUTCOFFSET string, "
    "VENUETIMEZONE string, SPECIALEVENT_NAME_DEFAULT string, " + LOADED)

# -- nested JSON elements ------------------------------------------------------
_NAME = T.StructType([T.StructField("default", S)])

THREE_STAR = T.StructType([
    T.StructField("star", I), T.StructField("playerId", L), T.StructField("name", _NAME),
    T.StructField("teamAbbrev", S), T.StructField("position", S), T.StructField("goals", I),
    T.StructField("assists", I), T.StructField("points", I), T.StructField("goalsAgainstAverage", D),
    T.StructField("savePctg", D)])

SKATER_LINE = T.StructType([T.StructField(n, t) for n, t in [
    ("playerId", L), ("name", _NAME), ("position", S), ("goals", I), ("assists", I), ("points", I),
    ("plusMinus", I), ("pim", I), ("hits", I), ("sog", I), ("faceoffWinningPctg", D), ("powerPlayGoals", I),
    ("giveaways", I), ("takeaways", I), ("blockedShots", I), ("shifts", I), ("toi", S)]])

GOALIE_LINE = T.StructType([T.StructField(n, t) for n, t in [
    ("playerId", L), ("name", _NAME), ("position", S), ("starter", B), ("decision", S), ("goalsAgainst", I),
    ("savePctg", D), ("saveShotsAgainst", S), ("evenStrengthShotsAgainst", S), ("evenStrengthGoalsAgainst", I),
    ("powerPlayShotsAgainst", S), ("powerPlayGoalsAgainst", I), ("shorthandedShotsAgainst", S),
    ("shorthandedGoalsAgainst", I), ("pim", I), ("toi", S)]])

ROSTER_PLAYER = T.StructType([T.StructField(n, t) for n, t in [
    ("id", L), ("firstName", _NAME), ("lastName", _NAME), ("positionCode", S), ("sweaterNumber", I),
    ("heightInInches", I), ("weightInPounds", I), ("shootsCatches", S), ("birthDate", S),
    ("birthCity", _NAME), ("birthStateProvince", _NAME), ("birthCountry", S), ("headshot", S)]])

SEED_ARENAS = "team_abv string, arena_name string, arena_capacity int, city string, state_province string"
SEED_COLORS = "team_abv string, primary_color string, secondary_color string"
SEED_HISTORY = ("team_abv string, founded_year int, previous_name string, current_location_since int, "
                "is_expansion_team boolean, is_original_or_relocated boolean")
