"""Intermediate models (M11–M31) over the staged frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonflow.functions import exprs as X
from seasonflow.operators import gapfill as G
from seasonflow.operators import joins as J
from seasonflow.operators.netting import offset_netting
from seasonflow.plans.season import schemas as S
from seasonflow.plans.season.staging import game_type_label
from seasonflow.sources.shaping import parse_json


# ------------------------------------------------------------ rosters M11-M15
def roster_players(rosters: DataFrame, roles: Sequence[str] = ("forward", "defense", "goalie")) -> DataFrame:
    """The three role arrays unnested in one pass and unioned by role."""
    src = {"forward": "forwards", "defense": "defensemen", "goalie": "goalies"}
    arr = F.array(*[F.struct(F.lit(r).alias("role"), F.col(src[r]).alias("players")) for r in roles])
    e = rosters.select("team_abv", F.inline(arr)).select("team_abv", "role", F.explode("players").alias("p"))
    return e.select(
        "team_abv", "role", F.col("p.id").alias("player_id"),
        F.col("p.firstName.default").alias("first_name"), F.col("p.lastName.default").alias("last_name"),
        F.concat_ws(" ", "p.firstName.default", "p.lastName.default").alias("full_name"),
        F.col("p.positionCode").alias("position"), F.col("p.sweaterNumber").alias("number"),
        F.col("p.heightInInches").alias("height_inches"), F.col("p.weightInPounds").alias("weight_pounds"),
        F.col("p.shootsCatches").alias("shoots_catches"),
        F.to_date("p.birthDate").alias("birth_date"), F.col("p.birthCity.default").alias("birth_city"),
        F.col("p.birthStateProvince.default").alias("birth_state"),
        F.col("p.birthCountry").alias("birth_country"), F.col("p.headshot").alias("headshot_url"))


def all_skaters(rosters: DataFrame) -> DataFrame:
    """Forwards UNION ALL defensemen."""
    return roster_players(rosters, ("forward", "defense"))


# ----------------------------------------------------------------- games M16-M19
def all_games(summaries_raw: DataFrame, games: DataFrame) -> DataFrame:
    """Deduplicated summaries left-joined to the games feed."""
    from seasonflow.operators.dedup import dedup_latest
    s = dedup_latest(summaries_raw, ["ID"], [F.col("_loaded_at").desc()])
    g = games.select(F.col("ID").alias("__id"), F.col("GAMESTATE").alias("game_state"),
                     F.col("GAMEOUTCOME_LASTPERIODTYPE").alias("outcome_period_type"),
                     F.col("NEUTRALSITE").alias("neutral_site"))
    return (s.join(g, s.ID == g.__id, "left").drop("__id", "_loaded_at")
             .withColumn("season", F.col("SEASON").try_cast("int")))


def basic_games_info(games: DataFrame) -> DataFrame:
    """Typed venue and UTC start timestamp."""
    return games.select(F.col("ID").alias("game_id"), F.col("VENUE_DEFAULT").alias("venue"),
                        F.col("VENUETIMEZONE").alias("venue_tz"), F.col("VENUEUTCOFFSET").alias("venue_utc_offset"),
                        X.parse_utc("STARTTIMEUTC").alias("start_ts_utc"))


def current_standings(cur: DataFrame) -> DataFrame:
    """Typed current table with record strings and signed differentials."""
    c = F.col
    return cur.select(
        c("TEAMABBREV_DEFAULT").alias("team_abv"), c("TEAMNAME_DEFAULT").alias("team_name"),
        c("CONFERENCENAME").alias("conference"), c("DIVISIONNAME").alias("division"),
        c("GAMESPLAYED").alias("gp"), c("POINTS").alias("points"), c("WINS").alias("wins"),
        c("LOSSES").alias("losses"), c("OTLOSSES").alias("ot_losses"),
        X.record_string("WINS", "LOSSES", "OTLOSSES").alias("record"),
        X.record_string("HOMEWINS", "HOMELOSSES", "HOMEOTLOSSES").alias("home_record"),
        X.record_string("ROADWINS", "ROADLOSSES", "ROADOTLOSSES").alias("road_record"),
        X.record_string("L10WINS", "L10LOSSES", "L10OTLOSSES").alias("l10_record"),
        (c("GOALFOR") - c("GOALAGAINST")).alias("goal_diff"),
        X.signed_string(c("GOALFOR") - c("GOALAGAINST")).alias("goal_diff_text"),
        X.signed_string("L10GOALDIFFERENTIAL").alias("l10_goal_diff_text"),
        F.concat(c("STREAKCODE"), c("STREAKCOUNT").cast("string")).alias("streak"))


def league_games(games: DataFrame, daily_standings: DataFrame) -> DataFrame:
    """Regular and playoff games whose two teams both appear in that season's
    standings (special events between non-participants drop out).  The
    participant list holds a row per season and team."""
    part = daily_standings.select(F.col("SEASONID").alias("season"), F.col("TEAMABBREV_DEFAULT").alias("team"))
    g = games.filter(F.col("GAMETYPE").isin(2, 3)).select(
        F.col("ID").alias("game_id"), F.col("SEASON").alias("season"),
        game_type_label("GAMETYPE", with_else=False).alias("game_type"), F.col("GAMEDATE").alias("game_date"),
        F.col("STARTTIMEUTC").alias("start_time_utc"), F.col("GAMESTATE").alias("game_state"),
        F.col("GAMEOUTCOME_LASTPERIODTYPE").alias("last_period_type"),
        F.col("HOMETEAM_ID").alias("home_team_id"), F.col("HOMETEAM_ABBREV").alias("home_team_abv"),
        F.col("AWAYTEAM_ID").alias("away_team_id"), F.col("AWAYTEAM_ABBREV").alias("away_team_abv"))
    return J.both_sides_in(g, part, "season", "home_team_abv", "away_team_abv", "team")


# -------------------------------------------------------- events M20, M21
def game_faceoffs(plays: DataFrame, league: DataFrame) -> DataFrame:
    """Faceoffs won per (game, team) and the game total (window over the aggregate)."""
    f = (J.semi(plays.filter((F.col("description") == "faceoff") & F.col("play_team_id").isNotNull()),
                league.select("game_id"), "game_id")
         .groupBy("game_id", F.col("play_team_id").alias("team_id")).agg(F.count(F.lit(1)).alias("faceoffs_won")))
    return f.withColumn("faceoffs_in_game", F.sum("faceoffs_won").over(Window.partitionBy("game_id")))


def game_penalties(plays: DataFrame, league: DataFrame) -> DataFrame:
    """PIM, penalties taken and times short-handed after offsetting
    (2/4/5-minute penalties at the same clock and duration cancel)."""
    p = J.semi(plays.filter((F.col("description") == "penalty") & F.col("penalty_duration").isNotNull()
                            & (F.col("penalty_duration") > 0)), league.select("game_id"), "game_id")
    p = p.select("game_id", F.col("play_team_id").alias("team_id"), "period", "time_in_period",
                 F.col("penalty_duration").alias("duration"))
    out = offset_netting(p, ["game_id"], "team_id", ["period", "time_in_period"], "duration", "duration",
                         F.col("duration").isin(2, 4, 5))
    return out.select("game_id", "team_id", F.col("total_weight").cast("bigint").alias("pim"),
                      F.col("n_events").alias("penalties_taken"), F.col("n_net").alias("times_shorthanded"))


# ---------------------------------------------------------- box score M22, M23
def _box_arrays(box: DataFrame, roles: Sequence[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(side.lower()).alias("type"), F.lit(role.lower()).alias("role"),
                             F.col(f"PLAYERBYGAMESTATS_{side}TEAM_{role}").alias("json"),
                             F.col(f"{side}TEAM_ABBREV").alias("team_abv"))
                    for side in ("HOME", "AWAY") for role in roles])
    return box.select(F.col("ID").alias("game_id"), F.col("SEASON").alias("season"),
                      game_type_label("GAMETYPE", with_else=False).alias("game_type"), F.inline(arr))


def skater_game_lines(box: DataFrame, league: DataFrame) -> DataFrame:
    """Four box-score arrays (side x role) unnested in one pass, universe-filtered."""
    a = _box_arrays(box, ("FORWARDS", "DEFENSE"))
    e = a.select("game_id", "season", "game_type", "type", "team_abv",
                 F.explode(parse_json("json", T.ArrayType(S.SKATER_LINE))).alias("p"))
    e = J.semi(e, league.select("game_id"), "game_id")
    p = lambda n: F.col(f"p.{n}")
    return e.select("game_id", "season", "game_type", "type", "team_abv", p("playerId").alias("player_id"),
                    p("name.default").alias("name"), p("position").alias("position"), p("goals").alias("goals"),
                    p("assists").alias("assists"), p("points").alias("points"), p("plusMinus").alias("plus_minus"),
                    p("pim").alias("pim"), p("hits").alias("hits"), p("sog").alias("shots"),
                    p("powerPlayGoals").alias("pp_goals"), p("giveaways").alias("giveaways"),
                    p("takeaways").alias("takeaways"), p("blockedShots").alias("blocked_shots"),
                    p("shifts").alias("shifts"), p("faceoffWinningPctg").alias("faceoff_pct"),
                    X.clock_to_seconds(p("toi")).alias("toi_seconds"))


def goalie_game_lines(box: DataFrame, league: DataFrame) -> DataFrame:
    """Goalie arrays; 'saved/against' texts parsed to ints; TOI in seconds
    (this Spark has no TIME type, so seconds stay integers end to end)."""
    a = _box_arrays(box, ("GOALIES",))
    e = a.select("game_id", "season", "game_type", "type", "team_abv",
                 F.explode(parse_json("json", T.ArrayType(S.GOALIE_LINE))).alias("p"))
    e = J.semi(e, league.select("game_id"), "game_id")
    p = lambda n: F.col(f"p.{n}")
    return e.select(
        "game_id", "season", "game_type", "type", "team_abv", p("playerId").alias("player_id"),
        p("name.default").alias("name"), p("starter").alias("starter"), p("decision").alias("result"),
        p("goalsAgainst").alias("goals_against"),
        X.fraction_part(p("saveShotsAgainst"), 1).alias("shots_saved"),
        X.fraction_part(p("saveShotsAgainst"), 2).alias("shots_against"),
        p("evenStrengthGoalsAgainst").alias("even_goals_against"),
        X.fraction_part(p("evenStrengthShotsAgainst"), 1).alias("even_shots_saved"),
        X.fraction_part(p("evenStrengthShotsAgainst"), 2).alias("even_shots_against"),
        p("powerPlayGoalsAgainst").alias("pp_goals_against"),
        X.fraction_part(p("powerPlayShotsAgainst"), 1).alias("pp_shots_saved"),
        X.fraction_part(p("powerPlayShotsAgainst"), 2).alias("pp_shots_against"),
        p("shorthandedGoalsAgainst").alias("sh_goals_against"),
        X.fraction_part(p("shorthandedShotsAgainst"), 1).alias("sh_shots_saved"),
        X.fraction_part(p("shorthandedShotsAgainst"), 2).alias("sh_shots_against"),
        p("pim").alias("pim"), X.clock_to_seconds(p("toi")).alias("toi_seconds"))


# ------------------------------------------------------------- seasons M24-M26
def skater_season(lines: DataFrame, roster: DataFrame, game_type: str = "regular") -> DataFrame:
    """Season totals per (season, player, team); the roster lookup is
    deduplicated first (a player on two rosters must not fan out, D8)."""
    s = lines.filter(F.col("game_type") == game_type).groupBy("season", "player_id", "team_abv").agg(
        F.min("name").alias("name"), F.count(F.lit(1)).alias("gp"),
        *[F.sum(c).alias(c) for c in ("goals", "assists", "points", "plus_minus", "pim", "hits", "shots",
                                      "pp_goals", "giveaways", "takeaways", "blocked_shots", "toi_seconds")])
    r = roster.groupBy("player_id").agg(F.min("position").alias("position"),
                                        F.min("headshot_url").alias("headshot_url"))
    return s.join(r, "player_id", "left")


def goalie_season(lines: DataFrame, game_type: str = "regular") -> DataFrame:
    """Goalie season totals; GAA per 60 minutes of ice time (not an average
    of per-game GA); save percentages with honest NULLs."""
    g = lines.filter((F.col("game_type") == game_type) & (F.col("starter") | F.col("result").isNotNull()))
    s = g.groupBy("season", "player_id", "team_abv").agg(
        F.min("name").alias("name"), F.count(F.lit(1)).alias("gp"),
        F.count(F.when(F.col("starter"), 1)).alias("starts"),
        F.sum("goals_against").alias("goals_against"), F.sum("toi_seconds").alias("toi_seconds"),
        F.sum("shots_saved").alias("saves"), F.sum("shots_against").alias("shots_faced"),
        F.sum("even_shots_saved").alias("even_saves"), F.sum("even_shots_against").alias("even_shots_against"),
        F.sum("pp_shots_saved").alias("pp_saves"), F.sum("pp_shots_against").alias("pp_shots_against"),
        F.sum("sh_shots_saved").alias("sh_saves"), F.sum("sh_shots_against").alias("sh_shots_against"),
        F.sum("pim").alias("pim"))
    return s.select("*", X.round_ratio(F.col("goals_against") * 3600, "toi_seconds", 2).alias("gaa"),
                    X.safe_divide("saves", "shots_faced").alias("save_pct"),
                    X.safe_divide("even_saves", "even_shots_against").alias("even_save_pct"),
                    X.safe_divide("pp_saves", "pp_shots_against").alias("pp_save_pct"),
                    X.safe_divide("sh_saves", "sh_shots_against").alias("sh_save_pct"))


def season_dates(daily_standings: DataFrame) -> DataFrame:
    """First and last standings date per season."""
    d = daily_standings.select(F.col("SEASONID").alias("season"), F.col("DATE").alias("date")).distinct()
    return G.period_bounds(d, "season", "date")


# ----------------------------------------------------------- standings M27
# carried forward: counters default to 0, places and the streak stay NULL until the first snapshot
NULL_FILLED = ("DIVISIONSEQUENCE", "WILDCARDSEQUENCE", "CONFERENCESEQUENCE", "LEAGUESEQUENCE", "STREAKCODE")
ZERO_FILLED = tuple(c for c in S.STANDING_INT_COLS if c not in NULL_FILLED)
# attributes of the season's team list, the same on every day
TEAM_NAMES = ("DIVISIONNAME", "DIVISIONABBREV", "CONFERENCENAME", "CONFERENCEABBREV", "TEAMNAME_DEFAULT")


def standings_by_day(daily: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Every (season, day, team) inside the season bounds, last snapshot
    carried forward; counters default to 0, places and streak to NULL; names come
    from the season's team list (their latest values), so they are there before
    the first snapshot too.  Snapshots become validity intervals by (season, team)."""
    d = daily.select(F.col("SEASONID").alias("season"), F.col("TEAMABBREV_DEFAULT").alias("team_abv"),
                     F.col("DATE").alias("date"), *ZERO_FILLED, *NULL_FILLED, *TEAM_NAMES)
    names = d.groupBy("season", "team_abv").agg(*[F.max_by(c, "date").alias(c) for c in TEAM_NAMES])
    d = d.drop(*TEAM_NAMES)
    fill = {**{c: 0 for c in ZERO_FILLED}, **{c: None for c in NULL_FILLED}}
    b = bounds if bounds is not None else G.period_bounds(d, "season", "date")
    out = G.gap_fill(d, "season", "team_abv", "date", fill, b)
    out = out.join(names, ["season", "team_abv"], "left")
    return out.select("season", "date", "team_abv",
                      *[F.col(c).alias(c.lower()) for c in (*S.STANDING_INT_COLS, *TEAM_NAMES)],
                      F.col("STREAKCODE").alias("streak_code"))


# ---------------------------------------------------------- team line M28
def team_game_line(summaries: DataFrame, faceoffs: DataFrame, penalties: DataFrame,
                   goalies: DataFrame, league: DataFrame, skaters: DataFrame | None = None) -> DataFrame:
    """(game, team) line: own and opponent goals and shots, special-teams
    fractions from the offset-netted penalties, faceoffs, goaltending rollup.

    pp attempts = the opponent's times short-handed; pk attempts = own;
    pk goals against = the opponent's power-play goals; shots against = what the
    team's goalies faced; missing sides -> 0.
    """
    base = J.semi(summaries, league.select("game_id"), "game_id").select(
        "game_id", "season", "game_type", "game_date", "team_id", "team_abv", "is_home", "goals",
        "goals_against", "shots", "last_period_type")
    pen = penalties.select("game_id", "team_id", "pim", "times_shorthanded")
    fo = faceoffs.select("game_id", "team_id", "faceoffs_won", "faceoffs_in_game")
    # every side lies by game, so no join below moves rows again
    gl = goalies.repartition("game_id").groupBy("game_id", "team_abv").agg(F.sum("shots_saved").alias("saves"),
                                                    F.sum("shots_against").alias("shots_against"))
    t = J.within(J.within(base, pen, "game_id", ["team_id"]), fo, "game_id", ["team_id"])
    t = J.within(t, gl, "game_id", ["team_abv"])
    if skaters is not None:
        ppg = skaters.repartition("game_id").groupBy("game_id", "team_abv").agg(F.sum("pp_goals").alias("pp_goals"),
                                                         F.sum("hits").alias("hits"),
                                                         F.sum("blocked_shots").alias("blocks"),
                                                         F.sum("giveaways").alias("giveaways"),
                                                         F.sum("takeaways").alias("takeaways"))
        t = J.within(t, ppg, "game_id", ["team_abv"])
    else:
        t = t.withColumns({"pp_goals": F.lit(0).cast("bigint"), "hits": F.lit(None).cast("bigint"),
                           "blocks": F.lit(None).cast("bigint"), "giveaways": F.lit(None).cast("bigint"),
                           "takeaways": F.lit(None).cast("bigint")})
    t = J.opponent_join(t, ["game_id"], "team_id", ["times_shorthanded", "pp_goals"], how="left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    pp_att, pk_att, pk_ga = z("opp_times_shorthanded"), z("times_shorthanded"), z("opp_pp_goals")
    return t.select(
        "game_id", "season", "game_type", "game_date", "team_id", "team_abv", "is_home", "goals",
        "goals_against", "shots", z("shots_against").alias("shots_against"), "last_period_type",
        z("pim").alias("pim"), z("pp_goals").alias("pp_goals"), pp_att.alias("pp_attempts"),
        pk_att.alias("pk_attempts"), pk_ga.alias("pk_goals_against"),
        X.safe_divide(z("pp_goals"), pp_att).alias("pp_pct"),
        X.safe_divide(pk_att - pk_ga, pk_att).alias("pk_pct"),
        X.fraction_text(z("pp_goals"), pp_att).alias("pp_text"),
        z("faceoffs_won").alias("faceoffs_won"), z("faceoffs_in_game").alias("faceoffs_in_game"),
        z("saves").alias("saves"), X.safe_divide("saves", "shots_against").alias("save_pct"), "hits", "blocks", "giveaways", "takeaways")


def team_season(team_lines: DataFrame, game_type: str = "regular") -> DataFrame:
    """Per (season, team) averages (2 decimals) and
    guarded ratios of sums (D7: always guarded)."""
    t = team_lines.filter(F.col("game_type") == game_type)
    s = t.groupBy("season", "team_abv").agg(
        F.count(F.lit(1)).alias("gp"), F.sum("goals").alias("goals"), F.sum("goals_against").alias("goals_against"),
        F.sum("shots").alias("shots"), F.sum("pim").alias("pim"), F.sum("pp_goals").alias("pp_goals"),
        F.sum("pp_attempts").alias("pp_attempts"), F.sum("pk_attempts").alias("pk_attempts"),
        F.sum("pk_goals_against").alias("pk_goals_against"), F.sum("faceoffs_won").alias("faceoffs_won"),
        F.sum("faceoffs_in_game").alias("faceoffs_total"), F.sum("hits").alias("hits"),
        F.sum("blocks").alias("blocks"), F.sum("takeaways").alias("takeaways"), F.sum("giveaways").alias("giveaways"))
    return s.select(
        "*", X.round_ratio("goals", "gp", 2).alias("goals_per_game"),
        X.round_ratio("goals_against", "gp", 2).alias("goals_against_average"),
        X.round_ratio("shots", "gp", 2).alias("shots_per_game"),
        X.round_ratio("pim", "gp", 2).alias("pim_per_game"),
        X.round_ratio(F.col("pp_goals") * 100, "pp_attempts", 2).alias("pp_pct"),
        X.round_ratio((F.col("pk_attempts") - F.col("pk_goals_against")) * 100, "pk_attempts", 2).alias("pk_pct"),
        X.round_ratio(F.col("faceoffs_won") * 100, "faceoffs_total", 2).alias("faceoff_pct"),
        X.round_ratio("hits", "gp", 2).alias("hits_per_game"), X.round_ratio("blocks", "gp", 2).alias("blocks_per_game"),
        X.round_ratio("takeaways", "gp", 2).alias("takeaways_per_game"),
        X.round_ratio("giveaways", "gp", 2).alias("giveaways_per_game"))


def teams_basic_info(teams_raw: DataFrame) -> DataFrame:
    """Typed team listing incl. a text -> boolean cast."""
    return teams_raw.select(F.col("ID").alias("team_id"), F.col("ABBREV").alias("team_abv"),
                            F.col("NAME_DEFAULT").alias("team_name"), X.text_to_bool("FRENCH").alias("is_french"))
