"""Dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seasonflow.functions import exprs as X
from seasonflow.operators import distinct as D
from seasonflow.operators import joins as J
from seasonflow.operators.dedup import dedup_latest, dedup_preference
from seasonflow.operators.reshape import union_distinct
from seasonflow.params import Params


def season_key_of(d) -> F.Column:
    """Season key by month: Oct-Dec y -> y(y+1); Jan-Jun -> (y-1)y; Jul-Sep none."""
    c = F.col(d) if isinstance(d, str) else d
    y, m = F.year(c), F.month(c)
    return (F.when(m >= 10, y * 10000 + y + 1).when(m <= 6, (y - 1) * 10000 + y)
             .otherwise(F.lit(None).cast("int")))


def dim_dates(spark: SparkSession, start: dt.date, season_dates: DataFrame, p: Params = Params()) -> DataFrame:
    """Calendar from ``start`` to ``as_of + 365`` (parameters, D4) with
    calendar parts, season key and phase, in-season counters, holiday and
    prime-day flags (weekday numbers, not names: D2, D3)."""
    spine = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.date_add(F.lit(p.as_of), 365))).alias("date"))
    m, dow = F.month("date"), X.iso_dow("date")
    d = spine.select("date", X.date_key("date").alias("date_key"), F.year("date").alias("year"), m.alias("month"),
                     F.dayofmonth("date").alias("day"), dow.alias("iso_day_of_week"),
                     F.date_format("date", "EEE").alias("day_name"), F.weekofyear("date").alias("week_of_year"),
                     F.date_format("date", "MMM").alias("month_name"), F.quarter("date").alias("quarter"),
                     (dow >= 6).alias("is_weekend"), season_key_of("date").alias("season"),
                     F.when(m.isin(7, 8, 9), "offseason").when(m.isin(10, 11, 12, 1, 2, 3), "regular_season")
                      .otherwise("playoff_period").alias("season_phase"))
    sb = season_dates.select("season", F.col("start_date").alias("season_start_date"),
                             F.col("end_date").alias("season_end_date"))
    d = d.join(F.broadcast(sb), "season", "left")      # one row per season
    inside = (F.col("date") >= F.col("season_start_date")) & (F.col("date") <= F.col("season_end_date"))
    return d.select("*", F.coalesce(inside, F.lit(False)).alias("is_in_season"),
                    F.when(inside, F.datediff("date", "season_start_date")).alias("days_from_season_start"),
                    F.when(inside, F.datediff("season_end_date", "date")).alias("days_to_season_end"),
                    (((m == 12) & F.col("day").between(24, 26)) |
                     ((m == 2) & F.col("week_of_year").isin(7, 8))).alias("is_holiday_period"),
                    (dow.isin(5, 6) | ((dow == 4) & m.isin(10, 11, 12, 1, 2, 3))).alias("is_prime_game_day"))


# Fixed values (must equal the reference's): per-season salary cap and the
# cup-winning captain, keyed by season, in season order; the COVID season.
SALARY_CAP = {
    20152016: 71500000, 20162017: 73000000, 20172018: 75000000, 20182019: 79500000,
    20192020: 81500000, 20202021: 81500000, 20212022: 81500000, 20222023: 82500000,
    20232024: 83500000, 20242025: 88000000, 20252026: 95500000,
}
CUP_CAPTAIN = {
    20152016: "Jonathan Toews", 20162017: "Sidney Crosby", 20172018: "Alexander Ovechkin",
    20182019: "Alex Pietrangelo", 20192020: "Victor Hedman", 20202021: "Victor Hedman",
    20212022: "Gabriel Landeskog", 20222023: "Jonathan Marchessault", 20232024: "Aleksander Barkov",
}
COVID_SEASON = 20202021


def _literal_map(d: dict):
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def dim_seasons(league: DataFrame, p: Params = Params(), season_dates: DataFrame | None = None) -> DataFrame:
    """Bounds and game counts by type, lengths, display, flags and literal
    lookups (``create_map``).  ``is_shortened`` treats an unfinished season as
    shortened (D12, reproduced)."""
    reg, po = F.col("game_type") == "regular", F.col("game_type") == "playoff"
    s = league.groupBy("season").agg(
        F.min(F.when(reg, F.col("game_date"))).alias("regular_season_start"),
        F.max(F.when(reg, F.col("game_date"))).alias("regular_season_end"),
        F.min(F.when(po, F.col("game_date"))).alias("playoffs_start"),
        F.max(F.when(po, F.col("game_date"))).alias("playoffs_end"),
        F.count_distinct("home_team_abv").alias("teams"))
    games = D.bitmaps(league, ["season"], {"regular_season_games": F.when(reg, F.col("game_id")),
                                           "playoff_games": F.when(po, F.col("game_id")), "total_games": "game_id"})
    s = s.join(D.counts(games, ["season"], ["regular_season_games", "playoff_games", "total_games"]), "season")
    if season_dates is not None:
        s = s.join(season_dates, "season", "left")
    else:
        s = s.withColumns({"start_date": F.col("regular_season_start"),
                           "end_date": F.coalesce("playoffs_end", "regular_season_end")})
    full = p.regular_season_games * p.team_count // 2
    key = F.col("season")
    return s.select("*", X.season_display("season").alias("season_display"),
                    F.substring(key.cast("string"), 1, 4).cast("int").alias("start_year"),
                    F.substring(key.cast("string"), 5, 4).cast("int").alias("end_year"),
                    (F.datediff("end_date", "start_date") + 1).alias("season_length_days"),
                    (F.datediff("regular_season_end", "regular_season_start") + 1).alias("regular_season_days"),
                    (F.datediff("playoffs_end", "playoffs_start") + 1).alias("playoff_length_days"),
                    (key == COVID_SEASON).alias("is_covid_season"),
                    (F.col("regular_season_games") < full).alias("is_shortened_season"),
                    (F.col("playoff_games") > 0).alias("has_playoffs"),
                    F.element_at(_literal_map(SALARY_CAP), key).alias("salary_cap"),
                    F.element_at(_literal_map(CUP_CAPTAIN), key).alias("cup_captain"))


# Seed attributes of a team; a seed that is not loaded leaves its columns NULL.
TEAM_SEEDS = ("arena_name string, arena_capacity int, city string, state_province string, founded_year int, "
              "previous_name string, current_location_since int, primary_color string, secondary_color string, "
              "is_original_or_relocated boolean, is_expansion_team boolean")


def dim_teams(current_teams: DataFrame, daily_standings: DataFrame, seeds: dict[str, DataFrame] | None = None,
              games: DataFrame | None = None, p: Params = Params()) -> DataFrame:
    """Current franchises UNION historical ones (seen in the standings but NOT
    IN the current list; ids from the games feed when given), latest division /
    conference per team, seed attributes.  The team key is the team id."""
    cur = current_teams.select("team_id", "team_abv", "team_name", "place_name", "common_name", "logo_url",
                               F.lit(True).alias("is_current"))
    latest = dedup_latest(daily_standings, ["TEAMABBREV_DEFAULT"], [F.col("DATE").desc()]).select(
        F.col("TEAMABBREV_DEFAULT").alias("team_abv"), F.col("TEAMNAME_DEFAULT").alias("team_name"),
        F.col("PLACENAME_DEFAULT").alias("place_name"), F.col("TEAMCOMMONNAME_DEFAULT").alias("common_name"),
        F.col("TEAMLOGO").alias("logo_url"), F.col("DIVISIONNAME").alias("division"),
        F.col("DIVISIONABBREV").alias("division_abv"), F.col("CONFERENCENAME").alias("conference"),
        F.col("CONFERENCEABBREV").alias("conference_abv"))
    places = ["division", "division_abv", "conference", "conference_abv"]
    hist = J.not_in(latest.drop(*places), "team_abv", cur, "team_abv")
    if games is not None:
        ids = (games.select(F.col("HOMETEAM_ABBREV").alias("team_abv"), F.col("HOMETEAM_ID").alias("team_id"))
               .unionByName(games.select(F.col("AWAYTEAM_ABBREV").alias("team_abv"), F.col("AWAYTEAM_ID").alias("team_id")))
               .distinct())
        hist = hist.join(ids, "team_abv", "left")
    else:
        hist = hist.withColumn("team_id", F.lit(None).cast("long"))
    t = cur.unionByName(hist.withColumn("is_current", F.lit(False))).join(latest.select("team_abv", *places), "team_abv", "left")
    for seed in (seeds or {}).values():
        t = t.join(seed, "team_abv", "left")
    for f in StructType.fromDDL(TEAM_SEEDS):
        if f.name not in t.columns:
            t = t.withColumn(f.name, F.lit(None).cast(f.dataType))
    return t.withColumns({
        "team_key": F.col("team_id"), "years_in_league": F.lit(p.as_of.year) - F.col("founded_year"),
        "is_original_or_relocated": F.coalesce("is_original_or_relocated", F.lit(False)),
        "is_expansion_team": F.coalesce("is_expansion_team", F.lit(False))})


def dim_players(roster: DataFrame, skater_lines: DataFrame, goalie_lines: DataFrame, p: Params = Params()) -> DataFrame:
    """players = roster UNION game appearances; last-seen team via max_by
    over (date-ish game id, team); a preferred roster row when a player is on
    several rosters (the roster of the team last played for wins, then by
    team); age, draft-year estimate, experience level, active flag."""
    apps = (skater_lines.select("player_id", "season", "game_id", "team_abv", "position", "name")
            .unionByName(goalie_lines.select("player_id", "season", "game_id", "team_abv",
                                             F.lit("G").alias("position"), "name")))
    seen = apps.groupBy("player_id").agg(
        F.max_by("team_abv", F.struct("game_id", "team_abv")).alias("last_team_abv"),
        F.max_by("position", F.struct("game_id", "team_abv")).alias("last_position_seen"),
        F.max("season").alias("last_season"), F.count_distinct("season").alias("seasons_played"),
        F.count(F.lit(1)).alias("career_games"), F.min("name").alias("seen_name"))
    latest_season = apps.agg(F.max("season").alias("__max_season"))
    ids = union_distinct(roster.select("player_id"), apps.select("player_id"))
    r = roster.join(seen.select("player_id", "last_team_abv"), "player_id", "left")
    r = dedup_preference(r, ["player_id"], F.col("team_abv") == F.col("last_team_abv"), [F.col("team_abv")])
    out = J.scalar_join(ids.join(r.drop("last_team_abv"), "player_id", "left").join(seen, "player_id", "left"),
                        latest_season)
    cg = F.coalesce(F.col("career_games"), F.lit(0))
    pos = F.coalesce(F.col("position"), F.col("last_position_seen"))
    return out.select(
        F.col("player_id").alias("player_key"), "player_id",
        F.coalesce(F.col("full_name"), F.col("seen_name")).alias("full_name"), "birth_date",
        X.age_years("birth_date", F.lit(p.as_of)).alias("current_age"),
        (F.year("birth_date") + 18).alias("draft_year_estimate"), "birth_country",
        "first_name", "last_name", "number", pos.alias("primary_position_code"),
        F.when(pos.isin("C", "L", "R"), "Forward").when(pos == "D", "Defenseman").when(pos == "G", "Goalie")
         .otherwise("Unknown").alias("position_category"),
        F.coalesce(F.col("last_team_abv"), F.col("team_abv")).alias("current_team_abv"), "headshot_url",
        F.coalesce(F.col("last_season") == F.col("__max_season"), F.lit(False)).alias("is_active"),
        (cg > 0).alias("has_experience"), F.coalesce(F.col("seasons_played"), F.lit(0)).alias("seasons_played"),
        cg.alias("career_games"),
        F.when(cg == 0, "Prospect").when(cg.between(1, 25), "Rookie").when(cg.between(26, 100), "Sophomore")
         .when(cg.between(101, 300), "Experienced").when(cg.between(301, 500), "Veteran")
         .when(cg > 500, "Elite Veteran").otherwise("Unknown").alias("experience_level"))


def dim_player_team_bridge(skater_lines: DataFrame, league: DataFrame) -> DataFrame:
    """Stints per (player, team, season) with first / last game dates,
    trade flag, acquisition type (lag over the player's stints), current-team
    flag and participation level."""
    g = league.select("game_id", "game_date")
    a = skater_lines.join(g, "game_id", "inner")
    s = a.groupBy("player_id", "team_abv", "season").agg(
        F.count(F.lit(1)).alias("games_played"), F.min_by("game_date", "game_id").alias("start_date"),
        F.max_by("game_date", "game_id").alias("end_date"), F.min("game_id").alias("first_game"))
    tr = a.groupBy("player_id", "season").agg(F.count_distinct("team_abv").alias("teams_in_season"))
    s = s.join(tr, ["player_id", "season"], "left").withColumn("was_traded", F.col("teams_in_season") > 1)
    wp = Window.partitionBy("player_id").orderBy("season", "start_date", "first_game", "team_abv")
    ws = Window.partitionBy("player_id", "season").orderBy("start_date", "first_game", "team_abv")
    s = s.select("*", F.lag("team_abv").over(wp).alias("__prev_team"), F.lag("season").over(wp).alias("__prev_season"),
                 F.row_number().over(ws).alias("__nth"),
                 F.max("end_date").over(Window.partitionBy("player_id")).alias("__last_end"))
    s = J.scalar_join(s, s.agg(F.max("season").alias("__max_season")))
    gp = F.col("games_played")
    return s.select(
        X.surrogate_key("player_id", "team_abv", "season").alias("bridge_key"), "player_id", "team_abv", "season",
        "start_date", "end_date",
        F.when(F.col("was_traded") & (F.col("__nth") > 1), "Trade").when(F.col("__prev_team") != F.col("team_abv"),
                                                                         "Free Agent")
         .when(F.col("__prev_season").isNull(), "Draft/Entry").otherwise("Retained").alias("acquisition_type"),
        ((F.col("season") == F.col("__max_season")) & (F.col("end_date") == F.col("__last_end"))).alias("is_current_team"),
        gp.alias("games_played_for_team"), F.col("was_traded").alias("traded_mid_season"), "teams_in_season",
        (F.datediff("end_date", "start_date") + 1).alias("stint_length_days"),
        F.when(gp >= 41, "Full Season").when(gp >= 20, "Significant").when(gp >= 10, "Regular")
         .when(gp >= 1, "Limited").otherwise("None").alias("participation_level"))
