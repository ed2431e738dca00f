"""Published tables of the facts, the team dimension and the season metrics: the
column names and order that readers of the tables rely on, over the models'
own frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import joins as J
from seasonflow.operators.distributed import RankOf, global_ranks
from seasonflow.operators.dedup import dedup_latest
from seasonflow.params import Params
from seasonflow.plans.season import schemas as S


def _share(num, den, default: float | None = 0.0) -> Column:
    """A plain ratio; ``default`` where the denominator is not positive."""
    n, d = (F.col(x) if isinstance(x, str) else x for x in (num, den))
    return F.when(d > 0, n.cast("double") / d).otherwise(F.lit(default).cast("double"))


def _named(**names: str | Column) -> list[Column]:
    return [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in names.items()]


def _keys(teams: DataFrame, prefix: str = "") -> DataFrame:
    return teams.select(F.col("team_abv").alias(f"{prefix}abv"), F.col("team_key").alias(f"{prefix}team_key"))


def _with_sides(df: DataFrame, league: DataFrame, teams: DataFrame) -> DataFrame:
    """A player line with its date, team key and the opponent's team key."""
    g = league.select("game_id", "game_date", "home_team_abv", "away_team_abv")
    j = df.join(g, "game_id", "left").withColumn(
        "opp_abv_", F.when(F.col("type") == "home", F.col("away_team_abv")).otherwise(F.col("home_team_abv")))
    return (j.join(_keys(teams), F.col("team_abv") == F.col("abv"), "left").drop("abv")
             .join(_keys(teams, "opponent_"), F.col("opp_abv_") == F.col("opponent_abv"), "left"))


def team_game_stats(fact: DataFrame, teams: DataFrame) -> DataFrame:
    """M42, one row per (game, team)."""
    t = (fact.join(_keys(teams), F.col("team_abv") == F.col("abv"), "left").drop("abv"))
    opp = fact.select(F.col("game_id").alias("g_"), F.col("team_id").alias("o_"), F.col("team_abv").alias("oa_"))
    t = t.join(opp, (F.col("game_id") == F.col("g_")) & (F.col("opponent_team_id") == F.col("o_")), "left")
    t = t.join(_keys(teams, "opponent_"), F.col("oa_") == F.col("opponent_abv"), "left")
    shots = F.col("shots") + F.col("shots_against")
    return t.select(*_named(
        team_game_key="team_game_key", game_key="game_id", team_key="team_key", opponent_team_key="opponent_team_key",
        date_key=X.date_key("game_date"), season_key="season", is_home="is_home", game_result="game_result",
        points_earned="points", goals_for="goals", goals_against="goals_against",
        goal_differential=F.col("goals") - F.col("goals_against"), shots_for="shots", shots_against="shots_against",
        shooting_pct=_share("goals", "shots"), save_pct="save_pct", powerplay_goals="pp_goals",
        powerplay_opportunities="pp_attempts", powerplay_pct=_share("pp_goals", "pp_attempts"),
        penalty_kill_goals_against="pk_goals_against", penalty_kill_situations="pk_attempts",
        penalty_kill_pct=_share(F.col("pk_attempts") - F.col("pk_goals_against"), "pk_attempts"),
        faceoff_wins="faceoffs_won", faceoff_losses=F.col("faceoffs_in_game") - F.col("faceoffs_won"),
        faceoff_win_pct=_share("faceoffs_won", "faceoffs_in_game", None), hits="hits", blocks="blocks",
        giveaways="giveaways", takeaways="takeaways", penalty_minutes="pim", score_first_flag="score_first_flag",
        lead_after_1st="lead_after_1st", lead_after_2nd="lead_after_2nd", comeback_win_flag="comeback_win_flag",
        game_type="game_type", game_date="game_date", game_outcome="game_outcome", game_id="game_id",
        team_abv="team_abv", is_overtime=F.col("game_outcome") == "OT", is_shootout=F.col("game_outcome") == "SO",
        shorthanded_goals_against="pk_goals_against", times_shorthanded="pk_attempts",
        shot_differential=F.col("shots") - F.col("shots_against"), scored_5_plus=F.col("goals") >= 5,
        shutout_for=F.col("goals_against") == 0, shutout_against=F.col("goals") == 0,
        pp_drought=(F.col("pp_attempts") > 0) & (F.col("pp_goals") == 0),
        perfect_pk=(F.col("pk_attempts") > 0) & (F.col("pk_goals_against") == 0),
        shot_share_pct=_share("shots", shots, 0.5)))


def player_game_stats(fact: DataFrame, league: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """M39, one row per (game, skater)."""
    t = _with_sides(fact, league, teams)
    t = t.join(players.select("player_id", F.col("primary_position_code").alias("p_"), "number"), "player_id", "left")
    same = {c: c for c in ("goals", "assists", "primary_assists", "secondary_assists", "points", "plus_minus", "shots")}
    return t.select(*_named(
        player_game_key="player_game_key", game_key="game_id", player_key="player_id", team_key="team_key",
        date_key=X.date_key("game_date"), season_key="season", opponent_team_key="opponent_team_key",
        is_home_game=F.col("type") == "home", position_played=F.coalesce("position", "p_"), jersey_number="number",
        **same, shooting_pct=_share("goals", "shots"), hits="hits", blocks="blocked_shots", giveaways="giveaways",
        takeaways="takeaways", faceoff_pct="faceoff_pct", faceoffs_won="faceoffs_won", faceoffs_lost="faceoffs_lost",
        penalty_minutes="pim", time_on_ice_seconds="toi_seconds", pp_goals="pp_goals", pp_assists="pp_assists",
        sh_goals="shorthanded_goals", sh_assists="sh_assists", empty_net_goals="empty_net_goals",
        game_winning_goals="game_winning_goals", overtime_goals="overtime_goals", shifts="shifts",
        game_type="game_type", player_id="player_id", game_id="game_id", team_abv="team_abv", player_name="name",
        hat_trick="is_hat_trick", four_point_game="is_four_point_game", four_goal_game="is_four_goal_game",
        point_contributions=F.col("goals") + F.col("assists")))


def goalie_game_stats(fact: DataFrame, league: DataFrame, teams: DataFrame) -> DataFrame:
    """M38, one row per (game, goalie)."""
    t = _with_sides(fact, league, teams)
    splits = {}
    for name, k in (("even_strength", "even"), ("powerplay", "pp"), ("shorthanded", "sh")):
        splits |= {f"{name}_saves": f"{k}_shots_saved", f"{name}_shots": f"{k}_shots_against",
                   f"{name}_goals_against": f"{k}_goals_against",
                   f"{name}_save_pct": _share(f"{k}_shots_saved", f"{k}_shots_against", None)}
    return t.select(*_named(
        goalie_game_key="goalie_game_key", game_key="game_id", player_key="player_id", team_key="team_key",
        date_key=X.date_key("game_date"), season_key="season", opponent_team_key="opponent_team_key",
        is_home_game=F.col("type") == "home", is_starting_goalie="starter", decision="result",
        shots_faced="shots_against", saves="shots_saved", goals_against="goals_against", save_percentage="save_pct",
        goals_against_average="goals_against_per_60", time_on_ice_seconds="toi_seconds", **splits,
        shutout_flag="is_shutout", goals_allowed_1st="ga_p1", goals_allowed_2nd="ga_p2", goals_allowed_3rd="ga_p3",
        goals_allowed_ot="ga_ot", penalty_minutes="pim", performance_category="save_tier",
        is_relief_appearance="is_relief", game_type="game_type", player_id="player_id", game_id="game_id",
        team_abv="team_abv", player_name="name", quality_start="quality_start", really_bad_start="bad_start",
        saves_above_average="saves_above_average"))


def standings_daily(by_day: DataFrame, base: DataFrame, teams: DataFrame, p: Params = Params()) -> DataFrame:
    """M41, one row per (date, team).  ``base`` is the standings fact's frame."""
    b = base.select(F.col("date").alias("d_"), F.col("season").alias("s_"), F.col("team_abv").alias("t_"), "standings_key",
                    "in_playoff_position", "points_from_playoff_line")
    t = by_day.join(b, (F.col("date") == F.col("d_")) & (F.col("season") == F.col("s_")) & (F.col("team_abv") == F.col("t_")),
                    "left").join(_keys(teams), F.col("team_abv") == F.col("abv"), "left")
    gp, n = F.col("gamesplayed"), p.regular_season_games
    diff = F.col("goalfor") - F.col("goalagainst")

    def pace(c: str) -> Column:
        return F.coalesce(X.round_ratio(F.col(c) * n, "gamesplayed", 1), F.lit(0.0))

    def record(*cols: str) -> Column:
        return F.concat_ws("-", *[F.col(c).cast("string") for c in cols])
    return t.select(*_named(
        standings_daily_key="standings_key", date_key=X.date_key("date"), season_key="season", team_key="team_key",
        games_played=gp, wins="wins", losses="losses", ot_losses="otlosses", points="points",
        regulation_wins="regulationwins", row_wins="regulationplusotwins", points_percentage=_share("points", gp * 2),
        goals_for="goalfor", goals_against="goalagainst", goal_differential=diff, home_wins="homewins",
        home_losses="homelosses", home_ot_losses="homeotlosses", away_wins="roadwins", away_losses="roadlosses",
        away_ot_losses="roadotlosses", shootout_wins="shootoutwins", shootout_losses="shootoutlosses",
        last_10_wins="l10wins", last_10_losses="l10losses", last_10_ot_losses="l10otlosses", last_10_points="l10points",
        last_10_goals_for="l10goalsfor", last_10_goals_against="l10goalsagainst",
        last_10_goal_differential="l10goaldifferential", streak_type="streak_code", streak_count="streakcount",
        division_rank="divisionsequence", conference_rank="conferencesequence", league_rank="leaguesequence",
        wildcard_rank="wildcardsequence", playoff_spot_flag="in_playoff_position",
        points_from_playoff="points_from_playoff_line", games_remaining=F.lit(n) - gp,
        max_possible_points=F.col("points") + (F.lit(n) - gp) * 2, magic_number=F.lit(None).cast("int"),
        elimination_number=F.lit(None).cast("int"), points_pace=pace("points"), wins_pace=pace("wins"),
        goals_for_pace=pace("goalfor"), goals_against_pace=pace("goalagainst"),
        record=record("wins", "losses", "otlosses"), home_record=record("homewins", "homelosses", "homeotlosses"),
        away_record=record("roadwins", "roadlosses", "roadotlosses"),
        last_10_record=record("l10wins", "l10losses", "l10otlosses"),
        shootout_record=record("shootoutwins", "shootoutlosses"),
        goal_diff_string=F.when(diff > 0, F.concat(F.lit("+"), diff.cast("string"))).otherwise(diff.cast("string")),
        streak_string=F.concat("streak_code", F.col("streakcount").cast("string"))))


def teams_table(teams: DataFrame) -> DataFrame:
    """M36."""
    same = ("team_key", "team_id", "team_abv", "team_name")
    return teams.select(*same, *_named(
        team_location="place_name", common_name="common_name", conference="conference", conference_abv="conference_abv",
        division="division", division_abv="division_abv", arena_name="arena_name", arena_capacity="arena_capacity",
        arena_city="city", arena_state_province="state_province", founded_year="founded_year",
        previous_name="previous_name", current_location_since="current_location_since", years_in_league="years_in_league",
        logo_url="logo_url", primary_color="primary_color", secondary_color="secondary_color",
        is_original_or_relocated="is_original_or_relocated", is_expansion_team="is_expansion_team", is_active="is_current"))


def season_metrics(stats: DataFrame, teams: DataFrame, p: Params = Params()) -> DataFrame:
    """M45 over the published team games: the latest season's regular games per
    team, with league, conference and division ranks and percentiles."""
    cur = J.keep_max(stats.filter(F.col("game_date") <= F.lit(p.as_of)), "season_key").filter(F.col("game_type") == "regular")
    names = teams.select(F.col("team_key").alias("k_"), "team_name", "division", "conference")
    s = cur.join(names, F.col("team_key") == F.col("k_")).groupBy(
        "team_key", "team_abv", "team_name", "division", "conference").agg(
        F.count(F.lit(1)).alias("games_played"), F.count_if(F.col("game_result") == "W").alias("wins"),
        F.count_if(F.col("game_result") == "L").alias("regulation_losses"),
        F.count_if(F.col("game_result") == "OTL").alias("ot_losses"),
        *[F.sum(c).alias(f"s_{c}") for c in (
            "goals_for", "goals_against", "shots_for", "shots_against", "hits", "blocks", "takeaways", "giveaways",
            "penalty_minutes", "powerplay_goals", "powerplay_opportunities", "shorthanded_goals_against",
            "times_shorthanded", "faceoff_wins", "faceoff_losses")])
    gp, c = F.col("games_played"), lambda n: F.col(f"s_{n}")

    def pct(num: Column, den: Column, default: float) -> Column:
        return F.coalesce(X.round_ratio(num * 100, den, 2), F.lit(default))
    fo = c("faceoff_wins") + c("faceoff_losses")
    s = s.withColumns({
        "points": F.col("wins") * 2 + F.col("ot_losses"),
        "power_play_pct": pct(c("powerplay_goals"), c("powerplay_opportunities"), 0.0),
        "penalty_kill_pct": pct(c("times_shorthanded") - c("shorthanded_goals_against"), c("times_shorthanded"), 100.0),
        "faceoff_win_pct": pct(c("faceoff_wins"), fo, 50.0), "shooting_pct": pct(c("goals_for"), c("shots_for"), 0.0),
        "save_pct": pct(c("shots_against") - c("goals_against"), c("shots_against"), 100.0),
        **{f"{n}_pg": c(n).cast("double") / gp for n in ("goals_for", "goals_against", "hits", "blocks", "shots_for",
                                                         "shots_against", "takeaways", "giveaways", "penalty_minutes")}})

    # league ranks (NULLs last) and percentiles (the best value has 100)
    s = s.withColumn("league", F.struct("points", "wins", (F.col("goals_for_pg") - F.col("goals_against_pg")).alias("d")))
    better = {"league": True, **{f"{n}_pg": n not in ("goals_against", "shots_against", "giveaways") for n in (
        "goals_for", "goals_against", "hits", "blocks", "shots_for", "shots_against", "takeaways", "giveaways")},
        **{f"{n}_pct": True for n in ("power_play", "penalty_kill", "shooting", "save", "faceoff_win")}}
    in_percent = ("goals_for_pg", "goals_against_pg", "hits_pg", "blocks_pg", "power_play_pct", "penalty_kill_pct")
    s = global_ranks(s, [RankOf(f"r_{n}", n, not high) for n, high in better.items()]
                     + [RankOf(f"p_{n}", n, better[n], nulls_last=False, kind="percent_rank") for n in in_percent])
    best = lambda col: F.col(f"r_{col}")
    percentile = lambda col: F.round(F.col(f"p_{col}") * 100, 1)
    record = [F.col("points").desc(), F.col("wins").desc()]

    def within(by: str) -> Column:
        return F.rank().over(Window.partitionBy(by).orderBy(*record))
    one = lambda n, digits: F.round(F.col(f"{n}_pg"), digits)
    return s.select("team_key", "team_abv", "team_name", "division", "conference", "games_played", "wins",
                    "regulation_losses", "ot_losses", "points", *_named(
        points_pct=X.round_ratio(F.col("points") * 100, gp * 2, 3),
        league_rank=best("league"),
        conference_rank=within("conference"), division_rank=within("division"),
        goals_per_game=one("goals_for", 2), goals_per_game_rank=best("goals_for_pg"),
        goals_per_game_percentile=percentile("goals_for_pg"), goals_against_average=one("goals_against", 2),
        goals_against_rank=best("goals_against_pg"),
        goals_against_percentile=percentile("goals_against_pg"),
        hits_per_game=one("hits", 1), hits_per_game_rank=best("hits_pg"), hits_percentile=percentile("hits_pg"),
        blocks_per_game=one("blocks", 1), blocks_per_game_rank=best("blocks_pg"),
        blocks_percentile=percentile("blocks_pg"),
        power_play_pct="power_play_pct", power_play_rank=best("power_play_pct"),
        power_play_percentile=percentile("power_play_pct"),
        penalty_kill_pct="penalty_kill_pct", penalty_kill_rank=best("penalty_kill_pct"),
        penalty_kill_percentile=percentile("penalty_kill_pct"),
        shots_per_game=one("shots_for", 1), shots_per_game_rank=best("shots_for_pg"),
        shots_against_per_game=one("shots_against", 1), shots_against_rank=best("shots_against_pg"),
        shooting_pct="shooting_pct", shooting_pct_rank=best("shooting_pct"), save_pct="save_pct",
        save_pct_rank=best("save_pct"), faceoff_win_pct="faceoff_win_pct", faceoff_rank=best("faceoff_win_pct"),
        takeaways_per_game=one("takeaways", 1), takeaways_rank=best("takeaways_pg"),
        giveaways_per_game=one("giveaways", 1), giveaways_rank=best("giveaways_pg"),
        penalty_minutes_per_game=one("penalty_minutes", 1),
        goal_diff_per_game=F.round(F.col("goals_for_pg") - F.col("goals_against_pg"), 2),
        goal_differential=c("goals_for") - c("goals_against"), total_pp_opportunities="s_powerplay_opportunities",
        total_pp_goals="s_powerplay_goals", total_times_shorthanded="s_times_shorthanded",
        last_updated=F.lit(p.as_of).cast("timestamp")))


def head_to_head(stats: DataFrame, teams: DataFrame) -> DataFrame:
    """Season series between every pair of teams that met."""
    opp = teams.select(F.col("team_key").alias("k_"), F.col("team_abv").alias("opponent_abv"))
    t = stats.join(opp, F.col("opponent_team_key") == F.col("k_"), "left").groupBy(
        F.col("season_key").alias("season"), "game_type", "team_abv", "opponent_abv").agg(
        F.count(F.lit(1)).alias("games_played"), *[F.count_if(F.col("game_result") == r).alias(n) for n, r in (
            ("wins", "W"), ("losses", "L"), ("ot_losses", "OTL"))],
        *[F.sum(c).alias(c) for c in ("points_earned", "goals_for", "goals_against")])
    return t.select("season", X.season_display("season").alias("season_display"), "game_type", "team_abv", "opponent_abv",
                    "games_played", "wins", "losses", "ot_losses",
                    X.record_string("wins", "losses", "ot_losses").alias("record"), "points_earned", "goals_for",
                    "goals_against", (F.col("goals_for") - F.col("goals_against")).alias("goal_differential"))


# published name -> standings column
_STANDING = dict(
    games_played="gamesplayed", points="points", wins="wins", losses="losses", ot_losses="otlosses",
    goals_for="goalfor", goals_against="goalagainst", division_rank="divisionsequence",
    conference_rank="conferencesequence", league_rank="leaguesequence", wildcard_rank="wildcardsequence")


def _standing(by_day: DataFrame) -> DataFrame:
    t = by_day.select("season", "date", "team_abv", *_named(
        team_name="teamname_default", division="divisionname", conference="conferencename", **_STANDING),
        "regulationwins", "regulationplusotwins", "homewins", "homelosses", "homeotlosses", "roadwins", "roadlosses",
        "roadotlosses", "l10wins", "l10losses", "l10otlosses", "l10points", "l10goalsfor", "l10goalsagainst", "shootoutwins",
        "shootoutlosses", "streak_code", "streakcount")
    return t.withColumns({"season_display": X.season_display("season"), "goal_diff": F.col("goals_for") - F.col("goals_against"),
                          "point_pct": _share("points", F.col("games_played") * 2)})


def team_form(by_day: DataFrame) -> DataFrame:
    """The latest standings of each team in each season."""
    t = _standing(dedup_latest(by_day, ["season", "team_abv"], [F.col("date").desc()]))

    def record(*cols: str) -> Column:
        return F.concat_ws("-", *[F.col(c).cast("string") for c in cols])
    return t.select("season", "season_display", F.col("date").alias("as_of_date"), "team_abv", "team_name", "division",
                    "conference", "games_played", "points", "point_pct", "wins", "losses", "ot_losses", *_named(
        regulation_wins="regulationwins", row_wins="regulationplusotwins", goals_for="goals_for",
        goals_against="goals_against", goal_diff="goal_diff", division_rank="division_rank",
        conference_rank="conference_rank", league_rank="league_rank", wildcard_rank="wildcard_rank",
        record=record("wins", "losses", "ot_losses"), home_record=record("homewins", "homelosses", "homeotlosses"),
        road_record=record("roadwins", "roadlosses", "roadotlosses"),
        last_10_record=record("l10wins", "l10losses", "l10otlosses"), last_10_points="l10points",
        last_10_goals_for="l10goalsfor", last_10_goals_against="l10goalsagainst",
        shootout_record=record("shootoutwins", "shootoutlosses"),
        streak=F.concat("streak_code", F.col("streakcount").cast("string")), streak_code="streak_code",
        streak_count="streakcount"))


def standings_weekly(by_day: DataFrame) -> DataFrame:
    """Mondays and each season's final date."""
    last = by_day.groupBy("season").agg(F.max("date").alias("final_"))
    t = _standing(by_day).join(last, "season").filter(X.is_monday("date") | (F.col("date") == F.col("final_")))
    return t.select("date", "season", "season_display", "team_abv", "team_name", "division", "conference", "games_played",
                    "points", "point_pct", "wins", "losses", "ot_losses", F.col("regulationplusotwins").alias("row_wins"),
                    "goals_for", "goals_against", "goal_diff", "division_rank", "conference_rank", "league_rank",
                    "wildcard_rank", (F.col("date") == F.col("final_")).alias("is_season_final"),
                    F.weekofyear("date").alias("week_of_year"))


def three_stars(stars: DataFrame, league: DataFrame, players: DataFrame) -> DataFrame:
    """The stars of league games with a player's selections in the season (an
    aggregate joined back, so a much selected player is no hot window)."""
    s = stars.join(league.select("game_id"), "game_id", "left_semi")
    n = s.groupBy(F.col("season").alias("s_"), F.col("player_id").alias("p_")).agg(
        F.count(F.lit(1)).alias("star_selections_this_season"), F.count_if(F.col("star") == 1).alias("first_star_selections"))
    s = s.join(n, F.col("season").eqNullSafe(F.col("s_")) & F.col("player_id").eqNullSafe(F.col("p_")))
    s = s.join(players.select(F.col("player_id").alias("h_"), "headshot_url"), F.col("player_id") == F.col("h_"), "left")
    return s.select("game_id", "season", X.season_display("season").alias("season_display"), "game_date",
                    F.col("star").alias("star_number"), "player_id", F.col("name").alias("player_name"), "team_abv",
                    "position", "goals", "assists", "points", "gaa", "save_pct", "headshot_url",
                    "star_selections_this_season", "first_star_selections")


def goalie_season(stats: DataFrame, players: DataFrame, game_type: str = "regular", p: Params = Params()) -> DataFrame:
    """M49 / M50 over the published goalie games."""
    count = lambda cond: F.count_if(cond)
    sums = dict(goals_against="goals_against", toi_seconds="time_on_ice_seconds", saves="saves", shots_faced="shots_faced",
                even_goals_against="even_strength_goals_against", even_shots_saved="even_strength_saves",
                even_shots_against="even_strength_shots", pp_ga="powerplay_goals_against", pp_saves="powerplay_saves",
                pp_shots_against="powerplay_shots", sh_goals_against="shorthanded_goals_against",
                sh_saves="shorthanded_saves", sh_shots_against="shorthanded_shots", pim="penalty_minutes")
    s = stats.filter(F.col("game_type") == game_type).groupBy(F.col("season_key").alias("season"), "player_id", "team_abv").agg(
        F.min("player_name").alias("name"), count(F.col("time_on_ice_seconds") > 0).alias("gp"),
        F.count(F.lit(1)).alias("games_dressed"), count(F.col("is_starting_goalie")).alias("starts"),
        count(F.col("decision") == "W").alias("wins"), count(F.col("decision") == "L").alias("losses"),
        count(F.col("decision") == "O").alias("ot_losses"), count(F.col("shutout_flag")).alias("shutouts"),
        count(F.col("quality_start")).alias("quality_starts"), *[F.sum(v).alias(k) for k, v in sums.items()])
    s = s.select("season", "player_id", "name", "team_abv", "gp", "games_dressed", "starts", "wins", "losses", "ot_losses",
                 "shutouts", "quality_starts", *sums)
    average = F.lit(p.avg_save_pct).cast("decimal(4,3)")
    out = s.select("*", *_named(
        gaa=X.round_ratio(F.col("goals_against") * 3600, "toi_seconds", 2), save_pct=_share("saves", "shots_faced", None),
        even_save_pct=_share("even_shots_saved", "even_shots_against", None),
        pp_save_pct=_share("pp_saves", "pp_shots_against", None), sh_save_pct=_share("sh_saves", "sh_shots_against", None),
        goals_saved_above_average=F.round(F.col("saves") - F.col("shots_faced") * average, 1).cast("double"),
        is_qualified=F.col("gp") >= p.min_games_goalie, season_display=X.season_display("season")))
    return _with_player(out, players, p)


def skater_season(stats: DataFrame, players: DataFrame, game_type: str = "regular", p: Params = Params()) -> DataFrame:
    """M59 / M60 over the published skater games."""
    first = dict(goals="goals", assists="assists", hits="hits", shots="shots", pim="penalty_minutes", plus_minus="plus_minus",
                 points="points", pp_goals="pp_goals", giveaways="giveaways", takeaways="takeaways", shifts="shifts",
                 total_toi="time_on_ice_seconds")
    rest = ("primary_assists", "secondary_assists", "pp_assists", "sh_goals", "sh_assists", "empty_net_goals",
            "game_winning_goals", "overtime_goals", "faceoffs_won", "faceoffs_lost")
    s = stats.filter(F.col("game_type") == game_type).groupBy(F.col("season_key").alias("season"), "player_id", "team_abv").agg(
        F.min("player_name").alias("name"), F.count(F.lit(1)).alias("games_played"),
        *[F.sum(v).alias(k) for k, v in first.items()], F.avg("time_on_ice_seconds").alias("avg_toi"),
        *[F.sum(c).alias(c) for c in rest])
    gp = F.col("games_played")
    out = s.select("*", *_named(
        faceoff_pct=_share("faceoffs_won", F.col("faceoffs_won") + F.col("faceoffs_lost"), None),
        points_per_game=X.round_ratio("points", gp, 2), goals_per_game=X.round_ratio("goals", gp, 2),
        assists_per_game=X.round_ratio("assists", gp, 2), points_per_60=X.round_ratio(F.col("points") * 3600, "total_toi", 2),
        goals_per_60=X.round_ratio(F.col("goals") * 3600, "total_toi", 2), is_qualified=gp >= p.min_games_skater,
        season_display=X.season_display("season")))
    return _with_player(out, players, p, position=True)


def _with_player(s: DataFrame, players: DataFrame, p: Params, position: bool = False) -> DataFrame:
    who = players.select(F.col("player_id").alias("i_"), "first_name", "last_name",
                         F.col("primary_position_code").alias("position"), F.col("headshot_url").alias("shot_"))
    j = s.join(who, F.col("player_id") == F.col("i_"), "left")
    made = F.lit(None).cast("string") if p.headshot_prefix is None else F.concat(
        F.lit(p.headshot_prefix), F.concat_ws("/", F.col("season").cast("string"), "team_abv",
                                              F.col("player_id").cast("string")), F.lit(".png"))
    return j.select(*s.columns, "first_name", "last_name", *(["position"] if position else []),
                    F.coalesce("shot_", made).alias("headshot_url"))


# Shot distance bands, zone and position names, nationalities by birth country.
ZONES = {"O": "Offensive", "D": "Defensive", "N": "Neutral"}
POSITIONS = {"C": "Center", "L": "Left Wing", "R": "Right Wing", "D": "Defenseman", "G": "Goalie"}
NATIONALITIES = {"USA": "American", "CAN": "Canadian", "SWE": "Swedish", "FIN": "Finnish", "RUS": "Russian", "CZE": "Czech",
                 "SVK": "Slovak", "CHE": "Swiss", "DEU": "German", "DNK": "Danish", "NOR": "Norwegian", "LVA": "Latvian",
                 "AUT": "Austrian", "FRA": "French", "SVN": "Slovenian"}


def _text(names: dict[str, str], code: str | Column, otherwise: str | Column | None = None) -> Column:
    """The name of a code; ``otherwise`` (default: the code itself) for an unknown one."""
    c = F.col(code) if isinstance(code, str) else code
    e = F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in names.items()])
    return F.coalesce(e, F.lit(otherwise) if isinstance(otherwise, str) else c if otherwise is None else otherwise)


def plays(fact: DataFrame, staged: DataFrame, teams: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per (game, event) with its place on the ice and all names.  The event's
    place comes from the staged plays of the same key."""
    where = staged.select(F.col("game_id").alias("g_"), F.col("event_id").alias("e_"), "time_remaining", "type_code",
                          "x_pos", "y_pos", "zone_code")
    t = fact.join(where, (F.col("game_id") == F.col("g_")) & (F.col("event_id") == F.col("e_")), "left")
    keys = teams.select(F.col("team_id").alias("t_"), "team_key")
    t = t.join(keys, F.col("event_team_key") == F.col("t_"), "left")
    band = (F.when(F.col("shot_distance") <= 10, "Close").when(F.col("shot_distance") <= 25, "Medium")
            .when(F.col("shot_distance") > 25, "Long"))
    return t.select("play_key", *_named(
        game_key="game_id", date_key="date_key", season_key="season", event_idx="event_id", period_number="period",
        period_type="period_type", time_elapsed_seconds="elapsed_seconds", game_elapsed_seconds="game_elapsed_seconds",
        time_in_period="time_in_period", time_remaining="time_remaining", event_type_id="type_code",
        event_type_name="event_type_name"), F.col("team_key").alias("event_team_key"), "primary_player_key",
        "secondary_player_key", "tertiary_player_key", "goalie_player_key", F.col("x_pos").alias("x_coordinate"),
        F.col("y_pos").alias("y_coordinate"), "zone_code", "shot_type", "shot_distance", "shot_angle", "is_goal", "is_penalty",
        "penalty_type", "penalty_severity", "penalty_minutes", "strength_code", "strength_state", "is_empty_net",
        "is_powerplay", "is_shorthanded", _text(ZONES, "zone_code", "Unknown").alias("zone_name"),
        band.alias("shot_distance_category"), "period_category")


def players_table(dim: DataFrame, roster: DataFrame) -> DataFrame:
    """M34 with birth place, size and names, from the roster row that the dimension chose:
    the current team's, else the first by team."""
    r = roster.select(F.col("player_id").alias("i_"), "team_abv", "birth_city", "birth_state", "height_inches",
                      "weight_pounds", "shoots_catches", F.col("number").alias("n_"))
    j = dim.join(r, F.col("player_id") == F.col("i_"), "left")
    j = dedup_latest(j, ["player_id"], [(F.col("team_abv") == F.col("current_team_abv")).cast("int").desc_nulls_last(),
                                        F.col("team_abv").asc_nulls_last()])
    return j.select(
        "player_key", "player_id", "first_name", "last_name", "full_name", "birth_date", "current_age", "draft_year_estimate",
        "birth_city", "birth_state", "birth_country", _text(NATIONALITIES, "birth_country").alias("nationality"), "height_inches",
        "weight_pounds", "shoots_catches", "primary_position_code", _text(POSITIONS, "primary_position_code").alias("primary_position_name"),
        "position_category", "current_team_abv", F.col("n_").alias("jersey_number"), "is_active",
        F.col("has_experience").alias("has_nhl_experience"), "seasons_played", "career_games", "headshot_url", "experience_level")


def all_players(roster: DataFrame) -> DataFrame:
    """Every rostered player of every team."""
    return roster.select("team_abv", "player_id", "first_name", "last_name", "position", "number", *_named(
        height="height_inches", weight="weight_pounds", shoots="shoots_catches"), "birth_date", "birth_city", "birth_state",
        "birth_country", "headshot_url")


def shot_metrics(metrics: DataFrame, plays_fact: DataFrame, lines: DataFrame, teams: DataFrame) -> DataFrame:
    """M55 over the model's sums; games played are those with a shot attempt outside of a
    shootout, and a team's rows are those of such games."""
    shots = plays_fact.filter(F.col("event_type_name").isin("goal", "shot-on-goal", "missed-shot", "blocked-shot")
                              & (F.col("period_category") != "Shootout") & F.col("event_side").isNotNull())
    seen = J.semi(lines.select("game_id", "season", "team_abv"), shots.select("game_id"), "game_id")
    played = seen.groupBy(F.col("season").alias("s_"), F.col("team_abv").alias("t_")).agg(F.count(F.lit(1)).alias("games_played"))
    m = metrics.join(played, (F.col("season") == F.col("s_")) & (F.col("team_abv") == F.col("t_")))
    m = m.join(teams.select(F.col("team_abv").alias("a_"), "team_name"), F.col("team_abv") == F.col("a_"), "left")
    return m.select(
        "season", X.season_display("season").alias("season_display"), "team_abv", "team_name", "games_played", *_named(
            shot_attempts_for="cf", shot_attempts_against="ca", corsi_pct=_percent("cf", "ca"), fenwick_for="ff",
            fenwick_against="fa", fenwick_pct=_percent("ff", "fa"), ev_shot_attempts_for="cf_even",
            ev_shot_attempts_against="ca_even", ev_corsi_pct=_percent("cf_even", "ca_even")), "shooting_pct", "save_pct", "pdo")


def _percent(own: str, other: str) -> Column:
    return X.round_ratio(own, F.col(own) + F.col(other), 4)


def games_table(all_games: DataFrame, info: DataFrame, league: DataFrame, lines: DataFrame, teams: DataFrame) -> DataFrame:
    """League games with both sides' figures, regulation score, outcome and flags.
    Attendance is not in the feed (NULL)."""
    h, a = F.col("HOMETEAM_SCORE"), F.col("AWAYTEAM_SCORE")
    g = (all_games.join(league.select(F.col("game_id").alias("l_"), F.col("game_type").alias("type_"),
                                      F.col("game_date").alias("date_")), F.col("ID") == F.col("l_"))
         .join(info.select(F.col("game_id").alias("i_"), F.col("venue"), "venue_tz", "venue_utc_offset",
                           F.col("start_ts_utc")), F.col("ID") == F.col("i_"), "left"))
    stats = ("shots", "hits", "pim", "pp_goals", "pp_attempts", "faceoff_pct")
    line = lines.withColumn("faceoff_pct", _share("faceoffs_won", "faceoffs_in_game", None))
    home, away = F.col("is_home"), ~F.col("is_home")
    sides = line.groupBy(F.col("game_id").alias("s_")).agg(*[
        F.sum(F.when(side, F.col(c))).alias(f"{name}_{c}") for c in stats for name, side in (("home", home), ("away", away))])
    g = g.join(sides, F.col("ID") == F.col("s_"), "left")
    for side in ("home", "away"):
        g = g.join(_keys(teams, f"{side}_"), F.col(f"{side.upper()}TEAM_ABBREV") == F.col(f"{side}_abv"), "left").drop(f"{side}_abv")
    end = F.col("outcome_period_type")
    late = end.isin("OT", "SO")

    def regulation(own: Column, other: Column) -> Column:
        return F.when(late & (own > other), own - 1).otherwise(own)
    return g.select(*_named(
        game_key="ID", game_id="ID", date_key=X.date_key("date_"), season_key="season", game_type=F.initcap("type_"),
        home_team_key="home_team_key", away_team_key="away_team_key", venue_name="venue", attendance=F.lit(None).cast("int"),
        regulation_home_score=regulation(h, a), regulation_away_score=regulation(a, h), final_home_score=h, final_away_score=a,
        winning_team_key=F.when(h > a, F.col("home_team_key")).when(a > h, F.col("away_team_key")),
        losing_team_key=F.when(h < a, F.col("home_team_key")).when(a < h, F.col("away_team_key")),
        game_duration_minutes=F.when(end == "REG", 60).when(late, 65), overtime_periods=F.when(late, 1).otherwise(0),
        is_shootout=F.coalesce(end == "SO", F.lit(False)), is_neutral_site="neutral_site"),
        *[f"{side}_{c}" for c in stats for side in ("home", "away")], *_named(
        goal_differential=h - a, goal_differential_abs=F.abs(h - a),
        is_blowout=F.coalesce(F.abs(h - a) >= 5, F.lit(False)), is_high_scoring=F.coalesce(h + a >= 10, F.lit(False)),
        is_low_scoring=F.coalesce(h + a <= 3, F.lit(False)), start_time_utc="start_ts_utc", venue_tz="venue_tz",
        venue_utc_offset="venue_utc_offset"))


def team_per_game(summaries: DataFrame, lines: DataFrame, penalties: DataFrame, goalies: DataFrame) -> DataFrame:
    """The team game line with power-play and penalty-kill texts, faceoff share, the
    goalies' sums, venue and start."""
    on = ["game_id", "team_id"]
    s = summaries.select(*on, "type", F.col("start_time_utc"), "venue")
    nets = goalies.groupBy("game_id", "team_abv").agg(F.sum("goals_against").alias("goals_against_g"),
                                                      F.sum("pp_shots_against").cast("int").alias("pp_shots_against"),
                                                      F.sum("pp_shots_saved").cast("int").alias("pp_saves"))
    t = (lines.join(s, on, "left").join(penalties.select(*on, "penalties_taken"), on, "left")
         .join(nets, ["game_id", "team_abv"], "left"))
    killed = F.col("pk_attempts") - F.col("pk_goals_against")
    text = lambda x, y: F.concat_ws("/", x.cast("string"), F.col(y).cast("string"))
    return t.select(
        "season", "game_id", "team_abv", "team_id", "type", "game_type", "shots", "goals", "goals_against", F.col("shots").alias("sog"),
        _share("faceoffs_won", "faceoffs_in_game", None).alias("faceoff_pct"), text(F.col("pp_goals"), "pp_attempts").alias("power_play"),
        "pp_goals", "pp_attempts", text(killed, "pk_attempts").alias("penalty_kill"), "pk_goals_against", "pk_attempts",
        _share("pp_goals", "pp_attempts", None).alias("pp_pct"), "pim", "hits", "blocks", "giveaways", "takeaways", "goals_against_g",
        "saves", "shots_against", "save_pct", "pp_shots_against", "pp_saves", "game_date", "start_time_utc", "venue",
        "last_period_type", "faceoffs_won", F.col("faceoffs_in_game").alias("faceoffs_taken"),
        _share(killed, "pk_attempts", None).alias("pk_pct"), F.coalesce("penalties_taken", F.lit(0)).alias("penalties_taken"))


def player_team_bridge(bridge: DataFrame, lines: DataFrame, players: DataFrame, teams: DataFrame, seasons: DataFrame,
                       roster: DataFrame) -> DataFrame:
    """M33 with its keys, the position played last in the stint and the roster's number."""
    last = lines.groupBy(F.col("player_id").alias("p_"), F.col("team_abv").alias("t_"), F.col("season").alias("s_")).agg(
        F.max_by("position", "game_id").alias("line_position"))
    listed = roster.groupBy(F.col("player_id").alias("rp_"), F.col("team_abv").alias("rt_")).agg(
        F.min("number").alias("jersey_number"), F.min("position").alias("roster_position"))
    b = (bridge.join(last, (F.col("player_id") == F.col("p_")) & (F.col("team_abv") == F.col("t_")) & (F.col("season") == F.col("s_")), "left")
         .join(listed, (F.col("player_id") == F.col("rp_")) & (F.col("team_abv") == F.col("rt_")), "left")
         .join(players.select(F.col("player_id").alias("i_"), "player_key"), F.col("player_id") == F.col("i_"), "left")
         .join(_keys(teams), F.col("team_abv") == F.col("abv"), "left")
         .join(seasons.select(F.col("season").alias("season_key")), F.col("season") == F.col("season_key"), "left"))
    code = F.coalesce("line_position", "roster_position")
    return b.select("bridge_key", "player_key", "team_key", "season_key", "player_id", "team_abv", "season", "start_date", "end_date",
                    "jersey_number", code.alias("position_code"), _text(POSITIONS, code).alias("position_name"), "acquisition_type",
                    "is_current_team", "games_played_for_team", "traded_mid_season", "teams_in_season", "stint_length_days",
                    "participation_level")


def upcoming(fact: DataFrame, schedules: DataFrame, teams: DataFrame, p: Params = Params()) -> DataFrame:
    """M43 with keys, names and logos of both teams."""
    s = schedules.select(F.col("game_id").alias("g_"), "game_state", F.col("home_team_id").alias("home_id"),
                         F.col("away_team_id").alias("away_id"))
    t = fact.join(s, F.col("game_id") == F.col("g_"))
    for side in ("home", "away"):
        names = teams.select(*_named(**{f"{side}_abv_": "team_abv", f"{side}_team_key": "team_key", f"{side}_team_name": "team_name",
                                        f"{side}_logo": "logo_url"}))
        t = t.join(names, F.col(f"{side}_team_abv") == F.col(f"{side}_abv_"), "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    return t.select(
        "game_id", F.col("game_id").alias("game_key"), X.date_key("game_date").alias("date_key"), F.col("season").alias("season_key"),
        "home_team_key", "away_team_key", "game_date", "game_type", "game_state", "home_id", F.col("home_team_abv").alias("home_abv"),
        "home_team_name", "home_logo", "away_id", F.col("away_team_abv").alias("away_abv"), "away_team_name", "away_logo",
        "is_weekend", F.col("start_local").alias("start_time_eastern"), F.col("time_slot").alias("game_time_category"),
        "days_until_game", flag("is_division_game").alias("is_divisional_game"), flag("is_conference_game").alias("is_conference_game"),
        F.lit(p.as_of).cast("timestamp").alias("last_updated"))


def _split(side: str) -> list[Column]:
    """The published columns of the home or the road split."""
    feed, name = side.upper(), side.lower()
    c = lambda n: F.col(f"{feed}{n}").cast("int")
    return _named(**{
        f"{name}_wins": c("WINS"), f"{name}_losses": c("LOSSES"), f"{name}_ot_l": c("OTLOSSES"), f"{name}_points": c("POINTS"),
        f"{name}_record": X.record_string(c("WINS"), c("LOSSES"), c("OTLOSSES")), f"{name}_gp": c("GAMESPLAYED"),
        f"{name}_goals": c("GOALSFOR"), f"{name}_goals_against": c("GOALSAGAINST"), f"{name}_goal_diff": c("GOALDIFFERENTIAL"),
        f"{name}_goal_diff_string": X.signed_string(c("GOALDIFFERENTIAL")), f"{name}_reg_wins": c("REGULATIONWINS"),
        f"{name}_reg_ot_wins": c("REGULATIONPLUSOTWINS"), f"league_{name}_standing": F.col(f"LEAGUE{feed}SEQUENCE").cast("int"),
        f"div_{name}_standing": F.col(f"DIVISION{feed}SEQUENCE").cast("int"),
        f"conf_{name}_standing": F.col(f"CONFERENCE{feed}SEQUENCE").cast("int")})


def current_standings(cur: DataFrame) -> DataFrame:
    """M18, one row per team of the current table; a column that the feed lacks is NULL."""
    known = set(cur.columns)
    cur = cur.withColumns({f.name: F.lit(None).cast(f.dataType) for f in S.CURRENT_STANDINGS if f.name not in known})
    c = lambda n: F.col(n).cast("int")
    return cur.select(
        *_named(team="TEAMNAME_DEFAULT", team_abv="TEAMABBREV_DEFAULT", division="DIVISIONNAME", division_abv="DIVISIONABBREV",
                conference="CONFERENCENAME", conference_abv="CONFERENCEABBREV", league_standing=c("LEAGUESEQUENCE"),
                conference_standing=c("CONFERENCESEQUENCE"), division_standing=c("DIVISIONSEQUENCE"),
                wildcard_standing=c("WILDCARDSEQUENCE"), waiver=c("WAIVERSSEQUENCE"), points=c("POINTS"), wins=c("WINS"),
                losses=c("LOSSES"), ot_losses=c("OTLOSSES"), games_played=c("GAMESPLAYED"),
                record=X.record_string(c("WINS"), c("LOSSES"), c("OTLOSSES")), win_pct="WINPCTG", point_pct="POINTPCTG",
                reg_wins=c("REGULATIONWINS"), reg_ot_wins=c("REGULATIONPLUSOTWINS"), reg_ot_win_pct="REGULATIONPLUSOTWINPCTG",
                reg_win_pct="REGULATIONWINPCTG", shootout_w=c("SHOOTOUTWINS"), shootout_l=c("SHOOTOUTLOSSES"),
                shootout_record=X.record_string(c("SHOOTOUTWINS"), c("SHOOTOUTLOSSES")), goals_for=c("GOALFOR"),
                goals_against=c("GOALAGAINST"), goal_diff=c("GOALDIFFERENTIAL"),
                goal_diff_string=X.signed_string(c("GOALDIFFERENTIAL")), goals_per_game="GOALSFORPCTG",
                goal_diff_pct="GOALDIFFERENTIALPCTG"),
        *_split("home"), *_split("road"),
        *_named(streak="STREAKCODE", streak_count=c("STREAKCOUNT"),
                streak_string=F.concat("STREAKCODE", c("STREAKCOUNT").cast("string")), l10_gp=c("L10GAMESPLAYED"),
                l10_wins=c("L10WINS"), l10_losses=c("L10LOSSES"), l10_ot_l=c("L10OTLOSSES"),
                l10_record=X.record_string(c("L10WINS"), c("L10LOSSES"), c("L10OTLOSSES")), l10_points=c("L10POINTS"),
                l10_goals=c("L10GOALSFOR"), l10_goals_against=c("L10GOALSAGAINST"), l10_goal_diff=c("L10GOALDIFFERENTIAL"),
                l10_reg_wins=c("L10REGULATIONWINS"), l10_reg_ot_wins=c("L10REGULATIONPLUSOTWINS"),
                div_l10_standing=c("DIVISIONL10SEQUENCE"), conf_l10_standing=c("CONFERENCEL10SEQUENCE")))


def standings_by_day(by_day: DataFrame) -> DataFrame:
    """The gap-filled standings of every day with the season's text."""
    return by_day.select("date", "season", *_named(
        team_name="teamname_default", team_abv="team_abv", games_played="gamesplayed", points="points", wins="wins", losses="losses",
        ot_losses="otlosses", regulation_wins="regulationwins", regulation_plus_ot_wins="regulationplusotwins",
        record=X.record_string("wins", "losses", "otlosses"), goals_for="goalfor", goals_against="goalagainst",
        goal_diff=F.col("goalfor") - F.col("goalagainst"), point_pct=_share("points", F.col("gamesplayed") * 2),
        division="divisionname", conference="conferencename", div_sequence="divisionsequence", wc_sequence="wildcardsequence",
        conf_sequence="conferencesequence", league_sequence="leaguesequence", home_wins="homewins", home_losses="homelosses",
        home_ot_losses="homeotlosses", road_wins="roadwins", road_losses="roadlosses", road_ot_losses="roadotlosses",
        shootout_wins="shootoutwins", shootout_losses="shootoutlosses", l10_wins="l10wins", l10_losses="l10losses",
        l10_ot_losses="l10otlosses", l10_points="l10points", l10_goals_for="l10goalsfor", l10_goals_against="l10goalsagainst",
        l10_goal_diff="l10goaldifferential", streak_code="streak_code", streak_count="streakcount",
        season_display=X.season_display("season")))


def team_season(lines: DataFrame, teams: DataFrame, game_type: str = "regular") -> DataFrame:
    """M62 / M63 (without the season's text M29 / M30): sums, averages per game that has
    the value, and shares of the season's sums (D7: NULL without attempts)."""
    t = lines.filter(F.col("game_type") == game_type)
    summed = ("goals", "goals_against", "shots", "pp_goals", "pp_attempts", "pim", "pk_attempts", "pk_goals_against", "hits",
              "blocks", "giveaways", "takeaways")
    s = t.groupBy("season", "team_abv").agg(
        F.count(F.lit(1)).alias("games_played"), *[F.sum(c).alias(c) for c in summed],
        *[F.count(c).alias(f"n_{c}") for c in summed])
    per = lambda c: X.round_ratio(c, f"n_{c}", 2)
    logo = teams.select(F.col("team_abv").alias("abv"), "logo_url")
    s = s.join(logo, F.col("team_abv") == F.col("abv"), "left")
    return s.select("season", "team_abv", "games_played", *_named(
        goals="goals", goals_per_game=per("goals"), goals_against_average=per("goals_against"), goals_against="goals_against",
        shots="shots", shots_per_game=per("shots"), pp_goals="pp_goals", pp_attempts="pp_attempts",
        pp_pct=_share("pp_goals", "pp_attempts", None), pim="pim", pk_attempts="pk_attempts",
        pk_pct=_share(F.col("pk_attempts") - F.col("pk_goals_against"), "pk_attempts", None), pim_per_game=per("pim"), hits="hits",
        hits_per_game=per("hits"), blocks="blocks", blocks_per_game=per("blocks"), giveaways="giveaways",
        giveaways_per_game=per("giveaways"), takeaways="takeaways", takeaways_per_game=per("takeaways"),
        season_display=X.season_display("season"), logo_url="logo_url"))


def upcoming_games(schedules: DataFrame, teams: DataFrame) -> DataFrame:
    """Scheduled regular and playoff games that have not begun, with both logos."""
    s = schedules.filter(F.col("game_state").isin("FUT", "PRE") & F.col("game_type_code").isin(2, 3))
    for side in ("away", "home"):
        logo = teams.select(F.col("team_abv").alias(f"{side}_"), F.col("logo_url").alias(f"{side}_logo"))
        s = s.join(logo, F.col(f"{side}_team_abv") == F.col(f"{side}_"), "left")
    return s.select(*_named(
        id="game_id", venue="venue", season="season", away_abv="away_team_abv", away_id="away_team_id", home_abv="home_team_abv",
        home_id="home_team_id", game_date="game_date", game_type="game_type_code", game_state="game_state",
        winning_goalie_id="winning_goalie_id", winning_scorer_id="winning_scorer_id", neutral="neutral_site",
        start_time_utc="start_time_utc", eastern_offset="eastern_offset", venue_tz="venue_tz", special_event="special_event",
        away_logo="away_logo", home_logo="home_logo"))


def tables(m: dict[str, DataFrame], p: Params = Params()) -> dict[str, DataFrame]:
    """The published tables by name, over the built models.  A name that a model's
    own frame already has gets the ending ``_published``."""
    teams, players, by_day = m["dim_teams"], m["dim_players"], m["standings_by_day"]
    team = team_game_stats(m["fct_team_game"], teams)
    player = player_game_stats(m["fct_player_game"], m["league_games"], teams, players)
    goalie = goalie_game_stats(m["fct_goalie_game"], m["league_games"], teams)
    out = {
        "fct_team_game_stats": team, "fct_player_game_stats": player, "fct_goalie_game_stats": goalie,
        "fct_standings_daily_published": standings_daily(by_day, m["fct_standings_daily"], teams, p),
        "dim_teams_published": teams_table(teams), "team_season_metrics_published": season_metrics(team, teams, p),
        "mart_head_to_head_published": head_to_head(team, teams), "mart_team_form_published": team_form(by_day),
        "mart_standings_weekly_published": standings_weekly(by_day),
        "mart_three_stars_published": three_stars(m["stg_three_stars"], m["league_games"], players),
        "fct_plays_published": plays(m["fct_plays"], m["stg_plays"], teams, p),
        "dim_players_published": players_table(players, m["roster_players"]),
        "all_players_published": all_players(m["roster_players"]),
        "mart_team_shot_metrics_published": shot_metrics(m["mart_team_shot_metrics"], m["fct_plays"], m["fct_team_game"], teams),
        "fct_games_published": games_table(m["all_games"], m["basic_games_info"], m["league_games"], m["team_game_line"], teams),
        "team_per_game_published": team_per_game(m["stg_game_summaries"], m["team_game_line"], m["game_penalties"],
                                                 m["goalie_game_lines"]),
        "dim_player_team_bridge_published": player_team_bridge(m["dim_player_team_bridge"], m["skater_game_lines"], players, teams,
                                                               m["dim_seasons"], m["roster_players"])}
    if "fct_upcoming_games" in m:
        out["fct_upcoming_games_published"] = upcoming(m["fct_upcoming_games"], m["stg_schedules"], teams, p)
        out["upcoming_games_published"] = upcoming_games(m["stg_schedules"], teams)
    if "stg_current_standings" in m:
        out["current_standings_published"] = current_standings(m["stg_current_standings"])
    out["standings_by_day_published"] = standings_by_day(by_day)
    for kind in ("regular", "playoff"):
        out[f"team_season_stats_{kind}_published"] = team_season(m["team_game_line"], teams, kind)
        out[f"team_season_{kind}_published"] = out[f"team_season_stats_{kind}_published"].drop("season_display")
        out[f"goalies_season_stats_{kind}_published"] = goalie_season(goalie, players, kind, p)
        out[f"skaters_season_stats_{kind}_published"] = skater_season(player, players, kind, p)
    return out
