"""Facts (M37–M43) over staged / intermediate frames."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import joins as J
from seasonflow.operators import windows as W
from seasonflow.operators.reshape import conditional_pivot, role_unpivot_counts
from seasonflow.params import Params

SHOT_TYPES = ("shot-on-goal", "goal", "missed-shot", "blocked-shot")


def _period_category(period: Column, period_type: Column, p: Params) -> Column:
    so = (period == 5) if p.period5_is_shootout else (period_type == "SO")
    return (F.when(so, "Shootout").when(period > 3, "Overtime").otherwise("Regulation"))


def fct_plays(plays: DataFrame, league: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per (game, event) of league games with actor attribution,
    strength state from the event team's side, empty net (the *opposing* goalie
    out), shot distance / angle / band, penalty severity, period category."""
    g = league.select("game_id", "season", "game_date", "home_team_id", "away_team_id")
    d = F.col("description")
    c = F.col
    primary = (F.when(d == "goal", c("scoring_player_id"))
                .when(d.isin("shot-on-goal", "missed-shot", "failed-shot-attempt"), c("shooting_player_id"))
                .when(d == "blocked-shot", c("blocking_player_id"))
                .when(d == "faceoff", c("faceoff_winner_player_id"))
                .when(d == "hit", c("hitting_player_id"))
                .when(d == "penalty", F.coalesce(c("committed_by_player_id"), c("served_by_player_id")))
                .when(d.isin("giveaway", "takeaway"), c("event_player_id")))
    secondary = (F.when(d == "goal", c("assist1_player_id"))
                  .when(d == "shot-on-goal", c("goalie_in_net_id"))
                  .when(d == "blocked-shot", c("shooting_player_id"))
                  .when(d == "faceoff", c("faceoff_loser_player_id"))
                  .when(d == "hit", c("hittee_player_id"))
                  .when(d == "penalty", c("drawn_by_player_id")))
    tertiary = F.when(d == "goal", c("assist2_player_id"))
    goalie = F.when(d.isin("goal", "shot-on-goal", "missed-shot"), c("goalie_in_net_id"))
    # actors before the join: three ids a row are moved, not every id of the feed
    actors = {"primary_player_key": primary, "secondary_player_key": secondary, "tertiary_player_key": tertiary,
              "goalie_player_key": goalie}
    j = plays.withColumns(actors).join(g, "game_id", "inner")
    is_shot = d.isin(*SHOT_TYPES) & c("x_pos").isNotNull() & c("y_pos").isNotNull()
    dist = F.when(is_shot, X.shot_distance("x_pos", "y_pos"))
    strength = X.strength_columns("situation_code", "play_team_id", "home_team_id", "away_team_id")
    pen = d.like("penalty%")
    return j.select(
        X.surrogate_key("game_id", "event_id").alias("play_key"), "game_id", "event_id", "season",
        X.date_key("game_date").alias("date_key"), "period", "period_type", "time_in_period",
        "elapsed_seconds", X.elapsed_seconds("period", "elapsed_seconds").alias("game_elapsed_seconds"),
        d.alias("event_type_name"), c("play_team_id").alias("event_team_key"),
        *actors,
        F.when(d.isin(*SHOT_TYPES), c("shot_type")).alias("shot_type"),
        dist.alias("shot_distance"), F.when(is_shot, X.shot_angle("x_pos", "y_pos")).alias("shot_angle"),
        X.distance_band(dist).alias("shot_distance_band"),
        (d == "goal").alias("is_goal"), pen.alias("is_penalty"),
        F.when(pen, c("penalty_desc_key")).alias("penalty_type"),
        F.when(~pen, F.lit(None).cast("string")).otherwise(
            X.penalty_severity("penalty_type_code", "penalty_duration")).alias("penalty_severity"),
        F.when(pen, c("penalty_duration")).alias("penalty_minutes"),
        c("situation_code").alias("strength_code"), *[v.alias(k) for k, v in strength.items()],
        _period_category(c("period"), c("period_type"), p).alias("period_category"),
        F.when(c("play_team_id") == c("home_team_id"), F.lit("home"))
         .when(c("play_team_id") == c("away_team_id"), F.lit("away")).alias("event_side"))


def fct_games(team_lines: DataFrame, league: DataFrame) -> DataFrame:
    """home/away stats pivoted to one row per game; regulation score
    (OT/SO winner minus one), winner / loser, duration, result flags."""
    t = team_lines.withColumn("side", F.when(F.col("is_home"), "home").otherwise("away"))
    pv = conditional_pivot(t, ["game_id"], "side", ["home", "away"],
                           {"goals": "goals", "shots": "shots", "pim": "pim", "pp_goals": "pp_goals",
                            "faceoffs_won": "faceoffs_won"})
    g = league.join(pv, "game_id", "left")
    end = F.coalesce(F.col("last_period_type"), F.lit("REG"))
    hg, ag = F.col("home_goals"), F.col("away_goals")

    def reg(own, opp):
        return F.when(end == "REG", own).otherwise(F.when(own > opp, own - 1).otherwise(own))
    return g.select(
        "game_id", "season", F.initcap("game_type").alias("game_type_display"), "game_type", "game_date",
        X.date_key("game_date").alias("date_key"), "home_team_id", "away_team_id", "home_team_abv", "away_team_abv",
        "home_goals", "away_goals", "home_shots", "away_shots", "home_pim", "away_pim",
        "home_pp_goals", "away_pp_goals", "home_faceoffs_won", "away_faceoffs_won",
        reg(hg, ag).alias("home_regulation_goals"), reg(ag, hg).alias("away_regulation_goals"),
        F.when(hg > ag, F.col("home_team_id")).when(ag > hg, F.col("away_team_id")).alias("winning_team_id"),
        F.when(hg > ag, F.col("away_team_id")).when(ag > hg, F.col("home_team_id")).alias("losing_team_id"),
        end.alias("game_outcome"), F.when(end == "REG", 60).otherwise(65).alias("duration_minutes"),
        (F.abs(hg - ag) >= 5).alias("is_blowout"), ((hg + ag) >= 10).alias("is_high_scoring"),
        ((hg + ag) <= 3).alias("is_low_scoring"), (end != "REG").alias("went_to_overtime"))


def fct_goalie_game(goalies: DataFrame, p: Params = Params(), plays_fact: DataFrame | None = None) -> DataFrame:
    """Keeper line with GA per 60, shutout (GA 0 and the only keeper of his
    team with ice time), save tiers, relief, quality / bad starts, saves above
    the league-average save percentage, and (with the plays fact) goals
    against by period from the goalie in net."""
    w = Window.partitionBy("game_id", "team_abv")
    g = goalies.withColumn("goalies_used", F.count_if(F.col("toi_seconds") > 0).over(w))
    if plays_fact is not None:
        ga = (goal_events(plays_fact).filter(F.col("goalie_player_key").isNotNull())
              .groupBy("game_id", F.col("goalie_player_key").alias("player_id")).agg(
                  *[F.count_if(F.col("period") == n).alias(f"ga_p{n}") for n in (1, 2, 3)],
                  F.count_if(F.col("period") > 3).alias("ga_ot")))
        g = g.join(ga, ["game_id", "player_id"], "left")
    else:
        g = g.withColumns({c: F.lit(None).cast("bigint") for c in ("ga_p1", "ga_p2", "ga_p3", "ga_ot")})
    saves, sa = F.col("shots_saved"), F.col("shots_against")
    pct = X.safe_divide(saves, sa)
    avg = F.lit(Decimal(str(p.avg_save_pct))).cast("decimal(4,3)")
    return g.select(
        X.surrogate_key("game_id", "player_id").alias("goalie_game_key"), "game_id", "player_id", "team_abv",
        "season", "game_type", "starter", "result", "goals_against", "shots_saved", "shots_against", "toi_seconds",
        pct.alias("save_pct"),
        F.coalesce(F.try_divide(F.col("goals_against") * F.lit(3600.0), F.col("toi_seconds")), F.lit(0.0))
         .alias("goals_against_per_60"),
        ((F.col("goals_against") == 0) & (F.col("toi_seconds") > 0) & (F.col("goalies_used") == 1)).alias("is_shutout"),
        X.save_pct_tier(pct).alias("save_tier"),
        (~F.coalesce(F.col("starter"), F.lit(False)) & (F.col("toi_seconds") > 0)).alias("is_relief"),
        (F.col("starter") & (pct >= 0.917) & (F.col("goals_against") <= 2)).alias("quality_start"),
        (F.col("starter") & (pct < 0.850)).alias("bad_start"),
        (saves - sa * avg).cast("double").alias("saves_above_average"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if plays_fact is not None else F.col(c)
          for c in ("ga_p1", "ga_p2", "ga_p3", "ga_ot")], "type", "name", "pim",
        *[f"{k}_{c}" for k in ("even", "pp", "sh") for c in ("shots_saved", "shots_against", "goals_against")])


def goal_events(plays_fact: DataFrame) -> DataFrame:
    return plays_fact.filter((F.col("event_type_name") == "goal") & (F.col("period_category") != "Shootout"))


def fct_player_game(skaters: DataFrame, plays_fact: DataFrame, team_lines: DataFrame) -> DataFrame:
    """Skater line + scorer/assist splits from the plays, special-situation
    goals, game-winning goal (the winner's (loser final + 1)-th goal; none in
    shootout games), faceoffs won/lost, milestone flags."""
    goals = goal_events(plays_fact)
    roles = role_unpivot_counts(goals.select("game_id", "primary_player_key", "secondary_player_key",
                                             "tertiary_player_key"), ["game_id"],
                                {"goal": "primary_player_key", "a1": "secondary_player_key",
                                 "a2": "tertiary_player_key"}, entity="player_id")
    split = roles.groupBy("game_id", "player_id").agg(
        F.sum(F.when(F.col("role") == "a1", F.col("n")).otherwise(0)).alias("primary_assists"),
        F.sum(F.when(F.col("role") == "a2", F.col("n")).otherwise(0)).alias("secondary_assists"))
    special = goals.groupBy("game_id", F.col("primary_player_key").alias("player_id")).agg(
        F.count_if(F.col("strength_state") == "SH").alias("sh_goals"),
        F.count_if(F.col("period_category") == "Overtime").alias("ot_goals"),
        F.count_if(F.col("is_empty_net")).alias("en_goals"))
    helped = role_unpivot_counts(
        goals.select("game_id", "strength_state", "secondary_player_key", "tertiary_player_key"),
        ["game_id", "strength_state"], {"a1": "secondary_player_key", "a2": "tertiary_player_key"}, entity="player_id")
    helped = helped.groupBy("game_id", "player_id").agg(
        F.sum(F.when(F.col("strength_state") == "PP", F.col("n")).otherwise(0)).alias("pp_assists"),
        F.sum(F.when(F.col("strength_state") == "SH", F.col("n")).otherwise(0)).alias("sh_assists"))
    seq = W.nth_in_group(goals, ["game_id", "event_team_key"],
                         [F.col("game_elapsed_seconds"), F.col("event_id")], "team_goal_number")
    winners = team_lines.filter((F.col("goals") > F.col("goals_against")) &
                                (F.coalesce(F.col("last_period_type"), F.lit("REG")) != "SO")) \
                        .select("game_id", F.col("team_id").alias("event_team_key"), "goals_against")
    gwg = (J.within(seq, winners, "game_id", ["event_team_key"], "inner")
              .filter(F.col("team_goal_number") == F.col("goals_against") + 1)
              .select("game_id", F.col("primary_player_key").alias("player_id"), F.lit(1).alias("game_winning_goals")))
    fo = plays_fact.filter(F.col("event_type_name") == "faceoff")
    fo = role_unpivot_counts(fo.select("game_id", "primary_player_key", "secondary_player_key"), ["game_id"],
                             {"won": "primary_player_key", "lost": "secondary_player_key"}, entity="player_id")
    fo = fo.groupBy("game_id", "player_id").agg(
        F.sum(F.when(F.col("role") == "won", F.col("n")).otherwise(0)).alias("faceoffs_won"),
        F.sum(F.when(F.col("role") == "lost", F.col("n")).otherwise(0)).alias("faceoffs_lost"))
    out = skaters
    for counted in (split, special, helped, gwg, fo):
        out = J.within(out, counted, "game_id", ["player_id"])
    z = lambda n: F.coalesce(F.col(n), F.lit(0))
    return out.select(
        X.surrogate_key("game_id", "player_id").alias("player_game_key"), "game_id", "player_id", "team_abv",
        "season", "game_type", "goals", "assists", "points", z("primary_assists").alias("primary_assists"),
        z("secondary_assists").alias("secondary_assists"), "shots", "hits", "pim", "toi_seconds",
        z("sh_goals").alias("shorthanded_goals"), z("en_goals").alias("empty_net_goals"),
        z("game_winning_goals").alias("game_winning_goals"), z("faceoffs_won").alias("faceoffs_won"),
        z("faceoffs_lost").alias("faceoffs_lost"), z("pp_assists").alias("pp_assists"),
        z("sh_assists").alias("sh_assists"), z("ot_goals").alias("overtime_goals"), "type", "name", "position",
        "plus_minus", "pp_goals", "giveaways", "takeaways", "blocked_shots", "shifts", "faceoff_pct",
        (F.col("goals") >= 3).alias("is_hat_trick"), (F.col("points") >= 4).alias("is_four_point_game"),
        (F.col("goals") >= 4).alias("is_four_goal_game"))


def fct_team_game(team_lines: DataFrame, plays_fact: DataFrame) -> DataFrame:
    """Result (W, OTL after OT/SO, else L), points 2/1/0, first goal
    (min_by over elapsed time, event id breaks ties), leads after the first and
    second periods, comeback win."""
    goals = goal_events(plays_fact)
    per = goals.groupBy("game_id", F.col("event_team_key").alias("team_id")).agg(
        F.count_if(F.col("period") == 1).alias("p1"), F.count_if(F.col("period") <= 2).alias("p2"))
    first = goals.groupBy("game_id").agg(
        F.min_by("event_team_key", F.struct("game_elapsed_seconds", "event_id")).alias("first_goal_team_id"))
    t = J.within(team_lines, per, "game_id", ["team_id"]).join(first, "game_id", "left")
    t = J.opponent_join(t, ["game_id"], "team_id", ["p1", "p2"])
    z = lambda n: F.coalesce(F.col(n), F.lit(0))
    win = F.col("goals") > F.col("goals_against")
    ot = F.coalesce(F.col("last_period_type"), F.lit("REG")).isin("OT", "SO")
    result = F.when(win, "W").when(ot, "OTL").otherwise("L")
    shots_tot = F.col("shots") + F.col("shots_against")
    return t.select(
        X.surrogate_key("game_id", "team_id").alias("team_game_key"), "game_id", "team_id", "team_abv",
        F.col("opp_team_id").alias("opponent_team_id"), "season", "game_type", "game_date", "is_home",
        result.alias("game_result"), F.when(win, 2).when(ot, 1).otherwise(0).alias("points"),
        "goals", "goals_against", "shots", "shots_against",
        F.when(shots_tot == 0, F.lit(0.5)).otherwise(X.safe_divide("shots", shots_tot)).alias("shot_share"),
        (F.col("first_goal_team_id") == F.col("team_id")).alias("score_first_flag"),
        (z("p1") > z("opp_p1")).alias("lead_after_1st"), (z("p2") > z("opp_p2")).alias("lead_after_2nd"),
        (win & ((z("p1") < z("opp_p1")) | (z("p2") < z("opp_p2")))).alias("comeback_win_flag"),
        "pp_goals", "pp_attempts", "pk_attempts", "pk_goals_against", "pim",
        "hits", "blocks", "giveaways", "takeaways", "faceoffs_won", "faceoffs_in_game", "saves", "save_pct",
        F.col("last_period_type").alias("game_outcome"))


def fct_standings_daily(by_day: DataFrame, p: Params = Params()) -> DataFrame:
    """Playoff position (division rank <= 3 or wild card <= 2), distance to
    the cutoff (lowest points among the qualifying places of the same date,
    season and conference; 0 when in), remaining games, max points, pace."""
    inside = (F.col("divisionsequence") <= 3) | (F.col("wildcardsequence") <= 2)
    s = by_day.withColumn("in_playoff_position", F.coalesce(inside, F.lit(False)))
    cut = (s.filter((F.col("divisionsequence") == 3) | (F.col("wildcardsequence") == 2))
            .groupBy("date", "season", "conferencename").agg(F.min("points").alias("cutoff_points")))
    s = s.join(cut, ["date", "season", "conferencename"], "left")
    rem = F.lit(p.regular_season_games) - F.col("gamesplayed")
    return s.select(
        X.surrogate_key("date", "team_abv").alias("standings_key"), X.date_key("date").alias("date_key"),
        "date", "season", "team_abv", F.col("conferencename").alias("conference"),
        F.col("divisionname").alias("division"), F.col("gamesplayed").alias("games_played"), "points", "wins",
        "losses", F.col("otlosses").alias("ot_losses"), "in_playoff_position",
        F.when(F.col("in_playoff_position"), F.lit(0))
         .otherwise(F.col("cutoff_points") - F.col("points")).alias("points_from_playoff_line"),
        rem.alias("games_remaining"), (F.col("points") + rem * 2).alias("max_possible_points"),
        F.coalesce(X.round_ratio(F.col("points") * p.regular_season_games, "gamesplayed", 1), F.lit(0.0))
         .alias("points_pace"),
        X.record_string("wins", "losses", "otlosses").alias("record"))


def fct_upcoming_games(schedules: DataFrame, teams: DataFrame, p: Params = Params()) -> DataFrame:
    """Future games (date >= as_of) with local start time and hour,
    category, same-division / conference flags (role-playing team joins),
    days until the game."""
    s = schedules.filter((F.col("game_date") >= F.lit(p.as_of)) & F.col("game_state").isin("FUT", "PRE"))
    ts = X.parse_utc("start_time_utc")
    s = s.withColumn("start_local", X.to_local(ts, p.local_tz))
    s = J.role_playing(s, teams, "team_abv", {"home": "home_team_abv", "away": "away_team_abv"},
                       ["division", "conference"])
    return s.select(
        "game_id", "season", "game_type", "game_date", "home_team_abv", "away_team_abv", "start_local",
        F.hour("start_local").alias("start_hour_local"),
        # Time slots
        F.when(F.hour("start_local") < 17, "Afternoon").when(F.hour("start_local") < 20, "Early Evening")
         .otherwise("Late Evening").alias("time_slot"),
        X.is_weekend("game_date").alias("is_weekend"),
        (F.col("home_division") == F.col("away_division")).alias("is_division_game"),
        (F.col("home_conference") == F.col("away_conference")).alias("is_conference_game"),
        F.datediff("game_date", F.lit(p.as_of)).alias("days_until_game"))
