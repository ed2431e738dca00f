"""Power-ranking model (M44) and team season metrics (M45) over a standard
team-game table, so one implementation serves every binding.

Input columns (one row per team per game):
  season, team, opponent, game_id, game_date, game_type ('regular' | 'playoff'),
  goals_for, goals_against, points, shots, pp_goals, pp_attempts, pk_attempts,
  pk_goals_against

``points`` are the standings points of the game (2 for a win, 1 for an overtime
or shootout loss), so a season's points are 2 W + OTL.

After the first aggregation every frame is at team grain — bounded by the
league size — so the global windows and the one-row min/max broadcast never
see fact-grain rows.

Fixed values of the power model (must equal the reference's):
  league size for the previous-rank scale 32 -> rank100 = 100 * (32 - rank) / 31
  playoff carry-over: 0.5 * rank100 + 0.5 * (wins / 16 * 100 * 0.6
    + win_pct * 100 * 0.2 + (goal_diff_per_game + 2) * 10 * 0.2); no playoffs 0.8 * rank100
  blend: current weight = min(gp / 20, 1)
  goal component 0.5 diff + 0.3 for + 0.2 against; advanced 0.4 shots + 0.3 pp + 0.3 pk (gp >= 5)
  momentum: gp >= 10 0.6 last10 + 0.4 recent diff; gp >= 5 0.5 trend + 0.5 recent diff; else 50
  final weights (points, goal, advanced, schedule, momentum):
    gp < 5: .35 .30 .15 .10 .10; gp < 10: .32 .28 .18 .12 .10; otherwise .30 .25 .20 .15 .10
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import ranking as R
from seasonflow.operators import windows as W

LEAGUE_SIZE = 32
NEUTRAL = 50.0
METRICS = ["points_pct", "goals_for_pg", "goals_against_pg", "goal_diff_pg", "shots_pg", "pp_pct", "pk_pct",
           "sos", "last10_pct", "recent_gd"]


def _f(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _div(a, b) -> Column:
    return F.try_divide(_f(a), _f(b))


def season_scalars(g: DataFrame) -> DataFrame:
    """One row: current season = max, previous = max below it.

    Distinct seasons (partial aggregate), the newest two kept by a top-k, then
    one global row — no fact-grain join.
    """
    top2 = g.select("season").distinct().orderBy(F.col("season").desc()).limit(2)
    return top2.agg(F.max("season").alias("cur_season"),
                    F.when(F.count(F.lit(1)) == 2, F.min("season")).alias("prev_season"))


def in_season(df: DataFrame, sc: DataFrame, which: str) -> DataFrame:
    """Rows of the season named by the one-row scalar — an equi-join with a
    broadcast row, so a season-partitioned scan is pruned dynamically."""
    return df.join(F.broadcast(sc.select(F.col(which).alias("season"))), "season", "inner")


def _overtime_loss() -> Column:
    """A lost game that still gave a point."""
    return (F.col("goals_for") < F.col("goals_against")) & (F.col("points") == 1)


def record_table(g: DataFrame) -> DataFrame:
    return g.groupBy("team").agg(
        F.count(F.lit(1)).alias("gp"),
        F.count_if(F.col("goals_for") > F.col("goals_against")).alias("wins"),
        F.count_if(F.col("goals_for") < F.col("goals_against")).alias("losses"),
        F.count_if(_overtime_loss()).alias("ot_losses"), F.sum("points").alias("points"),
        F.sum("goals_for").alias("gf"), F.sum("goals_against").alias("ga"),
        F.sum("shots").alias("shots"), F.sum("pp_goals").alias("pp_goals"),
        F.sum("pp_attempts").alias("pp_attempts"), F.sum("pk_attempts").alias("pk_attempts"),
        F.sum("pk_goals_against").alias("pk_goals_against"))


def _split_table(g: DataFrame) -> DataFrame:
    """Regular-season record and playoff record per team in ONE aggregate."""
    reg, po = F.col("game_type") == "regular", F.col("game_type") == "playoff"
    w, l = F.col("goals_for") > F.col("goals_against"), F.col("goals_for") < F.col("goals_against")
    return g.groupBy("team").agg(
        F.count_if(reg).alias("gp"), F.count_if(reg & w).alias("wins"), F.count_if(reg & l).alias("losses"),
        F.sum(F.when(reg, F.col("points"))).alias("points"), F.sum(F.when(reg, F.col("goals_for"))).alias("gf"),
        F.sum(F.when(reg, F.col("goals_against"))).alias("ga"),
        F.count_if(po).alias("p_gp"), F.count_if(po & w).alias("p_wins"),
        F.sum(F.when(po, F.col("goals_for") - F.col("goals_against"))).alias("p_gd"))


def previous_final(g: DataFrame, sc: DataFrame | None = None) -> DataFrame:
    """W19 + playoff carry-over for the previous season (regular and playoff
    records from one aggregate; teams without regular games drop out)."""
    t = _split_table(in_season(g, season_scalars(g) if sc is None else sc, "prev_season")).filter(F.col("gp") > 0)
    t = t.withColumn("pct", _div("points", F.col("gp") * 2))
    t = R.multi_key_rank(t, [F.col("pct").desc(), F.col("wins").desc(),
                             (F.col("gf") - F.col("ga")).desc(), F.col("team").asc()], name="final_rank")
    p_gp = F.when(F.col("p_gp") > 0, F.col("p_gp"))
    t = t.withColumns({"p_win_pct": _div("p_wins", p_gp), "p_gd_pg": _div("p_gd", p_gp)})
    rank100 = F.lit(100.0) * _f(F.lit(LEAGUE_SIZE) - F.col("final_rank")) / F.lit(LEAGUE_SIZE - 1.0)
    playoff = ((_f("p_wins") / F.lit(16.0)) * F.lit(100.0) * F.lit(0.6)
               + F.col("p_win_pct") * F.lit(100.0) * F.lit(0.2)
               + (F.col("p_gd_pg") + F.lit(2.0)) * F.lit(10.0) * F.lit(0.2))
    score = F.when(F.col("p_gp") > 0, rank100 * F.lit(0.5) + playoff * F.lit(0.5)).otherwise(rank100 * F.lit(0.8))
    # Playoff round reached by wins >= 12 / 8 / 4, any playoff game -> 1
    rnd = (F.when(F.col("p_wins") >= 12, 4).when(F.col("p_wins") >= 8, 3).when(F.col("p_wins") >= 4, 2)
            .when(F.col("p_gp") > 0, 1).otherwise(0))
    return t.select("team", "gp", "wins", "pct", "final_rank", rank100.alias("rank100"),
                    F.col("p_gp").alias("playoff_games"), rnd.alias("playoff_round_reached"),
                    score.alias("prev_power_score"))


def opponent_strength(g: DataFrame) -> DataFrame:
    """Mean opponent points share over games of all types (D14) per (season, team); a
    share counts regular games only, as standings do, and is fixed at 4 decimals
    (integer ten-thousandths) so the mean is exact."""
    tab = g.filter(F.col("game_type") == "regular").groupBy("season", "team").agg(F.count(F.lit(1)).alias("gp"), F.sum("points").alias("pts"))
    share = tab.select("season", F.col("team").alias("opponent"),
                       X.round_ratio(F.col("pts") * 10000, F.col("gp") * 2, 0).cast("bigint").alias("e4"))
    agg = (g.join(share, ["season", "opponent"], "inner")
            .groupBy("season", "team").agg(F.sum("e4").alias("__s"), F.count(F.lit(1)).alias("__n")))
    return agg.select("season", "team", X.round_ratio("__s", F.col("__n") * 10000, 4).alias("opponent_avg_points_pct"))


def current_metrics(g: DataFrame, sc: DataFrame | None = None) -> DataFrame:
    """Latest-season per-team rates (regular season) plus the last 10 regular games' points
    share, the last 5 games of any type (newest first, game id breaks ties) and
    schedule strength.

    The record is one partial aggregate; the form windows come from group limits
    per team (never a full sort of a team's season in one task);
    schedule strength is computed on the current season only (the
    season-partitioned input is pruned to it).
    """
    s = in_season(g, season_scalars(g) if sc is None else sc, "cur_season")
    reg = F.col("game_type") == "regular"
    w, l = F.col("goals_for") > F.col("goals_against"), F.col("goals_for") < F.col("goals_against")
    record = s.groupBy("team").agg(
        F.count_if(reg).alias("gp"), F.count_if(reg & w).alias("wins"), F.count_if(reg & l).alias("losses"),
        *[F.sum(F.when(reg, F.col(c))).alias(o) for o, c in (
            ("points", "points"), ("gf", "goals_for"), ("ga", "goals_against"), ("shots", "shots"), ("pp_goals", "pp_goals"),
            ("pp_attempts", "pp_attempts"), ("pk_attempts", "pk_attempts"), ("pk_goals_against", "pk_goals_against"))]
    ).filter(F.col("gp") > 0)
    # the newest rows per team through group limits (kept map-side)
    newest = [F.col("game_date").desc(), F.col("game_id").desc()]
    l10 = W.last_n(s.filter(reg), ["team"], newest, 10, rank_col="__rn").groupBy("team").agg(
        F.sum("points").alias("l10_pts"), F.count(F.lit(1)).alias("l10_n"))
    r5 = W.last_n(s, ["team"], newest, 5, rank_col="__rn").groupBy("team").agg(
        F.count_if(w).alias("r_w"), F.count_if(l).alias("r_l"), F.count(F.lit(1)).alias("r_n"),
        F.sum(F.col("goals_for") - F.col("goals_against")).alias("recent_gd"))
    m = record.join(l10, "team", "left").join(r5, "team", "left")
    opp = opponent_strength(s).select("team", F.col("opponent_avg_points_pct").alias("sos"))
    m = m.join(opp, "team", "left")
    return m.select(
        "team", "gp", "wins", "losses",
        _div("points", F.col("gp") * 2).alias("points_pct"),
        _div("gf", "gp").alias("goals_for_pg"), _div("ga", "gp").alias("goals_against_pg"),
        _div(F.col("gf") - F.col("ga"), "gp").alias("goal_diff_pg"), _div("shots", "gp").alias("shots_pg"),
        _div("pp_goals", "pp_attempts").alias("pp_pct"),
        _div(F.col("pk_attempts") - F.col("pk_goals_against"), "pk_attempts").alias("pk_pct"),
        "sos", _div("l10_pts", F.col("l10_n") * 2).alias("last10_pct"), _f("recent_gd").alias("recent_gd"),
        _div(F.col("r_w") - F.col("r_l"), "r_n").alias("trend"))


def scaled(g: DataFrame, sc: DataFrame | None = None) -> DataFrame:
    """The ten metrics min-max scaled to 0-100 (goals against inverted),
    zero range or NULL -> 50; trend mapped from [-1, 1] to [0, 100]."""
    out = R.minmax_normalize(current_metrics(g, sc), {c: c == "goals_against_pg" for c in METRICS},
                             suffix="_scaled", neutral=NEUTRAL)
    return out.withColumn("trend_scaled", F.coalesce((F.col("trend") + F.lit(1.0)) * F.lit(50.0), F.lit(NEUTRAL)))


def blended(g: DataFrame) -> DataFrame:
    """Step 8: the current weight grows linearly with games / 20; the previous
    score defaults to 50 (so the 'no previous season' branch is dead, D5)."""
    sc = season_scalars(g)                  # planned once, read by both seasons
    s = scaled(g, sc)
    prev = previous_final(g, sc).select("team", "prev_power_score", "playoff_round_reached",
                                    F.col("pct").alias("prev_pct"))
    prev = R.minmax_normalize(prev, {"prev_pct": False}, suffix="_scaled", neutral=NEUTRAL)
    j = s.join(prev, "team", "left")
    gp = F.col("gp")
    cw = F.when(gp >= 20, F.lit(1.0)).when(gp == 0, F.lit(0.0)).otherwise(_f(gp) / F.lit(20.0))
    pw = F.when(gp >= 20, F.lit(0.0)).when(gp == 0, F.lit(1.0)).otherwise(F.lit(1.0) - _f(gp) / F.lit(20.0))
    return j.select("*", cw.alias("current_weight"), pw.alias("previous_weight"),
                    F.coalesce("prev_power_score", F.lit(NEUTRAL)).alias("prev_score"),
                    F.coalesce("prev_pct_scaled", F.lit(NEUTRAL)).alias("prev_points_scaled"))


def composite(g: DataFrame) -> DataFrame:
    """Steps 9-11: five components with activation thresholds, final weights by
    games played, row_number rank (team breaks ties), rounded display."""
    b = blended(g)
    gp = F.col("gp")
    c = F.col
    goal = c("goal_diff_pg_scaled") * 0.5 + c("goals_for_pg_scaled") * 0.3 + c("goals_against_pg_scaled") * 0.2
    adv = F.when(gp >= 5, c("shots_pg_scaled") * 0.4 + c("pp_pct_scaled") * 0.3 + c("pk_pct_scaled") * 0.3) \
           .otherwise(F.lit(NEUTRAL))
    sched = F.when(gp >= 5, c("sos_scaled")).otherwise(F.lit(NEUTRAL))
    mom = (F.when(gp >= 10, c("last10_pct_scaled") * 0.6 + c("recent_gd_scaled") * 0.4)
            .when(gp >= 5, c("trend_scaled") * 0.5 + c("recent_gd_scaled") * 0.5).otherwise(F.lit(NEUTRAL)))
    comp = b.select("team", "gp", "current_weight", "previous_weight", "prev_score",
                    F.col("playoff_round_reached").alias("prev_playoff_round"),
                    c("points_pct_scaled").alias("points_component"), goal.alias("goal_component"),
                    adv.alias("advanced_component"), sched.alias("schedule_component"),
                    mom.alias("momentum_component"))

    def mix(w):
        return (c("points_component") * w[0] + c("goal_component") * w[1] + c("advanced_component") * w[2]
                + c("schedule_component") * w[3] + c("momentum_component") * w[4])

    def blend(w):
        return c("prev_score") * c("previous_weight") + mix(w) * c("current_weight")
    score = (F.when(gp == 0, c("prev_score"))
              .when(gp < 5, blend((0.35, 0.30, 0.15, 0.10, 0.10)))
              .when(gp < 10, blend((0.32, 0.28, 0.18, 0.12, 0.10)))
              .when(gp < 20, blend((0.30, 0.25, 0.20, 0.15, 0.10)))
              .otherwise(mix((0.30, 0.25, 0.20, 0.15, 0.10))))
    out = R.multi_key_rank(comp.withColumn("power_score", score),
                           [F.col("power_score").desc(), F.col("team").asc()], name="power_rank")
    # Playoff label by round reached; NULL where no previous season is loaded
    reached = F.col("prev_playoff_round")
    label = (F.when(reached == 4, "Cup Finals").when(reached == 3, "Conference Finals")
              .when(reached == 2, "Second Round").when(reached == 1, "First Round")
              .when(reached.isNotNull(), "Missed Playoffs"))
    return out.withColumns({"power_score_display": F.round("power_score", 1), "prev_playoff_label": label})


def season_metrics(g: DataFrame, conference: DataFrame | None = None) -> DataFrame:
    """Latest-season totals and rates; defaults when a denominator is 0
    (PP 0, PK 100, faceoff 50, shooting 0, save 100); points = 2W + OTL; ranks
    for every available metric (lower-is-better ones ascending), conference
    ranks, and percentiles.  Optional columns (shots against, hits, blocks,
    giveaways, takeaways, faceoffs) are used when the input carries them."""
    sc = season_scalars(g)
    cur = in_season(g, sc, "cur_season").filter(F.col("game_type") == "regular")
    opt = [c for c in ("shots_against", "hits", "blocks", "giveaways", "takeaways", "faceoffs_won",
                       "faceoffs_in_game") if c in g.columns]
    t = record_table(cur)
    if opt:
        t = t.join(cur.groupBy("team").agg(*[F.sum(c).alias(c) for c in opt]), "team", "left")
    cols = [(F.col("gp") - F.col("wins") - F.col("ot_losses")).alias("regulation_losses"),
            X.round_ratio(F.col("points") * 100, F.col("gp") * 2, 3).alias("points_pct"),
            _div("gf", "gp").alias("goals_per_game"), _div("ga", "gp").alias("goals_against_per_game"),
            _div("shots", "gp").alias("shots_per_game"),
            F.coalesce(X.round_ratio(F.col("pp_goals") * 100, "pp_attempts", 2), F.lit(0.0)).alias("power_play_pct"),
            F.coalesce(X.round_ratio((F.col("pk_attempts") - F.col("pk_goals_against")) * 100, "pk_attempts", 2),
                       F.lit(100.0)).alias("penalty_kill_pct"),
            F.coalesce(X.round_ratio(F.col("gf") * 100, "shots", 2), F.lit(0.0)).alias("shooting_pct")]
    ranks = {"goals_per_game": False, "power_play_pct": False, "shots_per_game": False, "shooting_pct": False,
             "goals_against_per_game": True, "penalty_kill_pct": False, "points": False}
    if "shots_against" in opt:
        cols += [_div("shots_against", "gp").alias("shots_against_per_game"),
                 F.coalesce(X.round_ratio((F.col("shots_against") - F.col("ga")) * 100, "shots_against", 2),
                            F.lit(100.0)).alias("save_pct")]
        ranks.update({"shots_against_per_game": True, "save_pct": False})
    for c, lower in (("hits", False), ("blocks", False), ("takeaways", False), ("giveaways", True)):
        if c in opt:
            cols.append(_div(c, "gp").alias(f"{c}_per_game"))
            ranks[f"{c}_per_game"] = lower
    if "faceoffs_won" in opt:
        cols.append(F.coalesce(X.round_ratio(F.col("faceoffs_won") * 100, "faceoffs_in_game", 2), F.lit(50.0))
                    .alias("faceoff_win_pct"))
        ranks["faceoff_win_pct"] = False
    t = t.select("*", *cols)
    if conference is not None:
        t = t.join(conference, "team", "left")
    t = R.rank_metrics(t, ranks)
    if conference is not None:
        t = R.rank_metrics(t, {"points": False}, partition=["conference"], suffix="_conference_rank")
    pct = {"goals_per_game": False, "goals_against_per_game": True, "power_play_pct": False,
           "penalty_kill_pct": False}
    pct.update({k: False for k in ("hits_per_game", "blocks_per_game") if k in ranks})
    return R.percentile_metrics(t, pct)
