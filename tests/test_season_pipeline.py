"""End-to-end season models on hand-built raw-feed fixtures (edge rows)."""

import datetime as dt

import pytest

from seasonflow.params import Params
from seasonflow.plans.season import pipeline
from tests import fixtures as FX


@pytest.fixture(scope="module")
def models(spark):
    raw = {
        "games": FX.games(spark), "daily_standings": FX.daily_standings(spark),
        "play_by_play": FX.plays(spark, [
            {"game": 1, "event": 1, "type": "faceoff", "team": 100, "period": 1, "clock": "00:00"},
            {"game": 1, "event": 2, "type": "goal", "team": 200, "period": 1, "clock": "05:00", "code": "1451"},
            {"game": 1, "event": 3, "type": "goal", "team": 100, "period": 2, "clock": "01:00"},
            {"game": 1, "event": 3, "type": "goal", "team": 100, "period": 2, "clock": "01:00", "loaded": FX.T0},
            {"game": 1, "event": 4, "type": "blocked-shot", "team": 100, "period": 2, "clock": "02:00"},
            {"game": 1, "event": 5, "type": "goal", "team": 100, "period": 3, "clock": "10:00", "code": None},
            {"game": 1, "event": 6, "type": "goal", "team": 100, "period": 3, "clock": "19:00", "code": "0651"},
            {"game": 1, "event": 7, "type": "goal", "team": 200, "period": 3, "clock": "19:30"},
            {"game": 1, "event": 8, "type": "penalty", "team": 200, "period": 1, "clock": "07:00", "duration": 2},
            {"game": 3, "event": 1, "type": "goal", "team": 900, "period": 1, "clock": "01:00"},
        ]),
        "game_summaries": FX.summaries(spark), "game_boxscore": FX.boxscore(spark),
        "team_rosters": FX.rosters(spark), "current_teams": FX.current_teams(spark),
        "season_schedules": FX.schedules(spark),
    }
    raw["current_standings"] = FX.daily_standings(spark)
    seeds = {"colors": spark.createDataFrame([("HOM", "gold", "navy")], "team_abv string, primary_color string, "
                                                                       "secondary_color string")}
    return pipeline.build(spark, raw, Params(as_of=dt.date(2025, 10, 12)), seeds=seeds)


def test_every_model_executes(models):
    for name, df in models.items():
        df.count()   # full execution of each plan


def test_universe_drops_special_events_and_preseason(models):
    rows = {r.game_id: r for r in models["league_games"].collect()}
    assert set(rows) == {1, 2}
    assert rows[1].game_state == "OFF"          # later load wins


def test_summaries_unpivot_two_rows_swapped(models):
    rows = {(r.game_id, r.team_abv): (r.goals, r.goals_against, r.type) for r in models["stg_game_summaries"].collect()}
    assert rows[(1, "HOM")] == (3, 2, "home") and rows[(1, "AWY")] == (2, 3, "away")


def test_three_stars_empty_and_null_arrays_vanish(models):
    assert sorted((r.game_id, r.star) for r in models["stg_three_stars"].collect()) == [(1, 1), (1, 2)]


def test_rosters_latest_load_and_null_array(models):
    rows = models["roster_players"].collect()
    assert sorted(r.player_id for r in rows if r.team_abv == "HOM") == [9, 11, 12, 13]
    assert sorted(r.player_id for r in rows if r.team_abv == "AWY") == [7, 11]


def test_standings_gap_fill_and_late_start(models):
    rows = {(r.team_abv, r.date): r for r in models["standings_by_day"].collect()}
    assert len(rows) == 8
    assert rows[("HOM", dt.date(2025, 10, 10))].points == 2        # carried forward
    assert rows[("AWY", dt.date(2025, 10, 8))].points == 0         # before first snapshot: default
    early = rows[("AWY", dt.date(2025, 10, 8))]
    assert early.divisionname == "Central"                         # from the season's team list
    assert early.divisionsequence is None and early.wildcardsequence is None and early.streak_code is None
    daily = {(r.team_abv, r.date): r for r in models["fct_standings_daily"].collect()}
    d = daily[("AWY", dt.date(2025, 10, 8))]
    assert d.in_playoff_position is False and d.points_pace == 0.0


def test_goalie_backup_with_zero_clock_and_tiers(models):
    g = {(r.game_id, r.player_id): r for r in models["fct_goalie_game"].collect()}
    assert g[(1, 19)].is_relief is False and g[(1, 9)].is_shutout is False
    assert g[(1, 9)].saves_above_average == pytest.approx(23 - 25 * 0.910)
    # Tier labels; no shots faced falls to the last one
    for r in g.values():
        pct = r.save_pct
        want = ("Below Average" if pct is None or pct < 0.88 else "Average" if pct < 0.9 else "Good" if pct < 0.92
                else "Excellent" if pct < 0.95 else "Elite")
        assert r.save_tier == want


def test_team_game_results_and_score_state(models):
    t = {(r.game_id, r.team_abv): r for r in models["fct_team_game"].collect()}
    assert t[(2, "HOM")].game_result == "OTL" and t[(2, "HOM")].points == 1
    assert t[(2, "AWY")].game_result == "W"
    assert t[(1, "AWY")].score_first_flag is True and t[(1, "HOM")].comeback_win_flag is True


def test_plays_strength_and_empty_net(models):
    p = {r.event_id: r for r in models["fct_plays"].filter("game_id = 1").collect()}
    assert p[2].strength_state == "SH"            # away team scoring with 4 skaters vs 5
    assert p[5].strength_state == "Even" and p[5].is_powerplay is None   # NULL code
    assert p[6].is_empty_net is True              # home goal while the away goalie is pulled
    assert p[4].primary_player_key is None and p[1].event_type_name == "faceoff"


def test_game_winning_goal(models):
    pg = {r.player_id: r for r in models["fct_player_game"].filter("game_id = 1").collect()}
    assert set(pg) == {11, 12, 7}
    # the winner's third goal (two conceded) decides; its scorer alone is credited
    goals = [r for r in models["fct_plays"].filter("game_id = 1 AND event_type_name = 'goal'").collect()
             if r.event_team_key == 100]
    goals.sort(key=lambda r: r.game_elapsed_seconds)
    assert len(goals) == 3
    scorer = goals[2].primary_player_key
    assert {i: r.game_winning_goals for i, r in pg.items()} == {i: int(i == scorer) for i in pg}


def test_upcoming_and_power(models):
    up = {r.game_id: r for r in models["upcoming_games"].collect()}
    assert set(up) == {10, 11} and up[10].days_until_game == 2 and up[10].is_division_game is True
    pr = models["team_power_rankings"].collect()
    assert sorted(r.power_rank for r in pr) == [1, 2]


def test_cards_and_checks(models, spark):
    from seasonflow.plans.season import cards as C
    from seasonflow.plans.season.checks import run_checks
    t = C.detailed_team_table(models["standings_by_day"], models["dim_teams"]).collect()
    assert [r.team_abv for r in t] == ["HOM", "AWY"]
    assert C.leaders(models["skaters_season_stats_regular"], "goals", k=1).collect()[0].player_id == 7
    assert C.standings_series(models["standings_by_day"], team="HOM", cap=2).count() == 2
    assert C.team_future_games(models["upcoming_games"], "AWY", dt.date(2025, 10, 15)).count() == 1
    assert C.player_compare(models["fct_player_game"], [11]).collect()[0].games == 2
    assert C.running_stats(models["fct_player_game"], models["league_games"], 11).count() == 2
    summary = {r.target: r.status for r in run_checks(models).collect()}
    assert summary["league_games(game_id)"] == "pass"
    assert summary["fct_team_game.game_result"] == "pass"


def test_teams_dimension_with_seeds_and_current_table(models):
    t = {r.team_abv: r for r in models["dim_teams"].collect()}
    assert t["HOM"].primary_color == "gold" and t["AWY"].primary_color is None
    assert t["HOM"].division == "Central" and t["HOM"].is_current is True
    cur = {r.team_abv: r for r in models["current_standings"].collect()}
    assert set(cur) == {"HOM", "AWY"}


def test_statwise_rankings_cover_all_eleven_stats(models):
    from seasonflow.plans.season.marts import STATWISE
    cols = models["current_statwise_rankings"].columns
    assert all(f"{s}_rank_ordinal" in cols for s in STATWISE)
    r = {x.team_abv: x for x in models["current_statwise_rankings"].collect()}
    assert {r["HOM"].goals_per_game_rank, r["AWY"].goals_per_game_rank} == {1, 2}


def test_goalie_goals_by_period_and_season_metrics(models):
    g = {(r.game_id, r.player_id): r for r in models["fct_goalie_game"].collect()}
    # game 1: AWY goals in P1 and P3 against the HOM goalie in net (none recorded) -> zeros
    assert g[(1, 9)].ga_p1 == 0
    m = {r.team: r for r in models["team_season_metrics"].collect()}
    assert set(m) == {100, 200}
    r = m[100]
    # a win and an overtime loss: 2 W + OTL
    assert r.points == 3 and r.ot_losses == 1 and r.wins == 1 and r.points_pct == 75.0
    assert m[200].points == 2 and m[200].ot_losses == 0 and 0 <= r.faceoff_win_pct <= 100 and r.save_pct is not None
    assert "hits_per_game_rank" in models["team_season_metrics"].columns


def test_season_dimension_lookups(models):
    r = models["dim_seasons"].collect()[0]
    assert (r.season, r.regular_season_games, r.start_year, r.end_year) == (20252026, 2, 2025, 2026)
    assert r.salary_cap == 95500000 and r.cup_captain is None and r.is_shortened_season is True
    assert r.season_display == "2025-26" and r.season_length_days == 4


def test_publish_and_table_writer(spark, models):
    import tempfile
    base = tempfile.mkdtemp(prefix="sf-pub-", dir="/tmp")
    written = pipeline.publish(models, base, ["fct_team_game", "mart_head_to_head", "dim_seasons"])
    assert spark.read.parquet(f"{base}/fct_team_game").count() == models["fct_team_game"].count()
    keep = pipeline.table_writer(base, spark)
    df = keep("league_games", models["league_games"])
    assert df.count() == 2 and len(written) == 3


def test_batch_job_end_to_end(spark):
    import tempfile
    from seasonflow.plans.season import run
    raw_dir = tempfile.mkdtemp(prefix="sf-raw-", dir="/tmp")
    out_dir = tempfile.mkdtemp(prefix="sf-out-", dir="/tmp")
    FX.games(spark).write.parquet(f"{raw_dir}/games")
    FX.daily_standings(spark).write.parquet(f"{raw_dir}/daily_standings")
    FX.plays(spark, [{"game": 1, "event": 1, "type": "goal", "team": 100, "period": 1, "clock": "01:00"}]) \
        .write.parquet(f"{raw_dir}/play_by_play")
    FX.summaries(spark).write.parquet(f"{raw_dir}/game_summaries")
    FX.boxscore(spark).write.parquet(f"{raw_dir}/game_boxscore")
    FX.rosters(spark).write.parquet(f"{raw_dir}/team_rosters")
    run.main(["--raw", raw_dir, "--out", out_dir, "--as-of", "2025-10-12", "--no-cluster-settings"])
    assert spark.read.parquet(f"{out_dir}/fct_team_game").count() == 4
    assert spark.read.parquet(f"{out_dir}/_checks").filter("status = 'fail'").count() == 0


# Column names and order of the published tables.
PUBLISHED = {
    "fct_plays_published": """play_key game_key date_key season_key event_idx period_number period_type time_elapsed_seconds
        game_elapsed_seconds time_in_period time_remaining event_type_id event_type_name event_team_key primary_player_key
        secondary_player_key tertiary_player_key goalie_player_key x_coordinate y_coordinate zone_code shot_type shot_distance
        shot_angle is_goal is_penalty penalty_type penalty_severity penalty_minutes strength_code strength_state is_empty_net
        is_powerplay is_shorthanded zone_name shot_distance_category period_category""",
    "dim_players_published": """player_key player_id first_name last_name full_name birth_date current_age draft_year_estimate
        birth_city birth_state birth_country nationality height_inches weight_pounds shoots_catches primary_position_code
        primary_position_name position_category current_team_abv jersey_number is_active has_nhl_experience seasons_played
        career_games headshot_url experience_level""",
    "all_players_published": """team_abv player_id first_name last_name position number height weight shoots birth_date
        birth_city birth_state birth_country headshot_url""",
    "mart_team_shot_metrics_published": """season season_display team_abv team_name games_played shot_attempts_for
        shot_attempts_against corsi_pct fenwick_for fenwick_against fenwick_pct ev_shot_attempts_for ev_shot_attempts_against
        ev_corsi_pct shooting_pct save_pct pdo""",
    "fct_games_published": """game_key game_id date_key season_key game_type home_team_key away_team_key venue_name attendance
        regulation_home_score regulation_away_score final_home_score final_away_score winning_team_key losing_team_key
        game_duration_minutes overtime_periods is_shootout is_neutral_site home_shots away_shots home_hits away_hits home_pim
        away_pim home_pp_goals away_pp_goals home_pp_attempts away_pp_attempts home_faceoff_pct away_faceoff_pct
        goal_differential goal_differential_abs is_blowout is_high_scoring is_low_scoring start_time_utc venue_tz
        venue_utc_offset""",
    "team_per_game_published": """season game_id team_abv team_id type game_type shots goals goals_against sog faceoff_pct
        power_play pp_goals pp_attempts penalty_kill pk_goals_against pk_attempts pp_pct pim hits blocks giveaways takeaways
        goals_against_g saves shots_against save_pct pp_shots_against pp_saves game_date start_time_utc venue last_period_type
        faceoffs_won faceoffs_taken pk_pct penalties_taken""",
    "dim_player_team_bridge_published": """bridge_key player_key team_key season_key player_id team_abv season start_date
        end_date jersey_number position_code position_name acquisition_type is_current_team games_played_for_team
        traded_mid_season teams_in_season stint_length_days participation_level""",
    "fct_upcoming_games_published": """game_id game_key date_key season_key home_team_key away_team_key game_date game_type
        game_state home_id home_abv home_team_name home_logo away_id away_abv away_team_name away_logo is_weekend
        start_time_eastern game_time_category days_until_game is_divisional_game is_conference_game last_updated""",
    "team_power_rankings": """ranking_date team_id team_abv team_name power_score power_rank points_component goal_component
        advanced_stats_component schedule_component momentum_component point_pct goals_per_game goals_against_per_game
        goal_differential_per_game shots_per_game pp_pct pk_pct last_10_points_pct last_5_wins last_5_losses
        last_5_goal_diff strength_of_schedule games_played current_season_weight_pct previous_season_weight_pct
        prev_playoff_round prev_playoff_result prev_playoff_win_pct prev_playoff_wins prev_playoff_games""",
    "mart_team_power_rankings": """ranking_date team_id team_abv team_name power_score power_rank points_component
        goal_component advanced_stats_component schedule_component momentum_component point_pct goals_per_game
        goals_against_per_game goal_differential_per_game shots_per_game pp_pct pk_pct last_10_points_pct last_5_wins
        last_5_losses last_5_goal_diff strength_of_schedule games_played current_season_weight_pct
        previous_season_weight_pct prev_playoff_round prev_playoff_result prev_playoff_win_pct prev_playoff_wins
        prev_playoff_games""",
    "fct_team_game_stats": """team_game_key game_key team_key opponent_team_key date_key season_key is_home game_result
        points_earned goals_for goals_against goal_differential shots_for shots_against shooting_pct save_pct
        powerplay_goals powerplay_opportunities powerplay_pct penalty_kill_goals_against penalty_kill_situations
        penalty_kill_pct faceoff_wins faceoff_losses faceoff_win_pct hits blocks giveaways takeaways penalty_minutes
        score_first_flag lead_after_1st lead_after_2nd comeback_win_flag game_type game_date game_outcome game_id
        team_abv is_overtime is_shootout shorthanded_goals_against times_shorthanded shot_differential scored_5_plus
        shutout_for shutout_against pp_drought perfect_pk shot_share_pct""",
    "fct_player_game_stats": """player_game_key game_key player_key team_key date_key season_key opponent_team_key
        is_home_game position_played jersey_number goals assists primary_assists secondary_assists points plus_minus
        shots shooting_pct hits blocks giveaways takeaways faceoff_pct faceoffs_won faceoffs_lost penalty_minutes
        time_on_ice_seconds pp_goals pp_assists sh_goals sh_assists empty_net_goals game_winning_goals overtime_goals
        shifts game_type player_id game_id team_abv player_name hat_trick four_point_game four_goal_game
        point_contributions""",
    "fct_goalie_game_stats": """goalie_game_key game_key player_key team_key date_key season_key opponent_team_key
        is_home_game is_starting_goalie decision shots_faced saves goals_against save_percentage goals_against_average
        time_on_ice_seconds even_strength_saves even_strength_shots even_strength_goals_against even_strength_save_pct
        powerplay_saves powerplay_shots powerplay_goals_against powerplay_save_pct shorthanded_saves shorthanded_shots
        shorthanded_goals_against shorthanded_save_pct shutout_flag goals_allowed_1st goals_allowed_2nd
        goals_allowed_3rd goals_allowed_ot penalty_minutes performance_category is_relief_appearance game_type
        player_id game_id team_abv player_name quality_start really_bad_start saves_above_average""",
    "fct_standings_daily_published": """standings_daily_key date_key season_key team_key games_played wins losses
        ot_losses points regulation_wins row_wins points_percentage goals_for goals_against goal_differential home_wins
        home_losses home_ot_losses away_wins away_losses away_ot_losses shootout_wins shootout_losses last_10_wins
        last_10_losses last_10_ot_losses last_10_points last_10_goals_for last_10_goals_against
        last_10_goal_differential streak_type streak_count division_rank conference_rank league_rank wildcard_rank
        playoff_spot_flag points_from_playoff games_remaining max_possible_points magic_number elimination_number
        points_pace wins_pace goals_for_pace goals_against_pace record home_record away_record last_10_record
        shootout_record goal_diff_string streak_string""",
    "dim_teams_published": """team_key team_id team_abv team_name team_location common_name conference conference_abv
        division division_abv arena_name arena_capacity arena_city arena_state_province founded_year previous_name
        current_location_since years_in_league logo_url primary_color secondary_color is_original_or_relocated
        is_expansion_team is_active""",
    "team_season_metrics_published": """team_key team_abv team_name division conference games_played wins
        regulation_losses ot_losses points points_pct league_rank conference_rank division_rank goals_per_game
        goals_per_game_rank goals_per_game_percentile goals_against_average goals_against_rank goals_against_percentile
        hits_per_game hits_per_game_rank hits_percentile blocks_per_game blocks_per_game_rank blocks_percentile
        power_play_pct power_play_rank power_play_percentile penalty_kill_pct penalty_kill_rank penalty_kill_percentile
        shots_per_game shots_per_game_rank shots_against_per_game shots_against_rank shooting_pct shooting_pct_rank
        save_pct save_pct_rank faceoff_win_pct faceoff_rank takeaways_per_game takeaways_rank giveaways_per_game
        giveaways_rank penalty_minutes_per_game goal_diff_per_game goal_differential total_pp_opportunities
        total_pp_goals total_times_shorthanded last_updated""",
    "mart_head_to_head_published": """season season_display game_type team_abv opponent_abv games_played wins losses
        ot_losses record points_earned goals_for goals_against goal_differential""",
    "mart_team_form_published": """season season_display as_of_date team_abv team_name division conference games_played
        points point_pct wins losses ot_losses regulation_wins row_wins goals_for goals_against goal_diff division_rank
        conference_rank league_rank wildcard_rank record home_record road_record last_10_record last_10_points
        last_10_goals_for last_10_goals_against shootout_record streak streak_code streak_count""",
    "mart_standings_weekly_published": """date season season_display team_abv team_name division conference games_played
        points point_pct wins losses ot_losses row_wins goals_for goals_against goal_diff division_rank conference_rank
        league_rank wildcard_rank is_season_final week_of_year""",
    "mart_three_stars_published": """game_id season season_display game_date star_number player_id player_name team_abv
        position goals assists points gaa save_pct headshot_url star_selections_this_season first_star_selections""",
    "goalies_season_stats_regular_published": """season player_id name team_abv gp games_dressed starts wins losses
        ot_losses shutouts quality_starts goals_against toi_seconds saves shots_faced even_goals_against even_shots_saved
        even_shots_against pp_ga pp_saves pp_shots_against sh_goals_against sh_saves sh_shots_against pim gaa save_pct
        even_save_pct pp_save_pct sh_save_pct goals_saved_above_average is_qualified season_display first_name last_name
        headshot_url""",
    "skaters_season_stats_regular_published": """season player_id team_abv name games_played goals assists hits shots pim
        plus_minus points pp_goals giveaways takeaways shifts total_toi avg_toi primary_assists secondary_assists
        pp_assists sh_goals sh_assists empty_net_goals game_winning_goals overtime_goals faceoffs_won faceoffs_lost
        faceoff_pct points_per_game goals_per_game assists_per_game points_per_60 goals_per_60 is_qualified
        season_display first_name last_name position headshot_url""",
    "current_standings_published": """team team_abv division division_abv conference conference_abv league_standing
        conference_standing division_standing wildcard_standing waiver points wins losses ot_losses games_played record
        win_pct point_pct reg_wins reg_ot_wins reg_ot_win_pct reg_win_pct shootout_w shootout_l shootout_record goals_for
        goals_against goal_diff goal_diff_string goals_per_game goal_diff_pct home_wins home_losses home_ot_l home_points
        home_record home_gp home_goals home_goals_against home_goal_diff home_goal_diff_string home_reg_wins
        home_reg_ot_wins league_home_standing div_home_standing conf_home_standing road_wins road_losses road_ot_l
        road_points road_record road_gp road_goals road_goals_against road_goal_diff road_goal_diff_string road_reg_wins
        road_reg_ot_wins league_road_standing div_road_standing conf_road_standing streak streak_count streak_string l10_gp
        l10_wins l10_losses l10_ot_l l10_record l10_points l10_goals l10_goals_against l10_goal_diff l10_reg_wins
        l10_reg_ot_wins div_l10_standing conf_l10_standing""",
    "standings_by_day_published": """date season team_name team_abv games_played points wins losses ot_losses
        regulation_wins regulation_plus_ot_wins record goals_for goals_against goal_diff point_pct division conference
        div_sequence wc_sequence conf_sequence league_sequence home_wins home_losses home_ot_losses road_wins road_losses
        road_ot_losses shootout_wins shootout_losses l10_wins l10_losses l10_ot_losses l10_points l10_goals_for
        l10_goals_against l10_goal_diff streak_code streak_count season_display""",
    "team_season_stats_regular_published": """season team_abv games_played goals goals_per_game goals_against_average
        goals_against shots shots_per_game pp_goals pp_attempts pp_pct pim pk_attempts pk_pct pim_per_game hits
        hits_per_game blocks blocks_per_game giveaways giveaways_per_game takeaways takeaways_per_game season_display
        logo_url""",
    "upcoming_games_published": """id venue season away_abv away_id home_abv home_id game_date game_type game_state
        winning_goalie_id winning_scorer_id neutral start_time_utc eastern_offset venue_tz special_event away_logo
        home_logo""",
}


@pytest.mark.parametrize("name", sorted(PUBLISHED))
def test_published_columns(models, name):
    assert models[name].columns == PUBLISHED[name].split()


def test_published_team_games(models):
    t = {(r.game_id, r.team_abv): r for r in models["fct_team_game_stats"].collect()}
    assert len(t) == 4
    a, b = t[(1, "HOM")], t[(1, "AWY")]
    assert (a.team_key, a.opponent_team_key, b.team_key, b.opponent_team_key) == (100, 200, 200, 100)
    assert (a.goals_for, a.goals_against, a.goal_differential, a.points_earned) == (3, 2, 1, 2)
    assert a.date_key == 20251008 or a.date_key == int(a.game_date.strftime("%Y%m%d"))
    assert a.shooting_pct == pytest.approx(3 / a.shots_for) and a.shot_differential == a.shots_for - a.shots_against
    assert (a.faceoff_wins, a.faceoff_losses, a.faceoff_win_pct) == (1, 0, 1.0)
    assert (a.shutout_for, a.shutout_against, a.scored_5_plus, a.is_overtime) == (False, False, False, False)
    # one penalty against AWY: one power play for HOM without a goal in the box score, or with
    assert a.powerplay_opportunities == b.penalty_kill_situations == 1
    assert b.perfect_pk == (b.penalty_kill_goals_against == 0) and a.pp_drought == (a.powerplay_goals == 0)
    assert t[(2, "HOM")].points_earned == 1 and t[(2, "HOM")].game_result == "OTL"


def test_published_player_and_goalie_games(models):
    box = {(r.game_id, r.player_id): r for r in models["skater_game_lines"].collect()}
    rows = {(r.game_id, r.player_id): r for r in models["fct_player_game_stats"].collect()}
    assert set(rows) == set(box)
    for k, r in rows.items():
        assert (r.blocks, r.takeaways, r.shifts, r.plus_minus) == (
            box[k].blocked_shots, box[k].takeaways, box[k].shifts, box[k].plus_minus)
        assert r.is_home_game == (box[k].type == "home") and {r.team_key, r.opponent_team_key} == {100, 200}
        assert r.point_contributions == r.goals + r.assists
    g = {(r.game_id, r.player_id): r for r in models["fct_goalie_game_stats"].collect()}
    line = {(r.game_id, r.player_id): r for r in models["goalie_game_lines"].collect()}
    assert set(g) == set(line)
    for k, r in g.items():
        assert (r.even_strength_saves, r.powerplay_shots, r.shorthanded_goals_against) == (
            line[k].even_shots_saved, line[k].pp_shots_against, line[k].sh_goals_against)
        if r.even_strength_shots:
            assert r.even_strength_save_pct == pytest.approx(r.even_strength_saves / r.even_strength_shots)


def test_published_standings_and_teams(models):
    s = {(r.team_key, r.date_key): r for r in models["fct_standings_daily_published"].collect()}
    early = s[(200, 20251008)]
    assert (early.playoff_spot_flag, early.points_pace, early.record, early.streak_string) == (False, 0.0, "0-0-0", None)
    assert early.points_percentage == 0.0 and early.division_rank is None
    t = {r.team_abv: r for r in models["dim_teams_published"].collect()}
    assert t["HOM"].primary_color == "gold" and t["HOM"].is_active and t["HOM"].is_expansion_team is False
    assert t["HOM"].team_key == 100 and t["HOM"].arena_name is None


def test_card_row_limit_is_the_callers(models):
    from seasonflow.plans.season import cards as C
    assert C.standings_series(models["standings_by_day"]).count() == 8
    rows = C.standings_series(models["standings_by_day"], cap=3).collect()
    assert len(rows) == 3 and min(r.date for r in rows) >= dt.date(2025, 10, 10)


def test_shot_metrics_are_fractions(models):
    for r in models["mart_team_shot_metrics"].collect():
        assert r.corsi_pct is None or 0 <= r.corsi_pct <= 1
        assert r.pdo == pytest.approx(1000 * ((r.gf / r.sf if r.sf else 0) + (r.saves / r.sa if r.sa else 0)), abs=0.06)


def test_time_slots_and_playoff_labels(models):
    assert {r.time_slot for r in models["upcoming_games"].collect()} <= {"Afternoon", "Early Evening", "Late Evening"}
    # no previous season is loaded: no playoff result
    assert {r.prev_playoff_result for r in models["team_power_rankings"].collect()} == {None}


def test_published_marts(models):
    m = {r.team_abv: r for r in models["team_season_metrics_published"].collect()}
    assert (m["HOM"].points, m["HOM"].ot_losses, m["HOM"].wins, m["HOM"].league_rank) == (3, 1, 1, 1)
    assert m["AWY"].points == 2 and m["AWY"].division_rank == 2 and m["HOM"].points_pct == 75.0
    assert m["HOM"].goal_differential == -m["AWY"].goal_differential
    h = {(r.team_abv, r.opponent_abv): r for r in models["mart_head_to_head_published"].collect()}
    assert h[("HOM", "AWY")].record == "1-0-1" and h[("HOM", "AWY")].points_earned == 3
    f = {r.team_abv: r for r in models["mart_team_form_published"].collect()}
    assert set(f) == {"HOM", "AWY"} and f["HOM"].season_display == "2025-26"
    w = models["mart_standings_weekly_published"].collect()
    assert w and all(r.is_season_final or r.date.isoweekday() == 1 for r in w)
    stars = {r.star_number: r for r in models["mart_three_stars_published"].collect()}
    assert set(stars) == {1, 2} and all(r.star_selections_this_season == 1 for r in stars.values())
    s = {(r.player_id, r.team_abv): r for r in models["skaters_season_stats_regular_published"].collect()}
    for r in s.values():
        assert r.points_per_game == pytest.approx(r.points / r.games_played, abs=0.006)
    g = {(r.player_id, r.team_abv): r for r in models["goalies_season_stats_regular_published"].collect()}
    for r in g.values():
        assert r.gp <= r.games_dressed and (not r.shots_faced or r.save_pct == pytest.approx(r.saves / r.shots_faced))


def test_published_plays_players_and_games(models):
    plays = {(r.game_key, r.event_idx): r for r in models["fct_plays_published"].collect()}
    assert set(plays) == {(1, e) for e in range(1, 9)}
    assert plays[(1, 2)].event_team_key == 200 and plays[(1, 2)].is_goal and plays[(1, 1)].zone_name == "Unknown"
    assert plays[(1, 7)].game_elapsed_seconds == 2400 + 19 * 60 + 30 and plays[(1, 8)].penalty_minutes == 2
    players = {r.player_id: r for r in models["dim_players_published"].collect()}
    assert set(players) == {7, 8, 9, 11, 12, 13, 19}
    p = players[11]
    assert (p.primary_position_name, p.position_category, p.nationality, p.jersey_number, p.full_name) == (
        "Center", "Forward", "XXA", 11, "F One")
    assert players[8].first_name is None and players[8].primary_position_name == "Goalie" and players[13].experience_level == "Prospect"
    g = {r.game_id: r for r in models["fct_games_published"].collect()}
    assert set(g) == {1, 2}
    assert (g[1].final_home_score, g[1].final_away_score, g[1].winning_team_key, g[1].losing_team_key, g[1].game_type) == (
        3, 2, 100, 200, "Regular")
    # game 2 went to overtime: the winner had one goal less after regulation
    assert (g[2].regulation_home_score, g[2].regulation_away_score, g[2].game_duration_minutes, g[2].overtime_periods) == (3, 3, 65, 1)
    assert not g[2].is_shootout and g[1].home_shots == 30 and g[1].goal_differential_abs == 1 and g[1].attendance is None


def test_published_lines_bridge_and_metrics(models):
    t = {(r.game_id, r.team_abv): r for r in models["team_per_game_published"].collect()}
    assert len(t) == 4
    r = t[(1, "HOM")]
    assert (r.type, r.goals, r.goals_against, r.sog, r.saves, r.shots_against, r.goals_against_g) == ("home", 3, 2, 30, 23, 25, 2)
    assert (r.power_play, r.penalty_kill, r.penalties_taken) == ("0/1", "0/0", 0) and t[(1, "AWY")].penalties_taken == 1
    assert r.faceoffs_taken == 1 and r.faceoff_pct == 1.0 and r.pk_pct is None
    b = {(r.player_id, r.team_abv): r for r in models["dim_player_team_bridge_published"].collect()}
    assert b[(11, "HOM")].jersey_number == 11 and b[(11, "HOM")].position_name == "Center" and b[(11, "HOM")].team_key == 100
    assert b[(7, "AWY")].games_played_for_team == 2 and b[(7, "AWY")].season_key == 20252026
    m = {r.team_abv: r for r in models["mart_team_shot_metrics_published"].collect()}
    assert set(m) == {"HOM", "AWY"} and all(r.games_played == 1 for r in m.values())
    # five goals and one blocked shot, which counts for the team that shot it
    assert (m["HOM"].shot_attempts_for, m["HOM"].shot_attempts_against, m["HOM"].fenwick_against) == (3, 3, 2)
    assert m["HOM"].corsi_pct == 0.5 and m["HOM"].season_display == "2025-26"
    a = {(r.team_abv, r.player_id) for r in models["all_players_published"].collect()}
    assert ("AWY", 11) in a and ("HOM", 13) in a
    u = models["fct_upcoming_games_published"].collect()
    assert {r.game_id for r in u} == {10, 11} and all(r.home_team_name for r in u) and u[0].home_team_key in (100, 200)


def test_published_current_standings(spark, models):
    # the feed of the other tests has the daily columns alone (two rows a team, loaded at once): the rest is NULL
    few = {r.team_abv: r for r in models["current_standings_published"].collect()}
    assert few["HOM"].points in (2, 3) and (few["HOM"].waiver, few["HOM"].home_gp, few["HOM"].record) == (None, None, None)
    from seasonflow.plans.season import published
    from seasonflow.plans.season import staging as ST
    rows = {r.team_abv: r for r in published.current_standings(ST.stg_current_standings(FX.current_standings(spark))).collect()}
    r = rows["HOM"]
    assert set(rows) == {"HOM", "AWY"} and len(r) == 78
    assert (r.team, r.points, r.record, r.shootout_record, r.goal_diff, r.goal_diff_string) == (
        "Home City", 100, "48-30-4", "3-2", 10, "+10")
    assert (r.home_record, r.home_goal_diff_string, r.road_record, r.road_goal_diff, r.road_goal_diff_string) == (
        "30-10-1", "+30", "18-20-3", -20, "-20")
    assert (r.streak_string, r.l10_record, r.l10_points, r.waiver, r.league_home_standing, r.div_road_standing,
            r.conf_l10_standing, r.point_pct) == ("W2", "6-3-1", 13, 20, 4, 5, 6, 0.61)
    assert (rows["AWY"].points, rows["AWY"].wins, rows["AWY"].record, rows["AWY"].goal_diff_string) == (90, 44, None, None)


def test_published_team_seasons_days_and_schedule(models):
    s = {r.team_abv: r for r in models["team_season_stats_regular_published"].collect()}
    h = s["HOM"]
    assert set(s) == {"HOM", "AWY"} and (h.games_played, h.goals, h.goals_against, h.shots) == (2, 6, 6, 58)
    assert (h.goals_per_game, h.goals_against_average, h.shots_per_game, h.season_display) == (3.0, 3.0, 29.0, "2025-26")
    # one penalty of the other team: an attempt without a goal, none to kill
    assert (h.pp_attempts, h.pp_pct, h.pk_attempts, h.pk_pct) == (1, 0.0, 0, None)
    assert (s["AWY"].pk_pct, s["AWY"].pim, s["AWY"].pim_per_game) == (1.0, 2, 1.0)
    assert models["team_season_stats_playoff_published"].count() == 0
    assert models["team_season_regular_published"].columns == [c for c in h.__fields__ if c != "season_display"]
    d = {(r.team_abv, r.date.day): r for r in models["standings_by_day_published"].collect()}
    assert len(d) == 8 and (d[("HOM", 10)].points, d[("HOM", 10)].point_pct, d[("HOM", 10)].streak_code) == (2, 1.0, "W")
    assert (d[("AWY", 8)].record, d[("AWY", 8)].point_pct, d[("AWY", 8)].div_sequence) == ("0-0-0", 0.0, None)
    u = {r.id: r for r in models["upcoming_games_published"].collect()}
    assert set(u) == {10, 11} and u[10].game_type == 2 and u[11].away_abv == "HOM" and u[10].winning_goalie_id is None


def test_shot_metrics_of_a_side_without_attempts(spark):
    from seasonflow.plans.season import marts
    plays = spark.createDataFrame([(1, 2025, "goal", "Regulation", "home", "Even"), (1, 2025, "blocked-shot", "Regulation", "away", "PP")],
                                  "game_id long, season int, event_type_name string, period_category string, event_side string, "
                                  "strength_state string")
    lines = spark.createDataFrame([(1, 2025, "HOM", True, 1, 0, 10, 8, 8), (1, 2025, "AWY", False, 0, 1, 8, 10, 9)],
                                  "game_id long, season int, team_abv string, is_home boolean, goals int, goals_against int, shots int, "
                                  "shots_against int, saves int")
    m = {(r.season, r.team_abv): r for r in marts.team_shot_metrics(plays, lines).collect()}
    assert set(m) == {(2025, "HOM"), (2025, "AWY")}
    a = m[(2025, "AWY")]
    assert (a.cf, a.ca, a.ff, a.fa, a.cf_even, a.ca_even, a.corsi_pct) == (0, 2, 0, 1, 0, 1, 0.0) and m[(2025, "HOM")].corsi_pct == 1.0
