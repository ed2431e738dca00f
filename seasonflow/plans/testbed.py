"""Binding of the season patterns to the driver's TPC-H-ish tables.

The season feed itself is not in the test data, so every pattern runs on an
analogue built from the given tables (all derived by Spark, so the work grows
with the tables):

* game      — an order with at least one line.  game_id = o_orderkey,
              game_date = o_orderdate as DATE, season = year(o_orderdate),
              game_type = 2 (status F, regular) / 3 (P, playoff) / 1 (O, other),
              home_team = the customer's nation, away_team = the nation of the
              order's lowest supplier key.
* score     — home = sum(floor(l_quantity)) over odd line numbers, away = even.
* team dim  — nation (25 rows, fixed domain) with region as "conference".
* plays     — events: player = user_id, type = event_type, k = props.k.
* snapshot  — per (user, day) cumulative purchase count / value.

Every frame here is a lazy plan; the matching SQL lives in ``registry.BASE_CTE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.operators.joins import both_sides_in
from seasonflow.operators.reshape import two_sided_unpivot
from seasonflow.session import written
from seasonflow.sources.readers import read_raw


class Bed:
    """Lazy table access and shared derived views for one run of one query.

    Nothing outlives the query: every run derives the shared models (games,
    league universe, side lines, player game lines) from the given tables.  A
    query that reads one of them many times writes it once with ``written``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._tables: dict[str, DataFrame] = {}

    def written(self, name: str) -> DataFrame:
        """A shared model written to a fresh path of the shared folder, once per
        run: its many readers share one derivation, and a lost executor costs only
        the retry of its tasks."""
        if name not in self._tables:
            # the universe reads the games twice, as games and as participants
            df = self.universe(self.written("games")) if name == "universe" else getattr(self, name)()
            self._tables[name] = written(df, f"run-{name}")
        return self._tables[name]

    def t(self, name: str, *cols: str) -> DataFrame:
        return read_raw(self.spark, self.root, name, list(cols) or None)

    # -- dimensions (Spark broadcasts them when their measured size allows) ----
    def teams(self) -> DataFrame:
        n = self.t("nation", "n_nationkey", "n_name", "n_regionkey")
        r = self.t("region", "r_regionkey", "r_name")
        return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
                 .select(F.col("n_nationkey").alias("team"), F.col("n_name").alias("team_name"),
                         F.col("n_regionkey").alias("conference_id"),
                         F.col("r_name").alias("conference")))

    # -- games ---------------------------------------------------------------
    def line_rollup(self) -> DataFrame:
        li = self.t("lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
        odd = (F.col("l_linenumber") % 2) == 1
        goals = F.floor("l_quantity")
        return li.groupBy("l_orderkey").agg(
            F.min("l_suppkey").alias("away_supp"),
            F.sum(F.when(odd, goals).otherwise(F.lit(0))).cast("bigint").alias("home_score"),
            F.sum(F.when(~odd, goals).otherwise(F.lit(0))).cast("bigint").alias("away_score"))

    def games(self) -> DataFrame:
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        c = self.t("customer", "c_custkey", "c_nationkey")
        s = self.t("supplier", "s_suppkey", "s_nationkey")
        g = (o.join(self.line_rollup(), o.o_orderkey == F.col("l_orderkey"), "inner")
              .join(c, o.o_custkey == c.c_custkey, "inner")
              .join(s, F.col("away_supp") == s.s_suppkey, "inner"))
        return g.select(
            F.col("o_orderkey").alias("game_id"),
            F.col("o_orderdate").cast("date").alias("game_date"),
            F.year("o_orderdate").cast("int").alias("season"),
            F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "P", 3)
             .otherwise(1).alias("game_type"),
            F.col("c_nationkey").alias("home_team"),
            F.col("s_nationkey").alias("away_team"),
            "home_score", "away_score")

    def universe(self, games: DataFrame | None = None) -> DataFrame:
        """League games: regular/playoff, two distinct teams, both participants
        of that season's regular schedule (J04)."""
        games = self.games() if games is None else games
        g = games.filter(F.col("game_type").isin(2, 3) &
                         (F.col("home_team") != F.col("away_team")))
        part = (games.filter(F.col("game_type") == 2)
                .select("season", F.col("home_team").alias("team")))
        return both_sides_in(g, part, "season", "home_team", "away_team", "team")

    def sides(self, games: DataFrame | None = None) -> DataFrame:
        """Two rows per game with own / opponent values."""
        g = self.universe() if games is None else games
        return two_sided_unpivot(
            g, ["game_id", "game_date", "season", "game_type"],
            home={"team": "home_team", "goals_for": "home_score"},
            away={"team": "away_team", "goals_for": "away_score"},
        ).withColumnRenamed("opp_team", "opponent").withColumnRenamed("opp_goals_for", "goals_against")

    # -- side lines (M28 base) --------------------------------------------------
    def side_lines(self) -> DataFrame:
        """Per (game, side) counts from the game's lines: odd lines are the home side."""
        li = self.t("lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_discount")
        u = self.universe().select("game_id", "season", "game_type", "home_team", "away_team")
        j = li.join(u, li.l_orderkey == u.game_id, "inner")
        home = (F.col("l_linenumber") % 2) == 1
        j = j.withColumn("is_home", home).withColumn(
            "team", F.when(home, F.col("home_team")).otherwise(F.col("away_team")))
        return j.groupBy("game_id", "season", "game_type", "is_home", "team").agg(
            F.count(F.lit(1)).alias("shots"),
            F.sum(F.floor("l_quantity")).cast("bigint").alias("goals"),
            F.count_if(F.col("l_returnflag") == "R").alias("shorthanded"),
            F.count_if(F.col("l_discount") >= 0.05).alias("pp_goals"))

    # -- standard team-game table (power model input) ----------------------------
    def team_games(self) -> DataFrame:
        """Two-sided game rows plus per-side line counts: shots; power-play
        goals over shots; short-handed lines as goals against on the kill."""
        sl = self.side_lines().select("game_id", "is_home", "shots", "pp_goals", "shorthanded")
        j = self.results().join(sl, ["game_id", "is_home"], "left")
        return j.select("season", "team", "opponent", "game_id", "game_date", "game_type", "goals_for", "goals_against",
                        "points", "shots", "pp_goals", F.col("shots").alias("pp_attempts"),
                        F.col("shots").alias("pk_attempts"), F.col("shorthanded").alias("pk_goals_against"))

    def results(self) -> DataFrame:
        """Two rows per game with the game type's name, goals and standings points."""
        win, level = F.col("goals_for") > F.col("goals_against"), F.col("goals_for") == F.col("goals_against")
        return self.sides().select(
            "season", "team", "opponent", "game_id", "game_date", "is_home",
            F.when(F.col("game_type") == 2, "regular").when(F.col("game_type") == 3, "playoff").alias("game_type"),
            "goals_for", "goals_against", F.when(win, 2).when(level, 1).otherwise(0).alias("points"))

    # -- team standings by day (M27 analogue) -------------------------------------
    def team_standings(self) -> DataFrame:
        """Cumulative (gp, wins, points, goal diff) per (season, team, day) over
        regular games, scaffolded over the season's days and forward-filled;
        windows are partitioned by (season, team) at daily grain."""
        from seasonflow.operators import gapfill as G
        from seasonflow.operators import windows as W
        s = self.sides().filter(F.col("game_type") == 2)
        day = s.groupBy("season", "team", "game_date").agg(
            F.count(F.lit(1)).alias("d_gp"),
            F.count_if(F.col("goals_for") > F.col("goals_against")).alias("d_w"),
            F.sum(F.when(F.col("goals_for") > F.col("goals_against"), 2)
                   .when(F.col("goals_for") == F.col("goals_against"), 1).otherwise(0)).alias("d_pts"),
            F.sum(F.col("goals_for") - F.col("goals_against")).alias("d_gd"))
        cum = W.running_totals(day, ["season", "team"], [F.col("game_date")],
                               {"gp": "d_gp", "wins": "d_w", "points": "d_pts", "goal_diff": "d_gd"})
        cum = cum.select("season", "team", F.col("game_date").alias("date"), "gp", "wins", "points", "goal_diff")
        filled = G.gap_fill(cum, "season", "team", "date", {"gp": 0, "wins": 0, "points": 0, "goal_diff": 0})
        teams = self.teams().select("team", "team_name", "conference")
        return filled.join(teams, "team", "inner")

    # -- plays (events) --------------------------------------------------------
    def plays(self) -> DataFrame:
        e = self.t("events", "event_id", "ts", "user_id", "event_type", "value", "props")
        return e.select(
            F.col("event_id").alias("play_id"), "ts",
            F.col("ts").cast("date").alias("play_date"),
            F.col("user_id").alias("player"), F.col("event_type").alias("type"),
            "value",
            F.get_json_object("props", "$.k").try_cast("int").alias("k"))

    def player_range(self) -> DataFrame:
        """One row: how many player ids there are (ids count from 0)."""
        return self.t("events", "user_id").agg((F.max("user_id") + 1).alias("n_players"))

    # -- player game lines -----------------------------------------------------
    def player_games(self) -> DataFrame:
        """(game, player) lines: player = supplier, team = supplier's nation.

        Per line: goals = floor(qty) % 5, assists = linenumber % 3,
        shots = goals + linenumber % 4, toi = floor(price) % 1200 + 300 s,
        pim = 2 on returned lines.  Lines are placed by their order once, so
        the (order, supplier) aggregate and the order join need no further shuffle.
        """
        li = self.t("lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_returnflag")
        q = F.floor("l_quantity")
        g = q % 5
        per = li.repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("player")).agg(
            F.sum(g).cast("bigint").alias("goals"),
            F.sum(F.col("l_linenumber") % 3).cast("bigint").alias("assists"),
            F.sum(g + F.col("l_linenumber") % 4).cast("bigint").alias("shots"),
            F.sum(F.floor("l_extendedprice") % 1200 + 300).cast("bigint").alias("toi_seconds"),
            F.sum(F.when(F.col("l_returnflag") == "R", 2).otherwise(0)).cast("bigint").alias("pim"))
        o = self.t("orders", "o_orderkey", "o_orderdate", "o_orderstatus")
        s = self.t("supplier", "s_suppkey", "s_name", "s_nationkey")
        return (per.join(o, per.game_id == o.o_orderkey, "inner")
                   .join(s, per.player == s.s_suppkey, "inner")
                   .select("game_id", "player", F.col("s_name").alias("player_name"),
                           F.col("s_nationkey").alias("team"),
                           F.year("o_orderdate").cast("int").alias("season"),
                           F.col("o_orderdate").cast("date").alias("game_date"),
                           F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "P", 3)
                            .otherwise(1).alias("game_type"),
                           "goals", "assists", (F.col("goals") + F.col("assists")).alias("points"),
                           "shots", "toi_seconds", "pim"))

    # -- standings-like daily snapshots -----------------------------------------
    def snapshots(self) -> DataFrame:
        """(player, day) cumulative purchase count and value, only on days with a
        purchase (so a calendar gap-fill has real gaps).  The running window is
        partitioned by player over *daily* rows, bounded by the calendar."""
        from pyspark.sql import Window
        p = self.plays().filter(F.col("type") == "purchase")
        d = p.groupBy("player", "play_date").agg(
            F.count(F.lit(1)).alias("day_n"),
            F.sum(F.col("value").cast("decimal(18,2)")).alias("day_value"))
        w = (Window.partitionBy("player").orderBy("play_date")
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return d.select("player", "play_date",
                        F.year("play_date").alias("season"),
                        F.sum("day_n").over(w).alias("cum_n"),
                        F.sum("day_value").over(w).cast("double").alias("cum_value"))
