"""Batch job: raw feed folders -> season models -> published parquet tables.

    python -m seasonflow.plans.season.run --raw /data/raw --out /data/warehouse [--as-of 2026-01-15]

``--raw`` holds one folder per raw table (games, daily_standings, play_by_play,
game_summaries, game_boxscore, team_rosters, and optionally current_teams,
current_standings, season_schedules), each read with its explicit schema.
The shared models are materialised under ``--out/_shared`` and every fact,
dimension and mart is written season-partitioned under ``--out``; the
data-quality summary is written to ``--out/_checks``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from seasonflow.params import Params
from seasonflow.plans.season import checks, pipeline
from seasonflow.plans.season import schemas as S
from seasonflow.session import apply_cluster_settings, path_exists

RAW = {
    "games": S.GAMES, "daily_standings": S.DAILY_STANDINGS, "play_by_play": S.PLAY_BY_PLAY,
    "game_summaries": S.GAME_SUMMARIES, "game_boxscore": S.GAME_BOXSCORE, "team_rosters": S.TEAM_ROSTERS,
    "current_teams": S.CURRENT_TEAMS, "season_schedules": S.SEASON_SCHEDULES,
}
OPTIONAL = ("current_teams", "season_schedules", "current_standings")


def read_raw_tables(spark: SparkSession, root: str) -> dict:
    out = {}
    for name, schema in RAW.items():
        path = f"{root.rstrip('/')}/{name}"
        if name in OPTIONAL and path_exists(spark, path) is False:
            continue
        out[name] = spark.read.schema(schema).parquet(path)
    cs = f"{root.rstrip('/')}/current_standings"
    if path_exists(spark, cs):
        out["current_standings"] = spark.read.schema(S.CURRENT_STANDINGS).parquet(cs)
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--raw", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--no-cluster-settings", action="store_true",
                    help="keep the session's own SQL settings (local runs, tests)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("seasonflow-season").getOrCreate()
    if not a.no_cluster_settings:
        apply_cluster_settings(spark)
    p = Params(as_of=dt.date.fromisoformat(a.as_of)) if a.as_of else Params()
    raw = read_raw_tables(spark, a.raw)
    models = pipeline.build(spark, raw, p, persist=pipeline.table_writer(f"{a.out.rstrip('/')}/_shared", spark))
    pipeline.publish(models, a.out)
    checks.run_checks(models, raw, dt.datetime.combine(p.as_of, dt.time())).write.mode("overwrite") \
        .parquet(f"{a.out.rstrip('/')}/_checks")


if __name__ == "__main__":
    main()
