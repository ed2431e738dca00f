"""Query registry: key -> Spark builder and key -> oracle SQL (DuckDB dialect).

Oracle SQL is written from the definition, in a different shape from the
Spark plan where practical (correlated subqueries / EXISTS where Spark uses
windows or joins), so both cannot share one mistake.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Shared CTEs over the pre-registered views; DuckDB inlines unused ones.
BASE_CTE = """
line_rollup AS (
  SELECT l_orderkey, min(l_suppkey) AS away_supp,
         CAST(sum(CASE WHEN l_linenumber % 2 = 1 THEN floor(l_quantity) ELSE 0 END) AS BIGINT) AS home_score,
         CAST(sum(CASE WHEN l_linenumber % 2 = 0 THEN floor(l_quantity) ELSE 0 END) AS BIGINT) AS away_score
  FROM lineitem GROUP BY l_orderkey),
games AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date,
         CAST(year(o_orderdate) AS INTEGER) AS season,
         CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE 1 END AS game_type,
         c_nationkey AS home_team, s_nationkey AS away_team, home_score, away_score
  FROM orders
  JOIN line_rollup ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON away_supp = s_suppkey),
participants AS (SELECT DISTINCT season, home_team AS team FROM games WHERE game_type = 2),
universe AS (
  SELECT g.* FROM games g
  WHERE g.game_type IN (2, 3) AND g.home_team <> g.away_team
    AND EXISTS (SELECT 1 FROM participants p WHERE p.season = g.season AND p.team = g.home_team)
    AND EXISTS (SELECT 1 FROM participants p WHERE p.season = g.season AND p.team = g.away_team)),
sides AS (
  SELECT game_id, game_date, season, game_type, true AS is_home, home_team AS team,
         home_score AS goals_for, away_team AS opponent, away_score AS goals_against FROM universe
  UNION ALL
  SELECT game_id, game_date, season, game_type, false, away_team, away_score, home_team, home_score
  FROM universe),
teams AS (
  SELECT n_nationkey AS team, n_name AS team_name, n_regionkey AS conference_id, r_name AS conference
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
player_games AS (
  SELECT l_orderkey AS game_id, l_suppkey AS player, s_name AS player_name, s_nationkey AS team,
         CAST(year(o_orderdate) AS INTEGER) AS season, CAST(o_orderdate AS DATE) AS game_date,
         CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE 1 END AS game_type,
         goals, assists, goals + assists AS points, shots, toi_seconds, pim
  FROM (SELECT l_orderkey, l_suppkey,
               CAST(sum(CAST(floor(l_quantity) AS BIGINT) % 5) AS BIGINT) AS goals,
               CAST(sum(l_linenumber % 3) AS BIGINT) AS assists,
               CAST(sum(CAST(floor(l_quantity) AS BIGINT) % 5 + l_linenumber % 4) AS BIGINT) AS shots,
               CAST(sum(CAST(floor(l_extendedprice) AS BIGINT) % 1200 + 300) AS BIGINT) AS toi_seconds,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 0 END) AS BIGINT) AS pim
        FROM lineitem GROUP BY l_orderkey, l_suppkey) pl
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey),
plays AS (
  SELECT event_id AS play_id, ts, CAST(ts AS DATE) AS play_date, user_id AS player,
         event_type AS type, value, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
snapshots AS (
  SELECT player, play_date, CAST(year(play_date) AS INTEGER) AS season,
         CAST(sum(day_n) OVER (PARTITION BY player ORDER BY play_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_n,
         CAST(sum(day_value) OVER (PARTITION BY player ORDER BY play_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum_value
  FROM (SELECT player, play_date, count(*) AS day_n, sum(CAST(value AS DECIMAL(18,2))) AS day_value
        FROM plays WHERE type = 'purchase' GROUP BY player, play_date) d)
"""


def _balanced(text: str, i: int) -> int:
    """Index just past the parenthesis group opening at ``text[i] == '('``."""
    depth = 0
    for j in range(i, len(text)):
        if text[j] == "(":
            depth += 1
        elif text[j] == ")":
            depth -= 1
            if depth == 0:
                return j + 1
    raise ValueError("unbalanced parentheses")


def _bigint_count_if(text: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; Spark's is BIGINT.  Wrap every call
    (with its OVER clause, if any) in ``CAST(... AS BIGINT)``."""
    out, i, key = [], 0, "count_if("
    while True:
        k = text.find(key, i)
        if k < 0:
            out.append(text[i:])
            return "".join(out)
        end = _balanced(text, k + len(key) - 1)
        rest = text[end:]
        stripped = rest.lstrip()
        if stripped.upper().startswith("OVER"):
            p = end + (len(rest) - len(stripped)) + 4
            while text[p].isspace():
                p += 1
            end = _balanced(text, p)
        out.append(text[i:k] + "CAST(" + text[k:end] + " AS BIGINT)")
        i = end


def sql(body: str) -> str:
    """Prefix ``body`` (a query that may reference the base CTEs) with them."""
    return _bigint_count_if("WITH " + BASE_CTE.strip() + "\n" + body.strip())


def register(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def rr(num: str, den: str, digits: int = 2, scale: int = 1) -> str:
    """Oracle form of ``round_ratio`` for non-negative integer expressions:
    exact HALF_UP by integer arithmetic.  ``scale`` multiplies the numerator
    (e.g. 3600 for per-hour rates)."""
    m = 10 ** digits
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST((CAST({num} AS HUGEINT) * {scale * m * 2} + ({den})) "
            f"// (2 * ({den})) AS DOUBLE) / {m} END)")
