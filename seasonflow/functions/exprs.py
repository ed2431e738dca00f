"""Column -> Column helpers.  All stay inside Catalyst (no Python UDFs).

Spark 4 runs in ANSI mode: bad casts, division by zero and ``split_part``
index 0 raise.  Helpers therefore use ``try_cast`` / ``try_divide`` and
1-based part indexes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
#   clock text format: "MM:SS"
#   fraction text format: "saved/against"
#   season key: 8 digits, e.g. 20252026 -> display "2025-26"
#   surrogate-key separator "-" and NULL sentinel "_dbt_utils_surrogate_key_null_"
#   period start offsets in seconds: P1 0, P2 1200, P3 2400, P4 3600, P5 3900
#   rink goal line x = 89 (feet from centre ice)
#   shot distance bands: <= 10 Close, <= 25 Medium, > 25 Long
#   penalty severity: MIN or 2 min Minor; 4 min Double Minor; MAJ or 5 min
#     Major; BEN Bench Minor; MIS, GMI or 10 min Misconduct; MAT Match;
#     PS Penalty Shot; else Other
#   goalie save-pct tiers: >= .950 Elite, >= .920 Great, >= .900 Good,
#     >= .880 Average, else Poor
# ---------------------------------------------------------------------------
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
PERIOD_OFFSETS = {1: 0, 2: 1200, 3: 2400, 4: 3600, 5: 3900}
GOAL_LINE_X = 89


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# F01 ---------------------------------------------------------------------
def clock_to_seconds(clock) -> Column:
    """'MM:SS' -> integer seconds; malformed text -> NULL."""
    c = _c(clock)
    mins = F.split_part(c, F.lit(":"), F.lit(1)).try_cast("int")
    secs = F.split_part(c, F.lit(":"), F.lit(-1)).try_cast("int")
    return mins * 60 + secs


def seconds_to_clock(seconds) -> Column:
    """Integer seconds -> 'MM:SS' (minutes zero-padded to at least two)."""
    s = _c(seconds).cast("bigint")
    return F.concat(F.lpad(F.floor(s / 60).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((s % 60).cast("string"), 2, "0"))


# F02 ---------------------------------------------------------------------
def safe_divide(num, den) -> Column:
    """num / den with NULL on a zero or NULL denominator (ANSI safe)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def round_ratio(num, den, digits: int = 2) -> Column:
    """round(num / den, digits), exact HALF_UP, NULL when den = 0 — for integer
    num and den (counts, sums of counts, seconds).

    Rounding a binary double at a decimal tie is engine-dependent, so rates
    that are published rounded are divided in decimals and cast to double
    last.  The operands are decimal(20,0) (every bigint fits), which leaves 18
    fractional digits in the quotient — far below any integer-ratio tie — so
    the single final rounding is exact (a narrow quotient scale would round
    twice).
    """
    n = _c(num).cast("decimal(20,0)")
    d = _c(den).cast("decimal(20,0)")
    return F.round(F.try_divide(n, F.when(d != 0, d)), digits).cast("double")


# F03 ---------------------------------------------------------------------
def season_display(season_key) -> Column:
    s = _c(season_key).cast("string")
    return F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 7, 2))


def season_key_from_year(start_year) -> Column:
    """Season starting in ``start_year`` -> 8-digit key (2025 -> 20252026)."""
    y = _c(start_year).cast("int")
    return y * 10000 + (y + 1)


# F04 / F05 ---------------------------------------------------------------
def fraction_part(text, index: int) -> Column:
    """Part ``index`` (1-based) of an 'n/m' text as int; NULL when malformed."""
    return F.split_part(_c(text), F.lit("/"), F.lit(index)).try_cast("int")


def fraction_text(num, den) -> Column:
    return F.concat(_c(num).cast("string"), F.lit("/"), _c(den).cast("string"))


# F07 / F08 / F09 ---------------------------------------------------------
def record_string(*parts) -> Column:
    """'W-L-O' style record; NULL when any part is NULL."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(_c(p).cast("string"))
    return F.concat(*pieces)


def url_fallback(url, prefix: str, key) -> Column:
    return F.coalesce(_c(url), F.concat(F.lit(prefix), _c(key).cast("string")))


def signed_string(x) -> Column:
    """Positive numbers get a leading '+'; zero and negatives print as is."""
    c = _c(x)
    return F.when(c > 0, F.concat(F.lit("+"), c.cast("string"))).otherwise(c.cast("string"))


# F10 ---------------------------------------------------------------------
def ordinal_suffix(n) -> Column:
    """1 -> '1st', 2 -> '2nd', 11 -> '11th', 23 -> '23rd'."""
    c = _c(n)
    suffix = (F.when((c % 100).isin(11, 12, 13), F.lit("th"))
              .when(c % 10 == 1, F.lit("st"))
              .when(c % 10 == 2, F.lit("nd"))
              .when(c % 10 == 3, F.lit("rd"))
              .otherwise(F.lit("th")))
    return F.concat(c.cast("string"), suffix)


# F13 / F14 / F15 / F17 ---------------------------------------------------
def date_key(d) -> Column:
    """DATE -> integer YYYYMMDD."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def iso_dow(d) -> Column:
    """ISO day of week: Monday 1 .. Sunday 7 (same in every engine)."""
    return F.weekday(_c(d)) + 1


def is_weekend(d) -> Column:
    return iso_dow(d) >= 6


def is_monday(d) -> Column:
    return F.weekday(_c(d)) == 0


# F18 / F23 ---------------------------------------------------------------
def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (end - start)."""
    return F.datediff(_c(end), _c(start))


def age_years(birth, as_of) -> Column:
    return F.floor(F.datediff(_lit(as_of), _c(birth)) / F.lit(365.25)).cast("int")


def ntz(ts) -> Column:
    """A wall-clock timestamp literal (TIMESTAMP_NTZ): comparing it with NTZ
    columns never involves the session time zone."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


# F19 / F20 / F21 ---------------------------------------------------------
def parse_utc(text, fmt: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> Column:
    return F.try_to_timestamp(_c(text), F.lit(fmt))


def to_local(ts, tz: str) -> Column:
    return F.from_utc_timestamp(_c(ts), tz)


def add_offset_hours(ts, offset_text) -> Column:
    """ts + hours parsed from '+HH:MM' / '-HH:MM' text (minutes kept)."""
    t = _c(offset_text)
    sign = F.when(F.substring(t, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    body = F.regexp_replace(t, r"^[+-]", "")
    hours = F.split_part(body, F.lit(":"), F.lit(1)).try_cast("int")
    mins = F.coalesce(F.split_part(body, F.lit(":"), F.lit(2)).try_cast("int"), F.lit(0))
    return _c(ts) + F.make_dt_interval(F.lit(0), sign * hours, sign * mins, F.lit(0))


# F25 / F26 ---------------------------------------------------------------
def shot_distance(x, y) -> Column:
    dx = F.abs(F.lit(GOAL_LINE_X) - F.abs(_c(x)))
    return F.sqrt(F.pow(dx, 2) + F.pow(_c(y), 2))


def shot_angle(x, y) -> Column:
    dx = F.abs(F.lit(GOAL_LINE_X) - F.abs(_c(x)))
    return F.degrees(F.atan2(_c(y), dx))


def distance_band(dist) -> Column:
    d = _c(dist)
    return (F.when(d.isNull(), F.lit(None).cast("string"))
            .when(d <= 10, "Close").when(d <= 25, "Medium").otherwise("Long"))


# F27 ---------------------------------------------------------------------
def surrogate_key(*cols) -> Column:
    """md5 over '-'-joined stringified columns, NULL replaced by a sentinel."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# F28 / F29 ---------------------------------------------------------------
def text_to_bool(t) -> Column:
    return _c(t).try_cast("boolean")


# Period / clock helpers (M40) ------------------------------------------------
def elapsed_seconds(period, clock_seconds) -> Column:
    """Game-elapsed seconds from period number and seconds into the period."""
    p = _c(period)
    expr = None
    for num, off in PERIOD_OFFSETS.items():
        expr = (F.when(p == num, F.lit(off)) if expr is None
                else expr.when(p == num, F.lit(off)))
    offset = expr.otherwise(F.lit(None).cast("int"))
    return offset + _c(clock_seconds)


def penalty_severity(type_code, minutes) -> Column:
    t, m = _c(type_code), _c(minutes)
    return (F.when((t == "MIN") | (m == 2), "Minor")
            .when(m == 4, "Double Minor")
            .when((t == "MAJ") | (m == 5), "Major")
            .when(t == "BEN", "Bench Minor")
            .when(t.isin("MIS", "GMI") | (m == 10), "Misconduct")
            .when(t == "MAT", "Match")
            .when(t == "PS", "Penalty Shot")
            .otherwise("Other"))


def save_pct_tier(pct) -> Column:
    p = _c(pct)
    return (F.when(p >= 0.950, "Elite").when(p >= 0.920, "Excellent")
            .when(p >= 0.900, "Good").when(p >= 0.880, "Average").otherwise("Below Average"))


def strength_columns(code, event_team, home_team, away_team) -> dict[str, Column]:
    """Decode a 4-char situation code from the event team's point of view.

    Code layout: [away goalie][away skaters][home skaters][home goalie].
    Returns ``strength_state``, ``is_powerplay``, ``is_shorthanded``,
    ``is_empty_net``.  A NULL code makes the length test NULL, so the state
    falls through to 'Even' and the flags stay NULL (as the reference does).
    """
    c, t = _c(code), _c(event_team)
    bad = (F.length(c) != 4) | t.isNull()
    is_home = t == _c(home_team)
    home_sk = F.substring(c, 3, 1).try_cast("int")
    away_sk = F.substring(c, 2, 1).try_cast("int")
    own = F.when(F.length(c) != 4, None).when(is_home, home_sk).otherwise(away_sk)
    opp = F.when(F.length(c) != 4, None).when(is_home, away_sk).otherwise(home_sk)
    state = (F.when(bad, "Other").when(own > opp, "PP").when(own < opp, "SH")
             .otherwise("Even"))
    empty = (F.when(bad, False)
             .when(is_home, F.substring(c, 1, 1) == "0")
             .when(t == _c(away_team), F.substring(c, 4, 1) == "0")
             .otherwise(False))
    return {
        "strength_state": state,
        "is_powerplay": F.when(bad, False).otherwise(own > opp),
        "is_shorthanded": F.when(bad, False).otherwise(own < opp),
        "is_empty_net": empty,
    }
