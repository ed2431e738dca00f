"""Job parameters.  Every clock read comes from ``as_of`` (determinism)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # Fixed values of the season model (must equal the reference's for right
    # results): 82 regular-season games, 32 teams, league-average save
    # percentage 0.910, minimum games for skater / goalie qualification 10 / 15.
    regular_season_games: int = 82
    team_count: int = 32
    avg_save_pct: float = 0.910
    min_games_skater: int = 10
    min_games_goalie: int = 15
    as_of: _dt.date = field(default_factory=lambda: _dt.date(2026, 1, 15))
    local_tz: str = "America/New_York"
    game_types: tuple = (2, 3)
    # When True, period 5 is always labelled a shootout (the reference's rule);
    # otherwise the feed's period type decides.
    period5_is_shootout: bool = False
    # Folder of player pictures, used where the roster has none (None: no picture).
    headshot_prefix: str | None = None
