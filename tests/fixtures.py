"""Small hand-built raw-feed fixtures (the reference's edge rows)."""

from __future__ import annotations

import datetime as dt
import json

from seasonflow.plans.season import schemas as S

T0 = dt.datetime(2025, 10, 10, 6, 0)
T1 = dt.datetime(2025, 10, 11, 6, 0)


def row(schema, **kw):
    return tuple(kw.get(f.name) for f in schema.fields)


def games(spark):
    rows = [
        # game 1 loaded twice: the later load (final) wins
        row(S.GAMES, ID=1, SEASON=20252026, GAMETYPE=2, GAMEDATE=dt.date(2025, 10, 8), GAMESTATE="LIVE",
            HOMETEAM_ID=100, HOMETEAM_ABBREV="HOM", AWAYTEAM_ID=200, AWAYTEAM_ABBREV="AWY", _loaded_at=T0,
            STARTTIMEUTC="2025-10-09T00:00:00Z"),
        row(S.GAMES, ID=1, SEASON=20252026, GAMETYPE=2, GAMEDATE=dt.date(2025, 10, 8), GAMESTATE="OFF",
            GAMEOUTCOME_LASTPERIODTYPE="REG", HOMETEAM_ID=100, HOMETEAM_ABBREV="HOM", AWAYTEAM_ID=200,
            AWAYTEAM_ABBREV="AWY", _loaded_at=T1, STARTTIMEUTC="2025-10-09T00:00:00Z"),
        row(S.GAMES, ID=2, SEASON=20252026, GAMETYPE=2, GAMEDATE=dt.date(2025, 10, 10), GAMESTATE="OFF",
            GAMEOUTCOME_LASTPERIODTYPE="OT", HOMETEAM_ID=200, HOMETEAM_ABBREV="AWY", AWAYTEAM_ID=100,
            AWAYTEAM_ABBREV="HOM", _loaded_at=T1),
        # special event between non-participants: dropped by the universe
        row(S.GAMES, ID=3, SEASON=20252026, GAMETYPE=2, GAMEDATE=dt.date(2025, 10, 11), GAMESTATE="OFF",
            HOMETEAM_ID=900, HOMETEAM_ABBREV="XXA", AWAYTEAM_ID=901, AWAYTEAM_ABBREV="XXB", _loaded_at=T1),
        # preseason: dropped
        row(S.GAMES, ID=4, SEASON=20252026, GAMETYPE=1, GAMEDATE=dt.date(2025, 10, 1), GAMESTATE="OFF",
            HOMETEAM_ID=100, HOMETEAM_ABBREV="HOM", AWAYTEAM_ID=200, AWAYTEAM_ABBREV="AWY", _loaded_at=T1),
    ]
    return spark.createDataFrame(rows, S.GAMES)


def daily_standings(spark):
    def st(d, team, gp, pts, w, div="Central", conf="Western"):
        return row(S.DAILY_STANDINGS, DATE=d, SEASONID=20252026, TEAMABBREV_DEFAULT=team, GAMESPLAYED=gp,
                   POINTS=pts, WINS=w, DIVISIONNAME=div, CONFERENCENAME=conf, STREAKCODE="W", _loaded_at=T1)
    rows = [st(dt.date(2025, 10, 8), "HOM", 1, 2, 1),
            # gap on 10-09 and 10-10 for HOM
            st(dt.date(2025, 10, 11), "HOM", 2, 3, 1),
            # AWY starts one day late
            st(dt.date(2025, 10, 9), "AWY", 1, 0, 0),
            st(dt.date(2025, 10, 11), "AWY", 2, 2, 1)]
    return spark.createDataFrame(rows, S.DAILY_STANDINGS)


def current_standings(spark):
    """The current table with every published value of one team, and a team with few."""
    ints = dict(GAMESPLAYED=82, POINTS=100, WINS=48, LOSSES=30, OTLOSSES=4, GOALFOR=250, GOALAGAINST=240, GOALDIFFERENTIAL=10,
                HOMEWINS=30, HOMELOSSES=10, HOMEOTLOSSES=1, HOMEPOINTS=61, HOMEGAMESPLAYED=41, HOMEGOALSFOR=140,
                HOMEGOALSAGAINST=110, HOMEGOALDIFFERENTIAL=30, ROADWINS=18, ROADLOSSES=20, ROADOTLOSSES=3, ROADPOINTS=39,
                ROADGAMESPLAYED=41, ROADGOALSFOR=110, ROADGOALSAGAINST=130, ROADGOALDIFFERENTIAL=-20, SHOOTOUTWINS=3,
                SHOOTOUTLOSSES=2, L10GAMESPLAYED=10, L10WINS=6, L10LOSSES=3, L10OTLOSSES=1, L10POINTS=13, STREAKCOUNT=2,
                WAIVERSSEQUENCE=20, LEAGUEHOMESEQUENCE=4, DIVISIONROADSEQUENCE=5, CONFERENCEL10SEQUENCE=6)
    rows = [row(S.CURRENT_STANDINGS, TEAMABBREV_DEFAULT="HOM", TEAMNAME_DEFAULT="Home City", STREAKCODE="W", POINTPCTG=0.61,
                _loaded_at=T1, **ints),
            row(S.CURRENT_STANDINGS, TEAMABBREV_DEFAULT="HOM", POINTS=98, _loaded_at=T0),
            row(S.CURRENT_STANDINGS, TEAMABBREV_DEFAULT="AWY", POINTS=90, WINS=44, _loaded_at=T1)]
    return spark.createDataFrame(rows, S.CURRENT_STANDINGS)


def plays(spark, events):
    """events: dicts with GAME_ID, EVENTID, TYPEDESCKEY, owner, period, clock, duration..."""
    rows = []
    for e in events:
        rows.append(row(S.PLAY_BY_PLAY, GAME_ID=e["game"], EVENTID=e["event"], SORTORDER=e.get("sort", e["event"]),
                        TYPEDESCKEY=e["type"], DETAILS_EVENTOWNERTEAMID=e.get("team"),
                        PERIODDESCRIPTOR_NUMBER=e.get("period", 1), TIMEINPERIOD=e.get("clock", "00:00"),
                        DETAILS_DURATION=e.get("duration"), SITUATIONCODE=e.get("code", "1551"),
                        _loaded_at=e.get("loaded", T1)))
    return spark.createDataFrame(rows, S.PLAY_BY_PLAY)


def summaries(spark):
    stars = json.dumps([{"star": 1, "playerId": 9, "name": {"default": "G. One"}, "teamAbbrev": "HOM",
                         "position": "G"},
                        {"star": 2, "playerId": 7, "name": {"default": "A. Skater"}, "teamAbbrev": "AWY",
                         "position": "C", "goals": 1, "assists": 1, "points": 2}])
    rows = [row(S.GAME_SUMMARIES, ID=1, SEASON="20252026", GAMETYPE=2, GAMEDATE=dt.date(2025, 10, 8),
                HOMETEAM_ID=100, HOMETEAM_ABBREV="HOM", HOMETEAM_SCORE=3, HOMETEAM_SOG=30, AWAYTEAM_ID=200,
                AWAYTEAM_ABBREV="AWY", AWAYTEAM_SCORE=2, AWAYTEAM_SOG=25, PERIODDESCRIPTOR_PERIODTYPE="REG",
                SUMMARY_THREESTARS=stars, _loaded_at=T1),
            row(S.GAME_SUMMARIES, ID=2, SEASON="20252026", GAMETYPE=2, GAMEDATE=dt.date(2025, 10, 10),
                HOMETEAM_ID=200, HOMETEAM_ABBREV="AWY", HOMETEAM_SCORE=4, HOMETEAM_SOG=33, AWAYTEAM_ID=100,
                AWAYTEAM_ABBREV="HOM", AWAYTEAM_SCORE=3, AWAYTEAM_SOG=28, PERIODDESCRIPTOR_PERIODTYPE="OT",
                SUMMARY_THREESTARS="[]", _loaded_at=T1),
            row(S.GAME_SUMMARIES, ID=3, SEASON="20252026", GAMETYPE=2, GAMEDATE=dt.date(2025, 10, 11),
                HOMETEAM_ID=900, HOMETEAM_ABBREV="XXA", HOMETEAM_SCORE=1, HOMETEAM_SOG=10, AWAYTEAM_ID=901,
                AWAYTEAM_ABBREV="XXB", AWAYTEAM_SCORE=0, AWAYTEAM_SOG=12, SUMMARY_THREESTARS=None, _loaded_at=T1)]
    return spark.createDataFrame(rows, S.GAME_SUMMARIES)


def skater(pid, name, goals=0, assists=0, toi="15:00", pos="C", ppg=0):
    return {"playerId": pid, "name": {"default": name}, "position": pos, "goals": goals, "assists": assists,
            "points": goals + assists, "plusMinus": 0, "pim": 0, "hits": 1, "sog": goals + 1,
            "powerPlayGoals": ppg, "giveaways": 0, "takeaways": 0, "blockedShots": 0, "shifts": 20, "toi": toi}


def goalie(pid, name, starter, ga, saved, against, toi, decision=None):
    return {"playerId": pid, "name": {"default": name}, "position": "G", "starter": starter, "decision": decision,
            "goalsAgainst": ga, "saveShotsAgainst": f"{saved}/{against}", "evenStrengthShotsAgainst": f"{saved}/{against}",
            "evenStrengthGoalsAgainst": ga, "powerPlayShotsAgainst": "0/0", "powerPlayGoalsAgainst": 0,
            "shorthandedShotsAgainst": "0/0", "shorthandedGoalsAgainst": 0, "pim": 0, "toi": toi}


def boxscore(spark):
    def box(gid, home, away, hf, hd, hg, af, ad, ag):
        return row(S.GAME_BOXSCORE, ID=gid, SEASON=20252026, GAMETYPE=2, HOMETEAM_ABBREV=home, AWAYTEAM_ABBREV=away,
                   PLAYERBYGAMESTATS_HOMETEAM_FORWARDS=json.dumps(hf), PLAYERBYGAMESTATS_HOMETEAM_DEFENSE=json.dumps(hd),
                   PLAYERBYGAMESTATS_HOMETEAM_GOALIES=json.dumps(hg), PLAYERBYGAMESTATS_AWAYTEAM_FORWARDS=json.dumps(af),
                   PLAYERBYGAMESTATS_AWAYTEAM_DEFENSE=json.dumps(ad), PLAYERBYGAMESTATS_AWAYTEAM_GOALIES=json.dumps(ag),
                   _loaded_at=T1)
    rows = [box(1, "HOM", "AWY", [skater(11, "F. One", 2, 0)], [skater(12, "D. One", 0, 1, pos="D")],
                [goalie(9, "G. One", True, 2, 23, 25, "60:00", "W"), goalie(19, "G. Three", False, 0, 0, 0, "00:00")],
                [skater(7, "A. Skater", 1, 1)], [], [goalie(8, "G. Two", True, 3, 27, 30, "59:00", "L")]),
            box(2, "AWY", "HOM", [skater(7, "A. Skater", 3, 0)], [], [goalie(8, "G. Two", True, 3, 25, 28, "64:00", "W")],
                [skater(11, "F. One", 1, 1)], [skater(12, "D. One", 1, 0, pos="D")],
                [goalie(9, "G. One", True, 4, 29, 33, "63:30", "O")])]
    return spark.createDataFrame(rows, S.GAME_BOXSCORE)


def rosters(spark):
    def p(pid, first, last, pos, birth="1995-05-05"):
        return {"id": pid, "firstName": {"default": first}, "lastName": {"default": last}, "positionCode": pos,
                "sweaterNumber": pid % 99, "birthDate": birth, "birthCountry": "XXA", "headshot": None}
    rows = [row(S.TEAM_ROSTERS, TEAM_ABV="HOM", FORWARDS=json.dumps([p(11, "F", "One", "C")]),
                DEFENSEMEN=json.dumps([p(12, "D", "One", "D")]), GOALIES=json.dumps([p(9, "G", "One", "G")]),
                _loaded_at=T0),
            row(S.TEAM_ROSTERS, TEAM_ABV="HOM", FORWARDS=json.dumps([p(11, "F", "One", "C"), p(13, "N", "Ew", "L")]),
                DEFENSEMEN=json.dumps([p(12, "D", "One", "D")]), GOALIES=json.dumps([p(9, "G", "One", "G")]),
                _loaded_at=T1),
            # player 11 also on AWY's roster (two rosters in one season)
            row(S.TEAM_ROSTERS, TEAM_ABV="AWY", FORWARDS=json.dumps([p(7, "A", "Skater", "C"), p(11, "F", "One", "C")]),
                DEFENSEMEN="[]", GOALIES=None, _loaded_at=T1)]
    return spark.createDataFrame(rows, S.TEAM_ROSTERS)


def current_teams(spark):
    rows = [row(S.CURRENT_TEAMS, ID=100, ABBREV="HOM", NAME_DEFAULT="Home City", FRENCH="false", _loaded_at=T1),
            row(S.CURRENT_TEAMS, ID=200, ABBREV="AWY", NAME_DEFAULT="Away City", FRENCH="false", _loaded_at=T1)]
    return spark.createDataFrame(rows, S.CURRENT_TEAMS)


def schedules(spark):
    def g(gid, d, state, home, away, start):
        return row(S.SEASON_SCHEDULES, ID=gid, SEASON=20252026, GAMETYPE=2, GAMESTATE=state, GAMEDATE=d,
                   HOMETEAM_ABBREV=home, AWAYTEAM_ABBREV=away, STARTTIMEUTC=start, _loaded_at=T1)
    rows = [g(10, dt.date(2025, 10, 14), "FUT", "HOM", "AWY", "2025-10-15T00:00:00Z"),
            g(11, dt.date(2025, 10, 18), "FUT", "AWY", "HOM", "2025-10-18T19:00:00Z"),
            g(1, dt.date(2025, 10, 8), "OFF", "HOM", "AWY", "2025-10-09T00:00:00Z")]
    return spark.createDataFrame(rows, S.SEASON_SCHEDULES)
