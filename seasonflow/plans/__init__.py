"""Domain plans and the query registry bound to the test tables.

Importing this package registers every query module.
"""
from seasonflow.plans import (  # noqa: F401
    aggregates, bridge, calendar, events, feed_models, games, ingest, latest, league, models, power, quality_checks, relations,
    scalars)
from seasonflow.plans.registry import ORACLE, QUERIES  # noqa: F401
