"""Scalar Column helpers (formats, keys, dates, geometry)."""
from seasonflow.functions.exprs import *  # noqa: F401,F403
