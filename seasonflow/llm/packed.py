"""Rows that carry many small records as packed arrays.

Billions of (key, document, place) records would cost a Spark row each.  Packed,
one row holds all records that one task sends to one partition: a binary column
per field, and a table of the texts they name (``ids`` and the like), into which
the field ``at`` points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Fields with one entry per named text; all others have one entry per record.
TEXT_FIELDS = ("ids", "marks", "homes", "sizes")


def schema(names: dict[str, str], head: str) -> str:
    return head + "".join(f", {n} binary" for n in names)


def rows_of(fields: dict[str, str], lead: dict[str, list], rows: list[dict]) -> pa.RecordBatch:
    cols = [pa.array(v, pa.int32()) for v in lead.values()]
    cols += [pa.array([np.ascontiguousarray(r[n], t).tobytes() for r in rows], pa.binary()) for n, t in fields.items()]
    return pa.RecordBatch.from_arrays(cols, [*lead, *fields])


def unpack(table, fields: dict[str, str]) -> dict[str, np.ndarray]:
    """All rows' arrays, one after another; ``at`` points into the joined texts."""
    out, base = {n: [] for n in fields}, 0
    for i in range(table.num_rows):
        for n, t in fields.items():
            x = np.frombuffer(table.column(n)[i].as_buffer(), t)
            out[n].append(x.astype(np.int64) + base if n == "at" else x)
        base += len(out["ids"][-1])
    return {n: np.concatenate(v) if v else np.zeros(0, np.int64 if n == "at" else t)
            for (n, t), v in zip(fields.items(), out.values(), strict=True)}


def grouped(groups: np.ndarray):
    """``(group, its indices)`` in order."""
    order = np.argsort(groups, kind="stable")
    cut = np.flatnonzero(np.diff(groups[order])) + 1
    return [(int(groups[x[0]]), x) for x in np.split(order, cut) if len(x)]


def share(x: dict, pick: np.ndarray, names) -> dict:
    """The picked records with the texts they name."""
    texts, at = np.unique(x["at"][pick], return_inverse=True)
    return {n: x[n][texts] for n in TEXT_FIELDS if n in names} | {"at": at} | {
        n: x[n][pick] for n in names if n not in (*TEXT_FIELDS, "at")}


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``start .. start + size``, one after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - size), size)
