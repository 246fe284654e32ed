"""Order-insensitive comparison of two result tables, for the tests."""

from __future__ import annotations

import datetime as dt
import decimal
import math


def cell(v) -> str:
    """One value as text, the same for both engines."""
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
        return "∅"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float) or "float" in type(v).__name__:
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    return str(v)


def rows(columns: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def difference(left: tuple[list[str], list[tuple]], right: tuple[list[str], list[tuple]]) -> str | None:
    """None when equal, else a short account of the first difference."""
    if sorted(left[0]) != sorted(right[0]):
        return f"columns {sorted(left[0])} and {sorted(right[0])}"
    a, b = rows(*left), rows(*right)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(left[0])}: {x} and {y}"
    return None
