"""All oracle SQL texts, keyed like the job registry."""

from __future__ import annotations

from . import intervals, other, quality_kpi, windows


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for mod in (intervals, quality_kpi, other, windows):
        for k, v in mod.ORACLE.items():
            if k in out:
                raise KeyError(f"duplicate oracle key {k}")
            out[k] = v
    return out
