"""Independent SQL statements of every query, for checking results in DuckDB."""

from __future__ import annotations


def statements() -> dict[str, str]:
    from . import dashboards, marts, reports, upkeep

    return {**marts.SQL, **upkeep.SQL, **reports.SQL, **dashboards.SQL}
