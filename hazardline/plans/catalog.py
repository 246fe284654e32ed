"""All registered queries with their checking SQL."""

from __future__ import annotations

from hazardline.plans import catalog_cleaning, catalog_lines, catalog_runs, catalog_survival

CATALOG: dict[str, tuple] = {**catalog_cleaning.Q, **catalog_lines.Q, **catalog_survival.Q, **catalog_runs.Q}
