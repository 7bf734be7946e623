"""Named queries over the sample tables, each with the SQL it must equal."""

from __future__ import annotations

from tapewarden.catalog import alerting, detection, ingestion, reporting, streams
from tapewarden.catalog.sample import Query

_MODULES = (detection, ingestion, alerting, reporting, streams)


def all_queries() -> dict[str, Query]:
    return {name: run for module in _MODULES for name, run in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
