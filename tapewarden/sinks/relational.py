"""Options for Spark's JDBC connector, which reads and writes relational tables."""

from __future__ import annotations


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra: str) -> dict[str, str]:
    named = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    return {**{k: v for k, v in named.items() if v is not None}, **extra}
