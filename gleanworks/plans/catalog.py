"""Every query of the engine, by name, with its oracle SQL where SQL can express it."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a (spark, sf_dir) -> DataFrame function under `name`."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put
