"""Registered queries, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from importlib import import_module

from hearthscore.queries.catalog import ORACLE, QUERIES

for _area in ("prepare", "households", "explore", "evaluate", "segments", "modelling"):
    import_module(f"hearthscore.queries.{_area}")

__all__ = ["ORACLE", "QUERIES"]
