"""Registered queries over the driver tables, each next to the SQL that checks it."""

from tidemark.suite import (  # noqa: F401
    cleaning, cube, etl, features, loads, model, profile, quality, scans, streams, tracking, warehouse,
)
from tidemark.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
