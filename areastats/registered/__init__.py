"""Queries over the driver tables, each with the SQL it must agree with."""

from areastats.registered.base import QUERIES, SQL
from areastats.registered import attribute, ingest, publishing, spatial, survey  # noqa: F401

__all__ = ["QUERIES", "SQL"]
