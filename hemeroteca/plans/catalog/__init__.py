"""Runnable queries, each over whole given tables, with check SQL where SQL can say it."""

from __future__ import annotations

from hemeroteca.plans.catalog import corpus, io, pages, streams, text
from hemeroteca.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "corpus", "io", "pages", "streams", "text"]
