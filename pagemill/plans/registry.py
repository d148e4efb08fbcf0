"""All registered queries: name -> function of (spark, sf_dir), and name -> DuckDB SQL."""

from __future__ import annotations

from pagemill.plans import documents, files, queue, runs  # noqa: F401  they register their queries
from pagemill.plans.catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
