"""Query catalogue: each operator on the test tables, with the same query as plain SQL."""

from careflow.catalog import batches, cleaning, clinical, files, keep_first, merged, runs, stored  # noqa: F401  (register)
from careflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
