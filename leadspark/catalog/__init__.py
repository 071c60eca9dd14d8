"""Named queries over the benchmark tables; importing this package registers them all."""

from . import functions, jobs, relational, scans, whole_jobs  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
