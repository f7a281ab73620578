from . import files, intake, landed, tables, targets  # noqa: F401  (importing registers the queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
