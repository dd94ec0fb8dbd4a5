"""Every operator as a query over the shared test tables, next to the SQL that must agree with it."""

from . import files, joins, ledger, metrics, shaping, stored, streams  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
