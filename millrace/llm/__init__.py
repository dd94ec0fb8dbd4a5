"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

from . import chat, decontamination, jaccard_join, lexical_search, merkle, mixing, neighbours, quality, quality_rules, sharding, substring_dedup, suffix_dedup, token_files  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
