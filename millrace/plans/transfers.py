"""Due scheduled transfers: post what is valid, report what is not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ledger import balances, due_transfers, error_rollup, post_transfers, postings
from ..session import stored


def run_due(schedule: DataFrame, accounts: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """Postings, new balances, rejected transfers and error counts.

    The checked transfers feed all four results, so they are written to the shared folder once.
    """
    checked = stored(due_transfers(schedule, accounts, as_of), "due-transfers")
    accepted = checked.filter(F.col("error_code").isNull()).drop("error_code", "http_code", "error_type")
    rejected = checked.filter(F.col("error_code").isNotNull())
    return {
        "postings": post_transfers(accepted, accounts),
        "balances": balances(accounts, postings(accepted)),
        "rejected": rejected,
        "errors": error_rollup(rejected),
    }
