"""Transfers accepted or rejected one after the other, decided in rounds.

Whether a transfer passes depends on every earlier transfer of the sender's account, and through their senders on
others: the rule is serial. But most transfers are decided by bounds. In each round running totals per account give the
least and the greatest balance the sender can have had: earlier transfers that are still open count against it in the
one and for it in the other. A transfer that passes with the least balance is accepted, one that fails with the greatest
is rejected. The first open transfer of all has equal bounds, so every round decides some; what is decided and lies
before the first open transfer of an account becomes part of its opening balance and leaves the work. Once few transfers
are open, a walk over one number for each of them ends it.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, stored
from .ledger import with_error
from .windows import BLOCK_ROWS, HOT_ROWS, running_total

# Open transfers that the driver walks over, at most: some 40 bytes each.
FINISH = 10_000
WORK = ("no", "src", "dst", "cents", "ok", "src_done", "dst_done")


@dataclass
class Settlement:
    """Outcome per transfer, final balances, and the number of transfers that each round left open."""

    transfers: DataFrame
    balances: DataFrame
    rounds: list[int]


def _sides(work: DataFrame) -> DataFrame:
    """Debit and credit of each transfer: (account, at, move, debit, done, WORK). A debit comes before its credit."""
    debit = F.struct(F.col("src").alias("account"), (F.col("no") * 2).alias("at"), (-F.col("cents")).alias("move"),
                     F.lit(True).alias("debit"), F.col("src_done").alias("done"))
    credit = F.struct(F.col("dst").alias("account"), (F.col("no") * 2 + 1).alias("at"), F.col("cents").alias("move"),
                      F.lit(False).alias("debit"), F.col("dst_done").alias("done"))
    return work.select(*WORK, F.explode(F.array(debit, credit)).alias("side")).select(*WORK, "side.*")


def _decide(work: DataFrame, opening: DataFrame, hot_rows: int, block_rows: int) -> DataFrame:
    """One round: ``work`` with ``ok`` set where the bounds allow it."""
    open_ = F.col("ok").isNull()
    sides = _sides(work).where(~F.col("done")).withColumns({
        "low": F.when(open_ & ~F.col("debit"), 0).otherwise(F.col("move")),
        "high": F.when(open_ & F.col("debit"), 0).otherwise(F.col("move"))})
    blocks = {"opening": opening, "hot_rows": hot_rows, "block_rows": block_rows}
    least = running_total(sides, "account", "at", "low", "least", **blocks)
    both = running_total(least, "account", "at", "high", "greatest", **blocks)
    # The least balance already has the transfer itself taken off, the greatest has not.
    told = F.when(F.col("least") >= 0, True).when(F.col("greatest") < F.col("cents"), False)
    debits = both.where("debit").withColumn("ok", F.coalesce("ok", told)).select(*WORK)
    return debits.unionByName(work.where("src_done"))


def _fold(work: DataFrame, opening: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Move accepted sides before their account's first open transfer into the opening balances."""
    first = stored(_sides(work.where("ok IS NULL")).groupBy("account").agg(F.min("at").alias("first")), "settle-first")
    src = first.select(F.col("account").alias("src"), F.col("first").alias("__src"))
    dst = first.select(F.col("account").alias("dst"), F.col("first").alias("__dst"))
    marked = stored(work.join(src, "src", "left").join(dst, "dst", "left").withColumns({
        "src_new": F.coalesce("ok", F.lit(False)) & ~F.col("src_done") & F.coalesce(F.col("no") * 2 < F.col("__src"), F.lit(True)),
        "dst_new": F.coalesce("ok", F.lit(False)) & ~F.col("dst_done") & F.coalesce(F.col("no") * 2 + 1 < F.col("__dst"), F.lit(True)),
    }).select(*WORK, "src_new", "dst_new"), "settle-marked")
    moves = (marked.where("src_new").select(F.col("src").alias("account"), (-F.col("cents")).alias("opening"))
             .unionAll(marked.where("dst_new").select("dst", "cents")))
    opening = stored(opening.unionByName(moves).groupBy("account").agg(F.sum("opening").cast("long").alias("opening")), "settle-opening")
    work = marked.withColumns({"src_done": F.col("src_done") | F.col("src_new"), "dst_done": F.col("dst_done") | F.col("dst_new")})
    return work.select(*WORK), opening


def _walk(work: DataFrame, opening: DataFrame, hot_rows: int, block_rows: int) -> tuple[list[tuple], list[tuple]]:
    """Decide the open transfers one after the other: (no, accepted) of each, and (account, change) of their accounts.

    Each comes with its sender's balance from all that is decided; the walk adds what it has accepted itself.
    """
    sides = _sides(work).where(~F.col("done")).withColumn("settled", F.when(F.col("ok"), F.col("move")).otherwise(0))
    run = running_total(sides, "account", "at", "settled", "balance", opening=opening, hot_rows=hot_rows, block_rows=block_rows)
    open_ = run.where(F.col("debit") & F.col("ok").isNull()).select("no", "src", "dst", "cents", "balance")
    told, change = [], defaultdict(int)
    for no, src, dst, cents, balance in sorted(map(tuple, open_.collect())):
        accepted = balance + change[src] >= cents
        told.append((no, accepted))
        if accepted:
            change[src] -= cents
            change[dst] += cents
    return told, list(change.items())


def settle(transfers: DataFrame, opening: DataFrame, seq: str = "trans_id", hot_rows: int = HOT_ROWS,
           block_rows: int = BLOCK_ROWS, finish: int = FINISH) -> Settlement:
    """Accept or reject transfers (seq, from_acct, to_acct, amount) in order of the unique whole number ``seq``.

    A transfer that exceeds the sender's balance at its turn is AMOUNT_OVERDRAWN and moves nothing; a negative or
    missing amount, equal accounts and unknown ones are rejected with their own codes. ``opening`` is (id, balance);
    several rows of an account add up. The result is that of handling one transfer after the other. Rounds are written
    to the shared folder; hot accounts are cut into blocks by the running totals. Rounds go on until at most ``finish``
    transfers are open. The worst case, accounts that stay near zero with credits that hang on other open transfers,
    takes as many rounds as such a chain is long.
    """
    spark = transfers.sparkSession
    amount = F.col("amount").cast("decimal(18,2)")
    known = stored(opening.groupBy(F.col("id").cast("long").alias("account")).agg(
        (F.sum(F.col("balance").cast("decimal(18,2)")) * 100).cast("long").alias("opening")), "settle-opening")
    src = known.select(F.col("account").alias("src"), F.lit(True).alias("__src"))
    dst = known.select(F.col("account").alias("dst"), F.lit(True).alias("__dst"))
    asked = transfers.select(F.col(seq).cast("long").alias("no"), F.col("from_acct").cast("long").alias("src"),
                             F.col("to_acct").cast("long").alias("dst"), (amount * 100).cast("long").alias("cents"))
    error = (F.when(F.col("src") == F.col("dst"), "FROM_TO_ACCOUNT_IS_SAME")
             .when(F.col("cents").isNull() | (F.col("cents") < 0), "TRANSFER_AMOUNT_ZERO_OR_NEGATIVE")
             .when(F.col("__src").isNull() | F.col("__dst").isNull(), "ACCOUNT_NOT_EXISTS"))
    checked = stored(asked.join(src, "src", "left").join(dst, "dst", "left")
                     .select("no", "src", "dst", "cents", error.alias("error_code")), "settle-checked")
    path = scratch_path(spark, "settle-outcome")
    checked.where("error_code IS NOT NULL").select("no", "error_code").write.parquet(path)
    no = F.lit(False)
    work = checked.where("error_code IS NULL").select(
        "no", "src", "dst", "cents", F.lit(None).cast("boolean").alias("ok"), no.alias("src_done"), no.alias("dst_done"))
    accepted = F.lit(None).cast("string").alias("error_code")
    opening, rounds = known, []
    while True:
        work = stored(_decide(work, opening, hot_rows, block_rows), "settle-round")
        (work.where("NOT ok").select("no", F.lit("AMOUNT_OVERDRAWN").alias("error_code")).write.mode("append").parquet(path))
        work = work.where("ok IS NULL OR ok")
        rounds.append(work.where("ok IS NULL").count())
        if rounds[-1] <= finish:
            break
        work, opening = _fold(work, opening)
        work.where("src_done AND dst_done").select("no", accepted).write.mode("append").parquet(path)
        work = work.where("NOT (src_done AND dst_done)")
    told, change = _walk(work, opening, hot_rows, block_rows) if rounds[-1] else ([], [])
    last = spark.createDataFrame(told, "no long, ok boolean")
    (work.where("ok").select("no", accepted)
     .unionAll(last.select("no", F.when(~F.col("ok"), "AMOUNT_OVERDRAWN"))).write.mode("append").parquet(path))
    moves = _sides(work.where("ok")).where(~F.col("done")).select("account", F.col("move").alias("opening"))
    opening = (opening.unionByName(moves).unionByName(spark.createDataFrame(change, "account long, opening long"))
               .groupBy("account").agg(F.sum("opening").alias("opening")))
    outcome = spark.read.schema("no long, error_code string").parquet(path)
    result = transfers.join(outcome, F.col(seq).cast("long") == F.col("no")).drop("no")
    balances = opening.select("account", (F.col("opening").cast("decimal(20,0)") / 100).cast("decimal(18,2)").alias("balance"))
    return Settlement(with_error(result, F.col("error_code")), balances, rounds)
