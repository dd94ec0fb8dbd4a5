"""Deposit/withdraw replay with rejection, for accounts of any size.

A rejected withdrawal changes what later ones may do, so no window sum can express the result.
The fold over one account is serial by nature, but only where a rejection can happen:

* Accounts up to ``hot_rows`` operations are hashed over the cluster and folded in one sorted
  pass per task. The fold streams Arrow batches and holds one balance, never a whole group.
* Larger accounts are cut into range blocks, written to the shared folder. For each block Spark
  computes its net change and the balance it needs to pass without any rejection. A walk over
  these few numbers gives the balance before each block; only a block that is entered with too
  little is folded on the way, together with those behind it. Then all blocks are folded at once, in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

HOT_ROWS = 4_000_000

OPENING, DEPOSIT, WITHDRAW = 0, 1, 2


def _fold(keys: Sequence[str], kept: Sequence[str]):
    """Fold sorted rows: an opening row sets the balance, operations change it.

    Only the balance of the current group is carried from batch to batch.
    """
    keys, kept = list(keys), list(kept)

    def fold(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        current, balance, step = None, None, 64
        for batch in batches:
            size = batch.num_rows
            if size == 0:
                continue
            ends = {size}
            for key in keys:
                ends.update(pc.run_end_encode(batch.column(key)).run_ends.to_pylist())
            codes = batch.column("__code").to_numpy(zero_copy_only=False)
            is_op, withdraw = codes != OPENING, codes == WITHDRAW
            amounts = batch.column("__cents")
            cents = amounts.fill_null(0).to_numpy(zero_copy_only=False)
            gone = amounts.is_null().to_numpy(zero_copy_only=False)
            changes = np.where(withdraw, -cents, cents)
            changes[gone] = 0
            opens = (~is_op).tolist()

            balances, rejected, unknown = np.zeros(size, dtype="int64"), gone & is_op, np.zeros(size, dtype=bool)
            start = 0
            for end in sorted(ends):
                group = tuple(batch.column(k)[start].as_py() for k in keys) if start == 0 or end == size else None
                if start or group != current:
                    balance = None
                while start < end and opens[start]:
                    balance = None if gone[start] else int(changes[start])
                    start += 1
                if balance is None:
                    unknown[start:end] = True
                    start = end
                while start < end:
                    # Sums up to the next rejection, in stretches that grow while nothing is rejected.
                    stretch = slice(start, min(end, start + step))
                    after = balance + np.cumsum(changes[stretch])
                    low = (after < 0) & withdraw[stretch]
                    n = int(low.argmax()) if low.any() else len(after)
                    balances[start:start + n] = after[:n]
                    balance = int(after[n - 1]) if n else balance
                    start += n
                    step = min(4096, step * 2) if n == len(after) else 64
                    if n < len(after):
                        rejected[start] = True
                        balances[start] = balance
                        start += 1
                start, current = end, group
            accepted = ~unknown & ~rejected
            out = [batch.column(name) for name in kept]
            out += [pa.array(balances, mask=unknown), pa.array(accepted)]
            result = pa.RecordBatch.from_arrays(out, names=[*kept, "__balance", "__accepted"])
            yield result.filter(pa.array(is_op))

    return fold


def _folded(rows: DataFrame, keys: Sequence[str], kept: Sequence[str]) -> DataFrame:
    rows = rows.select(*keys, *[c for c in kept if c not in keys and c != "__seq"], "__seq", "__code", "__cents")
    schema = T.StructType(
        [rows.schema[name] for name in kept]
        + [T.StructField("__balance", T.LongType()), T.StructField("__accepted", T.BooleanType())]
    )
    # Operations without an account all fail on their own; they need not meet in one task.
    nobody = F.when(F.col(keys[0]).isNull(), F.col("__seq"))
    placed = rows.repartition(*keys, nobody).sortWithinPartitions(*keys, F.col("__seq").asc_nulls_first())
    return placed.mapInArrow(_fold(keys, kept), schema)


def _with_openings(ops: DataFrame, openings: DataFrame) -> DataFrame:
    return ops.unionByName(openings, allowMissingColumns=True)


def _as_openings(frame: DataFrame, cents: Column) -> DataFrame:
    """Opening rows have no sequence number, so they sort before the operations of their group."""
    return frame.select(
        *[c for c in frame.columns if c.startswith("__key")], F.lit(None).cast("bigint").alias("__seq"),
        F.lit(OPENING).cast("tinyint").alias("__code"), cents.alias("__cents"),
    )


def _walk(segments: list, start: dict, fold_blocks) -> list[tuple]:
    """The balance before each block of each hot account: (account, block, balance).

    ``segments`` is sorted (account, block, net, need); ``start`` has opening balances. A block entered with what it
    needs is passed by its numbers. From one entered with less on, blocks are folded: one in the first round, twice
    as many in each next one while that does not end, so rounds count the switches between the two and not the blocks.
    ``fold_blocks`` gets a list of (account, blocks, balance) and returns (account, block) -> balance after it.
    """
    chains: dict = {}
    for account, block, net, need in segments:
        chains.setdefault(account, []).append((block, net, need))
    entries, balances, position, width = [], dict(start), dict.fromkeys(chains, 0), dict.fromkeys(chains, 1)
    active = set(chains)
    while active:
        pending = []
        for account in list(active):
            chain, balance = chains[account], balances.get(account)
            while position[account] < len(chain):
                block, net, need = chain[position[account]]
                by_numbers = balance is None or need is None or balance >= need
                if not by_numbers and position[account] < len(chain) - 1:
                    blocks = [b for b, _, _ in chain[position[account]:position[account] + width[account]]]
                    pending.append((account, blocks, balance))
                    width[account] *= 2
                    break
                entries.append((account, block, balance))
                position[account] += 1
                if by_numbers:
                    balance = None if balance is None else balance + net
                    width[account] = 1
                balances[account] = balance
            else:
                active.discard(account)
        after = fold_blocks(pending) if pending else {}
        for account, blocks, balance in pending:
            for block in blocks:
                entries.append((account, block, balance))
                balance = after[account, block]
            position[account] += len(blocks)
            balances[account] = balance
    return entries


def _replay_hot(spark, ops: DataFrame, openings: DataFrame, kept: Sequence[str], hot_rows: int,
                total: int) -> DataFrame:
    path = scratch_path(spark, "replay-blocks")
    blocks = max(2, -(-4 * total // hot_rows))
    (ops.repartitionByRange(blocks, "__key", "__seq").sortWithinPartitions("__key", "__seq")
        .withColumn("__block", F.spark_partition_id())
        .write.partitionBy("__block").parquet(path))
    stored = spark.read.schema(
        T.StructType([*ops.schema.fields, T.StructField("__block", T.IntegerType())])).parquet(path)

    in_block = (Window.partitionBy("__key", "__block").orderBy("__seq")
                .rowsBetween(Window.unboundedPreceding, 0))
    withdraw = F.col("__code") == WITHDRAW
    signed = F.when(withdraw, -F.col("__cents")).otherwise(F.col("__cents"))
    # At most one row per account and block it touches: accounts + blocks in all.
    segments = (stored.select("__key", "__block", "__code", signed.alias("__signed"),
                              F.sum(signed).over(in_block).alias("__sum"))
                .groupBy("__key", "__block")
                .agg(F.sum("__signed").alias("net"), F.max(F.when(withdraw, -F.col("__sum"))).alias("need"))
                .orderBy("__key", "__block").collect())
    accounts = {row[0] for row in segments}
    start = {row[0]: row[1] for row in openings.select("__key", "__cents").collect() if row[0] in accounts}

    key_type = ops.schema["__key"].dataType
    entry_schema = T.StructType([
        T.StructField("__key", key_type), T.StructField("__key_block", T.IntegerType()),
        T.StructField("__entry", T.LongType()),
    ])
    rows = stored.withColumnRenamed("__block", "__key_block")

    def opened(entries: list) -> DataFrame:
        return _as_openings(spark.createDataFrame(entries, entry_schema), F.col("__entry"))

    def fold_blocks(pending: list) -> dict:
        """Fold a run of blocks per account, one task for each account."""
        wanted = spark.createDataFrame([(a, b, None) for a, blocks, _ in pending for b in blocks], entry_schema)
        some = rows.filter(F.col("__key_block").isin(sorted({b for _, blocks, _ in pending for b in blocks})))
        # As many rows as blocks at most.
        some = some.join(F.broadcast(wanted.drop("__entry")), ["__key", "__key_block"], "left_semi")
        starts = opened([(a, blocks[0], balance) for a, blocks, balance in pending])
        both = _with_openings(some, starts)
        last = (_folded(both, ["__key"], ["__key", "__key_block", "__seq"]).groupBy("__key", "__key_block")
                .agg(F.max_by("__balance", "__seq").alias("balance")).collect())
        return {(row[0], row[1]): row[2] for row in last}

    entries = _walk([tuple(r) for r in segments], start, fold_blocks)
    both = _with_openings(rows, opened([e for e in entries if e[2] is not None]))
    return _folded(both, ["__key", "__key_block"], kept)


def replay(ops: DataFrame, opening: DataFrame, account: str = "account", seq: str = "seq", kind: str = "kind",
           amount: str = "amount", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Outcome of each deposit or withdrawal, in ``seq`` order per account.

    ``opening`` is (account, balance); several rows of an account add up. A withdrawal below zero is rejected with
    TRANSACTION_EXCEPTION / 402 and leaves the balance; an unknown account gives
    ACCOUNT_NOT_EXISTS / 404. Operations of any other kind, or without a number, are rejected with
    TRANSACTION_EXCEPTION as well and have no balance. Adds ``accepted``, ``balance``, ``error_code`` and ``http_code``.
    """
    spark = ops.sparkSession
    valid = F.coalesce(F.col(kind).isin("deposit", "withdraw"), F.lit(False)) & F.col(seq).isNotNull()
    invalid = ops.filter(~valid).select(
        *ops.columns, F.lit(False).alias("accepted"), F.lit(None).cast("decimal(18,2)").alias("balance"),
        F.lit("TRANSACTION_EXCEPTION").alias("error_code"), F.lit(402).alias("http_code"))
    ops = ops.filter(valid)
    opening = opening.groupBy(account).agg(F.sum("balance").alias("balance"))
    cents = (F.col(amount).cast("decimal(18,2)") * 100).cast("bigint")
    payload = [c for c in ops.columns if c not in (account, seq)]
    code = F.when(F.col(kind) == "withdraw", WITHDRAW).otherwise(DEPOSIT).cast("tinyint")
    typed = ops.select(F.col(account).alias("__key"), F.col(seq).cast("bigint").alias("__seq"),
                       code.alias("__code"), cents.alias("__cents"), *payload)
    openings = _as_openings(
        opening.select(F.col(account).alias("__key"), F.col("balance")),
        (F.col("balance").cast("decimal(18,2)") * 100).cast("bigint"),
    )
    kept = ["__key", "__seq", *payload]

    counts = typed.filter(F.col("__key").isNotNull()).groupBy("__key").agg(F.count("*").alias("n"))
    hot = counts.filter(F.col("n") > hot_rows).collect()
    if not hot:
        done = _folded(_with_openings(typed, openings), ["__key"], kept)
    else:
        # As many rows as hot accounts: at most operations / hot_rows.
        names = spark.createDataFrame([(r[0],) for r in hot], T.StructType([ops.schema[account]])).toDF("__key")
        names = F.broadcast(names)
        cold = _folded(
            _with_openings(typed.join(names, "__key", "left_anti"), openings.join(names, "__key", "left_anti")),
            ["__key"], kept,
        )
        hot_done = _replay_hot(spark, typed.join(names, "__key", "left_semi"),
                               openings.join(names, "__key", "left_semi"), kept, hot_rows, sum(r[1] for r in hot))
        done = cold.unionByName(hot_done)

    known = F.col("__balance").isNotNull()
    own = {account: F.col("__key"), seq: F.col("__seq").cast(ops.schema[seq].dataType)}
    outcome = done.select(
        *[own.get(c, F.col(f"`{c}`")).alias(c) for c in ops.columns],
        F.col("__accepted").alias("accepted"),
        (F.col("__balance").cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("balance"),
        F.when(~known, "ACCOUNT_NOT_EXISTS").when(~F.col("__accepted"), "TRANSACTION_EXCEPTION").alias("error_code"),
        F.when(~known, 404).when(~F.col("__accepted"), 402).otherwise(200).alias("http_code"),
    )
    return outcome.unionByName(invalid)
