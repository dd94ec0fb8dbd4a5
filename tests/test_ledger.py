import random
from datetime import date
from decimal import Decimal

import pytest

from millrace.operators import ledger
from millrace.operators.replay import _walk, replay
from millrace.plans.transfers import run_due


def accounts(spark):
    return spark.createDataFrame(
        [(100000, "Checking", Decimal("1000.00"), "ACTIVE"), (100001, "Checking", Decimal("4500.00"), "ACTIVE"),
         (100002, "Savings", Decimal("8500.50"), "ACTIVE")],
        "id BIGINT, type STRING, balance DECIMAL(10,2), status STRING")


def test_openings(spark):
    df = spark.createDataFrame([("Checking", -1), ("Savings", 0), ("checking", 5), (None, 5), ("x", -1)],
                               "type STRING, balance INT")
    got = [(r["error_code"], r["http_code"]) for r in ledger.validate_openings(df).collect()]
    assert got == [("INITIAL_BALANCE_NEGATIVE", 400), (None, None), ("INVALID_ACCOUNT_TYPE", 400),
                   ("INVALID_ACCOUNT_TYPE", 400), ("INITIAL_BALANCE_NEGATIVE", 400)]


@pytest.mark.parametrize("source, target, amount, code, http", [
    ("100000", "100001", 10, None, None),
    ("100000", "100001", 0, None, None),
    ("abc", "100001", 10, "INVALID_ACCOUNT_FORMAT", 400),
    (" 100000", "100001", 10, "INVALID_ACCOUNT_FORMAT", 400),
    ("100000", "99999999999", 10, "INVALID_ACCOUNT_FORMAT", 400),
    (None, "100001", 10, "INVALID_ACCOUNT_FORMAT", 400),
    ("100000", "100000", -10, "FROM_TO_ACCOUNT_IS_SAME", 400),
    ("100000", "100001", -10, "TRANSFER_AMOUNT_ZERO_OR_NEGATIVE", 400),
    ("5", "100001", 10, "ACCOUNT_NOT_EXISTS", 404),
    ("100000", "5", 10, "ACCOUNT_NOT_EXISTS", 404),
])
def test_transfer_rules(spark, source, target, amount, code, http):
    df = spark.createDataFrame([(source, target, amount)], "from_account STRING, to_account STRING, amount INT")
    row = ledger.validate_transfers(df, accounts(spark)).first()
    assert (row["error_code"], row["http_code"]) == (code, http)


@pytest.mark.parametrize("day, amount, code", [
    ("07/01/2020", 1000, None), ("07/02/2020", 1000, None), ("06/30/2020", 1000, "PAST_TRANSFER_DATE"),
    ("2020-07-02", 1000, "INVALID_DATE_FORMAT"), (None, 1000, "INVALID_DATE_FORMAT"),
    ("07/02/2020", 1001, "AMOUNT_OVERDRAWN"), ("06/30/2020", -1, "TRANSFER_AMOUNT_ZERO_OR_NEGATIVE"),
])
def test_schedule_rules(spark, day, amount, code):
    df = spark.createDataFrame([("100000", "100001", amount, day)],
                               "from_account STRING, to_account STRING, amount INT, schedule_date STRING")
    assert ledger.check_schedules(df, accounts(spark), "2020-07-01").first()["error_code"] == code


def test_post_and_rollup(spark, rows):
    transfers = spark.createDataFrame([(1, 100000, 100001, 600), (2, 100000, 100002, 600), (3, 100001, 100000, 300)],
                                      "trans_id BIGINT, from_acct BIGINT, to_acct BIGINT, amount INT")
    posted = ledger.post_transfers(transfers, accounts(spark), hot_rows=2, block_rows=2)
    mine = posted.filter("account = 100000").orderBy("trans_id").collect()
    assert [(int(r["balance"]), r["overdrawn"]) for r in mine] == [(400, False), (-200, True), (100, False)]
    totals = {r["account"]: r["balance"] for r in ledger.balances(accounts(spark), posted).collect()}
    assert totals == {100000: Decimal("100.00"), 100001: Decimal("4800.00"), 100002: Decimal("9100.50")}
    bad = spark.createDataFrame([("AMOUNT_OVERDRAWN",), ("AMOUNT_OVERDRAWN",), ("ACCOUNT_NOT_EXISTS",), (None,)],
                                "error_code STRING")
    assert rows(ledger.error_rollup(bad)) == [
        ("AMOUNT_OVERDRAWN", "AMOUNT_OVERDRAWN", 402, "Transfer amount exceeds available balance", 2),
        ("DATA_VALIDATION", "ACCOUNT_NOT_EXISTS", 404, "Account doesn't exists", 1)]
    assert ledger.error_table(spark).count() == 11


def test_many_small_transfers(spark):
    opening = spark.createDataFrame([(1, 30000), (2, 0)], "id BIGINT, balance INT")
    transfers = spark.range(100).selectExpr("id AS trans_id", "1L AS from_acct", "2L AS to_acct", "10 AS amount")
    posted = ledger.post_transfers(transfers, opening)
    totals = {r["account"]: int(r["balance"]) for r in ledger.balances(opening, posted).collect()}
    assert totals == {1: 29000, 2: 1000} and posted.filter("overdrawn").count() == 0


def test_due_transfers(spark):
    schedule = spark.createDataFrame(
        [(1, 100000, 100001, 50, date(2020, 6, 30), "SCHEDULED"), (2, 100000, 100001, 50, date(2020, 7, 2), "SCHEDULED"),
         (3, 100000, 100001, 50, date(2020, 6, 30), "COMPLETED"), (4, 100000, 7, 50, date(2020, 7, 1), "SCHEDULED")],
        "trans_id BIGINT, from_acct BIGINT, to_acct BIGINT, amount INT, sch_transfer_date DATE, status STRING")
    out = run_due(schedule, accounts(spark), "2020-07-01")
    assert sorted(r["trans_id"] for r in out["postings"].collect()) == [1, 1]
    assert {r["status"] for r in out["postings"].collect()} == {"COMPLETED"}
    assert [r["error_code"] for r in out["rejected"].collect()] == ["ACCOUNT_NOT_EXISTS"]
    assert [r["rejected"] for r in out["errors"].collect()] == [1]


def test_close(spark):
    closed = ledger.close_accounts(accounts(spark), spark.createDataFrame([(100001,), (100001,), (5,)], "id BIGINT"))
    assert {r["id"]: r["status"] for r in closed.collect()} == {
        100000: "ACTIVE", 100001: "CLOSED", 100002: "ACTIVE"}


def brute_force(ops, opening):
    balances, out = dict(opening), []
    for account, seq, kind, amount in sorted(ops, key=lambda o: o[1]):
        balance = balances.get(account)
        if balance is None:
            out.append((account, seq, False, None, "ACCOUNT_NOT_EXISTS", 404))
            continue
        after = balance + amount if kind == "deposit" else balance - amount
        if kind == "withdraw" and after < 0:
            out.append((account, seq, False, balance, "TRANSACTION_EXCEPTION", 402))
            continue
        balances[account] = after
        out.append((account, seq, True, after, None, 200))
    return sorted(out, key=lambda r: r[1])


def replayed(spark, ops, opening, **settings):
    frame = spark.createDataFrame(ops, "account BIGINT, seq BIGINT, kind STRING, amount INT")
    start = spark.createDataFrame(opening, "account BIGINT, balance INT")
    done = replay(frame, start, **settings).collect()
    rows = [(r["account"], r["seq"], r["accepted"], None if r["balance"] is None else int(r["balance"]),
             r["error_code"], r["http_code"]) for r in done]
    return sorted(rows, key=lambda r: r[1])


def test_replay_golden_cases(spark):
    swings = [(1, 2 * i, "deposit", 100) for i in range(100)] + [(1, 2 * i + 1, "withdraw", 100) for i in range(100)]
    assert replayed(spark, swings, [(1, 10000)])[-1][3] == 10000
    drain = replayed(spark, [(1, i, "withdraw", 100) for i in range(101)], [(1, 10000)])
    assert [r[2] for r in drain] == [True] * 100 + [False] and drain[-1][3] == 0 and drain[-1][5] == 402


@pytest.mark.parametrize("hot_rows", [10**9, 200, 60])
def test_replay_against_brute_force(spark, hot_rows):
    """Account 1 has a third of all operations, account 9 does not exist, some have none."""
    rng = random.Random(11)
    ops = []
    for seq in range(1500):
        account = 1 if seq % 3 == 0 else rng.choice([2, 3, 4, 5, 6, 7, 8, 9, None])
        kind = "deposit" if rng.random() < (0.8 if 300 < seq < 900 else 0.35) else "withdraw"
        ops.append((account, seq, kind, rng.randrange(0, 90)))
    opening = [(a, 40 * a) for a in range(1, 9)]
    assert replayed(spark, ops, opening, hot_rows=hot_rows) == brute_force(ops, opening)


def test_walk_folds_only_blocks_entered_too_low():
    segments = [("a", 0, 50, 10), ("a", 1, -20, 100), ("a", 2, 5, 0), ("b", 2, 7, None)]
    asked = []

    def fold(pending):
        asked.extend(pending)
        return {("a", 1): 33}

    entries = _walk(segments, {"a": 20}, fold)
    assert asked == [("a", [1], 70)]
    assert sorted(entries, key=str) == [("a", 0, 20), ("a", 1, 70), ("a", 2, 33), ("b", 2, None)]


def test_walk_takes_few_rounds_where_every_block_rejects():
    rounds = []

    def fold(pending):
        rounds.append(pending)
        return {(account, block): 0 for account, blocks, _ in pending for block in blocks}

    entries = _walk([("a", b, -5, 9) for b in range(500)], {"a": 1}, fold)
    assert [e[1] for e in entries] == list(range(500)) and len(rounds) <= 9


def test_replay_rejects_what_it_does_not_know(spark):
    ops = spark.createDataFrame([(1, 1, "deposit", 10), (1, 2, "Withdraw", 5), (1, 3, None, 5), (1, None, "withdraw", 5),
                                 (1, 4, "withdraw", 25)], "account BIGINT, seq BIGINT, kind STRING, amount INT")
    opening = spark.createDataFrame([(1, 8), (1, 7)], "account BIGINT, balance INT")
    done = {(r["seq"], r["kind"]): (r["accepted"], r["balance"] and int(r["balance"]), r["http_code"])
            for r in replay(ops, opening).collect()}
    assert done == {(1, "deposit"): (True, 25, 200), (2, "Withdraw"): (False, None, 402), (3, None): (False, None, 402),
                    (None, "withdraw"): (False, None, 402), (4, "withdraw"): (True, 0, 200)}


def test_rows_of_one_account_add_up_in_every_check(spark):
    """Two rows of account 1 hold 30 together: enough for 25, not for 31."""
    accounts = spark.createDataFrame([(1, 10), (1, 20), (2, 0)], "id int, balance int")
    asked = spark.createDataFrame([("1", "2", 25, "01/02/2030"), ("1", "2", 31, "01/02/2030")],
                                  "from_account string, to_account string, amount int, schedule_date string")
    got = {r["amount"]: r["error_code"] for r in ledger.check_schedules(asked, accounts, "2024-01-01").collect()}
    assert got == {25: None, 31: "AMOUNT_OVERDRAWN"}


def test_requests_are_scanned_once(spark, tmp_path):
    spark.createDataFrame([("1", "2", 5), ("x", "2", 5), (None, "2", 5), ("1", "1", 5)],
                          "from_account string, to_account string, amount int").write.parquet(str(tmp_path / "r"))
    accounts = spark.createDataFrame([(1,), (2,)], "id int")
    out = ledger.validate_transfers(spark.read.parquet(str(tmp_path / "r")), accounts)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("FileScan" in line and "from_account" in line for line in plan) == 1
    assert sorted(str(r["error_code"]) for r in out.collect()) == [
        "FROM_TO_ACCOUNT_IS_SAME", "INVALID_ACCOUNT_FORMAT", "INVALID_ACCOUNT_FORMAT", "None"]
