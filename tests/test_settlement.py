"""Transfers settled in rounds, next to a plain loop."""

import random

import pytest

from millrace.operators.settlement import settle

DDL = "trans_id long, from_acct int, to_acct int, amount decimal(18,2), note string"


def serial(transfers, opening):
    balances, out = {}, {}
    for account, balance in opening:
        balances[account] = balances.get(account, 0) + balance
    for no, src, dst, amount, _ in sorted(transfers):
        if src is not None and src == dst:
            out[no] = "FROM_TO_ACCOUNT_IS_SAME"
        elif amount is None or amount < 0:
            out[no] = "TRANSFER_AMOUNT_ZERO_OR_NEGATIVE"
        elif src not in balances or dst not in balances:
            out[no] = "ACCOUNT_NOT_EXISTS"
        elif balances[src] < amount:
            out[no] = "AMOUNT_OVERDRAWN"
        else:
            balances[src] -= amount
            balances[dst] += amount
            out[no] = None
    return out, balances


def check(spark, transfers, opening, **blocks):
    from decimal import Decimal

    rows = [(n, s, d, None if a is None else Decimal(a), x) for n, s, d, a, x in transfers]
    done = settle(spark.createDataFrame(rows, DDL), spark.createDataFrame(opening, "id int, balance int"), **blocks)
    want, balances = serial(transfers, opening)
    assert {r["trans_id"]: r["error_code"] for r in done.transfers.collect()} == want
    assert {r["account"]: int(r["balance"]) for r in done.balances.collect()} == balances
    return done


def entangled(seed, n, accounts, least):
    rng = random.Random(seed)
    transfers = [(i * 3 + rng.randrange(3), rng.randrange(accounts + 1), rng.choice([rng.randrange(accounts), 0]),
                  rng.choice([rng.randrange(100)] * 9 + [None, -1, 0]), "n") for i in range(n)]
    transfers += [(5000, None, 1, 5, None), (5001, 1, None, 5, None)]
    return transfers, [(a, least + rng.randrange(60)) for a in range(accounts)] + [(0, 7)]


@pytest.mark.parametrize("seed, n, accounts, least", [(1, 400, 4, 0), (2, 900, 30, 50)])
def test_agrees_with_a_serial_loop(spark, seed, n, accounts, least):
    """Few accounts near zero that depend on each other, with unknown, equal and missing values among them."""
    check(spark, *entangled(seed, n, accounts, least))


def test_rounds_alone_agree_with_a_serial_loop(spark):
    done = check(spark, *entangled(3, 40, 8, 150), finish=4)
    assert done.rounds[-1] <= 4 and all(a > b for a, b in zip(done.rounds, done.rounds[1:]))


def test_ample_balances_take_one_round(spark):
    """100 transfers of 10 out of 30000, as fast as they come."""
    done = check(spark, [(i, 1, 2, 10, "") for i in range(100)], [(1, 30000), (2, 0)])
    assert done.rounds == [0]


def test_a_hot_account_is_cut_into_blocks(spark):
    rng = random.Random(5)
    transfers = [(i, 7 if i % 3 else rng.randrange(20), 7 if i % 3 == 0 else rng.randrange(20), rng.randrange(30), "") for i in range(400)]
    check(spark, transfers, [(a, 300) for a in range(20)], hot_rows=100, block_rows=120, finish=390)


def test_a_chain_of_credits_takes_rounds(spark):
    """Each transfer is paid by the one before; a failed first one fails them all."""
    chain = [(i, i, i + 1, 10, "") for i in range(3)]
    done = check(spark, chain, [(0, 10)] + [(i, 0) for i in range(1, 4)], finish=0)
    assert all(r["error_code"] is None for r in done.transfers.collect()) and len(done.rounds) == 3
    check(spark, chain, [(i, 0) for i in range(4)])


def test_nothing_to_settle(spark):
    done = check(spark, [], [(1, 5)])
    assert done.rounds == [0]
