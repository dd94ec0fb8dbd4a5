"""Rules, postings and replay over orders, lines and customers as a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import ledger
from millrace.operators.replay import replay
from millrace.operators.settlement import settle
from millrace.operators.windows import running_total
from millrace.plans.transfers import run_due

from .registry import Tables, query

DETAIL = """CASE error_code WHEN 'ACCOUNT_NOT_EXISTS' THEN 404 WHEN 'AMOUNT_OVERDRAWN' THEN 402
            ELSE CASE WHEN error_code IS NOT NULL THEN 400 END END"""


def double(name: str):
    return F.col(name).cast("double").alias(name)


@query(f"""SELECT id, error_code, {DETAIL} AS http_code FROM (
    SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'INITIAL_BALANCE_NEGATIVE'
      WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'INVALID_ACCOUNT_TYPE' END AS error_code FROM customer)""")
def validate_openings(t):
    kind = (F.when(F.col("c_mktsegment") == "BUILDING", "Checking").when(F.col("c_mktsegment") == "MACHINERY", "Savings")
            .when(F.col("c_mktsegment") == "FURNITURE", "checking"))
    accounts = t.customer.select(F.col("c_custkey").alias("id"), kind.alias("type"), F.col("c_acctbal").alias("balance"))
    return ledger.validate_openings(accounts).select("id", "error_code", "http_code")


def requests(t: Tables) -> DataFrame:
    """Lines as transfer requests from part to supplier numbers, some of them badly written."""
    source = (F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 1), F.concat(F.lit("A"), "l_partkey"))
              .when((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 2), F.concat(F.lit(" "), "l_partkey"))
              .otherwise(F.col("l_partkey").cast("string")))
    amount = F.when(F.col("l_discount") == 0.1, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    return t.lineitem.select("l_orderkey", "l_linenumber", source.alias("from_account"),
                             F.col("l_suppkey").cast("string").alias("to_account"), amount.alias("amount"),
                             "l_shipdate", "l_tax")


def accounts(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
                             F.lit("ACTIVE").alias("status"))


REQUEST_ERROR = """CASE WHEN l_returnflag = 'R' AND l_quantity IN (1, 2) THEN 'INVALID_ACCOUNT_FORMAT'
    WHEN l_partkey = l_suppkey THEN 'FROM_TO_ACCOUNT_IS_SAME'
    WHEN l_discount = 0.1 AND l_extendedprice > 0 THEN 'TRANSFER_AMOUNT_ZERO_OR_NEGATIVE'
    WHEN l_partkey NOT IN (SELECT c_custkey FROM customer) OR l_suppkey NOT IN (SELECT c_custkey FROM customer)
      THEN 'ACCOUNT_NOT_EXISTS' END"""


@query(f"""SELECT l_orderkey, l_linenumber, error_code, {DETAIL} AS http_code FROM (
             SELECT l_orderkey, l_linenumber, {REQUEST_ERROR} AS error_code FROM lineitem)""")
def validate_transfers(t):
    return (ledger.validate_transfers(requests(t), accounts(t))
            .select("l_orderkey", "l_linenumber", "error_code", "http_code"))


@query(f"""SELECT 'DATA_VALIDATION' AS error_type, error_code, CAST(count(*) AS BIGINT) AS rejected FROM (
             SELECT {REQUEST_ERROR} AS error_code FROM lineitem) WHERE error_code IS NOT NULL GROUP BY error_code""")
def error_rollup(t):
    rollup = ledger.error_rollup(ledger.validate_transfers(requests(t), accounts(t)))
    return rollup.select("error_type", "error_code", "rejected")


@query(f"""
    SELECT l_orderkey, l_linenumber, coalesce(error_code,
             CASE WHEN l_tax = 0.08 THEN 'INVALID_DATE_FORMAT'
                  WHEN l_shipdate < DATE '2000-01-01' THEN 'PAST_TRANSFER_DATE'
                  WHEN c_acctbal < l_extendedprice THEN 'AMOUNT_OVERDRAWN' END) AS error_code
    FROM (SELECT *, {REQUEST_ERROR} AS error_code FROM lineitem) LEFT JOIN customer ON l_partkey = c_custkey""")
def check_schedules(t):
    text = F.when(F.col("l_tax") == 0.08, "soon").otherwise(F.date_format("l_shipdate", "MM/dd/yyyy"))
    checked = ledger.check_schedules(requests(t).withColumn("schedule_date", text), accounts(t), as_of="2000-01-01")
    return checked.select("l_orderkey", "l_linenumber", "error_code")


@query("""SELECT c_custkey AS id, c_acctbal AS balance,
                 CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
                      THEN 'CLOSED' ELSE 'ACTIVE' END AS status FROM customer""")
def close_accounts(t):
    closing = t.orders.filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("id"))
    return ledger.close_accounts(accounts(t), closing)


@query("""
    SELECT o_orderkey, account, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE -1 END
             * CAST(o_totalprice AS DECIMAL(18,2)))
             OVER (PARTITION BY account ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
    FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS account FROM orders)""")
def running_balance(t):
    """A third of the orders on one account, numbered by the microseconds of their dates: far from dense."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    number = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
    moves = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey")).alias("account"),
                            number.alias("number"), F.when(F.col("o_orderstatus") == "O", amount).otherwise(-amount).alias("posting"))
    many = max(1, t.orders.count() // 50)
    return (running_total(moves, "account", "number", "posting", hot_rows=many, block_rows=many)
            .select("o_orderkey", "account", double("running")))


def transfers(t: Tables) -> DataFrame:
    """Orders as transfers from the customer to the account numbered like the customer's nation."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("trans_id"), F.col("o_custkey").alias("from_acct"),
        F.col("c_nationkey").cast("bigint").alias("to_acct"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("date").alias("sch_transfer_date"),
        F.when(F.col("o_orderstatus") == "P", "COMPLETED").otherwise("SCHEDULED").alias("status"))


TRANSFERS_SQL = """
    tr AS (SELECT o_orderkey AS trans_id, o_custkey AS from_acct, c_nationkey AS to_acct,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS amount
           FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE {where}),
    po AS (SELECT trans_id, from_acct AS account, -amount AS posting FROM tr
           UNION ALL SELECT trans_id, to_acct, amount FROM tr)"""
POSTED_SQL = """
    SELECT trans_id, account, CAST(posting AS DOUBLE) AS posting, CAST(balance AS DOUBLE) AS balance,
           balance < 0 AS overdrawn FROM (
      SELECT *, CAST(c_acctbal AS DECIMAL(18,2)) + sum(posting) OVER (
               PARTITION BY account ORDER BY trans_id, posting ROWS UNBOUNDED PRECEDING) AS balance
      FROM po JOIN customer ON account = c_custkey)"""


@query("WITH " + TRANSFERS_SQL.format(where="true") + POSTED_SQL)
def post_transfers(t):
    """Receivers are few and get many transfers each; those with a fiftieth of all are cut into blocks."""
    many = max(1, t.orders.count() // 50)
    posted = ledger.post_transfers(transfers(t), accounts(t), hot_rows=many, block_rows=many)
    return posted.select("trans_id", "account", double("posting"), double("balance"), "overdrawn")


DUE = "o_orderstatus <> 'P' AND o_orderdate <= DATE '1998-01-01'"
# Scheduled transfers are validated, and those to the own account rejected.
DUE_VALID = DUE + " AND o_custkey <> c_nationkey"


@query("WITH " + TRANSFERS_SQL.format(where=DUE_VALID) + POSTED_SQL)
def due_transfers(t):
    posted = run_due(transfers(t), accounts(t), as_of="1998-01-01")["postings"]
    return posted.select("trans_id", "account", double("posting"), double("balance"), "overdrawn")


@query("WITH " + TRANSFERS_SQL.format(where=DUE_VALID) + """
    SELECT c_custkey AS account, CAST(CAST(c_acctbal AS DECIMAL(18,2)) + coalesce(s, 0) AS DOUBLE) AS balance
    FROM customer LEFT JOIN (SELECT account, sum(posting) AS s FROM po GROUP BY account) ON c_custkey = account""")
def account_balances(t):
    return run_due(transfers(t), accounts(t), as_of="1998-01-01")["balances"].select("account", double("balance"))


REPLAY_SQL = """
    WITH RECURSIVE ops AS (
      SELECT {account} AS account, o_orderkey, o_orderstatus = 'O' AS deposit, o_orderpriority = '5-LOW' AND o_orderkey % 5 = 0 AS odd, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
             row_number() OVER (PARTITION BY {account} ORDER BY o_orderkey) AS rn
      FROM orders JOIN customer ON o_custkey = c_custkey),
    r AS (
      SELECT account, 0 AS rn, CAST(NULL AS BIGINT) AS o_orderkey, true AS accepted, {opening} AS balance FROM ({accounts})
      UNION ALL
      SELECT r.account, r.rn + 1, ops.o_orderkey, CASE WHEN odd THEN NULL ELSE ops.deposit OR r.balance >= ops.cents END,
             CASE WHEN odd THEN r.balance WHEN ops.deposit THEN r.balance + ops.cents WHEN r.balance >= ops.cents THEN r.balance - ops.cents
                  ELSE r.balance END
      FROM r JOIN ops ON ops.account = r.account AND ops.rn = r.rn + 1)
    SELECT o_orderkey, account, coalesce(accepted, false) AS accepted,
           CASE WHEN accepted IS NOT NULL THEN CAST(balance AS DOUBLE) / 100 END AS balance,
           CASE WHEN accepted THEN 200 ELSE 402 END AS http_code FROM r WHERE rn > 0"""


def operations(t: Tables, account: str) -> DataFrame:
    kind = (F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") % 5 == 0), "refund")
            .when(F.col("o_orderstatus") == "O", "deposit").otherwise("withdraw"))
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col(account).alias("account"), kind.alias("kind"), F.col("o_totalprice").alias("amount"))


@query(REPLAY_SQL.format(account="o_custkey", accounts="SELECT c_custkey AS account, c_acctbal FROM customer",
                         opening="CAST(round(greatest(c_acctbal, 0) * 100) AS BIGINT)"))
def replay_ops(t):
    opening = t.customer.select(F.col("c_custkey").alias("account"),
                                F.greatest("c_acctbal", F.lit(0.0)).alias("balance"))
    done = replay(operations(t, "o_custkey"), opening, seq="o_orderkey")
    return done.select("o_orderkey", "account", "accepted", double("balance"), "http_code")


@query(REPLAY_SQL.format(account="c_nationkey", accounts="SELECT n_nationkey AS account FROM nation",
                         opening="CAST(500000000 AS BIGINT)"))
def replay_hot_accounts(t):
    """Few accounts with many operations each: most are cut into blocks."""
    opening = t.nation.select(F.col("n_nationkey").alias("account"), F.lit(5_000_000).alias("balance"))
    ops = operations(t, "c_nationkey")
    done = replay(ops, opening, seq="o_orderkey", hot_rows=max(1, t.orders.count() // 50))
    return done.select("o_orderkey", "account", "accepted", double("balance"), "http_code")


@query("""
    WITH RECURSIVE ops AS (
      SELECT o_custkey AS account, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
    r AS (
      SELECT c_custkey AS account, 0 AS rn, CAST(NULL AS BIGINT) AS o_orderkey, true AS accepted,
             CAST(round(greatest(c_acctbal, 0) * 100) AS BIGINT) * 60 AS balance FROM customer
      UNION ALL
      SELECT r.account, r.rn + 1, ops.o_orderkey, r.balance >= ops.cents,
             CASE WHEN r.balance >= ops.cents THEN r.balance - ops.cents ELSE r.balance END
      FROM r JOIN ops ON ops.account = r.account AND ops.rn = r.rn + 1)
    SELECT o_orderkey AS trans_id, CASE WHEN NOT accepted THEN 'AMOUNT_OVERDRAWN' END AS error_code FROM r WHERE rn > 0""")
def settled_transfers(t):
    """Orders as transfers to the accounts of nations, which send nothing: each sender's own order decides."""
    asked = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("trans_id"), F.col("o_custkey").alias("from_acct"),
        (-1 - F.col("c_nationkey")).alias("to_acct"), F.col("o_totalprice").alias("amount"))
    opening = (t.customer.select(F.col("c_custkey").alias("id"), (F.greatest("c_acctbal", F.lit(0.0)).cast("decimal(18,2)") * 60).alias("balance"))
               .unionAll(t.nation.select(-1 - F.col("n_nationkey"), F.lit(0))))
    return settle(asked, opening).transfers.select("trans_id", "error_code")
