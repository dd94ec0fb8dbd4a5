"""Ledger rules and postings. Rules are data; every check is a Column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import parse_us_date, same_text
from ..session import stored
from .windows import running_total

# Error code, message, HTTP status, error type.
ERRORS = [
    ("INVALID_ACCOUNT_FORMAT", "Account format is not valid", 400, "DATA_VALIDATION"),
    ("FROM_TO_ACCOUNT_IS_SAME", "From and To account can't be the same", 400, "DATA_VALIDATION"),
    ("INVALID_DATE_FORMAT", "Input date format is not valid", 400, "DATA_VALIDATION"),
    ("PAST_TRANSFER_DATE", "Scheduled transfer date cannot past", 400, "DATA_VALIDATION"),
    ("TRANSACTION_EXCEPTION", "Exception while performing the transaction", 402, "TRANSACTION_ERROR"),
    ("INITIAL_BALANCE_NEGATIVE", "Account balance can't be negative at open", 400, "DATA_VALIDATION"),
    ("INVALID_ACCOUNT_TYPE", "Account type should be Checking or Savings", 400, "DATA_VALIDATION"),
    ("ACCOUNT_CLOSING_ERROR", "Unable to close the account.", 402, "ACCOUNT_CLOSING_ERROR"),
    ("TRANSFER_AMOUNT_ZERO_OR_NEGATIVE", "Transfer amount can't be negative", 400, "DATA_VALIDATION"),
    ("ACCOUNT_NOT_EXISTS", "Account doesn't exists", 404, "DATA_VALIDATION"),
    ("AMOUNT_OVERDRAWN", "Transfer amount exceeds available balance", 402, "AMOUNT_OVERDRAWN"),
]

# Account types, case-sensitive.
ACCOUNT_TYPES = ["Checking", "Savings"]


def error_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ERRORS, "error_code string, message string, http_code int, error_type string")


def _detail(position: int) -> Column:
    """Look up one attribute of the row's error code, without a join."""
    pairs = [F.lit(x) for row in ERRORS for x in (row[0], row[position])]
    return F.try_element_at(F.create_map(*pairs), F.col("error_code"))


def with_error(df: DataFrame, code: Column) -> DataFrame:
    """Add ``error_code`` (NULL = accepted) with its HTTP status and type."""
    return (df.withColumn("error_code", code)
            .withColumns({"http_code": _detail(2), "error_type": _detail(3)}))


def validate_openings(accounts: DataFrame) -> DataFrame:
    """Account openings (type, balance): the first failing rule decides."""
    return with_error(accounts, F.when(F.col("balance") < 0, "INITIAL_BALANCE_NEGATIVE")
                      .when(~F.coalesce(F.col("type").isin(ACCOUNT_TYPES), F.lit(False)), "INVALID_ACCOUNT_TYPE"))


def account_number(text: Column | str) -> Column:
    """Whole number of 32 bits from text, NULL otherwise; blanks around it are not allowed."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("int")).cast("bigint")


def _request_error() -> Column:
    """What a request shows by itself."""
    return (F.when(F.col("from_acct").isNull() | F.col("to_acct").isNull(), "INVALID_ACCOUNT_FORMAT")
            .when(same_text("from_account", "to_account"), "FROM_TO_ACCOUNT_IS_SAME")
            .when(F.col("amount") < 0, "TRANSFER_AMOUNT_ZERO_OR_NEGATIVE"))


def _checked(requests: DataFrame, accounts: DataFrame, late: Column | None = None, *extra: str) -> DataFrame:
    """Requests with parsed account numbers and error columns, from one scan of the requests.

    The accounts are written once with one row per id, ``extra`` numbers of several rows added up as ``balances`` does:
    both look-ups are plain joins to a table, which Spark splits where one account has very many requests. Requests that
    fail by themselves are looked up under numbers of their own that no account has, so that those without a readable
    number meet nowhere. ``late`` is a rule for requests that pass, over the ``extra`` columns of the sender's account,
    named with two underscores.
    """
    typed = requests.withColumns(
        {"from_acct": account_number("from_account"), "to_acct": account_number("to_account")}
    ).withColumn("__failed", _request_error())
    known = stored(accounts.groupBy(F.col("id").cast("bigint").alias("__id")).agg(
        F.lit(True).alias("__known"), *[F.sum(c).alias(f"__{c}") for c in extra]), "accounts")
    # Account numbers that are looked up have 32 bits.
    spread = F.lit(-(1 << 40)) - F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in requests.columns]), 24)
    own = {f"__{side}": F.when(F.col("__failed").isNull(), F.col(side)).otherwise(spread) for side in ("from_acct", "to_acct")}
    sender = known.withColumnsRenamed({"__id": "__from_acct", "__known": "__has_from"})
    receiver = known.select(F.col("__id").alias("__to_acct"), F.col("__known").alias("__has_to"))
    found = typed.withColumns(own).join(sender, "__from_acct", "left").join(receiver, "__to_acct", "left")
    missing = F.when(F.col("__has_from").isNull() | F.col("__has_to").isNull(), "ACCOUNT_NOT_EXISTS")
    rules = [F.col("__failed"), missing] + ([late] if late is not None else [])
    columns = [c for c in typed.columns if c != "__failed"]
    return with_error(found.withColumn("error_code", F.coalesce(*rules)).select(*columns, "error_code"), F.col("error_code"))


def validate_transfers(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transfer requests (from_account, to_account as text; amount) against known accounts (id).

    Zero passes the amount rule. Adds the parsed ``from_acct``/``to_acct`` and the error columns.
    """
    return _checked(requests, accounts).select(
        *requests.columns, "from_acct", "to_acct", "error_code", "http_code", "error_type")


def check_schedules(requests: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """Scheduled transfers: the transfer rules, then date format, past date, overdraft.

    ``accounts`` is (id, balance); ``as_of`` stands for today, which is allowed. Scheduling does
    not reserve money, so each row is compared with the same balance.
    """
    dated = requests.withColumn("sch_transfer_date", parse_us_date("schedule_date"))
    late = (F.when(F.col("sch_transfer_date").isNull(), "INVALID_DATE_FORMAT")
            .when(F.col("sch_transfer_date") < F.lit(as_of).cast("date"), "PAST_TRANSFER_DATE")
            .when(F.col("__balance") < F.col("amount"), "AMOUNT_OVERDRAWN"))
    return _checked(dated, accounts, late, "balance").select(
        *requests.columns, "from_acct", "to_acct", "sch_transfer_date", "error_code", "http_code", "error_type"
    )


def postings(transfers: DataFrame) -> DataFrame:
    """Two signed rows per transfer, from one scan of the transfers."""
    amount = F.col("amount").cast("decimal(18,2)")
    debit = F.struct(F.col("from_acct").alias("account"), (-amount).cast("decimal(18,2)").alias("posting"))
    credit = F.struct(F.col("to_acct").alias("account"), amount.alias("posting"))
    return (transfers.withColumn("__posting", F.explode(F.array(debit, credit)))
            .select("__posting.*", *transfers.columns))


def balances(opening: DataFrame, posted: DataFrame) -> DataFrame:
    """Opening balance plus all postings, per account."""
    moves = opening.select(F.col("id").alias("account"), F.col("balance").cast("decimal(18,2)").alias("posting"))
    return (moves.unionByName(posted.select("account", "posting"))
            .groupBy("account").agg(F.sum("posting").cast("decimal(18,2)").alias("balance")))


def post_transfers(transfers: DataFrame, opening: DataFrame, seq: str = "trans_id", **blocks) -> DataFrame:
    """Postings with the running balance of their account; ``overdrawn`` marks a negative one.

    A batch posts every transfer and flags overdrafts. Rejecting them one by one needs the outcome
    of every earlier transfer of both accounts, which is serial.
    """
    start = opening.select(F.col("id").alias("account"), F.col("balance").cast("decimal(18,2)").alias("opening"))
    # A transfer to the own account posts twice: the debit comes first.
    numbered = postings(transfers).withColumn("__no", F.col(seq) * 2 + (F.col("posting") > 0).cast("int"))
    running = running_total(numbered, "account", "__no", "posting", "balance", opening=start, **blocks).drop("__no")
    return (running.withColumn("balance", F.col("balance").cast("decimal(18,2)"))
            .withColumn("overdrawn", F.col("balance") < 0))


def due_transfers(schedule: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """All SCHEDULED transfers due by ``as_of``, with ``error_code`` and, if there is none, COMPLETED."""
    due = schedule.filter((F.col("status") == "SCHEDULED") & (F.col("sch_transfer_date") <= F.lit(as_of).cast("date")))
    requests = due.withColumns({"from_account": F.col("from_acct").cast("string"),
                                "to_account": F.col("to_acct").cast("string")}).drop("from_acct", "to_acct")
    checked = validate_transfers(requests, accounts).drop("from_account", "to_account")
    return checked.withColumn("status", F.when(F.col("error_code").isNull(), "COMPLETED").otherwise(F.col("status")))


def close_accounts(accounts: DataFrame, closing: DataFrame) -> DataFrame:
    """Set the status of the listed ids to CLOSED; all other columns and rows stay."""
    listed = closing.select("id").distinct().withColumn("__closing", F.lit(True))
    status = F.when(F.col("__closing"), "CLOSED").otherwise(F.col("status"))
    return accounts.join(listed, "id", "left").withColumn("status", status).select(*accounts.columns)


def error_details(rejected: DataFrame) -> DataFrame:
    """Code, type and message of each rejected row."""
    return (rejected.filter(F.col("error_code").isNotNull())
            .withColumns({"message": _detail(1), "http_code": _detail(2), "error_type": _detail(3)}))


def error_rollup(rejected: DataFrame) -> DataFrame:
    """Rejected rows per error type and code."""
    return (error_details(rejected).groupBy("error_type", "error_code", "http_code", "message")
            .agg(F.count("*").alias("rejected")))
