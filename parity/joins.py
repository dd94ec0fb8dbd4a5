"""Star joins, feeds, semi and anti joins, merges, distinct and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.predicates import all_equal, contains, not_false, since_months
from millrace.operators import grouping, joins
from millrace.operators.windows import dense_ids, last_write
from millrace.plans import exports, feeds, star
from millrace.sources import generate

from .registry import WORDS_SQL, Tables, cents, query


# Action ids do not fit 32 bits.
BIG = 3_000_000_000


def star_frames(t: Tables) -> dict[str, DataFrame]:
    """Orders as actions and trackers, their lines as activities, customers as categories."""
    entered = F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "R", False)
    return {
        "action": t.orders.select(
            (F.col("o_orderkey") + BIG).alias("id"), F.col("o_orderpriority").alias("action_type"),
            F.lit("order").alias("name"), F.col("o_orderstatus").alias("description")),
        "action_activities": t.lineitem.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            (F.col("l_orderkey") + BIG).alias("action_id"),
            F.concat_ws("-", "l_linenumber", F.col("l_quantity").cast("int")).alias("activity_type"),
            entered.alias("manually_entered")),
        "tracker": t.orders.select(
            F.col("o_orderkey").alias("id"), F.lit("tracker").alias("description"), F.lit("t").alias("title"),
            F.col("o_custkey").alias("thrive_category_id"), (F.col("o_orderkey") + BIG).alias("action"),
            (F.col("o_orderstatus") == "O").alias("hide_on_healthy_habits"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "Published").otherwise("Unpublished").alias("status"),
            F.when(F.col("o_totalprice") > 400000, F.col("o_custkey")).alias("sponsor_id")),
        "category": t.customer.select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("#f26700").alias("color"),
            F.col("c_nationkey").cast("bigint").alias("order_index"), F.col("c_mktsegment").alias("type"),
            F.when(F.col("c_mktsegment") == "BUILDING", "Published").otherwise("Unpublished").alias("status"),
            F.lit(False).alias("sensitive")),
    }


STAR_SQL = """
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE l_returnflag = 'A' AND o_orderstatus <> 'O' AND o_orderpriority = '1-URGENT'
      AND NOT o_totalprice > 400000 AND c_mktsegment = 'BUILDING'"""


@query("SELECT DISTINCT concat_ws('-', l_linenumber, CAST(l_quantity AS INT)) AS activity_type" + STAR_SQL)
def hh_list(t):
    return feeds.item_list(**star_frames(t))


@query("""SELECT concat_ws('-', l_linenumber, CAST(l_quantity AS INT)) AS activity_type,
                 CAST(count(*) AS BIGINT) AS n""" + STAR_SQL + " GROUP BY 1")
def star_join_frames(t):
    items = star.visible_items(star.joined_star(**star_frames(t)), "activity_type")
    return items.groupBy("activity_type").agg(F.count("*").alias("n"))


@query("""
    SELECT c_name AS "name", n_name AS nation, o_orderkey AS id, ".id", "status", ".status" FROM (
      SELECT c_name, n_name, o_orderkey, c_custkey AS ".id", o_orderstatus AS "status", c_mktsegment AS ".status"
      FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey)""")
def prefix_join(t):
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                  F.col("c_mktsegment").alias("status"), "c_nationkey")
    orders = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey", F.col("o_orderstatus").alias("status"))
    nations = t.nation.select("n_nationkey", F.col("n_name").alias("nation"))
    both = joins.prefix_join(joins.prefix_join(customers, nations, "c_nationkey", "n_nationkey"), orders,
                             "id", "o_custkey")
    return both.select("name", "nation", "id", "`.id`", "status", "`.status`")


METADATA_TYPES = "SELECT DISTINCT p_brand FROM part WHERE p_type = 'PROMO' AND p_size = 50"


@query(f"""
    SELECT DISTINCT 'hh_' || p_partkey AS "ITEM_ID", 'hh_' AS "ITEM_TYPE", p_size AS thrive_category_id
    FROM part JOIN nation ON p_size = n_nationkey WHERE p_brand IN ({METADATA_TYPES})""")
def item_metadata(t):
    types = (t.part.filter((F.col("p_type") == "PROMO") & (F.col("p_size") == 50))
             .select(F.col("p_brand").alias("activity_type")).distinct())
    trackers = t.part.select(F.col("p_partkey").alias("tracker_id"), F.col("p_size").alias("thrive_category_id"),
                             F.col("p_brand").alias("activity_type"))
    categories = t.nation.select(F.col("n_nationkey").alias("thrive_category_id"))
    return feeds.item_metadata(types, trackers, categories)


def interactions(t: Tables, salt_rows: int | None) -> DataFrame:
    priorities = t.orders.select(F.col("o_orderpriority").alias("activity_type")).distinct()
    members = t.customer.select(F.col("c_custkey").alias("member_key"),
                                F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("member_id"))
    activities = t.orders.select(
        F.col("o_orderdate").alias("activity_date"), F.col("o_orderdate").alias("dw_created_date"),
        F.col("o_custkey").alias("member_key"), F.col("o_orderpriority").alias("activity_type"))
    trackers = priorities.select(F.left("activity_type", F.lit(1)).cast("bigint").alias("tracker_id"), "activity_type")
    return feeds.member_interactions(priorities.filter(contains("activity_type", "U")), members, activities, trackers,
                                     as_of="2001-08-01", salt_rows=salt_rows)


INTERACTIONS_SQL = """
    SELECT c_custkey AS "USER_ID", 'hh_' || left(o_orderpriority, 1) AS "ITEM_ID",
           CAST(epoch(o_orderdate) AS BIGINT) AS "TIMESTAMP"
    FROM customer JOIN orders ON c_custkey = o_custkey
    WHERE c_acctbal >= 0 AND o_orderdate >= DATE '2001-08-01' - INTERVAL 12 MONTH AND o_orderpriority LIKE '%U%'"""


@query(INTERACTIONS_SQL)
def member_interactions(t):
    return interactions(t, None)


@query(INTERACTIONS_SQL)
def member_interactions_salted(t):
    return interactions(t, max(1, t.orders.count() // 500))


@query("""
    SELECT o_custkey AS user_id, 'order-' || o_orderkey AS item, o_orderdate AS at FROM orders
    UNION ALL SELECT l_suppkey, 'part-' || l_partkey, l_shipdate FROM lineitem""")
def interaction_union(t):
    orders = t.orders.select(F.col("o_custkey").alias("user_id"),
                             F.concat(F.lit("order-"), "o_orderkey").alias("item"), F.col("o_orderdate").alias("at"))
    lines = t.lineitem.select(F.concat(F.lit("part-"), "l_partkey").alias("item"), F.col("l_shipdate").alias("at"),
                              F.col("l_suppkey").alias("user_id"))
    return orders.unionByName(lines)


@query("""
    SELECT c_custkey, c_name, CAST(count(o_orderkey) AS BIGINT) AS urgent_orders FROM customer LEFT JOIN orders
      ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
    GROUP BY c_custkey, c_name""")
def left_join_counts(t):
    urgent = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    counts = urgent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return (t.customer.join(counts, "c_custkey", "left")
            .select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("urgent_orders")))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def in_list_semi(t):
    debtors = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return joins.in_list(t.orders.select("o_orderkey", "o_custkey"), debtors, "o_custkey")


@query("""SELECT c_custkey, c_name FROM customer
          WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def ref_check_anti(t):
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return joins.ref_check(t.customer.select("c_custkey", "c_name"), urgent, "c_custkey")


@query("""SELECT a.o_custkey, CAST(count(*) AS BIGINT) AS joined_rows FROM orders a JOIN orders b
          ON a.o_custkey = b.o_custkey GROUP BY a.o_custkey""")
def fanout_join(t):
    return joins.fanout_counts(t.orders, t.orders, ["o_custkey"]).select("o_custkey", "joined_rows")


@query("""
    WITH stage AS (
      SELECT l_orderkey AS id, 'RETURNED' AS state, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
      UNION ALL SELECT -1 - s_suppkey, 'NEW', CAST(round(s_acctbal * 100) AS BIGINT) FROM supplier)
    SELECT id, state, cents FROM stage
    UNION ALL SELECT o_orderkey, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) FROM orders
    WHERE o_orderkey NOT IN (SELECT id FROM stage)""")
def merge_by_key(t):
    source = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("state"),
                             cents("o_totalprice").alias("cents"))
    returned = (t.lineitem.filter(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("id"))
                .agg(F.lit("RETURNED").alias("state"), F.sum(cents("l_extendedprice")).alias("cents")))
    new = t.supplier.select((F.lit(-1) - F.col("s_suppkey")).alias("id"), F.lit("NEW").alias("state"),
                            cents("s_acctbal").alias("cents"))
    return joins.merge_by_key(source, returned.unionByName(new), "id")


@query("""
    SELECT p_name AS journeyname, s_name AS name, l_partkey AS journeyid, l_suppkey AS memberid
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey""")
def three_table_export(t):
    journeys = t.part.select(F.col("p_partkey").alias("journeyid"), F.col("p_name").alias("journeyname"))
    members = t.supplier.select(F.col("s_suppkey").alias("memberid"), F.col("s_name").alias("name"))
    pairs = t.lineitem.select(F.col("l_partkey").alias("journeyid"), F.col("l_suppkey").alias("memberid")).distinct()
    return exports.three_table_export(journeys, members, pairs)


@query("SELECT p_name AS journeyname, CAST(p_partkey AS INT) AS journeyid FROM part")
def table_export(t):
    return exports.table_export(t.part, [("p_name", "string", "journeyname", "string"),
                                         ("p_partkey", "long", "journeyid", "int")])


@query("SELECT DISTINCT event_type FROM events")
def distinct_types(t):
    return grouping.distinct_rows(t.events, "event_type")


@query("SELECT CAST(count(*) AS BIGINT) AS row_count FROM lineitem")
def row_count(t):
    return grouping.row_count(t.lineitem)


@query(f"""WITH {WORDS_SQL} SELECT word, CAST(count(*) AS BIGINT) AS "count" FROM words GROUP BY word""")
def word_count(t):
    return grouping.word_count(grouping.lines(t.documents, "text"))


@query("""SELECT n_name, label FROM nation JOIN (VALUES (0, 'south'), (1, 'west'), (3, NULL)) AS r(key, label)
          ON n_regionkey = key""")
def literal_join(t):
    labels = generate.frame(t.spark, [(0, "south"), (1, "west"), (3, None)], "key INT, label STRING")
    return t.nation.join(labels, F.col("n_regionkey") == F.col("key")).select("n_name", "label")


@query("SELECT c_custkey, repeat('x', CAST(c_custkey % 9 AS INT)) AS filler FROM customer")
def filler_items(t):
    return t.customer.select("c_custkey", generate.filler((F.col("c_custkey") % 9).cast("int")).alias("filler"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 15")
def order_limit(t):
    return grouping.order_limit(t.customer.select("c_custkey", "c_name", "c_acctbal"),
                                F.col("c_acctbal").desc(), "c_custkey", limit=15)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def order_by_date(t):
    return grouping.order_limit(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000042'")
def point_lookup(t):
    return t.customer.filter(F.col("c_name") == "Customer#000000042").select("c_custkey", "c_name", "c_mktsegment")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def like_filter(t):
    return t.part.filter(contains("p_name", "ring")).select("p_partkey", "p_name")


NULLABLE_FLAG = "CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE ({NULLABLE_FLAG}) <> false")
def nullable_flag(t):
    lines = t.lineitem.withColumn("flag", F.expr(NULLABLE_FLAG))
    return lines.filter(not_false("flag")).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
          WHERE l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity = 50.0""")
def strict_filter(t):
    lines = t.lineitem.withColumn("flag", F.expr(NULLABLE_FLAG))
    wanted = all_equal({"flag": None, "l_linestatus": "O", "l_quantity": 50.0})
    return lines.filter(wanted).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 12 MONTH")
def rolling_months(t):
    return t.orders.filter(since_months("o_orderdate", "2001-08-01")).select("o_orderkey", "o_orderdate")


LAST_WRITE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                    "l_returnflag", "l_linestatus"]


@query(f"""
    SELECT l_orderkey, l_linenumber, {', '.join(LAST_WRITE_ORDER)} FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {', '.join(c + ' DESC' for c in LAST_WRITE_ORDER)}) AS rn FROM lineitem)
    WHERE rn = 1""")
def last_write_wins(t):
    return last_write(t.lineitem, ["l_orderkey", "l_linenumber"], LAST_WRITE_ORDER)


@query("""SELECT o_orderkey, 99999 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders""")
def sequence_ids(t):
    return dense_ids(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"],
                     start=100000).select("o_orderkey", "id")
