"""Mapping, choice, JSON, nested data and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalar
from millrace.functions.predicates import dimensions_match, json_event_matches
from millrace.operators import shaping
from millrace.plans import sensors

from .registry import as_ntz, query


@query("""SELECT o_orderdate AS order_ts, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
                 CAST(o_orderkey AS VARCHAR) AS order_id, TRY_CAST(o_orderpriority AS BIGINT) AS priority_number
          FROM orders""")
def apply_mapping(t):
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    nested = t.orders.select(F.struct(millis.alias("at"), "o_totalprice").alias("placed"), "o_orderkey",
                             "o_orderpriority")
    mapped = shaping.apply_mapping(nested, [
        ("placed.at", "long", "order_ts", "timestamp"), ("placed.o_totalprice", "double", "price", "decimal(12,2)"),
        ("o_orderkey", "long", "order_id", "string"), ("o_orderpriority", "string", "priority_number", "long"),
    ])
    return mapped.select(as_ntz("order_ts"), F.col("price").cast("double").alias("price"), "order_id",
                         "priority_number")


CHOICE = "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE CAST(o_orderkey AS {text}) END"


@query(f"""SELECT o_orderkey, TRY_CAST(c AS BIGINT) AS choice_long,
                  CASE WHEN TRY_CAST(c AS BIGINT) IS NULL THEN c END AS choice_string
           FROM (SELECT o_orderkey, {CHOICE.format(text='VARCHAR')} AS c FROM orders)""")
def resolve_make_cols(t):
    mixed = t.orders.select("o_orderkey", F.expr(CHOICE.format(text="STRING")).alias("choice"))
    return shaping.resolve_choice(mixed, [("choice", "make_cols")])


@query(f"""SELECT o_orderkey, TRY_CAST(c AS BIGINT) AS as_long,
                  CASE WHEN TRY_CAST(c AS BIGINT) IS NULL THEN c END AS as_string
           FROM (SELECT o_orderkey, {CHOICE.format(text='VARCHAR')} AS c FROM orders)""")
def resolve_make_struct(t):
    mixed = t.orders.select("o_orderkey", F.expr(CHOICE.format(text="STRING")).alias("choice"))
    resolved = shaping.resolve_choice(mixed, [("choice", "make_struct")])
    return resolved.select("o_orderkey", F.col("choice.long").alias("as_long"),
                           F.col("choice.string").alias("as_string"))


@query(f"""SELECT o_orderkey, TRY_CAST({CHOICE.format(text='VARCHAR')} AS BIGINT) AS choice FROM orders""")
def resolve_cast(t):
    mixed = t.orders.select("o_orderkey", F.expr(CHOICE.format(text="STRING")).alias("choice"))
    return shaping.resolve_choice(mixed, [("choice", "cast:long")])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def unbox(t):
    return shaping.unbox(t.events.select("event_id", "props"), "props")


@query("""SELECT vec_id AS id, CAST(i AS INT) AS "index", CAST(embedding[i + 1] AS DOUBLE) AS val
          FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM embeddings)""")
def relationalize_child(t):
    child = shaping.relationalize(t.embeddings, "vectors", key="vec_id")["vectors_embedding"]
    return child.withColumn("val", F.col("val").cast("double"))


@query("""SELECT conv_id, turn, role AS "speaker.role", text AS "speaker.text", len(string_split(text, ' ')) AS words
          FROM conversations""")
def relationalize_root(t):
    """Rows without a key: generated ids link each root row with the elements of its array."""
    nested = t.conversations.select("conv_id", "turn", F.struct("role", "text").alias("speaker"),
                                    F.split("text", " ").alias("words"))
    tables = shaping.relationalize(nested, "talk")
    counts = tables["talk_words"].groupBy("id").agg(F.count("val").alias("n"))
    root = tables["talk"].join(counts, F.col("words") == F.col("id"), "left")
    return root.select("conv_id", "turn", "`speaker.role`", "`speaker.text`", F.col("n").alias("words"))


MIXED_JSON = """CASE event_id % 6 WHEN 0 THEN CAST(user_id AS {text}) WHEN 1 THEN '1.5' WHEN 2 THEN 'true'
    WHEN 3 THEN props WHEN 4 THEN '"abc"' ELSE 'null' END"""


@query("""SELECT event_id, CASE WHEN event_id % 6 = 0 THEN user_id END AS v_long,
                 CASE WHEN event_id % 6 = 1 THEN 1.5::DOUBLE END AS v_double, CASE WHEN event_id % 6 = 2 THEN true END AS v_boolean,
                 CASE event_id % 6 WHEN 3 THEN replace(props, ' ', '') WHEN 4 THEN 'abc' END AS v_string FROM events""")
def resolve_variant(t):
    """Whole numbers, fractions, booleans, objects and texts in one column: no value is lost."""
    mixed = t.events.select("event_id", F.parse_json(F.expr(MIXED_JSON.format(text="STRING"))).alias("v"))
    return shaping.resolve_choice(mixed, [("v", "make_cols")], types=("long", "double", "boolean", "string"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def drop_null_fields(t):
    empty = F.nullif("o_orderstatus", "o_orderstatus")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", empty.alias("by_data"),
                             F.lit(None).alias("by_type"))
    return shaping.drop_null_fields(shaping.drop_null_fields(orders), by="data")


@query("SELECT o_orderkey, o_orderdate AS placed FROM orders")
def drop_and_rename(t):
    orders = t.orders.select("*", F.struct("o_orderstatus", "o_orderpriority").alias("state"))
    slim = shaping.drop_fields(orders, ["o_custkey", "state.o_orderstatus", "o_orderstatus", "o_totalprice"])
    return shaping.select_fields(shaping.rename_field(slim, "o_orderdate", "placed"), ["o_orderkey", "placed"])


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'one' WHEN 'O' THEN 'two' ELSE 'other' END AS value_desc
          FROM orders""")
def case_value(t):
    return t.orders.select("o_orderkey",
                           scalar.label_values("o_orderstatus", {"F": "one", "O": "two"}, "other").alias("value_desc"))


@query("SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders")
def null_normalise(t):
    return shaping.null_normalise(t.orders.select("o_orderkey", "o_orderpriority"), ["o_orderpriority"],
                                  "4-NOT SPECIFIED")


@query("""
    WITH r AS (
      SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment, n_name, r_name,
             '-' || c_nationkey || '.' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS lat,
             '1' || c_nationkey || '.' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS lng,
             c_custkey || ' ' || c_mktsegment || ' St, ' || n_name || ', ' || r_name AS address
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT to_timestamp(1519516800 + c_custkey)::TIMESTAMP AS "timestamp",
           CAST(split_part(lat, '.', 2) || split_part(lng, '.', 2) ||
                CASE WHEN c_nationkey < 10 THEN '0' ELSE '' END || c_nationkey AS BIGINT) AS sensorid,
           r_name || '-' || n_name || '-' || c_mktsegment || 'St-' || c_custkey || '-' ||
             CASE WHEN c_nationkey < 10 THEN '0' ELSE '' END || c_nationkey AS sensorname,
           CAST(CAST(lat AS DECIMAL(8,4)) AS DOUBLE) AS latitude, CAST(CAST(lng AS DECIMAL(8,4)) AS DOUBLE) AS longitude,
           CAST(c_custkey AS VARCHAR) AS block, c_mktsegment || ' St' AS street, n_name AS city, r_name AS state,
           c_acctbal AS temperature, c_nationkey AS number, '["' || lat || '","' || lng || '"]' AS location, address
    FROM r""")
def sensor_flatten(t):
    places = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    latitude = F.concat(F.lit("-"), "c_nationkey", F.lit("."), F.format_string("%06d", "c_custkey"))
    longitude = F.concat(F.lit("1"), "c_nationkey", F.lit("."), F.format_string("%04d", "c_nationkey"))
    address = F.concat("c_custkey", F.lit(" "), "c_mktsegment", F.lit(" St, "), "n_name", F.lit(", "), "r_name")
    readings = places.select(
        (F.lit(1519516800) + F.col("c_custkey")).alias("timestamp"), F.col("c_acctbal").alias("temperature"),
        F.struct(F.col("c_nationkey").alias("number"), F.array(latitude, longitude).alias("location"),
                 address.alias("address")).alias("sensor"))
    flat = sensors.flatten(readings)
    return flat.withColumns({"timestamp": as_ntz("timestamp"), "latitude": F.col("latitude").cast("double"),
                             "longitude": F.col("longitude").cast("double")})


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS path, CAST(o_orderdate AS DATE) AS day FROM orders""")
def date_path(t):
    return t.orders.select("o_orderkey", scalar.date_path("o_orderdate").alias("path"),
                           scalar.parse_us_date(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("day"))


@query("SELECT o_orderkey, o_orderdate + INTERVAL 1 SECOND AS at FROM orders")
def parse_datetime(t):
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 00:00:01"))
    return t.orders.select("o_orderkey", scalar.parse_datetime(text).alias("at")).withColumn("at", as_ntz("at"))


@query("""SELECT o_orderkey, CAST(epoch(coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END,
                 o_orderdate + INTERVAL 1 DAY)) AS BIGINT) AS epoch FROM orders""")
def epoch_fallback(t):
    first = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    second = F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")
    return t.orders.select("o_orderkey", scalar.epoch_with_fallback(first, second).alias("epoch"))


@query("SELECT event_id, 'prod' AS env, event_type AS kind, CAST(user_id AS VARCHAR) || ':x' AS who FROM events")
def tag_map(t):
    tags = F.array(F.lit("env:prod"), F.concat(F.lit("kind:"), "event_type"),
                   F.concat(F.lit("who:"), "user_id", F.lit(":x")))
    tagged = t.events.select("event_id", scalar.tags_to_map(tags).alias("tags"))
    return tagged.select("event_id", *[F.col("tags")[k].alias(k) for k in ("env", "kind", "who")])


@query("SELECT event_id, event_type FROM events WHERE event_type = 'click' AND value < 35")
def dimension_filter(t):
    size = F.when(F.col("value") < 35, "small").otherwise("large")
    tagged = t.events.withColumn("dims", F.create_map(F.lit("kind"), F.col("event_type"), F.lit("size"), size))
    return tagged.filter(dimensions_match("dims", {"kind": "click", "size": "small"})).select("event_id", "event_type")


@query("""SELECT event_id FROM events WHERE event_type IN ('error', 'purchase') AND value >= 100""")
def event_match(t):
    state = F.when(F.col("value") >= 100, "SUCCEEDED").otherwise("FAILED")
    payload = F.to_json(F.struct(
        F.lit("jobs").alias("source"), F.lit("Job State Change").alias("detail-type"),
        F.struct(F.col("event_type").alias("jobName"), state.alias("state"), "user_id").alias("detail")))
    pattern = {"source": ["jobs"], "detail-type": ["Job State Change"],
               "detail": {"jobName": ["error", "purchase"], "state": ["SUCCEEDED"]}}
    return (t.events.select("event_id", payload.alias("payload"))
            .filter(json_event_matches("payload", pattern)).select("event_id"))


@query("""SELECT p_partkey, CASE WHEN length(p_name) < 8 THEN p_name ELSE left(p_name, 8) || '...' END AS short,
                 lower(p_type) = lower('promo') AS promo,
                 '{"p_brand":"' || p_brand || '","p_size":' || p_size || '}' AS json
          FROM part""")
def text_functions(t):
    return t.part.select("p_partkey", scalar.ellipsize("p_name", 8).alias("short"),
                         scalar.same_text("p_type", F.lit("promo")).alias("promo"),
                         scalar.row_as_json("p_brand", "p_size").alias("json"))
