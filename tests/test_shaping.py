from decimal import Decimal

import pytest

from millrace.operators import shaping
from millrace.plans import sensors
from millrace.sources.files import read_json_array


def test_apply_mapping_unnests_renames_and_casts(spark):
    df = spark.createDataFrame([(7, ("bob", 12), "x")], "id BIGINT, actor STRUCT<login: STRING, id: BIGINT>, junk STRING")
    out = shaping.apply_mapping(df, [("actor.id", "int", "actor.id", "int"), ("actor.login", "string", "login", "string"),
                                     ("id", "long", "id", "string"), ("junk", "string", "n", "long"),
                                     ("actor", "struct", "actor", "string")])
    assert out.columns == ["actor.id", "login", "id", "n", "actor"]
    assert tuple(out.first()) == (12, "bob", "7", None, '{"login":"bob","id":12}')


def test_drop_fields(spark):
    df = spark.createDataFrame([(1, 2, (3, 4))], "`.journeyid` INT, b INT, s STRUCT<x: INT, y: INT>")
    out = shaping.drop_fields(df, ["`.journeyid`", "s.x"])
    assert out.columns == ["b", "s"] and tuple(out.first()["s"]) == (4,)


def test_drop_null_fields(spark):
    df = spark.sql("SELECT 1 AS a, NULL AS b, CAST(NULL AS INT) AS c, named_struct('x', 1, 'y', NULL) AS s")
    by_type = shaping.drop_null_fields(df)
    assert by_type.columns == ["a", "c", "s"] and by_type.schema["s"].dataType.names == ["x"]
    assert shaping.drop_null_fields(by_type, by="data").columns == ["a", "s"]


def test_resolve_choice(spark, rows):
    df = spark.createDataFrame([("1001",), ("abc",), (None,)], "`provider id` STRING")
    cast = shaping.resolve_choice(df, [("provider id", "cast:long")])
    assert rows(cast) == [(1001,), (None,), (None,)]
    cols = shaping.resolve_choice(df, [("provider id", "make_cols")])
    assert cols.columns == ["provider id_long", "provider id_string"]
    assert rows(cols) == [(1001, None), (None, "abc"), (None, None)]
    struct = shaping.resolve_choice(df, [("provider id", "make_struct")])
    assert [tuple(r[0]) for r in struct.collect()] == [(1001, None), (None, "abc"), (None, None)]
    with pytest.raises(ValueError):
        shaping.resolve_choice(df, [("provider id", "unknown")])


def test_resolve_choice_on_variant(spark, rows):
    df = spark.createDataFrame([("1001",), ('"abc"',), ('"7"',)], "j STRING").selectExpr("parse_json(j) AS v")
    assert rows(shaping.resolve_choice(df, choice="make_cols")) == [(1001, None), (None, "7"), (None, "abc")]
    assert rows(shaping.resolve_choice(df, [("v", "cast:long")])) == [(1001,), (7,), (None,)]


def test_choice_column_of_a_json_file(spark, rows, tmp_path):
    (tmp_path / "p.json").write_text('{"provider id": 1001}\n{"provider id": "abc"}\n')
    df = spark.read.schema("`provider id` VARIANT").json(str(tmp_path))
    assert rows(shaping.resolve_choice(df, choice="make_cols")) == [(1001, None), (None, "abc")]
    struct = shaping.resolve_choice(df, choice="make_struct")
    assert sorted(map(str, (tuple(r[0]) for r in struct.collect()))) == ["(1001, None)", "(None, 'abc')"]


def test_unbox(spark):
    df = spark.createDataFrame([(1, '{"a":3,"b":"foo","c":1.2}'), (2, "broken")], "id INT, json STRING")
    typed = shaping.unbox(df, "json", "a INT, b STRING, c DOUBLE")
    assert [tuple(r) for r in typed.orderBy("id").collect()] == [(1, 3, "foo", 1.2), (2, None, None, None)]
    found = shaping.unbox(df, "json")
    assert found.schema.simpleString() == "struct<id:int,a:bigint,b:string,c:double>"
    assert shaping.unbox(df, "json", flatten=False).first()["json"]["b"] == "foo"


def test_relationalize(spark, rows):
    df = spark.createDataFrame(
        [(1, ("x", ["p", "q"]), [(10, [1, 2]), (20, [])]), (2, ("y", None), [])],
        "id INT, s STRUCT<name: STRING, tags: ARRAY<STRING>>, items: ARRAY<STRUCT<sku: INT, sizes: ARRAY<INT>>>"
        .replace("items:", "items"))
    tables = shaping.relationalize(df, "root", key="id")
    assert set(tables) == {"root", "root_s.tags", "root_items", "root_items_sizes"}
    assert rows(tables["root"]) == [(1, "x", 1, 1), (2, "y", None, 2)]
    assert rows(tables["root_s.tags"]) == [(1, 0, "p"), (1, 1, "q")]
    items = tables["root_items"]
    assert items.columns == ["id", "index", "val.sku", "val.sizes"]
    assert rows(items) == [(1, 0, 10, "1:0"), (1, 1, 20, "1:1")]
    assert rows(tables["root_items_sizes"]) == [("1:0", 0, 1), ("1:0", 1, 2)]


def test_relationalize_generates_ids_that_agree(spark):
    df = spark.range(100).selectExpr("id AS n", "array(id, id + 1) AS pair")
    tables = shaping.relationalize(df, "r")
    joined = tables["r"].withColumnRenamed("pair", "fk").join(tables["r_pair"].withColumnRenamed("id", "fk"), "fk")
    assert joined.filter("val - index = n").count() == 200


def test_null_token_and_remap(spark, rows):
    df = spark.createDataFrame([("null", "a"), ("9", "b")], "sponsor_id STRING, service STRING")
    out = shaping.remap(shaping.null_normalise(df, ["sponsor_id"]), "service", "dd.service")
    assert out.columns == ["sponsor_id", "dd.service"] and rows(out) == [("9", "b"), (None, "a")]


READINGS = """[
{"timestamp": 1519516800, "temperature": 20.5, "sensor": {"number": 4, "location": ["-48.8712", "-151.6866"], "address": "123 Main St, LAX, CA"}},
{"timestamp": 1519516801, "temperature": null, "sensor": {"number": 123, "location": ["-48.8712"], "address": "Main"}}
]"""


@pytest.mark.parametrize("per_line", [False, True])
def test_sensor_readings(spark, tmp_path, per_line):
    (tmp_path / "r.json").write_text(READINGS)
    readings = read_json_array(spark, str(tmp_path), sensors.READING, per_line)
    flat = sensors.flatten(readings)
    assert dict(flat.dtypes)["latitude"] == "decimal(8,4)" and dict(flat.dtypes)["sensorid"] == "bigint"
    first, second = flat.orderBy("timestamp").collect()
    assert str(first["timestamp"]) == "2018-02-25 00:00:00"
    assert first["sensorid"] == 8712686604 and first["sensorname"] == "CA-LAX-MainSt-123-04"
    assert (first["latitude"], first["longitude"]) == (Decimal("-48.8712"), Decimal("-151.6866"))
    assert (first["block"], first["street"], first["city"], first["state"]) == ("123", "Main St", "LAX", "CA")
    assert first["location"] == '["-48.8712","-151.6866"]'
    assert second["block"] == "Main"
    assert all(second[c] is None for c in ("longitude", "sensorid", "sensorname", "street", "city", "state"))
