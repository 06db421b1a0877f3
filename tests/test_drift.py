"""Payloads that differ from the declared schema."""

import copy
import json

from helpers import rows
from pyspark.sql import types as T

from velotide import schemas
from velotide.operators import drift
from velotide.operators.decode import decode_status

STATION = {
    "is_installed": 1, "is_renting": 1, "is_returning": 1, "last_reported": 1735689600, "num_bikes_available": 3,
    "num_bikes_available_types": {"electric": 1, "smart": 0, "classic": 2}, "num_docks_available": 4, "station_id": "hub_1",
}


def payloads(spark, *values):
    texts = [(v if isinstance(v, str) else json.dumps(v),) for v in values]
    return spark.createDataFrame(texts, "value string")


def payload(**changes):
    return {"data": {"stations": [{**copy.deepcopy(STATION), **changes}]}, "last_updated": 1, "ttl": 60, "version": "1.1"}


def found(df):
    return rows(df, "kind", "path", "declared", "found", "payloads")


def test_no_drift(spark):
    assert found(drift.schema_drift(payloads(spark, payload(), payload(station_id="hub_2")))) == []
    assert drift.schema_drift(payloads(spark, payload()).limit(0)).collect() == []


def test_each_kind_by_path(spark):
    df = payloads(
        spark,
        payload(),
        payload(num_docks_available="4"),
        payload(battery={"volts": [12.5, 11.0]}),
        payload(battery={"volts": [12.5]}, num_docks_available="5"),
        payload(station_id=None),
        "no json",
        '{"data": 5}',
    )
    station = "data.stations[]"
    assert found(drift.schema_drift(df)) == sorted(
        [
            ("retyped", f"{station}.num_docks_available", "int", "STRING", 2),
            ("unknown", f"{station}.battery", None, "OBJECT", 2),
            ("unknown", f"{station}.battery.volts", None, "ARRAY", 2),
            ("unknown", f"{station}.battery.volts[]", None, "DECIMAL", 2),
            ("unreadable", "$", None, None, 1),
            ("retyped", "data", "struct", "BIGINT", 1),
        ],
        key=repr,
    )


def test_missing_fields_by_group(spark):
    whole, less = payload(), payload()
    del less["data"]["stations"][0]["num_bikes_available_types"]["smart"]
    df = spark.createDataFrame([("a", json.dumps(whole)), ("b", json.dumps(less)), ("b", json.dumps(less)), (None, "x")], "g string, value string")
    got = [tuple(r) for r in drift.schema_drift(df, by=["g"]).collect()]
    assert ("b", "missing", "data.stations[].num_bikes_available_types.smart", "int", None, 0) in got
    assert not [r for r in got if r[0] == "a"]
    assert (None, "unreadable", "$", None, None, 1) in got


def test_rows_still_decode(spark):
    same = decode_status(payloads(spark, payload(battery=5, num_bikes_available=9)))
    assert rows(same) == rows(decode_status(payloads(spark, payload(num_bikes_available=9))))


def test_odd_names_and_types(spark):
    df = payloads(spark, '{"a b": {"c:d, >": 1, "`": true}, "e": [[1, "x"], []], "f": 1.5e300, "g": null}')
    paths = {r["path"]: r["found"] for r in drift.schema_drift(df, schema="g string").collect()}
    assert paths == {"a b": "OBJECT", "a b.c:d, >": "BIGINT", "a b.`": "BOOLEAN", "e": "ARRAY", "e[]": "ARRAY", "e[][]": "VARIANT", "f": "DOUBLE"}


def test_declared_paths():
    got = drift.declared_paths(T.StructType.fromDDL(schemas.STATUS_PAYLOAD))
    assert got[1:4] == [("data", "struct"), ("data.stations", "array"), ("data.stations[]", "struct")]
