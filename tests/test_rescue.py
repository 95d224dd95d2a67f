"""Nested records: typed where they fit, rescued by path where they do not."""

import json

import pytest
from pyspark.sql.types import StructType

from tidepool.sources.rescue import drift_counts, observed_fields, read_rescued

DDL = "a INT, s STRUCT<x: STRING, y: ARRAY<STRUCT<z: INT>>>, m MAP<STRING, ARRAY<INT>>, `odd.name` DATE"


def rows(spark, lines, **options):
    df = read_rescued(spark.createDataFrame([(x,) for x in lines], "value string"), StructType.fromDDL(DDL), **options)
    return [(r.asDict(recursive=True), json.loads(r._rescued_data) if r._rescued_data else None) for r in df.collect()]


def test_depths_and_types(spark):
    lines = ['{"a":1,"s":{"x":"q","y":[{"z":1},{"z":"w"},5,null]},"m":{"k":[1,"v"],"l":3},"odd.name":"2024-02-30"}',
             '{"a":null,"s":null,"odd.name":"2024-02-29","new":{"deep":[1]}}', '{"a":[1],"s":"text","m":[],"s2":1}', "[1]", "{", None, "{}", '{"s":{"u":1,"y":{}}}']
    got = rows(spark, lines)
    assert got[0][0]["s"] == {"x": "q", "y": [{"z": 1}, {"z": None}, None, None]} and got[0][0]["m"] == {"k": [1, None], "l": None}
    assert got[0][1] == {"$.s.y[1].z": "w", "$.s.y[2]": 5, "$.m.k[1]": "v", "$.m.l": 3, "$.odd.name": "2024-02-30"}
    assert str(got[1][0]["odd.name"]) == "2024-02-29" and got[1][1] == {"$.new": {"deep": [1]}}
    assert got[2][1] == {"$.a": [1], "$.s": "text", "$.m": [], "$.s2": 1}
    assert got[3][1] == {"_corrupt": "[1]"} and got[4][1] == {"_corrupt": "{"}
    assert got[5][1] is None and got[6][1] is None and set(got[6][0].values()) == {None}
    assert got[7][1] == {"$.s.u": 1, "$.s.y": {}}


def test_modes(spark):
    lines = ['{"a":1,"n":{"p":1}}', '{"a":"x","n":{"p":2,"q":"t"}}']
    assert [r for _, r in rows(spark, lines)] == [{"$.n": {"p": 1}}, {"$.a": "x", "$.n": {"p": 2, "q": "t"}}]
    assert [r for _, r in rows(spark, lines, mode="none")] == [None, {"$.a": "x"}]
    added = rows(spark, lines, mode="addNewColumns")
    assert [d["n"] for d, _ in added] == [{"p": 1, "q": None}, {"p": 2, "q": "t"}] and [r for _, r in added] == [None, {"$.a": "x"}]
    with pytest.raises(ValueError, match="new columns: n"):
        rows(spark, lines, mode="failOnNewColumns")
    with pytest.raises(ValueError, match="mode is one of"):
        rows(spark, lines, mode="merge")
    assert rows(spark, ['{"a":1}'], mode="failOnNewColumns")[0][1] is None
    seen = {r.field: (r.type, r.n_lines) for r in observed_fields(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert seen["a"] == ("VARIANT", 2) and seen["n"][0].startswith("STRUCT<p: BIGINT")


def test_drift_counts_values_and_rows(spark):
    lines = ['{"m":{"k":["a","b",1]}}', '{"m":{"k":["c"]},"a":"z"}', '{"a":1}']
    df = read_rescued(spark.createDataFrame([(x,) for x in lines], "value string"), StructType.fromDDL(DDL))
    assert sorted(map(tuple, drift_counts(df).collect())) == [("$.a", 1, 1), ("$.m.k[*]", 3, 2)]
    assert drift_counts(df.limit(0)).collect() == []


def test_flat_lines_are_typed_once(spark):
    """Each value is cast once; what doesn't fit, is unknown or is no object is kept, in the line's order."""
    from tidepool.sources.files import parse_with_rescue
    lines = {
        '{"a":"1","t":"2024-01-01 00:00:00","a.b":"x"}': (1, True, "x", None),
        '{"n":5,"a":"q","t":"bad","a.b":null}': (None, False, None, {"n": "5", "a": "q", "t": "bad"}),
        '{"a":null,"n":null}': (None, False, None, {"n": None}),
        '{"a":1,"a":"q"}': (1, False, None, None),
        "{}": (None, False, None, None),
        "[1]": (None, False, None, {"_corrupt": "[1]"}),
    }
    schema = StructType.fromDDL("a INT, t TIMESTAMP, `a.b` STRING, _misfits DOUBLE")
    got = parse_with_rescue(spark.createDataFrame([(x,) for x in lines], "value string"), schema)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") == 2  # a and _misfits
    rescued = [json.loads(r[4]) if r[4] else None for r in got.collect()]
    assert [(r[0], r[1] is not None, r[2]) for r in got.collect()] == [x[:3] for x in lines.values()]
    assert [{k: v for k, v in x.items() if v is not None} if x else x for x in rescued] == \
        [{k: v for k, v in x[3].items() if v is not None} if x[3] else x[3] for x in lines.values()]
    assert [list(x) for x in rescued if x and len(x) > 1] == [["n", "a", "t"]]
