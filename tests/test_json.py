"""JSON documents → rows (R2–R6, S6–S9, Q3–Q5, A8) on hand-written documents."""

from __future__ import annotations

import json
import os

import pytest

from lakepipe.errors import CheckFailed, NotFound
from lakepipe.sources.json_docs import json_rows, read_json_files, variant_type_to_ddl


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def _docs(spark, docs):
    return spark.createDataFrame([(d,) for d in docs], "doc string")


def test_list_of_objects_and_scalars(spark):
    df = _docs(spark, ['[{"a": 1}, {"a": 2, "b": "x"}, 7]'])
    cols, rows = _rows(json_rows(df, deduplicate=False))
    assert cols == ["a", "b", "value"]
    assert rows == sorted([(1, None, None), (2, "x", None), (None, None, 7)], key=repr)


def test_single_list_explodes_and_empty_list_gives_no_row(spark):
    df = _docs(spark, ['{"id": 1, "t": ["a", "b"]}', '{"id": 2, "t": []}', '{"id": 3}'])
    cols, rows = _rows(json_rows(df))
    assert cols == ["id", "t"]
    assert rows == sorted([(1, "a"), (1, "b"), (3, None)], key=repr)


def test_several_lists_zip_or_fail(spark):
    ok = _docs(spark, ['{"id": 1, "t": ["a", "b"], "s": [1, 2]}'])
    assert _rows(json_rows(ok))[1] == [(1, 1, "a"), (1, 2, "b")]
    bad = _docs(spark, ['{"id": 1, "t": ["a", "b"], "s": [1]}'])
    with pytest.raises(Exception, match=r"differ in length \(\w+=\d, \w+=\d\)"):
        json_rows(bad).collect()


def test_scalar_and_null_documents(spark):
    df = _docs(spark, ["5", "null", None, "6", "5"])
    cols, rows = _rows(json_rows(df))
    assert cols == ["value"] and rows == [(5,), (6,)]


def test_flatten_nested_objects_and_switch_off(spark):
    df = _docs(spark, ['{"u": {"id": 1, "f": {"odd": true}}, "l": [{"q": 1}]}'])
    cols, rows = _rows(json_rows(df))
    assert cols == ["l.q", "u.f.odd", "u.id"]          # the single list is exploded
    assert rows == [(1, True, 1)]
    raw = json_rows(df, flatten=False)
    assert sorted(raw.columns) == ["l", "u"]


def test_members_of_list_documents_keep_their_lists_by_default(spark):
    df = _docs(spark, ['[{"id": 1, "t": ["a", "b"]}]', '{"id": 2, "t": ["c"]}'])
    cols, rows = _rows(json_rows(df))
    assert rows == sorted([(1, '["a","b"]'), (2, "c")], key=repr)
    cols, rows = _rows(json_rows(df, explode_lists="record"))
    assert rows == sorted([(1, "a"), (1, "b"), (2, "c")], key=repr)


def test_mixed_types_become_text_and_dedup(spark):
    df = _docs(spark, ['{"id": 1}', '{"id": "x"}', '{"id": 1}'])
    cols, rows = _rows(json_rows(df))
    assert rows == [("1",), ("x",)]


def test_schema_validation(spark):
    df = _docs(spark, ['{"id": 1, "flag": true, "name": "a"}'])
    from pyspark.sql import types as T
    json_rows(df, schema={"id": T.LongType(), "flag": T.IntegerType(), "name": None})
    with pytest.raises(CheckFailed, match="name"):
        json_rows(df, schema={"name": T.LongType()})
    with pytest.raises(CheckFailed, match="missing"):
        json_rows(df, schema={"missing": None})


def test_read_json_files_directory_and_fallbacks(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    (d / "b.json").write_text('{"id": 3, "t": [1]}\n{"id": 4, "t": [2]}\n')  # NDJSON in .json
    (d / "p.json").write_text('{\n  "id": 8,\n  "t": [9]\n}\n')   # one pretty-printed document
    (d / "c.jsonl").write_text('{"id": 5}\n\n{"id": 6}\n')
    (d / "d.ndjson").write_text('{"id": 7}\n')
    (d / "e.json").write_text("   \n")                          # blank → skipped
    (d / "f.json").write_text("null")                           # null document → skipped
    (d / "g.txt").write_text('{"id": 99}')                      # other extension ignored
    docs = read_json_files(spark, str(d))
    cols, rows = _rows(json_rows(docs, "doc"))
    # NDJSON lines are list members (lists kept, as text); the pretty document's list explodes
    assert cols == ["id", "t"]
    assert rows == sorted([(1, None), (2, None), (3, "[1]"), (4, "[2]"), (5, None), (6, None),
                           (7, None), (8, "9")], key=repr)
    with pytest.raises(NotFound):
        read_json_files(spark, os.path.join(str(tmp_path), "missing"))


def test_variant_type_to_ddl():
    s = "OBJECT<`a b`: OBJECT<x: BIGINT>, l: ARRAY<VOID>, `OBJECT<`: STRING>"
    assert variant_type_to_ddl(s) == "STRUCT<`a b`: STRUCT<x: BIGINT>, l: ARRAY<STRING>, `OBJECT<`: STRING>"


def test_stored_shape_skips_inference_and_fixes_the_schema(spark):
    from lakepipe.sources.json_docs import JsonShape, infer_json_shape
    docs = _docs(spark, ['{"id": 1, "t": ["a", "b"], "u": {"x": 1}}', '[{"id": 2}, 9]'])
    shape = infer_json_shape(docs)
    assert shape == JsonShape("STRUCT<id: BIGINT, t: ARRAY<STRING>, u: STRUCT<x: BIGINT>>",
                              "BIGINT", True)
    assert _rows(json_rows(docs, shape=shape)) == _rows(json_rows(docs))
    # a later batch without "u" and without scalars keeps the same columns
    later = _docs(spark, ['{"id": 3, "t": ["c"]}'])
    out = json_rows(later, shape=shape)
    assert sorted(out.columns) == ["id", "t", "u.x", "value"]
    assert _rows(out)[1] == [(3, "c", None, None)]


def test_in_memory_objects(spark):
    from lakepipe.sources.json_docs import json_object_rows
    cols, rows = _rows(json_object_rows(spark, {"id": 1, "t": ["a", "b"], "u": {"x": 2}}))
    assert cols == ["id", "t", "u.x"] and rows == [(1, "a", 2), (1, "b", 2)]
    cols, rows = _rows(json_object_rows(spark, [{"a": 1}, {"a": 1}, 5]))
    assert rows == sorted([(1, None), (None, 5)], key=repr)
    assert json_object_rows(spark, []).count() == 0


def test_items_outside_a_given_shape_are_an_error(spark):
    from pyspark.errors import PySparkException

    from lakepipe.sources.json_docs import JsonShape, shape_misfits
    docs = _docs(spark, ['{"x": 1}', '7', '{"x": 2, "y": 3}', '{"x": 3, "u": {"a": 1, "b": 2}}', '[{"x": null}]'])
    shape = JsonShape("STRUCT<x: BIGINT, u: STRUCT<a: BIGINT>>", None, True)
    got = sorted((r.reason, r.item) for r in shape_misfits(docs, shape).collect())
    assert got == [("fields u.b", '{"u":{"a":1,"b":2},"x":3}'), ("fields y", '{"x":2,"y":3}'), ("value", "7")]
    with pytest.raises(PySparkException, match="declared shape"):
        json_rows(docs, shape=shape).collect()
    fits = _docs(spark, ['{"x": 1}', '[{"x": null}]'])
    assert len(json_rows(fits, shape=shape).collect()) == 2
    with pytest.raises(PySparkException, match="object"):
        json_rows(fits, shape=JsonShape(None, "BIGINT", False)).collect()


def test_types_are_those_of_the_documents(spark):
    """Text that looks like a number is no number; fractions are doubles; numbers are no text."""
    from pyspark.sql import types as T
    df = _docs(spark, ['{"x": 2.5}', '{"x": 1.25}'])
    out = json_rows(df, schema={"x": float})
    assert isinstance(out.schema["x"].dataType, T.DoubleType)
    for docs, kind in ((['{"x": "12"}'], int), (['{"x": "a"}', '{"x": 5}'], str), (['{"x": 2.5}'], int), (['{"x": 1}'], float)):
        with pytest.raises(CheckFailed, match="another type"):
            json_rows(_docs(spark, docs), schema={"x": kind})
    json_rows(_docs(spark, ['{"x": true, "t": ["a"]}', '{"x": null, "t": []}']), schema={"x": int, "t": str})


def test_fields_that_flatten_to_one_name_are_an_error(spark):
    with pytest.raises(CheckFailed, match="flatten"):
        json_rows(_docs(spark, ['{"a.b": 1, "a": {"b": 2}}']))
