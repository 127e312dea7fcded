"""Operators: merge, reshape, quality checks, ordering, output tail."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.errors import CheckFailed
from lakepipe.operators import (flatten, global_row_number, null_safe_merge, output_tail,
                                unpivot, zip_lists)
from lakepipe.operators import quality as Q
from lakepipe.schema import ColumnSpec, OutputSchema, unsigned_decimal, unsigned_tinyint, varchar


def test_merge_null_keys_suffixes_and_unmatched(spark):
    left = spark.createDataFrame([(1, None, 10, "l1"), (2, "b", 20, "l2"), (3, "c", 30, "l3")],
                                 "k1 int, k2 string, v int, only_l string")
    right = spark.createDataFrame([(1, None, 100, "r1"), (2, "b", 200, "r2"), (4, "d", 400, "r4")],
                                  "k1 int, k2 string, v int, only_r string")
    out = null_safe_merge(left, right, ["k1", "k2"], "outer")
    assert out.columns == ["k1", "k2", "v_x", "only_l", "v_y", "only_r"]
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [(1, None, 10, "l1", 100, "r1"), (2, "b", 20, "l2", 200, "r2"),
                    (3, "c", 30, "l3", None, None), (4, "d", None, None, 400, "r4")]
    inner = null_safe_merge(left, right, ["k1", "k2"], "inner")
    assert inner.count() == 2
    lj = null_safe_merge(left, right, ["k1", "k2"], "left")
    assert lj.count() == 3


def test_unpivot_casts_to_common_type(spark):
    df = spark.createDataFrame([("a", 1, Decimal("2.50"))], "id string, n int, m decimal(5,2)")
    out = unpivot(df, ["id"], var_name="kpi_name", value_name="value", value_type="string")
    assert sorted(tuple(r) for r in out.collect()) == [("a", "m", "2.50"), ("a", "n", "1")]


def test_zip_lists_rules(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1, 2]), (2, [], []), (3, None, None), (4, ["x"], None)],
                               "id int, tags array<string>, scores array<int>")
    rows = sorted(tuple(r) for r in zip_lists(df, ["tags", "scores"]).collect())
    assert rows == [(1, "a", 1), (1, "b", 2), (3, None, None), (4, "x", None)]
    bad = spark.createDataFrame([(1, ["a", "b"], [1])], "id int, tags array<string>, scores array<int>")
    with pytest.raises(Exception, match=r"differ in length \(\w+=\d, \w+=\d\)"):
        zip_lists(bad, ["tags", "scores"]).collect()


def test_flatten_three_levels_keeps_lists(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1, 'd', 'x')) AS a, "
                   "array(named_struct('q', 1)) AS l, 5 AS s")
    out = flatten(df)
    assert out.columns == ["a.b.c", "a.b.d", "l", "s"]
    assert tuple(out.first()) == (1, "x", [T.Row(q=1)], 5)


def test_pk_violations_treat_null_keys_as_equal(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c")], "k int, v string")
    rows = sorted((tuple(r) for r in Q.pk_violations(df, ["k", "v"]).collect()), key=repr)
    assert rows == sorted([(1, "a", 2), (None, "b", 2)], key=repr)


SCHEMA = OutputSchema(
    "t", ColumnSpec("id", T.LongType(), primary_key=True),
    unsigned_tinyint("small", default=0), unsigned_decimal("amount", 5, 2),
    varchar("name", 3, nullable=False))


def test_enforce_output_order_of_checks(spark):
    dup = spark.createDataFrame([(1, 1, Decimal(1), "a"), (1, 2, Decimal(1), None)],
                                "id long, small int, amount decimal(10,2), name string")
    with pytest.raises(CheckFailed, match="more than once"):
        Q.enforce_output(dup, SCHEMA)
    nul = spark.createDataFrame([(1, 1, Decimal(1), "a"), (2, 2, Decimal(1), None)],
                                "id long, small int, amount decimal(10,2), name string")
    with pytest.raises(CheckFailed) as e:
        Q.enforce_output(nul, SCHEMA)
    assert (e.value.check, e.value.where) == ("not_null", "name")
    rng = spark.createDataFrame([(1, 300, Decimal("1000.00"), "abcd")],
                                "id long, small int, amount decimal(10,2), name string")
    with pytest.raises(CheckFailed, match="outside"):
        Q.enforce_output(rng, SCHEMA)
    viol = {r["column_name"]: r["out_of_range"] for r in Q.range_violations(rng, SCHEMA).collect()}
    assert viol == {"small": 1, "amount": 1, "name": 1}


def test_output_tail_projects_cleans_defaults_and_casts(spark):
    df = spark.createDataFrame([(1, None, Decimal("1.5"), " ab ", "extra"), (2, 3, None, "NULL", "x")],
                               "id long, small int, amount decimal(10,2), name string, other string")
    out = output_tail(df, SCHEMA)
    assert out.columns == ["id", "small", "amount", "name"]
    assert out.schema["small"].dataType == T.ShortType()
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0, Decimal("1.50"), "ab"),
                                                       (2, 3, None, None)]
    with pytest.raises(CheckFailed, match="missing"):
        output_tail(df.drop("name"), SCHEMA)


def test_null_counts_and_all_null_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "a int, b string, c string")
    got = {r["column_name"]: (r["null_count"], r["non_null"]) for r in Q.null_counts(df).collect()}
    assert got == {"a": (0, 2), "b": (2, 0), "c": (1, 1)}
    assert [r[0] for r in Q.all_null_columns(df).collect()] == ["b"]


def test_type_mismatches_bool_counts_as_int(spark):
    df = spark.createDataFrame([(True, "1", "x", 1.5)], "flag boolean, n string, s string, d double")
    exp = {"flag": T.IntegerType(), "n": T.IntegerType(), "s": T.IntegerType(), "d": T.StringType()}
    got = {r["column_name"]: r["mismatches"] for r in Q.type_mismatches(df, exp).collect()}
    assert got == {"flag": 0, "n": 0, "s": 1, "d": 1}
    with pytest.raises(CheckFailed, match="missing"):
        Q.type_mismatches(df, {"nope": None})


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"), F.col("id").alias("u"))
    got = global_row_number(df, [F.col("k"), F.col("u")], "rn", num_partitions=7)
    exp = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "u")))
    assert sorted(tuple(r) for r in got.select("k", "u", "rn").collect()) == \
        sorted(tuple(r) for r in exp.select("k", "u", "rn").collect())


def test_zero_sum_days_and_invalid_options(spark):
    from datetime import datetime
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5), 0, 1), (datetime(2024, 1, 1, 6), 0, 2),
                                (datetime(2024, 1, 2, 1), 3, 0)], "ts timestamp_ntz, a int, b int")
    rows = sorted((str(r[0]), list(r[1])) for r in Q.zero_sum_days(df, "ts", ["a", "b"]).collect())
    assert rows == [("2024-01-01", ["a"]), ("2024-01-02", ["b"])]
    ev = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "t string")
    assert sorted(tuple(r) for r in Q.invalid_options(ev, "t", ["x"]).collect()) == [("y", 2)]


def test_validate_table_name():
    assert Q.validate_table_name("ok_1") == "ok_1"
    with pytest.raises(ValueError):
        Q.validate_table_name("bad; drop")


def test_python_types_in_validation_schema(spark):
    df = spark.createDataFrame([(1, 2.5, "x", True)], "i long, f double, s string, b boolean")
    got = {r["column_name"]: r["mismatches"]
           for r in Q.type_mismatches(df, {"i": int, "f": float, "s": int, "b": int}).collect()}
    assert got == {"i": 0, "f": 0, "s": 1, "b": 0}
    with pytest.raises(CheckFailed) as e:
        Q.enforce_types(df, {"i": int, "s": float})
    assert e.value.where == "s" and e.value.facts["declared"] is float


def test_remaining_domain_errors_carry_their_fields(spark):
    from datetime import date, datetime

    from lakepipe.sources.calendar import date_range
    ev = spark.createDataFrame([(datetime(2024, 1, 1, 3),), (datetime(2024, 1, 3, 4),)], "ts timestamp_ntz")
    with pytest.raises(CheckFailed) as e:
        Q.enforce_daily_completeness(ev, "ts", date_range(spark, "2024-01-01", "2024-01-03"), "events")
    assert e.value.where == "events" and e.value.facts == {"day": date(2024, 1, 2)}
    z = spark.createDataFrame([(datetime(2024, 1, 1), 0, 1)], "ts timestamp_ntz, a int, b int")
    with pytest.raises(CheckFailed) as e:
        Q.enforce_no_zero_sums(z, "ts", ["a", "b"])
    assert e.value.facts["columns"] == ["a"]
    with pytest.raises(CheckFailed) as e:
        Q.check_parameter("mode", "x", ["a", "b"])
    assert e.value.facts == {"value": "x", "options": ["a", "b"]} and "none of the options" in str(e.value)


def test_small_helpers(spark):
    from datetime import date, datetime

    from lakepipe.functions.dates import minutes_before, ntz_literal, start_of_day_before
    from lakepipe.operators.reshape import explode_list
    from lakepipe.operators.tail import clean_strings
    from lakepipe.sources.calendar import data_date_bounds, date_range
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, t array<string>")
    assert sorted(tuple(r) for r in explode_list(df, "t").collect()) == [(1, "a"), (1, "b")]
    s = spark.createDataFrame([(" x ", " y ")], "a string, b string")
    assert tuple(clean_strings(s, exclude=["b"]).first()) == ("x", " y ")
    with pytest.raises(TypeError):
        OutputSchema("bad", "not a column spec")
    row = spark.range(1).select(minutes_before(ntz_literal(datetime(2024, 1, 1, 0, 30)), 45).alias("a"),
                                start_of_day_before(datetime(2024, 1, 30, 23, 58)).alias("b")).first()
    assert row["a"] == datetime(2023, 12, 31, 23, 45) and row["b"] == datetime(2024, 1, 29)
    cal = date_range(spark, "2024-02-27", "2024-03-01")
    assert [r[0] for r in cal.orderBy("date").collect()] == [
        date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    ev = spark.createDataFrame([(datetime(2024, 1, 5, 3),), (datetime(2024, 1, 2, 9),)], "ts timestamp_ntz")
    assert data_date_bounds([(ev, "ts")]) == (date(2024, 1, 2), date(2024, 1, 5))


def test_sums_and_distinct_counts(spark):
    from lakepipe.operators.aggregate import sums_and_distinct
    rows = [("a", i % 700 * 50, Decimal("1.10")) for i in range(5000)] + [("b", -3, Decimal("2.00")), ("b", 3, None),
            ("b", 0, Decimal("1.00")), ("b", None, Decimal("4.00")), ("c", None, None), (None, 2**62, Decimal("1.00")),
            (None, -(2**62), Decimal("1.00"))]
    df = spark.createDataFrame(rows, "k string, id bigint, m decimal(10,2)").repartition(5)
    want = {("a", Decimal("5500.00"), 700), ("b", Decimal("7.00"), 3), ("c", None, 0), (None, Decimal("2.00"), 2)}
    out = sums_and_distinct(df, ["k"], ["m"], "id", "n")
    assert {tuple(r) for r in out.collect()} == want
    # any other type of id gives the same
    assert {tuple(r) for r in sums_and_distinct(df.withColumn("id", F.col("id").cast("string")), ["k"], ["m"], "id",
                                                "n").collect()} == want
    assert sums_and_distinct(df.limit(0), ["k"], ["m"], "id", "n").collect() == []


def test_distinct_counts_shuffle_partial_sets_only(spark):
    from lakepipe.operators.aggregate import sums_and_distinct
    df = spark.range(100_000, numPartitions=4).selectExpr("id % 3 AS k", "id", "1 AS m")
    out = sums_and_distinct(df, ["k"], ["m"], "id", "n")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("partial_bit_or"):]
    assert "Exchange" not in first and "Expand" not in plan


def test_abbreviations_by_table_equal_the_pattern(spark):
    import random

    from lakepipe.functions import abbreviate
    from lakepipe.operators.abbreviations import abbreviate_with, dictionary_table
    rnd = random.Random(17)
    parts = ["a", "b", "ab", "é", "éa", "St", ".", "-", " ", "'", "a b", "x_1", "漢", "\t"]
    cases = [([{"Street": "St", "Saint": "St.", "North": "N", "St": "Street"}, {"Road": "Rd", "North": "No", "a.b": "AB"}],
              ["Saint Street North", "Streetwise Road", "  North Road ", None, "St Street", "Roadster road Road.", "x a.b y", "a.bc", ""])]
    for _ in range(6):
        words = {"".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 5))) for _ in range(12)}
        dicts = [{w: rnd.choice(["", "Z", "a", "b b", "$1\\"]) for w in words if w.strip()}, {"b": "B", "St": "S"}]
        cases.append((dicts, ["".join(rnd.choice(parts) for _ in range(rnd.randrange(25))) for _ in range(80)]))
    for dicts, texts in cases:
        df = spark.createDataFrame([(i, t, "r") for i, t in enumerate(texts)], "id int, t string, row string").repartition(3)
        want = {r["id"]: r["w"] for r in df.select("id", abbreviate("t", dicts).alias("w")).collect()}
        out = abbreviate_with(df, "t", dictionary_table(spark, dicts), "short")
        assert out.columns == ["id", "t", "row", "short"]
        assert {r["id"]: r["short"] for r in out.collect()} == want


def test_abbreviations_of_a_large_dictionary(spark):
    from lakepipe.operators.abbreviations import abbreviate_with
    entries = spark.range(100_000).selectExpr("concat('word', id, IF(id % 3 = 0, ' of many', '')) AS entry", "concat('w', id) AS short", "id AS rank")
    texts = spark.range(2000).selectExpr("id", "concat('a word', id * 40, ' of many and word', id, ' word') AS t")
    out = {r["id"]: r["s"] for r in abbreviate_with(texts, "t", entries, "s").collect()}
    want = {i: f"a {'w' + str(i * 40) if (i * 40) % 3 == 0 else 'w' + str(i * 40) + ' of many'} and "
               f"{'word' + str(i) if i % 3 == 0 else 'w' + str(i)} word" for i in range(2000)}
    assert out == want
    assert abbreviate_with(texts, "t", entries.limit(0), "s").where("s = t").count() == 2000
