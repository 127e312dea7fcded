"""Large JSON arrays read by ranges against Python's parser."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from lakepipe.errors import CheckFailed
from lakepipe.sources import json_ranges as R
from lakepipe.sources.json_docs import json_rows, read_json_files


@pytest.fixture()
def small_ranges(spark):
    """Ranges of some hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield 300
    for k in names:
        spark.conf.unset(k)


def value(rnd, depth=0):
    kind = rnd.randrange(9 if depth < 3 else 6)
    if kind < 2:
        return rnd.choice([1, -2.5, True, None, 10 ** 12])
    if kind < 6:
        return "".join(rnd.choice(['a', '"', "\\", "{", "}", "[", "]", ",", "é", "漢", "\n", " ", "😀"]) for _ in range(rnd.randrange(12)))
    if kind < 8:
        return {f"k{i}{rnd.choice(['', '}', ','])}": value(rnd, depth + 1) for i in range(rnd.randrange(4))}
    return [value(rnd, depth + 1) for _ in range(rnd.randrange(4))]


def read_back(df):
    return sorted((json.dumps(m, sort_keys=True) for r in df.collect() for m in json.loads(r.doc)))


@pytest.mark.parametrize("seed", range(4))
def test_random_arrays(spark, tmp_path, small_ranges, seed):
    rnd = random.Random(seed)
    want = []
    for f in range(3):
        members = [value(rnd) for _ in range(rnd.choice([1, 40, 120]))]
        want += members
        text = json.dumps(members, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, None, 1]))
        (tmp_path / f"f{f}.json").write_text(rnd.choice(["", " \n", "\t"]) + text + rnd.choice(["", "\n", "  "]), encoding="utf-8")
    docs = R.array_documents(spark, [str(tmp_path)])
    assert read_back(docs) == sorted(json.dumps(m, sort_keys=True) for m in want)
    assert R.ranges(spark, [str(tmp_path)]).select("file", "start").distinct().count() > 3


def test_members_across_many_ranges(spark, tmp_path, small_ranges):
    members = [{"a": "x" * 1000 + "}" * 50, "b": [{"c": "}{" * 300}] * 5}, 7, "}" * 2000, [], {}, [[1, [2, "]"]]], {"é}": ",]"}]
    (tmp_path / "a.json").write_text(json.dumps(members, ensure_ascii=False), encoding="utf-8")
    assert read_back(R.array_documents(spark, [str(tmp_path / "a.json")])) == sorted(json.dumps(m, sort_keys=True) for m in members)


def test_empty_arrays_and_malformed_files(spark, tmp_path, small_ranges):
    def docs(text):
        path = tmp_path / f"m{len(list(tmp_path.iterdir()))}.json"
        path.write_text(text, encoding="utf-8")
        return R.array_documents(spark, [str(path)]).collect()

    assert docs("[]") == [] and docs(" [ \n ] ") == []
    assert [r.doc for r in docs('[{"a": 1}]')] == ['[{"a": 1}]']
    for text in ('[{"a": 1}', '[{"a": "x}]', '[[1]'):
        with pytest.raises(CheckFailed, match="not one JSON document"):
            docs(text)
    for text in ("[1,,2]", "[1, ]", '[{"a": 1}] x', "[1] [2]", "[1], {}"):
        with pytest.raises(Exception, match="missing|outside the array|not one JSON document"):
            docs(text)


def test_reader_takes_ranges_for_large_arrays_only(spark, tmp_path, small_ranges):
    big = [{"id": i, "t": f"text {i}, with }} and ]"} for i in range(100)]
    (tmp_path / "big.json").write_text(json.dumps(big))
    (tmp_path / "object.json").write_text(json.dumps({"id": 1000, "t": "one object " * 60}))
    (tmp_path / "small.json").write_text('[{"id": 2000, "t": "s"}]')
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"id": 3000 + i, "t": "n" * 50}) for i in range(20)))
    (tmp_path / "more.jsonl").write_text('{"id": 4000, "t": "l"}\n\n')
    (tmp_path / "scalar.json").write_text('"only text"')
    docs = read_json_files(spark, str(tmp_path))
    assert docs.where(F.col("source_file").endswith("big.json")).count() == 100
    rows = {(r.id, r.t, r.value) for r in json_rows(docs).collect()}
    assert rows == ({(r["id"], r["t"], None) for r in big} | {(1000, "one object " * 60, None), (2000, "s", None), (4000, "l", None)}
                    | {(3000 + i, "n" * 50, None) for i in range(20)} | {(None, None, "only text")})


def test_summaries_compose():
    """Cut anywhere, a text's ranges have the state that the whole text has there."""
    rnd = random.Random(9)
    text = json.dumps([value(rnd) for _ in range(60)])
    pieces = text.split("}")
    cuts = [pieces[0], *("}" + p for p in pieces[1:])]
    inside, depth, commas = False, 0, 0
    total = R.Summary()
    for piece in cuts:
        part = R.Summary()
        part.add(piece)
        k = int(inside)
        commas += part.commas[k][1 - depth]
        depth += part.gain[k]
        inside ^= bool(part.flips & 1)
        total.add(piece)
    assert (inside, depth, commas) == (False, 0, 59) and total.gain[0] == 0 and total.commas[0][1] == 59
