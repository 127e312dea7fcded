"""Language ID: held-out accuracy, decoding against brute force, defined results of odd rows."""

from __future__ import annotations

import itertools
import zlib

import numpy as np

from lakepipe.llm import language_id as G
from lakepipe.llm.queries import QUERIES

from ..conftest import SF_ORACLE
from .cases import AWKWARD, frame, rows


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    got = QUERIES["op5_language_id"](spark, SF_ORACLE).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    known = {d.lang for d in docs.values()}
    assert {r.lang_pred for r in got} <= known | {"und"}
    held = [r for r in got if r.held_out and len(docs[r.doc_id].text) > 40]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.98


def test_codes_are_far_apart():
    for k in (2, 3, 4, 6, 12):
        code = G.code_matrix(k)
        near = min((a != b).sum() for a, b in itertools.combinations(code, 2))
        assert near >= (2 ** (k - 2) if k <= G.EXHAUSTIVE else 8)
        assert (abs(code.sum(0)) < k).all()


def test_one_wrong_bit_is_corrected():
    code = G.code_matrix(4)
    for k, bit in itertools.product(range(4), range(code.shape[1])):
        m = G.Model(list("abcd"), code, np.zeros((G.BUCKETS + 1, code.shape[1])))
        m.weights[-1] = code[k] * 3
        m.weights[-1, bit] *= -1
        losses = m.losses(np.zeros((1, G.BUCKETS)))[0]
        assert losses.argmin() == k
        brute = [sum(np.log1p(np.exp(-c * f)) for c, f in zip(word, m.weights[-1], strict=True)) for word in code]
        assert np.allclose(losses, brute)


def test_labels_are_no_input_of_predictions(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = G.train(docs)
    pick = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in G.identify(df, model).collect())
    assert pick(docs) == pick(docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source"))


def test_awkward_rows(spark):
    data = AWKWARD + rows("12345 ²³ !!", "!", start=80) + rows("der die das und nicht", lang="de", start=90)
    out = {r.doc_id: r for r in G.learn_and_identify(frame(spark, data), G.F.lit(False)).collect()}
    for i in (1, 2, 3, 80, 81):
        assert (out[i].lang_pred, out[i].score, out[i].ambiguous) == ("und", 0.0, True)
    assert out[90].lang_pred == "de"
    one = G.learn_and_identify(frame(spark, rows("only one language here")), G.F.lit(False)).collect()[0]
    assert (one.lang_pred, one.score, one.second, one.ambiguous) == ("en", 1.0, None, False)
    none = G.learn_and_identify(frame(spark, rows("no label", lang=None)), G.F.lit(False)).collect()[0]
    assert (none.lang_pred, none.score) == ("und", 0.0)
    assert G.learn_and_identify(frame(spark, []), G.F.lit(False)).collect() == []
