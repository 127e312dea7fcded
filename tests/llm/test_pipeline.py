"""The pipeline against its stages' brute-force versions, and what each stage keeps."""

from __future__ import annotations

import hashlib
import re
import struct

import corpus_pipeline as P
from tokenizers import Tokenizer

from lakepipe.llm.queries import WORD_BPE

from ..conftest import SF_ORACLE
from . import test_decontamination, test_line_dedup, test_near_dedup, test_quality_rules
from .cases import AWKWARD, SCHEMA, frame


def brute(docs, items):
    """(id, text) that come out of the first four stages, from (id, text, lang, source)."""
    kept = {i for i, (_, _, keep) in test_quality_rules.verdicts(docs).items() if keep}
    left = [(i, t) for i, t, _, _ in docs if i in kept]
    lines = test_line_dedup.brute(left)
    left = [(i, lines[i][2]) for i, _ in left if lines[i][1] == 0 or re.search(r"[^\x20\x09-\x0D]", lines[i][2])]
    groups = test_near_dedup.brute(left, 5)
    left = [(i, t) for i, t in left if groups[i][1] == i]
    leaked = {d for d, _ in test_decontamination.brute(left, items)}
    return [(i, t) for i, t in left if i not in leaked]


def test_pipeline_matches_brute_force(spark):
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()]
    library = Tokenizer.from_file(WORD_BPE)
    want = set()
    for i, t in brute(docs, items):
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.add((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                  hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in P.run(spark, SF_ORACLE).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert set(got) == want and len(got) == len(want) > 300


def test_stages_keep_columns_and_odd_rows(spark):
    for data in (AWKWARD, []):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, frame(spark, data), SF_ORACLE)
            assert out.schema.names == SCHEMA.names, name
            assert set(out.collect()) <= {tuple(r) for r in data}, name
    extra = ["_id", "_key", "_removed", "_gone", "_leaked", "id", "removed", "gone", "leaked", "left", "whole", "stats", "row"]
    clashing = frame(spark, AWKWARD).selectExpr("*", *[f"'{c}' AS `{c}`" for c in extra])
    for name, stage in P.STAGES:
        out = stage(spark, clashing, SF_ORACLE)
        assert name == "bpe" or out.columns == clashing.columns, name
        assert name == "bpe" or all(r[c] == c for r in out.collect() for c in extra), name
    assert P.ORACLE_SQL is None and [n for n, _ in P.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "bpe"]
