"""The corpus pipeline: five stages from raw documents to token digests.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all rows its predecessor kept. All but the
last return the columns of ``documents``:

* ``quality_rules`` drops documents that fail the fixed limits or are outliers of their language and source;
* ``line_dedup`` removes repeated chunks of lines from the texts, and documents of which no word is left;
* ``near_dedup`` keeps one document of each group of near copies (five-word shingles, similarity 0.8);
* ``decontamination`` drops documents that hold a benchmark passage;
* ``bpe`` encodes and decodes what is left: one row per document with the digests.

``run`` writes each stage's result to the shared folder and reads it back, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakepipe.llm import bpe, decontamination, line_dedup, near_dedup, quality_rules
from lakepipe.llm._base import documents, drop_written, written
from lakepipe.llm.queries import WORD_BPE


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digest(docs, WORD_BPE)


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_stage),
          ("decontamination", benchmark_stage), ("bpe", bpe_stage)]

# iterative estimates, groups over links and the tokenizer have no form in SQL: see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        out = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if i:
            drop_written(docs)
        docs = out
    return docs
