"""Abbreviation with a dictionary table (T2) of any size.

``functions.abbreviate`` writes a dictionary into one pattern and one literal map, which suits some hundred entries. Here the
dictionary is a table. Texts and entries are cut into the same tokens (runs of word characters, and every other character
by itself), so an entry can only begin where its first token stands: the texts' tokens are joined with the entries on it, and
the tokens that follow decide. Entries that would begin or end inside a word are left out by the tokens around them.

Of the entries that match at one place the first listed wins, as in the pattern; then each text takes its matches from left to
right without overlaps, and replaced text is not looked at again. Only matches are grouped by text, never the tokens, so a
word that every text has costs a row where the dictionary has it and none where it has not. Spark broadcasts a dictionary below
its broadcast limit and shuffles tokens otherwise; a frequent first token is then a partition that it can split.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import merge_abbreviations, py_strip
from ..session import staged

#: A run of word characters, or one other character; the flag makes them those of Unicode.
_TOKEN = r"(?U)(?s)\w+|\W"
_WORD = r"(?U)^\w"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), 0)


def dictionary_table(spark: SparkSession, dicts: Iterable[Mapping[str, str]]) -> DataFrame:
    """(entry, short, rank) of merged dictionaries: later ones win, the first insertion gives the rank."""
    merged = merge_abbreviations(dicts)
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(merged.items())], "entry string, short string, rank long")


def abbreviate_with(df: DataFrame, column: str, dictionary: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: the text of ``column`` abbreviated by the table (entry, short, rank).

    Null text gives an empty one, results are stripped; entries that are null or empty match nothing. Of entries listed
    twice the one of least rank counts.
    """
    if name in df.columns:
        raise ValueError(f"the frame has a column {name} already")
    # rows get a number that stays theirs: they are read twice, for their matches and for the result
    rows = staged(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"))
                  .withColumn("row", F.monotonically_increasing_id()), "abbreviations")
    text = F.coalesce(F.col("whole").getField(column), F.lit(""))
    entries = (dictionary.where("entry IS NOT NULL AND entry <> ''")
               .select(tokens(F.col("entry")).alias("e"), F.coalesce("short", F.lit("")).alias("short"), "rank")
               .select(F.get("e", F.lit(0)).alias("first"), "e", "short", "rank"))
    longest = entries.agg(F.coalesce(F.max(F.size("e")), F.lit(1)).alias("n")).first()["n"]
    placed = (rows.select("row", tokens(text).alias("t")).select("row", "t", F.posexplode("t").alias("at", "first"))
              .select("row", "at", "first", F.slice("t", F.col("at") + 1, F.lit(longest + 1)).alias("ahead"),
                      F.get("t", F.col("at") - 1).alias("before")))
    met = placed.join(entries, "first").where(F.slice("ahead", F.lit(1), F.size("e")) == F.col("e"))

    def word(token: Column) -> Column:
        return F.coalesce(token.rlike(_WORD), F.lit(False))

    # a boundary lies between a word character and something else
    begins = word(F.col("first")) != word(F.col("before"))
    ends = word(F.get("e", F.size("e") - 1)) != word(F.get("ahead", F.size("e")))
    best = met.where(begins & ends).groupBy("row", "at").agg(
        F.min(F.struct("rank", F.size("e").alias("n"), "short")).alias("m"))
    matches = best.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "m.n", "m.short"))).alias("ms"))
    joined = rows.join(matches.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")

    def replaced(t: Column) -> Column:
        none = F.struct(F.lit("").alias("out"), F.lit(0).alias("next"))
        upto = lambda a, end: F.array_join(F.slice(t, a["next"] + 1, F.greatest(end - a["next"], F.lit(0))), "")
        taken = F.aggregate("ms", none, lambda a, m: F.when(m["at"] < a["next"], a).otherwise(F.struct(
            F.concat(a["out"], upto(a, m["at"]), m["short"]).alias("out"), (m["at"] + m["n"]).alias("next"))))
        return F.element_at(F.transform(F.array(taken), lambda a: F.concat(a["out"], upto(a, F.size(t)))), 1)

    of_tokens = F.element_at(F.transform(F.array(tokens(text)), replaced), 1)
    return joined.select(*[F.col("whole").getField(c).alias(c) for c in df.columns],
                         py_strip(F.when(F.col("ms").isNull(), text).otherwise(of_tokens)).alias(name))
