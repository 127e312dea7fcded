"""Quality rules (operator 8): fixed limits, then robust multivariate outliers per language and source.

Statistics of each whole text come from its words ``[^\\x20\\x09-\\x0D]+`` and ``\\n``-split lines: code points in
words, symbol characters, lines equal to an earlier line, words in repeated 5-word windows. A text
fails the fixed limits with fewer than ``MIN_WORDS`` words or over ``MAX_REPEAT_PERCENT`` percent repeated words.

The others form vectors of four transformed statistics (shares are smoothed by pseudo-counts, then arcsine
of the root; mean word length by its log). Each group gets a minimum-covariance-determinant estimate. Concentration steps
start from three estimates: medians and median deviations, means and the covariance of all rows, and medians with the
least scales. A step keeps the ``SUPPORT`` share of rows nearest to the estimate (by a histogram of distances) and re-estimates
centre and covariance from them, corrected for consistency; a start's steps go on until the determinant of the covariance stops
falling, and of the three the one with the least determinant is kept. A last step takes the rows within the 97.5 % quantile. A text
whose squared Mahalanobis distance is above ``CUTOFF`` is rejected: the covariance of its group decides. Only where a group varies
less than a statistic's resolution (``FLOORS``: many groups have no symbol at all), its deviation is set to that.

A group is one language and source with at least ``MIN_GROUP`` texts within the fixed limits; smaller ones of a language
are estimated together, and if these are too few as well, all of them over languages; below that nothing is
rejected by distance. Null languages and sources are groups of their own.

Everything runs as DataFrame expressions: a text's windows are compared inside its row, a group's sums and
histograms are aggregated before they are shuffled, so no group is ever gathered. Null text has no words
and fails; an empty table gives an empty result; repeated rows repeat; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._base import drop_written, histogram_quantile, let, word_array, written

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
MIN_GROUP = 40
SUPPORT = 0.75
#: Covariance of the nearest 75 % of four normal variables to that of all, and chi-square quantiles
#: of four degrees of freedom at 97.5 % and 99.99 %.
CONSISTENCY = 1.486
REWEIGHT = 11.14
CUTOFF = 23.51
#: Least deviations, the resolution of each statistic: 2 % of word length, one symbol in 2500 characters, one repeated
#: line in 100, one window of five repeated words in 780.
FLOORS = (0.02, 0.02, 0.10, 0.08)
#: A determinant has stopped falling if a step lowers it by less than this share.
SETTLED = 1e-6
DIMS = len(FLOORS)
#: Group tables of at most so many rows (under 10 MB) are broadcast; larger ones are joined by a shuffle.
BROADCAST_GROUPS = 20_000
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words covered by windows of WINDOW words that occur at least twice in the array."""
    def in_windows(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(
            F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered))

    def covered(ordered: Column) -> Column:
        same = lambda x, at: F.coalesce(F.get(ordered, at)["h"] == x["h"], F.lit(False))
        twice = F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return let(F.array_sort(F.transform(twice, lambda x: x["i"])), lambda at: F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                          lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(windows, in_windows))


def statistics(text: Column) -> Column:
    """A struct of the statistics of a text, and its number of lines that have a word."""
    t = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
        return let(lines, lambda ls: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.size(F.split(t, "[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(ls).cast("long").alias("n_lines")))

    return let(word_array(t), of_words)


def base_failed(s: Column) -> Column:
    """Whether a text fails the fixed limits."""
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def vector(s: Column) -> list[Column]:
    """Transformed statistics, smoothed so that short texts vary little more than long ones."""
    share = lambda n, of, pseudo: F.asin(F.sqrt(F.least(F.lit(1.0), s[n] / (s[of] + pseudo))))
    return [F.log((s["word_chars"] + 250.0) / (s["n_words"] + 50.0)), share("n_symbols", "word_chars", 100.0),
            share("n_dup_lines", "n_lines", 10.0), share("n_repeat_words", "n_words", 50.0)]


def _distance(x: list[Column], m: list[Column], cov: Column) -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor ``cov``."""
    y: list[Column] = []
    for i in range(DIMS):
        rest = x[i] - m[i]
        for j in range(i):
            rest = rest - F.get(cov, F.lit(i * DIMS + j)) * y[j]
        y.append(rest / F.get(cov, F.lit(i * DIMS + i)))
    total = y[0] * y[0]
    for v in y[1:]:
        total = total + v * v
    return total


def _cholesky(estimates: DataFrame, cov: dict[tuple[int, int], Column]) -> DataFrame:
    """(grp, start, centre, factor, det): lower factors of the covariances, row by row of a table of estimates."""
    floor = {(i, j): F.greatest(c, F.lit(FLOORS[i] ** 2)) if i == j else c for (i, j), c in cov.items()}
    out = estimates.withColumns({f"_c{i}{j}": c for (i, j), c in floor.items()})
    for i in range(DIMS):
        for j in range(i + 1):
            rest = F.col(f"_c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            # rounded moments may leave a covariance a little short of positive
            out = out.withColumn(f"_l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-8))) if i == j else rest / F.col(f"_l{j}{j}"))
    factor = F.array(*[F.col(f"_l{i}{j}") if j <= i else F.lit(0.0) for i in range(DIMS) for j in range(DIMS)])
    det = F.col("_l00")
    for i in range(1, DIMS):
        det = det * F.col(f"_l{i}{i}")
    return out.select("grp", "start", F.array(*[F.col(f"_m{i}") for i in range(DIMS)]).alias("centre"),
                      factor.alias("factor"), (det * det).alias("det"))


def _moments(rows: DataFrame, scale: float) -> DataFrame:
    """Centres and factors of the covariances of the given rows, per group and start."""
    aggs = [F.avg(f"x{i}").alias(f"_m{i}") for i in range(DIMS)]
    aggs += [F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"_p{i}{j}") for i in range(DIMS) for j in range(i + 1)]
    # sums of doubles differ in their last digits between runs: rounding keeps the verdicts the same
    rounded = [F.round(f"_m{i}", 9).alias(f"_m{i}") for i in range(DIMS)]
    cov = {(i, j): F.round((F.col(f"_p{i}{j}") - F.col(f"_m{i}") * F.col(f"_m{j}")) * scale, 9)
           for i in range(DIMS) for j in range(i + 1)}
    table = rows.groupBy("grp", "start").agg(*aggs).select("grp", "start", *rounded, *[c.alias(f"_s{i}{j}") for (i, j), c in cov.items()])
    return _cholesky(table, {(i, j): F.col(f"_s{i}{j}") for (i, j) in cov})


def _at_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with their squared distance ``d2`` from each estimate of their group."""
    x = [F.col(f"x{i}") for i in range(DIMS)]
    m = [F.get(F.col("centre"), F.lit(i)) for i in range(DIMS)]
    return rows.join(estimates, "grp").withColumn("d2", _distance(x, m, F.col("factor"))).drop("centre", "factor", "det")


def _starts(rows: DataFrame, sized) -> DataFrame:
    """First estimates: medians with median deviations (0), means and covariances (1), medians with the least scales (2)."""
    long = rows.select("grp", F.posexplode(F.array(*[F.col(f"x{i}") for i in range(DIMS)])).alias("dim", "x"))
    mid = histogram_quantile(long, ["grp", "dim"], "x", 0.5, "mid")
    off = long.join(sized(mid), ["grp", "dim"]).select("grp", "dim", F.abs(F.col("x") - F.col("mid")).alias("off"))
    both = mid.join(histogram_quantile(off, ["grp", "dim"], "off", 0.5, "mad"), ["grp", "dim"])
    pick = lambda c, i: F.max(F.when(F.col("dim") == i, F.col(c)))
    table = both.groupBy("grp").agg(*[pick("mid", i).alias(f"_m{i}") for i in range(DIMS)],
                                    *[pick("mad", i).alias(f"_d{i}") for i in range(DIMS)])
    table = table.withColumn("start", F.explode(F.array(F.lit(0), F.lit(2))))
    spread = lambda i: F.when(F.col("start") == 0, F.pow(1.4826 * F.col(f"_d{i}"), 2)).otherwise(0.0)
    cov = {(i, j): spread(i) if i == j else F.lit(0.0) for i in range(DIMS) for j in range(i + 1)}
    return _cholesky(table, cov).unionByName(_moments(rows.withColumn("start", F.lit(1)), 1.0))


def _concentrated(rows: DataFrame, current: DataFrame, sized) -> DataFrame:
    """One step for every estimate that is not settled; it is settled if its determinant no longer falls."""
    near = _at_distance(rows, sized(current.filter("NOT settled").drop("settled")))
    reach = near.select("grp", "start", F.sqrt("d2").alias("d"))
    core = (near.join(sized(histogram_quantile(reach, ["grp", "start"], "d", SUPPORT, "reach")), ["grp", "start"])
            .filter(F.sqrt("d2") <= F.col("reach")))
    new = _moments(core, CONSISTENCY).select("grp", "start", *[F.col(c).alias(f"n_{c}") for c in ("centre", "factor", "det")])
    both = current.join(new, ["grp", "start"], "left")
    # the first determinant is that of a start, not of a core: any first step goes on
    falls = F.col("n_det").isNotNull() & (F.col("first") | (F.col("n_det") < F.col("det") * (1 - SETTLED)))
    return both.select("grp", "start", *[F.when(falls, F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in ("centre", "factor", "det")],
                       (~falls).alias("settled"), F.lit(False).alias("first"))


def _groups(stats: DataFrame) -> DataFrame:
    """(lang, source, grp): the group in which a language and source is estimated."""
    ok = stats.filter(~base_failed(F.col("stats")))
    n = ok.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    big = F.col("n") >= MIN_GROUP
    lang = Window.partitionBy("lang")
    few_of_lang = F.sum(F.when(~big, F.col("n")).otherwise(0)).over(lang)
    grp = (F.when(big, F.struct(F.lit(0).alias("level"), "lang", "source"))
           .when(few_of_lang >= MIN_GROUP, F.struct(F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source")))
           .otherwise(F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"),
                               F.lit(None).cast("string").alias("source"))))
    return n.select("lang", "source", F.to_json(grp).alias("grp"))


def estimates(stats: DataFrame) -> DataFrame:
    """(lang, source, centre, factor) from rows (lang, source, stats); read several times, so written before.

    The result is a written table of one row per language and source: see ``_base.drop_written``.
    """
    groups = written(_groups(stats), "quality-groups")
    # every table by group has four rows a group at most: one count bounds them all
    sized = F.broadcast if groups.count() <= BROADCAST_GROUPS else lambda df: df
    same = [F.col("s.lang").eqNullSafe(F.col("g.lang")), F.col("s.source").eqNullSafe(F.col("g.source"))]
    v = [c.alias(f"x{i}") for i, c in enumerate(vector(F.col("s.stats")))]
    rows = (stats.alias("s").filter(~base_failed(F.col("stats")))
            .join(sized(groups).alias("g"), same[0] & same[1]).select("grp", *v))
    rows = written(rows, "quality-vectors")
    current = written(_starts(rows, sized).withColumns({"settled": F.lit(False), "first": F.lit(True)}), "quality-estimate")
    while not current.filter("NOT settled").isEmpty():
        last, current = current, written(_concentrated(rows, current, sized), "quality-estimate")
        drop_written(last)
    least = current.groupBy("grp").agg(F.min(F.struct("det", "start", "centre", "factor")).alias("b")).select("grp", "b.*")
    final = _moments(_at_distance(rows, sized(least)).filter(F.col("d2") <= REWEIGHT), 1.0)
    sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= MIN_GROUP)
    out = written(groups.join(final, "grp").join(sizes, "grp").select("lang", "source", "centre", "factor"),
                  "quality-estimates")
    for used in (current, rows, groups):
        drop_written(used)
    return out


def judge(stats: DataFrame, fitted: DataFrame) -> DataFrame:
    """Rows of ``stats`` (any columns, with lang, source and stats) and base_failed, distance, kept."""
    small = fitted.count() <= BROADCAST_GROUPS
    e = (F.broadcast(fitted) if small else fitted).select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                      F.col("centre").alias("_centre"), F.col("factor").alias("_factor"))
    joined = stats.join(e, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    d2 = _distance(vector(F.col("stats")), [F.get(F.col("_centre"), F.lit(i)) for i in range(DIMS)], F.col("_factor"))
    failed = base_failed(F.col("stats"))
    return (joined.withColumn("base_failed", failed)
            .withColumn("distance", F.when(~failed, F.sqrt(d2)))
            .withColumn("kept", ~failed & F.coalesce(d2 <= CUTOFF, F.lit(True)))
            .drop("_lang", "_source", "_centre", "_factor"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Statistics and verdict of every text."""
    stats = written(docs.select("doc_id", "lang", "source", statistics(F.col("text")).alias("stats")), "quality-stats")
    out = judge(stats, estimates(stats))
    return out.select("doc_id", *[F.col(f"stats.{s}") for s in STATS], "base_failed", "kept", "distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they were."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # whole rows and statistics are written once; neither is computed or shuffled again
    stats = written(docs.select("lang", "source", statistics(F.col("text")).alias("stats"), whole), "quality-rows")
    kept = judge(stats, estimates(stats.drop("row"))).filter("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
