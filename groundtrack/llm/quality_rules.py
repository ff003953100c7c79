"""Quality rules with risk-controlled cutoffs, in native expressions only.

Each rule is a share of a text (symbols, repeated lines, repeated passages,
capitals, sameness); a text above the rule's cutoff is rejected. Cutoffs come
from labelled rows: within a stratum (texts of like length) a cutoff is allowed
if the exact binomial test on the good rows it would reject shows that its
false rejection rate is below ``risk / rules``: P(Bin(n, rate) <= k) must not
exceed ``error / (strata * rules)`` (Bonferroni). Along one rule's cutoffs the
counts are nested, so testing them from the loosest on needs no further
correction. All allowed cutoffs keep the guarantee; of these the one that
rejects most bad rows, less ``price`` times the good ones, is taken. So in each
stratum all rules together reject at most ``risk`` of the good texts, with
probability ``1 - error`` over all strata. Without enough labels there is no
allowed cutoff, and only the base rule rejects.

Defined results: a null text has no word and fails the base rule; shares of a
text without words are 0; a repeated or null id just counts again; rows whose
label is null do not calibrate; other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtrack.llm.common import SPACE, WORD
from groundtrack.llm.exprs import filled, hashes, let, pieces, positions, windows

RULES = ("symbols", "dup_lines", "repeats", "capitals", "sameness")
CUTOFFS = tuple(round(0.05 * i, 2) for i in range(1, 21))
STRATA = (50, 200, 1000)          # upper bounds of n_words; the last stratum is open
RISK, ERROR, PRICE = 0.10, 0.05, 10.0
_WINDOW = 8


def _repeat_words(h: Column) -> Column:
    """Words that lie in a window of eight found twice or more."""
    def covered(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def of(s: Column) -> Column:
            m = F.size(s)
            twice = F.filter(positions(m), lambda j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))].x == s[j].x))
                             | ((j < m - 1) & (s[F.least(j + 1, m - 1)].x == s[j].x)))
            at = F.sort_array(F.transform(twice, lambda j: s[j].i))
            return let(at, lambda p: F.aggregate(
                positions(F.size(p)), F.lit(0).cast("bigint"),
                lambda acc, j: acc + F.when(j == F.size(p) - 1, _WINDOW).otherwise(
                    F.least(F.lit(_WINDOW), p[F.least(j + 1, F.size(p) - 1)] - p[j])).cast("bigint")))

        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("bigint")).otherwise(let(ordered, of))
    return let(windows(h, _WINDOW), covered)


def measures(text: Column) -> Column:
    """Struct of the counts that base and rules need."""
    t = filled(text)

    def of(h: Column) -> Column:
        return F.struct(F.size(h).cast("bigint").alias("n_words"), _repeat_words(h).alias("n_repeat_words"),
                        F.size(F.array_distinct(h)).cast("bigint").alias("n_distinct"))

    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    by_word = let(hashes(pieces(text, WORD)), of)
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"),
                                            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")))
    return F.struct(by_word.alias("w"), by_line.alias("l"),
                    F.length(F.regexp_replace(t, SPACE, "")).cast("bigint").alias("word_chars"),
                    F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
                    F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("bigint").alias("n_upper"))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the base counts, the rules' shares (``x_<rule>``) and the
    stratum, all prefixed."""
    m = "__gt_measures"
    def per(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    w, c = f"{m}.w.n_words", F.col(f"{m}.w.n_words")
    stratum = F.lit(len(STRATA))
    for i, top in reversed(list(enumerate(STRATA))):
        stratum = F.when(c < top, F.lit(i)).otherwise(stratum)
    return (df.withColumn(m, measures(F.col(text)))
            .withColumns({prefix + k: v for k, v in {
                "n_words": c, "word_chars": F.col(f"{m}.word_chars"), "n_symbols": F.col(f"{m}.n_symbols"),
                "n_dup_lines": F.col(f"{m}.l.n_dup_lines"), "n_repeat_words": F.col(f"{m}.w.n_repeat_words"),
                "x_symbols": per(f"{m}.n_symbols", w), "x_dup_lines": per(f"{m}.l.n_dup_lines", f"{m}.l.n_lines"),
                "x_repeats": per(f"{m}.w.n_repeat_words", w), "x_capitals": per(f"{m}.n_upper", f"{m}.word_chars"),
                "x_sameness": F.when(c > 0, 1.0 - F.col(f"{m}.w.n_distinct") / c).otherwise(F.lit(0.0)),
                "stratum": stratum}.items()}).drop(m))


def _log_gamma(x: Column) -> Column:
    """ln gamma(x) for x >= 1, by Stirling's series eight places up."""
    y = x + 8.0
    shift = sum((F.log(x + float(i)) for i in range(1, 8)), F.log(x))
    return ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
            + 1 / (1260 * y * y * y * y * y) - shift)


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(Bin(n, rate) <= k), exact to rounding; 1 where k is above the mean."""
    n, k = n.cast("double"), k.cast("double")
    top = (_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate))
    # terms fall by j / (n - j + 1) * (1 - rate) / rate on the way down from k; those past
    # forty standard deviations are below any double's precision
    terms = F.least(k, 40 * F.sqrt(n * rate) + 60).cast("int")
    total = F.aggregate(positions(terms), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
                        lambda a, i: let(a.term * (k - i) / (n - k + i + 1) * ((1 - rate) / rate),
                                         lambda t: F.struct(t.alias("term"), (a["sum"] + t).alias("sum"))),
                        lambda a: a["sum"])
    return F.when(k > n * rate, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * total))


def tested_cutoffs(rows: DataFrame, label: str = "label", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Every (stratum, rule, cutoff) with its counts and p-value. ``rows`` has a
    label (1 good, 0 bad) and the measured columns."""
    n_strata = len(STRATA) + 1
    above = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"x_{r}").alias("x")) for r in RULES)))
    grid = F.array(*(F.lit(c) for c in CUTOFFS))
    counts = (rows.filter(F.col(label).isin(0, 1)).select("stratum", F.col(label).alias("y"), above.alias("r"))
              # cutoffs below x, as a count: rows reduce to a few groups before anything moves
              .groupBy("stratum", "y", F.col("r.rule").alias("rule"), F.size(F.filter(grid, lambda c: c < F.col("r.x"))).alias("over"))
              .agg(F.count("*").alias("n")))
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(CUTOFFS)))).alias("i")
    by_cutoff = (counts.select("*", steps).groupBy("stratum", "rule", "i")
                 .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n_good"),
                      F.sum(F.when((F.col("y") == 1) & (F.col("over") >= F.col("i")), F.col("n")).otherwise(0)).alias("good_rejected"),
                      F.sum(F.when((F.col("y") == 0) & (F.col("over") >= F.col("i")), F.col("n")).otherwise(0)).alias("bad_rejected")))
    return (by_cutoff.withColumn("cutoff", F.element_at(grid, F.col("i")))
            .withColumn("p_value", binomial_tail(F.col("n_good"), F.col("good_rejected"), risk / len(RULES)))
            .withColumn("allowed", F.col("p_value") <= error / (n_strata * len(RULES))).drop("i"))


def fit(rows: DataFrame, label: str = "label", risk: float = RISK, error: float = ERROR, price: float = PRICE) -> dict[tuple[int, str], float]:
    """The cutoff of each (stratum, rule) that has an allowed and useful one."""
    gain = F.col("bad_rejected") - price * F.col("good_rejected")
    best = (tested_cutoffs(rows, label, risk, error).filter(F.col("allowed") & (gain > 0))
            .groupBy("stratum", "rule").agg(F.max(F.struct(gain.alias("gain"), F.col("cutoff"))).alias("b")))
    return {(r["stratum"], r["rule"]): r["b"]["cutoff"] for r in best.collect()}       # strata x rules rows at most


def base_failed(prefix: str = "") -> Column:
    n, rep = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 20) | (100 * rep > 30 * n)


def rejected(cutoffs: dict[tuple[int, str], float], prefix: str = "") -> Column:
    """Whether any rule rejects a measured row."""
    out = F.lit(False)
    for (stratum, rule), cut in sorted(cutoffs.items()):
        out = out | ((F.col(f"{prefix}stratum") == stratum) & (F.col(f"{prefix}x_{rule}") > cut))
    return out
