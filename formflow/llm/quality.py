"""Quality rules with risk-controlled cutoffs.

Each rule rejects a document whose statistic exceeds a cutoff. Cutoffs are not set by hand: a labelled holdout says, per
stratum, how many good documents a cutoff would reject. A cutoff is admissible if an exact binomial tail shows, at the
corrected level, that its false rejection rate is at most ``risk / number of rules``. Each (stratum, rule) pair tests its
cutoffs from the loosest to the strictest and stops at the first failure, so the chain needs no correction of its own;
the chains are corrected by Bonferroni. Hence, with probability ``1 - error`` over the holdout, the rules together reject
at most a share ``risk`` of the good documents of every stratum.

Everything is DataFrame operations: statistics are computed within a row, calibration is one aggregate per stratum.

Nulls and edge cases: a null or empty text has no words and fails the base rule; a null stratum is a stratum of its own;
a stratum with too few labels gets no cutoff and keeps what the base rule keeps; label rows with a null id or null quality
are ignored, repeated ones count once (the worst quality holds); repeated documents are judged alike; extra columns are
never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.llm.columns import let, text_of, unwrapped, words_of, wrapped
from formflow.session import materialise

#: Statistic -> cutoffs, from the loosest to the strictest.
RULES: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1),
    "repeated_share": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "repeated_lines": (0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "capitals_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
}
MIN_WORDS, MAX_REPEATED_PCT = 50, 50


@dataclass(frozen=True)
class Risk:
    """``risk``: share of good documents that may be rejected; ``error``: chance that the bound does not hold."""

    risk: float = 0.02
    error: float = 0.05
    rules: tuple[str, ...] = tuple(RULES)


def repeated_words(words: Column) -> Column:
    """Words inside a three-word window that occurs twice or more among ``words``, the first occurrence included.

    Sorting the windows as strings shows which ones repeat. Their positions come from looking every window up in that
    list, or, where the list is long, from sorting the windows with their positions; the covered words are counted from
    the gaps between repeated positions.
    """
    short = 32

    def windows(w: Column) -> Column:
        n = F.size(w)
        pairs = F.zip_with(w, F.slice(w, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        triples = F.zip_with(pairs, F.slice(w, 3, F.greatest(n - 2, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.slice(triples, 1, F.greatest(n - 2, F.lit(0)))

    def twins(s: Column) -> Column:
        following = F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0)))
        return F.array_distinct(F.array_compact(F.zip_with(s, following, lambda a, b: F.when(a == b, a))))

    def looked_up(g: Column, repeated: Column) -> Column:
        return F.array_compact(F.transform(g, lambda x, i: F.when(F.array_contains(repeated, x), i)))

    def by_sorting(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))

        def of(s: Column) -> Column:
            n = F.size(s)
            return F.sort_array(F.array_compact(F.transform(s, lambda x, i: F.when(
                ((i > 0) & (s[F.greatest(i - 1, F.lit(0))]["g"] == x["g"])) | ((i < n - 1) & (s[F.least(i + 1, n - 1)]["g"] == x["g"])), x["i"]))))

        return let(ordered, of)

    def covered(positions: Column) -> Column:
        return F.aggregate(
            positions,
            F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(i.alias("at"), (acc["n"] + F.least(F.lit(3), i - acc["at"])).alias("n")),
            lambda acc: acc["n"],
        )

    def count(g: Column) -> Column:
        return let(twins(F.sort_array(g)), lambda r: F.when(F.size(r) == 0, F.lit(0)).otherwise(
            covered(F.when(F.size(r) <= short, looked_up(g, r)).otherwise(by_sorting(g)))))

    return let(windows(words), count).cast("long")


def with_statistics(docs: DataFrame, stratum: str | None = "lang", numbered: bool = False) -> DataFrame:
    """``docs`` as one struct ``__row``, its base counts and the statistics of the rules, and ``__at``, a row number, if
    wanted. Reads whole texts."""
    text, words, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    base = wrapped(docs).withColumn("__text", text_of("__row.text"))
    base = base.withColumns({
        "__words": words_of(text),
        "__lines": F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""),
    })
    base = base.select(
        "__row", *([F.monotonically_increasing_id().alias("__at")] if numbered else []),
        (F.col(f"__row.{stratum}").cast("string") if stratum else F.lit(None).cast("string")).alias("stratum"),
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return base.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words")),
        "symbols_per_word": share("n_symbols", "n_words"),
        "repeated_share": share("n_repeat_words", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "capitals_share": share("n_capitals", "word_chars"),
    })


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """Logarithm of P(X <= k) for X ~ Binomial(n, p), summed over all terms in log space, never underflowing."""
    odds = p / (1 - p)
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    start = F.struct((n * F.log(F.lit(1 - p))).alias("top"), F.lit(1.0).alias("sum"))
    return F.aggregate(
        steps, start,
        lambda a, i: F.struct((a["top"] + F.log((n - i + 1) / i * odds)).alias("top"), (1 + a["sum"] * i / (n - i + 1) / odds).alias("sum")),
        lambda a: a["top"] + F.log(a["sum"]),
    )


def calibrate(statistics: DataFrame, labels: DataFrame, how: Risk = Risk()) -> DataFrame:
    """One row per stratum: ``stratum``, labelled good documents ``n_good`` and ``cut_<rule>`` (null: the rule is off).

    ``statistics`` needs doc_id, stratum, base_failed and the rules' statistics. Documents that the base rule rejects are
    gone already and do not count. Among the admissible cutoffs the one that rejects most labelled bad documents is
    taken, the loosest of equals, and none if it rejects no bad document.
    """
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    held = (statistics.where(~F.col("base_failed")).select("doc_id", "stratum", *how.rules).join(marks, "doc_id")
            .dropDuplicates(["doc_id"]))
    good = F.col("quality") == 1
    sums = [F.sum(good.cast("long")).alias("n_good")]
    for rule in how.rules:
        for i, cut in enumerate(RULES[rule]):
            over = F.col(rule) > cut
            sums += [F.sum((good & over).cast("long")).alias(f"good_{rule}_{i}"), F.sum((~good & over).cast("long")).alias(f"bad_{rule}_{i}")]
    counts = materialise(held.groupBy("stratum").agg(*sums), "quality-counts")
    level = how.error / max(1, counts.count() * len(how.rules))
    rate, n = how.risk / len(how.rules), F.col("n_good")
    chosen = []
    for rule in how.rules:
        passed, options = F.lit(True), []
        for i, cut in enumerate(RULES[rule]):
            k, bad = F.col(f"good_{rule}_{i}"), F.col(f"bad_{rule}_{i}")
            # Beyond the mean the tail is far above any level; it need not be summed.
            passed = passed & (k < n * rate) & (F.when(k < n * rate, log_binomial_cdf(k, n, rate)) <= F.log(F.lit(level)))
            options.append(F.when(passed & (bad > 0), F.struct(bad.alias("bad"), F.lit(-i).alias("rank"), F.lit(cut).alias("cut"))))
        chosen.append(F.array_max(F.array(*options))["cut"].alias(f"cut_{rule}"))
    return counts.select("stratum", "n_good", *chosen)


def judged(statistics: DataFrame, cutoffs: DataFrame, how: Risk = Risk()) -> DataFrame:
    """``statistics`` with ``kept``: neither the base rule nor a rule with its stratum's cutoff rejects the document."""
    cuts = cutoffs.select(F.col("stratum").alias("__stratum"), *[f"cut_{r}" for r in how.rules])
    rejected = F.col("base_failed")
    for rule in how.rules:
        rejected = rejected | F.coalesce(F.col(rule) > F.col(f"cut_{rule}"), F.lit(False))
    joined = statistics.join(cuts, F.col("stratum").eqNullSafe(F.col("__stratum")), "left")
    return joined.withColumn("kept", ~rejected).drop("__stratum", *[f"cut_{r}" for r in how.rules])


def judge_documents(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", how: Risk = Risk()) -> DataFrame:
    """One row per document: doc_id, the base counts, the statistics, ``base_failed`` and ``kept``."""
    numbers = with_statistics(docs, stratum).withColumn("doc_id", F.col("__row.doc_id")).drop("__row")
    numbers = materialise(numbers, "quality-statistics")
    cutoffs = materialise(calibrate(numbers, labels, how), "quality-cutoffs")
    return judged(numbers, cutoffs, how)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", how: Risk = Risk()) -> DataFrame:
    """The documents that are kept, with their own columns."""
    # The row number keeps Catalyst from moving the filters below the statistics, where they would be worked out once more
    # for every use: no filter passes a step that numbers rows.
    statistics = with_statistics(docs, stratum, numbered=True)
    numbered = F.col("__at") >= 0
    numbers = statistics.where(numbered & ~F.col("base_failed")).select(F.col("__row.doc_id").alias("doc_id"), "stratum", "base_failed", *how.rules)
    cutoffs = materialise(calibrate(numbers, labels, how), "quality-cutoffs")
    return unwrapped(judged(statistics, cutoffs, how).where(numbered & F.col("kept")))
