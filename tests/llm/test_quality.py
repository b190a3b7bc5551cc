import math
import random
import re

import cases
import pytest
from pyspark.sql import functions as F

from formflow.llm import quality


def reference(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " ", "\n\n", "one", "a b", "a b c", "a b c a b c", "a a a a", "x\ny\nx\n\n \nx ", "# * $ %&|<> <>", "a\u00a0b c", "é 𝒳\x0bé\x0c𝒳\r",
    "a b c d a b c", " ".join(["q"] * 60), "\n".join(["same line here"] * 5), *[" ".join(random.Random(s).choices("abcd", k=s * 9)) for s in range(1, 12)],
    " ".join(random.Random(5).choices("abcdefghij", k=2500)),
]


def test_counts_equal_a_plain_count(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    got = quality.with_statistics(docs).select("__row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    for row in got:
        assert tuple(row)[1:] == reference(TEXTS[row[0]]), TEXTS[row[0]]


@pytest.mark.parametrize("k,n,p", [(0, 1, 0.5), (0, 1000, 0.005), (3, 2000, 0.005), (40, 10000, 0.005), (7, 10, 0.9)])
def test_binomial_tail_is_exact(spark, k, n, p):
    want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    df = spark.range(1).select(F.lit(k).cast("long").alias("k"), F.lit(n).cast("long").alias("n"))
    got = df.select(quality.log_binomial_cdf(F.col("k"), F.col("n"), p)).first()[0]
    assert math.isclose(math.exp(got), want, rel_tol=1e-9)


def symbols(kind):
    """Words with symbols, no three in a row alike."""
    return "".join(f" {i}{kind}{i}" for i in range(90))


def corpus(spark, good, noisy_good, bad, lang="en"):
    """Good documents without symbols, some good ones with, bad ones with many."""
    rows = [(i, cases.prose(i, 60), lang) for i in range(good)]
    rows += [(good + i, cases.prose(good + i, 60) + symbols("##"), lang) for i in range(noisy_good)]
    rows += [(good + noisy_good + i, cases.prose(i, 60) + symbols("|||"), lang) for i in range(bad)]
    labels = [(r[0], 1 if i < good + noisy_good else 0) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_a_cutoff_needs_proof(spark):
    how = quality.Risk(risk=0.04, error=0.05, rules=("symbols_per_word",))
    docs, labels = corpus(spark, 120, 0, 30)
    kept = {r.doc_id: r.kept for r in quality.judge_documents(docs, labels, "lang", how).collect()}
    # (1 - 0.04) ** 120 = 0.0075 <= 0.05: proven; every bad document goes, every good one stays
    assert all(kept[i] for i in range(120)) and not any(kept[i] for i in range(120, 150))
    docs, labels = corpus(spark, 60, 0, 30)
    # (1 - 0.04) ** 60 = 0.086 > 0.05: too few good documents to prove anything
    assert all(r.kept for r in quality.judge_documents(docs, labels, "lang", how).collect())


def test_a_cutoff_that_rejects_good_documents_is_not_taken(spark):
    how = quality.Risk(risk=0.04, error=0.05, rules=("symbols_per_word",))
    docs, labels = corpus(spark, 110, 20, 30)
    judged = {r.doc_id: r.kept for r in quality.judge_documents(docs, labels, "lang", how).collect()}
    assert all(judged[i] for i in range(130))


def test_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    for docs in (cases.documents(spark), cases.with_clashes(cases.documents(spark))):
        out = quality.judge_documents(docs, labels)
        assert out.count() == docs.count()
        assert out.where("base_failed and kept").isEmpty()
        kept = quality.keep_good(docs, labels)
        assert kept.columns == docs.columns
        assert kept.count() == out.where("kept").count()
    empty = cases.documents(spark, [])
    assert quality.judge_documents(empty, labels).isEmpty() and quality.keep_good(empty, labels.limit(0)).isEmpty()
    assert quality.keep_good(docs, labels.limit(0)).count() == kept.count()


def test_statistics_are_worked_out_once_a_pass(spark):
    """No filter is moved below the statistics: the word windows occur in one place of the plan."""
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = quality.keep_good(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    once = quality.with_statistics(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with") == once.count("zip_with") > 0
