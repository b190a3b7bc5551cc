import zlib

import cases
import numpy as np
from pyspark.sql import functions as F

from formflow.llm import language
from formflow.llm.queries import QUERIES


def bundle(text):
    """One n-gram after the other."""
    low = "".join(chr(language._letters()[ord(c)]) for c in f" {text} ")
    low = " " + " ".join(low.split()) + " "
    out = np.zeros(language.DIM)
    for i in range(len(low) - 2):
        if low[i + 1] != " ":
            v = np.ones(language.DIM)
            for k, c in enumerate(low[i : i + 3]):
                v = v * np.roll(language.letter_vector(ord(c)), 2 - k)
            out += v
    return out


def test_bundles_equal_the_definition():
    texts = ["Hello, world", "", "é", "a b  c1d\n\n e", "Grüße ÑÑ 𝒳𝒳", "123 !", "x" * 50]
    got, lettered = language.bundles(texts)
    for text, vector, has in zip(texts, got, lettered):
        assert has == any(c.isalpha() for c in text)
        assert np.array_equal(vector, bundle(text)), text


def test_letters_are_nearly_orthogonal_and_fixed():
    a, b = language.letter_vector(97).astype(int), language.letter_vector(98).astype(int)
    assert abs(a @ b) < 200 and np.array_equal(a, language.letter_vector(97))


def test_held_out_accuracy(spark):
    out = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").alias("o")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_edge_cases(spark):
    docs = cases.with_clashes(cases.documents(spark))
    rows = language.identify(docs, F.lit(False)).collect()
    assert len(rows) == docs.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (2, 3, 4))
    assert {r.lang_pred for r in rows} <= {"en", "fr", "de", "und"}
    assert language.identify(cases.documents(spark, []), F.lit(False)).isEmpty()
    nobody = language.identify(docs, F.lit(True)).collect()
    assert {r.lang_pred for r in nobody} == {"und"}
    one = docs.withColumn("lang", F.when(F.col("doc_id") == 1, "en"))
    assert {r.lang_pred for r in language.identify(one, F.lit(None).cast("boolean")).collect()} == {"en", "und"}
