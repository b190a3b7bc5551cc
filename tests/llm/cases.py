"""Tables that every corpus operator must take: nulls, empty and very long texts, ties, repeated rows, clashing names."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ("key", "__key", "__row", "print", "cls", "value", "n", "stratum", "kept", "seed", "score", "length", "start", "component", "__text")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows=None):
    long = prose(7, 30_000)
    rows = rows if rows is not None else [
        (1, prose(1, 120), "en", "s", 1), (1, prose(1, 120), "en", "s", 1), (2, None, "en", None, None), (3, "", None, "s", 0),
        (4, " \t\n ", "en", "s", 4), (None, prose(2, 80), "fr", "s", 2), (None, None, None, None, None), (5, long, "en", "s", 5),
        (6, "Grüße aus Köln, señor 𝒳 " * 40, "de", "s", 6), (7, prose(1, 120), "en", "s", 1), (8, "x" * 5000, "en", "s", 7),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)
