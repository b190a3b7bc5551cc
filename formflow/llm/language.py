"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A letter vector is permuted (rotated) once per place it stands before
the end of an n-gram, and the n-gram's vector is the product of its permuted letter vectors. A text is the bundle (sum) of
its n-gram vectors, a language's prototype is the bundle of its training texts, and a text gets the language whose prototype
has the largest cosine with it. Prototypes are centred on their mean, which takes out what all languages share.

Vectors are pseudo-random functions of the code point, so every worker makes the same ones and no vocabulary is kept.
Within a batch, equal n-grams are counted first; a batch is one product of the count matrix with the n-gram vectors.
Training sums one vector per language and task and then per language; the driver gets the prototypes only, one vector per
language.

Edge cases: a null text or one without a letter is ``und`` with score 0; texts whose language is null or whose text has no
letter are not learned from; with no language learned every text is ``und``; repeated rows count as often as they occur;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.llm.batches import slices, texts_of

DIM, ORDER, SEED = 1024, 3, 20240607
SPACE = 32
#: Distinct n-grams turned into vectors at a time, and texts in a count matrix: bound a batch's memory.
GRAMS_AT_ONCE, TEXTS_AT_ONCE = 4096, 256


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its letter in lower case as one code point, or a space for all that is no letter."""
    table = np.full(0x110000, SPACE, dtype=np.uint32)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


@lru_cache(maxsize=20_000)
def letter_vector(code: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIM, dtype=np.int8) * np.int8(2) - np.int8(1)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Vectors of n-grams, given as rows of code points."""
    codes, where = np.unique(grams, return_inverse=True)
    base = np.stack([letter_vector(int(c)) for c in codes])
    where = where.reshape(grams.shape)
    out = np.ones((len(grams), DIM), dtype=np.int8)
    for place in range(grams.shape[1]):
        out *= np.roll(base, grams.shape[1] - 1 - place, axis=1)[where[:, place]]
    return out.astype(np.float32)


def bundles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One bundle per text, and whether it has a letter. Words are set off by one space on each side."""
    out, lettered = np.zeros((len(texts), DIM), dtype=np.float32), np.zeros(len(texts), dtype=bool)
    for first in range(0, len(texts), TEXTS_AT_ONCE):
        group = texts[first : first + TEXTS_AT_ONCE]
        joined = "".join("\n" + t.replace("\n", " ") + " " for t in group)
        raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        owner = np.cumsum(raw == 10, dtype=np.int32) - 1
        codes = _letters()[raw]
        keep = np.r_[True, (codes[1:] != SPACE) | (codes[:-1] != SPACE) | (raw[1:] == 10)]
        codes, owner = codes[keep], owner[keep]
        lettered[first : first + len(group)] = np.bincount(owner[codes != SPACE], minlength=len(group))[: len(group)] > 0
        alphabet, index = np.unique(codes, return_inverse=True)
        n, size = len(codes) - ORDER + 1, len(alphabet)
        if n < 1:
            continue
        packed = np.zeros(n, dtype=np.int64)
        for k in range(ORDER):
            packed = packed * size + index[k : k + n]
        inside = (owner[:n] == owner[ORDER - 1 :]) & (codes[1 : 1 + n] != SPACE)
        packed, own = packed[inside], owner[:n][inside]
        distinct, which = np.unique(packed, return_inverse=True)
        for start in range(0, len(distinct), GRAMS_AT_ONCE):
            part = distinct[start : start + GRAMS_AT_ONCE]
            mine = (which >= start) & (which < start + len(part))
            counts = np.bincount(own[mine] * len(part) + which[mine] - start, minlength=len(group) * len(part)).reshape(len(group), len(part))
            grams = np.stack([alphabet[part // size ** (ORDER - 1 - k) % size] for k in range(ORDER)], axis=1)
            out[first : first + len(group)] += counts.astype(np.float32) @ gram_vectors(grams)
    return out, lettered


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for whole in batches:
        for batch in slices(whole, "text"):
            vectors, lettered = bundles(texts_of(batch))
            for lang, vector, use in zip(batch.column("lang").to_pylist(), vectors, lettered):
                if use:
                    norm = np.sqrt((vector.astype(np.float64) ** 2).sum())
                    if norm:
                        sums[lang] = sums.get(lang, 0) + vector.astype(np.float64) / norm
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["lang", "vector"])


def prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """Language -> centred unit prototype, learned from the rows of ``docs`` (text, lang) with a language.

    Each text counts as a unit vector. The result has one vector per distinct language.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    parts = rows.mapInArrow(_learn, "lang string, vector array<double>")
    spread = parts.select("lang", F.posexplode("vector").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
    sums = spread.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("vector")).collect()
    unit = {r["lang"]: np.array(r["vector"]) / max(np.linalg.norm(r["vector"]), 1e-12) for r in sorted(sums, key=lambda r: r["lang"])}
    if not unit:
        return {}
    mean = np.mean(list(unit.values()), axis=0) if len(unit) > 1 else 0.0
    return {k: (v - mean) / max(np.linalg.norm(v - mean), 1e-12) for k, v in unit.items()}


def _predict(learned: dict[str, np.ndarray]):
    names = list(learned)
    matrix = np.stack(list(learned.values())) if learned else np.zeros((1, DIM))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                vectors, lettered = bundles(texts_of(batch))
                cosine = vectors @ matrix.T / np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
                best = cosine.argmax(axis=1)
                known = lettered & bool(names)
                score = np.where(known, np.clip((cosine[np.arange(len(best)), best] + 1) / 2, 0, 1), 0.0)
                lang = [names[b] if k else "und" for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred and score (0 to 1). Learns from the rows where ``held_out`` is false."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    learned = prototypes(rows.where(~F.col("held_out")).select("text", "lang"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.drop("lang").mapInArrow(_predict(learned), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
