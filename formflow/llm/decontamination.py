"""Benchmark decontamination with spaced-seed hashing.

A mask looks at six of up to ``SPAN`` consecutive tokens and ignores the others. The masks are chosen so that wherever tokens
are substituted, an overlap of ``MIN_OVERLAP`` equal tokens and a share of ``MIN_SHARE`` keeps a seed (a test works out for
each length the fewest substitutions that leave none). Seeds of test items and of training documents are joined; around each
hit both token sequences are compared without gaps, and the longest overlap is reported of which ``MIN_OVERLAP`` tokens (all
of a shorter item's) and a share of ``MIN_SHARE`` are equal. Stretches compared
around several hits are chained; they end ``REACH`` tokens beyond the outermost seeds, so two passages with more than
twice as many tokens without a seed between them are two overlaps, of which the better is reported.

Tokens are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased, so punctuation and spacing do not matter.

Scale. Training seeds first meet a bitmap of the test seeds, at most ``2 ** bitmaps.MAX_BITS`` bits whatever the benchmark's size;
only seeds that may occur in the benchmark are shuffled, each with its surroundings, so texts never are. The bitmap only
saves shuffling: the join decides. Test seeds are a written table, so a seed that very many documents share is split.

Edge cases: null and empty texts have no tokens; an item with fewer than ``SHORTEST`` tokens cannot be found and a document
with fewer is clean; rows with a null doc_id are reported under null, test rows with a null item_id under a null item;
repeated documents with one id give one row per item; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.batches import slices
from formflow.llm.bitmaps import bitmap_of, held
from formflow.llm.columns import row_key
from formflow.llm.hashing import run_hashes, word_hashes
from formflow.session import materialise

SPAN = 11
MASKS = ((0, 1, 3, 4, 6, 7), (0, 2, 3, 5, 6, 8), (0, 1, 2, 6, 9, 10), (0, 2, 6, 7, 8, 9))
#: Tokens of the shortest text with a seed.
SHORTEST = 1 + min(mask[-1] for mask in MASKS)
#: Tokens carried on each side of a seed, for verification; what lies further is known from further seeds.
REACH = 32
MIN_OVERLAP, MIN_SHARE = 12, 0.8
#: What a matching and a substituted token weigh, in fifths: a sum of zero is a share of ``MIN_SHARE``.
FIFTHS = (1, 4)


def _seeds(bits: int, bitmap: np.ndarray | None):
    width = SPAN + 2 * REACH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words, owner = word_hashes(batch.column("text"), letters_only=True)
                per_text = np.bincount(owner, minlength=batch.num_rows)
                first = np.cumsum(per_text) - per_text
                short = (words >> np.uint64(32)).astype(np.int64).astype(np.int32)
                for number, mask in enumerate(MASKS):
                    seeds, at = run_hashes(words, owner, mask, number)
                    if bitmap is not None:
                        hit = held(seeds, bits, bitmap)
                        seeds, at = seeds[hit], at[hit]
                    if not len(at):
                        continue
                    text = owner[at]
                    window = np.arange(-REACH, SPAN + REACH)
                    where = at[:, None] + window
                    inside = (where >= first[text][:, None]) & (where < (first + per_text)[text][:, None])
                    around = np.where(inside, short[np.clip(where, 0, len(words) - 1)], 0).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seeds.view(np.int64)), *(batch.column(c).take(pa.array(text)) for c in batch.schema.names if c != "text"),
                         pa.array((at - first[text]).astype(np.int32)), pa.array(per_text[text].astype(np.int32)),
                         pa.array((REACH - inside[:, :REACH].sum(axis=1)).astype(np.int32)), pa.array(inside.sum(axis=1).astype(np.int32)),
                         pa.FixedSizeListArray.from_arrays(pa.array(around.ravel()), width).cast(pa.list_(pa.int32()))],
                        ["seed", *(c for c in batch.schema.names if c != "text"), "at", "n_tokens", "from_", "reach", "around"])

    return run


_SEED_COLUMNS = "at int, n_tokens int, from_ int, reach int, around array<int>"


def seed_table(rows: DataFrame, bits: int = 0, bitmap: np.ndarray | None = None) -> DataFrame:
    """Seeds of ``rows`` (ids, text) with their place and surroundings; with a bitmap only those that it holds."""
    ids = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "text")
    return rows.mapInArrow(_seeds(bits, bitmap), f"seed long, {ids}, {_SEED_COLUMNS}")


def longest(equal: np.ndarray, known: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per row of aligned tokens the overlap with most matching tokens of all those with a share of ``MIN_SHARE``.

    ``equal`` says where the tokens match, ``known`` where both sequences have one; ``least`` tokens must match. Gives
    accepted, length, matching tokens and start. An overlap starts and ends with equal tokens; of several with as many
    matching tokens the longest, then the first.
    """
    rows, width = equal.shape
    equal = equal & known
    # Prefix sums that do not fall over an overlap of sufficient share, and do over any that takes in an unknown token.
    up, down = FIFTHS
    gain = np.where(equal, up, np.where(known, -down, -up * (width + 1))).astype(np.int64)
    none = np.zeros((rows, 1), dtype=np.int64)
    total, matched = np.hstack([none, np.cumsum(gain, axis=1)]), np.hstack([none, np.cumsum(equal, axis=1)])
    # For each end the first start from which the sums do not fall: there most tokens match.
    lowest = np.minimum.accumulate(total, axis=1)
    apart = np.arange(rows)[:, None] * (total.max(initial=0) - total.min(initial=0) + 1)
    first = np.searchsorted((apart - lowest).ravel(), (apart - total).ravel()).reshape(total.shape) - np.arange(rows)[:, None] * (width + 1)
    place = np.arange(width)
    following = np.minimum.accumulate(np.where(equal, place, width)[:, ::-1], axis=1)[:, ::-1]
    start = np.take_along_axis(np.hstack([following, np.full((rows, 1), width)]), first, axis=1)
    matching, length = matched - np.take_along_axis(matched, first, axis=1), np.arange(width + 1) - start
    # An end behind an unequal token has a shorter one with as many matching tokens.
    matching[:, 1:][~equal] = 0
    matching[:, 0] = 0
    best = (matching * (width + 1) + np.where(matching > 0, length, 0)).argmax(axis=1)
    start, matching, length = (x[np.arange(rows), best] for x in (start, matching, length))
    return (matching > 0) & (matching >= least), length, matching, start


def _compared(ids: list[str]):
    """Hits to blocks of 64 item tokens: which of them the hit's surroundings hold, and which are equal there."""
    width = SPAN + 2 * REACH
    blocks = (width + 126) // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            number = lambda c: np.asarray(batch.column(c), dtype=np.int64)
            rows = lambda c: np.asarray(batch.column(c).flatten(), dtype=np.int32).reshape(n, -1)
            place = np.arange(width)
            within = lambda a, b: (place >= number(a)[:, None]) & (place < (number(a) + number(b))[:, None])
            known = within("from_", "reach") & within("item_from", "item_reach")
            first = (number("item_at") - REACH) // 64
            where = place + (number("item_at") - REACH - 64 * first)[:, None]

            def packed(bits: np.ndarray) -> np.ndarray:
                whole = np.zeros((n, 64 * blocks), dtype=bool)
                np.put_along_axis(whole, where, bits, axis=1)
                return np.packbits(whole, axis=1, bitorder="little").view("<i8")

            both, equal = packed(known), packed(known & (rows("around") == rows("item_around")))
            row, k = np.nonzero(both)
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(owner) for c in ids), pa.array((number("at") - number("item_at"))[row]),
                 pa.array(first[row] + k), pa.array(both[row, k]), pa.array(equal[row, k])],
                [*ids, "shift", "block", "known", "equal"])

    return run


def _chained(ids: list[str]):
    """Blocks of one diagonal, in order, to its longest overlap, if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("blocks")
            block, known, equal = (np.asarray(x, dtype=np.int64) for x in lists.flatten().flatten())
            count = np.asarray(pc.list_value_length(lists), dtype=np.int64)
            ends = np.cumsum(count)
            first, span = block[ends - count], block[ends - 1] - block[ends - count] + 1
            owner = np.repeat(np.arange(len(count)), count)
            shift, least = (np.asarray(batch.column(c), dtype=np.int64) for c in ("shift", "least"))
            for words in np.unique(span):
                same = np.flatnonzero(span == words)
                step = max(1, (1 << 20) // (64 * int(words)))
                for some in (same[i : i + step] for i in range(0, len(same), step)):
                    of = np.flatnonzero(np.isin(owner, some))
                    at = np.searchsorted(some, owner[of]), block[of] - first[owner[of]]

                    def bits(x: np.ndarray) -> np.ndarray:
                        whole = np.zeros((len(some), int(words)), dtype="<i8")
                        whole[at] = x[of]
                        return np.unpackbits(whole.view(np.uint8), axis=1, bitorder="little").astype(bool)

                    ok, length, matching, start = longest(bits(equal), bits(known), least[some])
                    start = start + 64 * first[some]
                    kept = pa.array(some[ok])
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(kept) for c in ids), *(pa.array(x[ok]) for x in (length, matching, start + shift[some], start))],
                        [*ids, "overlap", "matching", "doc_token", "item_token"])

    return run


def find_overlaps(docs: DataFrame, benchmark: DataFrame, ids: list[str]) -> DataFrame:
    """Per (``ids`` of docs, item_id) the best overlap: overlap and matching tokens, and where it starts in both.

    Surroundings of all hits on one diagonal (document place less item place) of a document and an item are put
    together, so an overlap has its full extent. They meet as bits, merged before they move: what a diagonal gathers
    follows the item's length only, whatever number of rows a document is repeated in.
    """
    text = F.col("text").cast("string").alias("text")
    items = benchmark.select("item_id", row_key("item_id", "text").alias("__item"), text)
    tests = materialise(seed_table(items), "benchmark-seeds")
    bits, bitmap = bitmap_of(tests, "seed")
    hits = seed_table(docs.select(*ids, row_key(*ids, "text").alias("__doc"), text), bits, bitmap)
    tests = tests.select("seed", "item_id", "__item", *[F.col(c).alias(a) for c, a in (
        ("at", "item_at"), ("n_tokens", "item_tokens"), ("from_", "item_from"), ("reach", "item_reach"), ("around", "item_around"))])
    joined = hits.join(tests, "seed").drop("seed", "n_tokens").withColumn("least", F.least(F.lit(MIN_OVERLAP), "item_tokens"))
    both = [*ids, "item_id"]
    kinds = dict(docs.dtypes) | {"item_id": dict(benchmark.dtypes)["item_id"]}
    declared = lambda names: ", ".join(f"`{c}` {kinds[c]}" for c in names)
    kinds |= {"__doc": "string", "__item": "string", "least": "int"}
    own = [*both, "__doc", "__item", "least"]
    compared = joined.mapInArrow(_compared(own), declared(own) + ", shift long, block long, known long, equal long")
    blocks = compared.groupBy(*own, "shift", "block").agg(F.bit_or("known").alias("known"), F.bit_or("equal").alias("equal"))
    # Far fewer diagonals have enough equal tokens at all.
    diagonals = blocks.groupBy(*own, "shift").agg(
        F.sum(F.bit_count("equal")).alias("n"), F.sort_array(F.collect_list(F.struct("block", "known", "equal"))).alias("blocks")).where("n >= least").drop("n")
    found = diagonals.mapInArrow(_chained(both), declared(both) + ", overlap long, matching long, doc_token long, item_token long")
    best = F.max(F.struct("matching", "overlap", (-F.col("doc_token")).alias("d"), (-F.col("item_token")).alias("i"))).alias("b")
    return found.groupBy(*both).agg(best).select(
        *both, F.col("b.overlap").alias("overlap_tokens"), F.col("b.matching").alias("matching_tokens"), (-F.col("b.d")).alias("doc_token"), (-F.col("b.i")).alias("item_token"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, overlap_tokens, matching_tokens, doc_token, item_token."""
    return find_overlaps(docs, benchmark, ["doc_id"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no test item, with their own columns."""
    keyed = docs.select(F.struct("*").alias("__row"), row_key("doc_id", "text").alias("__key"), F.col("text"))
    found = materialise(find_overlaps(keyed.select("__key", "text"), benchmark, ["__key"]).select("__key").distinct(), "benchmark-leaks")
    return keyed.join(found, "__key", "left_anti").select("__row.*")
