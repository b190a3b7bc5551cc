import random
import re

import cases
import numpy as np

from formflow.llm import bitmaps, decontamination

ITEMS = "item_id long, text string"


def words(seed, n):
    rng = random.Random(seed)
    return [f"t{rng.randrange(10**6)}" for _ in range(n)]


def found(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), ITEMS)
    return {(r.doc_id, r.item_id): r for r in decontamination.leaks(d, b).collect()}


def fewest_substitutions(masks, upto):
    """For each length the fewest substituted tokens with which no mask finds its tokens equal; one bit per token passed."""
    wide = max(m[-1] for m in masks)
    looked_at = [sum(1 << (m[-1] - p) for p in m) for m in masks]
    passed = np.arange(1 << wide)
    cost = np.where(passed == passed[-1], 0, 10**6)
    for _ in range(upto):
        following = np.full(len(passed), 10**6)
        for bit in (0, 1):
            window = 2 * passed + bit
            hidden = np.all([(window & m) != 0 for m in looked_at], axis=0)
            np.minimum.at(following, window & passed[-1], np.where(hidden, cost + bit, 10**6))
        cost = following
        yield int(cost.min())


def test_every_accepted_overlap_keeps_a_seed():
    for length, fewest in enumerate(fewest_substitutions(decontamination.MASKS, 300), start=1):
        if length >= decontamination.MIN_OVERLAP:
            assert fewest > min(length - decontamination.MIN_OVERLAP, int(length * (1 - decontamination.MIN_SHARE) + 1e-9)), length


def test_substituted_overlaps_are_found(spark):
    rng = random.Random(21)
    items, docs = [], []
    for length in (15, 16, 20, 25, 30, 40):
        for k in range(40):
            item = words(1000 * length + k, length)
            places = range(3, length, 4) if k == 0 and length < 20 else rng.sample(range(1, length - 1), length // 5)
            items.append(" ".join(item))
            docs.append(" ".join(words(k, 30) + [f"s{i}" if i in places else t for i, t in enumerate(item)] + words(k + 1, 30)))
    assert {(i, i) for i in range(len(items))} <= found(spark, docs, items).keys()


def test_bitmap_never_misses(spark):
    rng = random.Random(3)
    hashes = [rng.getrandbits(64) - 2**63 for _ in range(3000)]
    bits, bitmap = bitmaps.bitmap_of(spark.createDataFrame([(h,) for h in hashes], "h long"), "h")
    assert bitmaps.held(np.array(hashes, dtype=np.int64).view(np.uint64), bits, bitmap).all()
    others = np.array([rng.getrandbits(64) for _ in range(20000)], dtype=np.uint64)
    assert bitmaps.held(others, bits, bitmap).mean() < 0.01
    assert bitmaps.held(others, *bitmaps.bitmap_of(spark.createDataFrame([], "h long"), "h")).sum() == 0


def test_passages_are_found_with_substitutions(spark):
    item = words(1, 60)
    changed = item[:]
    for i in range(4, 60, 8):
        changed[i] = "other"
    lead, tail = words(2, 50), words(3, 50)
    text = lambda middle: " ".join(lead + middle + tail)
    docs = [text(item), text(changed), text(item[10:24]), text(item[10:20]), text([]), " ".join(item).upper().replace(" ", ", "), text(words(4, 60))]
    got = found(spark, docs, [" ".join(item)])
    assert {d for d, _ in got} == {0, 1, 2, 5}
    assert (got[0, 0].overlap_tokens, got[0, 0].matching_tokens, got[0, 0].doc_token, got[0, 0].item_token) == (60, 60, 50, 0)
    assert got[1, 0].overlap_tokens >= 50 and got[1, 0].matching_tokens < got[1, 0].overlap_tokens
    assert (got[2, 0].overlap_tokens, got[2, 0].item_token) == (14, 10)


def aligned(pattern, seed=70):
    """An item, and a document that has its tokens where the pattern says 1."""
    item, other = words(seed, len(pattern)), words(seed + 1, len(pattern))
    return " ".join(item), " ".join(t if p == "1" else o for t, o, p in zip(item, other, pattern))


def test_partly_similar_surroundings_hide_no_exact_run(spark):
    item, doc = aligned("0111111111001110101001011111111111101011110000010110011101")
    row = found(spark, [doc], [item])[0, 0]
    assert row.matching_tokens >= 12 and row.matching_tokens >= 0.8 * row.overlap_tokens


def test_overlaps_have_their_full_extent(spark):
    item = words(80, 300)
    changed = ["other" if i % 20 == 10 else t for i, t in enumerate(item)]
    docs = [" ".join(words(81, 40) + d + words(82, 40)) for d in (item, changed, item[30:90], item[:40] + words(83, 120) + item[160:])]
    got = found(spark, docs, [" ".join(item)])
    at = {d: (r.overlap_tokens, r.matching_tokens, r.doc_token, r.item_token) for (d, _), r in got.items()}
    assert at == {0: (300, 300, 40, 0), 1: (300, 285, 40, 0), 2: (60, 60, 40, 30), 3: (140, 140, 200, 160)}


def test_rows_of_one_id_are_not_chained_together(spark):
    item = words(84, 20)
    halves = [item[:10] + words(85, 10), words(86, 10) + item[10:]]
    docs = spark.createDataFrame([(None, " ".join(h)) for h in halves], "doc_id long, text string")
    assert decontamination.leaks(docs, spark.createDataFrame([(None, " ".join(item))], ITEMS)).isEmpty()
    items = spark.createDataFrame([(None, " ".join(h)) for h in halves], ITEMS)
    assert decontamination.leaks(spark.createDataFrame([(1, " ".join(item))], "doc_id long, text string"), items).isEmpty()


def test_longest_overlap_equals_all_pairs():
    rng = random.Random(5)
    for width in (1, 5, 30, 73):
        equal = np.array([[rng.random() < p for _ in range(width)] for p in [rng.choice((0.2, 0.6, 0.75, 0.9)) for _ in range(60)]])
        known = np.array([[rng.random() < 0.97 for _ in range(width)] for _ in range(60)])
        ok, length, matching, start = decontamination.longest(equal, known, np.full(60, min(12, width)))
        for e, k, *got in zip(equal & known, known, ok, length, matching, start):
            every = [(sum(e[i:j]), j - i, -i) for i in range(width) for j in range(i + 1, width + 1)
                     if e[i] and e[j - 1] and all(k[i:j]) and 5 * sum(e[i:j]) >= 4 * (j - i)]
            best = max(every, default=(0, 0, 0))
            assert got[0] == (best[0] >= min(12, width)) and (not got[0] or (got[2], got[1], -got[3]) == best)


def test_equals_brute_force_on_exact_passages(spark):
    rng = random.Random(8)
    items = [words(100 + i, rng.randrange(5, 40)) for i in range(15)]
    docs = []
    for i in range(120):
        parts = words(500 + i, rng.randrange(0, 30))
        if rng.random() < 0.5:
            own = rng.choice(items)
            a = rng.randrange(len(own))
            parts += own[a : a + rng.randrange(5, 40)]
        docs.append(parts + words(900 + i, rng.randrange(0, 30)))

    def longest(d, t):
        best = 0
        for i in range(len(d)):
            for j in range(len(t)):
                k = 0
                while i + k < len(d) and j + k < len(t) and d[i + k] == t[j + k]:
                    k += 1
                best = max(best, k)
        return best

    want = {(i, j) for i, d in enumerate(docs) for j, t in enumerate(items) if longest(d, t) >= min(decontamination.MIN_OVERLAP, max(len(t), decontamination.SHORTEST))}
    assert found(spark, map(" ".join, docs), map(" ".join, items)).keys() == want and len(want) > 5


def test_registered_query_equals_token_runs(spark):
    from formflow.llm.queries import QUERIES

    got = {(r.doc_id, r.item_id) for r in QUERIES["op1_decontamination"](spark, "/root/testdata/sf0.001").collect()}
    tokens = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    table = lambda n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet").collect()
    runs = {}
    for r in table("benchmark"):
        w = tokens(r.text)
        for k in range(len(w) - 11):
            runs.setdefault(tuple(w[k : k + 12]), set()).add(r.item_id)
    want = set()
    for r in table("documents"):
        w = tokens(r.text)
        want |= {(r.doc_id, i) for k in range(len(w) - 11) for i in runs.get(tuple(w[k : k + 12]), ())}
    assert got == want and want


def test_edge_cases(spark):
    item = " ".join(words(1, 30))
    docs = cases.with_clashes(cases.documents(spark).unionByName(cases.documents(spark, [(20, "x " + item, "en", "s", 1), (20, "x " + item, "en", "s", 1), (None, item, "en", "s", 1)])))
    items = cases.with_clashes(spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short"), (None, item)], ITEMS))
    rows = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()}
    assert rows == {(20, 1), (20, None), (None, 1), (None, None)}
    clean = decontamination.decontaminate(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 3
    nothing = items.limit(0)
    assert decontamination.leaks(docs, nothing).isEmpty() and decontamination.decontaminate(docs, nothing).count() == docs.count()
    empty = cases.documents(spark, [])
    assert decontamination.leaks(empty, items).isEmpty() and decontamination.decontaminate(empty, items).isEmpty()
