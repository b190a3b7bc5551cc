import random
import re

import cases
import numpy as np
from pyspark.sql import functions as F

from formflow.llm import minhash
from formflow.llm.components import connected_components


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(texts, k, percent=80):
    """doc -> smallest doc of its component"""
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sets, [find(i) for i in range(len(texts))]


def edited(rng, words, n):
    out = words[:]
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def corpus(seed):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(70)]
    texts = []
    for g in range(12):
        base = [f"b{g}_{rng.randrange(10**6)}" for _ in range(rng.choice((6, 15, 60, 300)))]
        texts += [" ".join(edited(rng, base, rng.randrange(0, 1 + len(base) // 12))) for _ in range(rng.choice((1, 2, 5, 25)))]
        texts += [" ".join(base).title(), " ".join(base) + "\n"]
    texts += [" ".join(common + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))]) for _ in range(60)]
    # a chain: neighbours are similar, ends are not
    chain = [f"k{i}" for i in range(140)]
    texts += [" ".join(chain[i * 8 : i * 8 + 100]) for i in range(5)]
    texts += ["", None, " \t", "one", "one", "One two three", "a b c d", "a b c d e"]
    rng.shuffle(texts)
    return texts


def test_components_equal_brute_force(spark):
    for seed, k in ((1, 4), (2, 5)):
        texts = corpus(seed)
        sets, want = brute(texts, k)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        for r in minhash.near_duplicates(docs, ["doc_id"], "doc_id", k).collect():
            assert (r.n, r.component) == (len(sets[r.doc_id]), want[r.doc_id]), texts[r.doc_id]


def test_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(edited(rng, base, 3)) for _ in range(400)] + [" ".join(base)] * 200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, want = brute(texts[:401], 4)
    got = {r.doc_id: r.component for r in minhash.near_duplicates(docs, ["doc_id"], "doc_id", 4).collect()}
    assert all(got[i] == want[i] for i in range(401)) and {got[i] for i in range(401, 600)} == {want[400]}


def test_parities_bound_the_difference():
    rng = np.random.default_rng(4)
    for n, changed in ((3, 1), (50, 10), (400, 80), (5000, 900)):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.r_[a[changed:], rng.integers(0, 2**63, changed + 2, dtype=np.uint64)]
        differing = int(np.bitwise_count(minhash.parities(a) ^ minhash.parities(b)).sum())
        assert differing <= 2 * changed + 2 and (n > 400 or differing >= 2 * changed * 0.7)


def test_remaining_pairs_miss_none_around_the_threshold(spark):
    rng = random.Random(12)
    texts = []
    for g in range(4):
        base = [f"g{g}_{i}" for i in range(rng.choice((40, 120, 260)))]
        texts += [" ".join(edited(rng, base, rng.randrange(1, 2 + len(base) // 20))) for _ in range(30)]
    sets = [shingles(t, 5) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.mapInArrow(minhash._sketches(5), "doc_id long, n long, print binary, sketch array<long>")
    classes = rows.select(F.col("doc_id").alias("cls"), "n", "print", "sketch")
    for groups in (1, 3, 10**6):
        opened = classes.select("cls", (F.col("cls") % groups).alias("root"))
        got = {(r.a, r.b) for r in minhash.remaining_pairs(opened, classes, docs.select("text"), 5, 80).collect()}
        apart = {(i, j) for j in range(len(texts)) for i in range(j) if i % groups != j % groups}
        want = {(i, j) for i, j in apart if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
        assert want <= got <= apart and (groups == 1 or len(got) < 1.5 * len(want))


def test_neighbours_are_pairs_of_open_lists(spark):
    rng = random.Random(3)
    rows = [(v, c, 100 + c % 7, c % 5) for v in range(40) for c in rng.sample(range(60), 20)]
    lists = spark.createDataFrame(rows, "value long, cls long, n long, root long").repartition(3)
    got = {(r.a, r.b) for r in minhash.neighbour_pairs(lists, 0.8).collect()}
    together = {(a, b) for v in range(40) for _, a, _, p in [x for x in rows if x[0] == v] for _, b, _, q in [x for x in rows if x[0] == v] if a < b and p != q}
    per_class = [sum(a == c for a, _ in got) for c in range(60)]
    assert got <= together and len(got) > 60 and max(per_class) == minhash.NEIGHBOURS
    assert minhash.neighbour_pairs(lists.withColumn("root", F.lit(1).cast("long")), 0.8).isEmpty()
    assert minhash.neighbour_pairs(lists.where("value < 0"), 0.8).isEmpty()


def test_group_around_the_threshold_leaves_few_pairs_to_the_full_sets(spark, monkeypatch):
    rng = random.Random(21)
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(edited(rng, base, 3)) for _ in range(120)]
    left, exact = [], minhash.remaining_pairs

    def counted(opened, *rest):
        sizes = [r["count"] for r in opened.groupBy("root").count().collect()]
        left.append((sum(sizes) ** 2 - sum(n * n for n in sizes)) // 2)
        return exact(opened, *rest)

    monkeypatch.setattr(minhash, "remaining_pairs", counted)
    _, want = brute(texts, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in minhash.near_duplicates(docs, ["doc_id"], "doc_id", 4).collect()}
    assert got == dict(enumerate(want)) and len(set(want)) < 60
    assert sum(left) < 0.2 * len(texts) ** 2 / 2, left


def test_texts_that_share_a_few_shingles_do_not_meet_on_full_sets(spark, monkeypatch):
    rng = random.Random(31)
    phrases = [[f"p{i}_{j}" for j in range(6)] for i in range(60)]
    texts = []
    for _ in range(300):  # chance phrases of many texts, and words of its own
        some = [w for p in rng.sample(phrases, 4) for w in [*p, *(f"u{rng.randrange(10**9)}" for _ in range(30))]]
        texts.append(" ".join(some))
    left, exact = [], minhash.remaining_pairs
    monkeypatch.setattr(minhash, "remaining_pairs", lambda opened, *rest: left.append(opened.count()) or exact(opened, *rest))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in minhash.near_duplicates(docs, ["doc_id"], "doc_id", 4).collect()}
    assert got == {i: i for i in range(300)} and sum(left) < 30, left


def test_short_lists_give_all_their_pairs(spark):
    rows = [(v, 10 * v + c, 100, n, c % 2) for v, n in ((1, 8), (2, 5), (3, 9)) for c in range(n)]
    opened = spark.createDataFrame(rows, "value long, cls long, n long, size long, root long")
    got = {(r.a, r.b) for r in minhash.short_list_pairs(opened, 0.8).collect()}
    assert got == {(10 * v + i, 10 * v + j) for v, n in ((1, 8), (2, 5)) for j in range(n) for i in range(j) if i % 2 != j % 2}


def test_similar_classes_have_enough_in_common(spark):
    rng = random.Random(17)
    texts = []
    for g in range(6):
        base = [f"g{g}_{i}" for i in range(rng.choice((5, 20, 45, 120, 260)))]
        texts += [" ".join(edited(rng, base, rng.randrange(1, 2 + len(base) // 20))) for _ in range(20)]
    texts += [" ".join([f"c{i}" for i in range(12)] + [f"u{rng.randrange(10**9)}" for _ in range(80)]) for _ in range(20)]
    sets = [shingles(t, 4) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.mapInArrow(minhash._sketches(4), "doc_id long, n long, print binary, sketch array<long>")
    classes = rows.select(F.col("doc_id").alias("cls"), "n", "print", "sketch")
    opened = classes.select("cls", (F.col("cls") % 3).alias("root"))
    got = {(r.cls, r.root) for r in minhash.enough_in_common(opened, classes, 0.8).collect()}
    similar = {i for j in range(len(texts)) for i in range(len(texts)) if i % 3 != j % 3 and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert {(i, i % 3) for i in similar} <= got and not {c for c, _ in got} & set(range(120, 140))


def test_contraction(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root if n in got} and {n for e in edges for n in e if e[0] != e[1]} <= got.keys()
    assert connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_edge_cases(spark):
    docs = cases.with_clashes(cases.documents(spark))
    out = minhash.near_duplicates(docs, ["doc_id"], "doc_id", 4)
    assert out.count() == docs.count()
    assert {(r.doc_id, r.component) for r in out.collect() if r.doc_id in (2, 3, 4, 7, 1)} == {(2, 2), (3, 3), (4, 4), (7, 1), (1, 1)}
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "6", "8", "None", "None"])
    empty = cases.documents(spark, [])
    assert minhash.near_duplicates(empty, ["doc_id"], "doc_id").isEmpty() and minhash.keep_one(empty).isEmpty()
    unlinked = minhash.near_duplicates(docs.where(F.col("doc_id") == 5), ["doc_id"], "doc_id").collect()
    assert [r.component for r in unlinked] == [5]


def test_only_wanted_sketches_and_shared_lists_move(spark):
    rng = np.random.default_rng(8)
    classes = spark.createDataFrame(
        [(i + (i % 3 << 33), 70, [int(v) for v in rng.integers(-2**63, 2**63, 4)]) for i in range(4000)], "cls long, n long, sketch array<long>")
    wanted = classes.select("cls").where("cls % 1000 = 7")
    got = minhash._sketches_of(wanted, classes)
    asked = {r.cls for r in wanted.collect()}
    assert asked and asked <= {r.cls for r in got.collect()} and got.count() < len(asked) + 40
    assert minhash._sketches_of(wanted.where("false"), classes).isEmpty()
    lists = spark.createDataFrame(
        [(int(v), c, 70, 0.5) for c, v in enumerate(rng.integers(-2**63, 2**63, 3000))] + [(v, c, 70, 0.5) for v in (-5, 0, 12) for c in range(v % 7 + 2)],
        "value long, cls long, n long, score float")
    shared = minhash.shared_lists(lists).groupBy("value").agg(F.count("*").alias("rows"), F.max("size").alias("size")).collect()
    assert {(r.value, r.rows, r["size"]) for r in shared} == {(v, v % 7 + 2, v % 7 + 2) for v in (-5, 0, 12)}


def test_members_move_once_to_the_classes_that_want_them(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i % 40}_{j}" for j in range(30))) for i in range(200)], "doc_id long, text string").repartition(6)
    rows = docs.mapInArrow(minhash._sketches(4), "doc_id long, n long, print binary, sketch array<long>")
    classes = rows.groupBy("print").agg(F.min("doc_id").alias("cls"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans, write = [], minhash.materialise
    try:
        minhash.materialise = lambda df, purpose, keep=False: (plans.append((purpose, df._jdf.queryExecution().executedPlan().toString())), write(df, purpose, keep))[1]
        sets = minhash.full_sets(classes, docs.select("text"), 4)
        assert sets.count() == 40 and {r.n for r in sets.select(F.length("members").alias("n")).collect()} == {27 * 8}
    finally:
        minhash.materialise = write
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert dict(plans)["minhash-sets"].count("Exchange hashpartitioning") == 2


def test_second_pass_takes_few_pivots_of_long_lists(spark):
    rows = [(9, p, v, few) for p, v, few in ((1, 5, False), (2, 9, False), (3, 7, False), (4, 8, False), (5, 1, True), (6, 2, True), (7, 9, False), (8, 9, True))]
    pairs = spark.createDataFrame(rows + [(10, 2, 3, False)], "cls long, pivot long, votes long, few boolean")
    first = spark.createDataFrame([(2, 9), (8, 9)], "a long, b long")  # checked, in this order, and no link
    roots = spark.createDataFrame([(7, 7), (9, 7)], "node long, root long")
    got = {(r.a, r.b) for r in minhash.further_pairs(pairs, first, roots).collect()}
    assert got == {(4, 9), (3, 9), (5, 9), (6, 9), (2, 10)} and minhash.FURTHER == 2


def test_group_around_the_threshold_checks_few_pairs_a_text(spark, monkeypatch):
    rng = random.Random(23)
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(edited(rng, base, 5)) for _ in range(300)]
    checked, check = [], minhash.confirm
    monkeypatch.setattr(minhash, "confirm", lambda pairs, *rest: checked.append(pairs.count()) or check(pairs, *rest))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in minhash.near_duplicates(docs, ["doc_id"], "doc_id", 4).collect()}
    assert got == dict(enumerate(brute(texts, 4)[1]))
    assert checked[1] <= 3 * len(texts), checked


def test_texts_reach_workers_in_small_batches(spark, monkeypatch):
    sketches = minhash._sketches

    def watched(size):
        def run(batches):
            def seen():
                for batch in batches:
                    assert batch.nbytes <= 3 << 20, batch.nbytes
                    yield batch

            return inner(seen())

        inner = sketches(size)
        return run

    monkeypatch.setattr(minhash, "_sketches", watched)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat(concat('w', id, ' '), 800) as text")
    got = minhash.near_duplicates(docs, ["doc_id"], "doc_id", 4)
    assert got.where("component = doc_id and n = 1").count() == 2000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
