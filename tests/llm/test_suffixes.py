import collections
import hashlib
import random

import cases
import numpy as np

from formflow.llm import suffixes


def brute(texts, length=suffixes.LENGTH):
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        spans = []
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        kept, at = [], 0
        for a, e in spans:
            kept.append(b[at:a])
            at = e
        out.append((len(b), [tuple(s) for s in spans], hashlib.sha256(b"".join([*kept, b[at:]])).hexdigest()))
    return out


def text(rng, n, alphabet="abcdefgh é"):
    return "".join(rng.choices(alphabet, k=n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [text(rng, n) for n in (395, 399, 400, 401, 450, 700, 1500)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 60)
            parts += [text(rng, rng.randrange(0, 120)), p[a:] if rng.random() < 0.5 else p[: len(p) - a], text(rng, rng.randrange(0, 40), "xy")]
        texts.append("".join(parts))
    texts += ["z" * 399, "z" * 400, "q" * 401, "m" * 1200, "ab" * 300, ("line of text é\n" * 60), passages[-1], passages[-1], None, "", "", "short", "short"]
    # partners whose agreement grows on both sides at the same place
    core = text(rng, 420)
    texts += [core[:k] + text(rng, 50, "pq") for k in range(398, 421, 3)] + [text(rng, 50, "rs") + core[k:] for k in range(0, 24, 3)]
    rng.shuffle(texts)
    return texts


def test_anchors_by_block_equal_anchors_of_whole_texts(monkeypatch):
    rng = np.random.default_rng(7)
    sizes = [0, 30, 399, 400, 5000, 0, 401, 1200, 9000, 0]
    borders = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    raw = rng.integers(97, 101, borders[-1]).astype(np.uint8)
    raw[8000:9000] = 97
    want = set(zip(*(x.tolist() for x in suffixes.anchors_of(raw, borders))))
    for block in (1 << 18, 997, 400, 50):
        monkeypatch.setattr(suffixes, "BLOCK", block)
        got = {x for part in suffixes.anchors_by_block(raw, borders) for x in zip(*(p.tolist() for p in part))}
        assert got == want and want, block
    assert not list(suffixes.anchors_by_block(raw[:399], np.array([0, 399])))


def test_spans_equal_brute_force(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        want = brute(texts)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
        rows = suffixes.repeated_spans(docs).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert (r.n_bytes, [(s.start, s.end) for s in r.removed], r.kept_sha256) == want[r.doc_id], texts[r.doc_id]


def test_anchors_of_equal_strings_agree():
    rng = random.Random(4)
    shared = bytes(rng.choices(b"abcd", k=suffixes.LENGTH))
    seen = []
    for lead in (0, 13, 500):
        raw = np.frombuffer(bytes(rng.choices(b"abcd", k=lead)) + shared + bytes(rng.choices(b"abcd", k=77)), dtype=np.uint8)
        value, _, at = suffixes.anchors_of(raw, np.array([0, len(raw)]))
        seen.append({(int(v), int(a) - lead) for v, a in zip(value, at) if lead <= a <= lead + suffixes.LENGTH - suffixes.GRAM})
    assert set.intersection(*seen)


def test_front_coding_and_merge():
    rng = random.Random(2)
    for runs in (1, 2, 3, 8, 13):
        parts = [sorted((bytes(rng.choices(b"ab", k=rng.randrange(1, 30))), bytes(rng.choices(b"ab", k=5)), bytes([k]) * 16, i) for i in range(rng.randrange(0, 40))) for k in range(runs)]
        for p in parts:
            assert [e for e, _ in suffixes.decode_run(suffixes.encode_run(p))] == p
        merged = list(suffixes.merge_runs([suffixes.decode_run(suffixes.encode_run(p)) for p in parts]))
        assert [e[0] for e, _ in merged] == sorted(e[0] for p in parts for e in p)
        assert sorted(e for e, _ in merged) == sorted(e for p in parts for e in p)
        for (a, _), (b, shared) in zip(merged, merged[1:]):
            assert shared == suffixes.shared_prefix(a[0], b[0])


def test_cluster_extents_equal_all_pairs():
    rng = random.Random(7)
    for n in (2, 3, 10, 60):
        for length in (6, 10):
            entries = sorted({(bytes(rng.choices(b"ab", k=8)), bytes(rng.choices(b"ab", k=6)), b"", 0) for _ in range(n)})
            shared = [0] + [suffixes.shared_prefix(a[0], b[0]) for a, b in zip(entries, entries[1:])]
            got = suffixes.cluster_extents(entries, shared, length)
            for i, e in enumerate(entries):
                pairs = [(suffixes.shared_prefix(e[1], o[1]), suffixes.shared_prefix(e[0], o[0])) for j, o in enumerate(entries) if j != i]
                good = [p for p in pairs if sum(p) >= length]
                assert got[i] == (max((p[0] for p in good), default=0), max((p[1] for p in good), default=0))


def test_edge_cases(spark):
    docs = cases.with_clashes(cases.documents(spark))
    rows = suffixes.repeated_spans(docs).collect()
    assert len(rows) == docs.count()
    copies = [r for r in rows if r.doc_id in (1, 7)]
    assert len(copies) == 3 and all([(s.start, s.end) for s in r.removed] == [(0, r.n_bytes)] for r in copies)
    assert all(r.n_bytes == 0 and not r.removed for r in rows if r.doc_id in (2, 3))
    assert suffixes.repeated_spans(cases.documents(spark, [])).isEmpty()


def test_a_cluster_holds_equal_surroundings_once():
    cluster = suffixes.Cluster()
    for i in range(1000):
        cluster.add((b"s" * 400, b"l" * 10, b"%016d" % i, i), 0 if i == 0 else 400)
    cluster.add((b"t" * 400, b"l" * 10, b"x" * 16, 5), 64)
    assert len(cluster.members) == 2 and [len(o) for o in cluster.owners] == [1000, 1] and cluster.shared == [0, 64]
