import hashlib
import random
from collections import Counter
from itertools import pairwise

import cases
import sentencepiece
from tokenizers import Tokenizer

from formflow.llm import alignment
from formflow.llm.queries import op11_tokenizer_alignment, table, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
HARD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "a  b \n\n c\t d"), (6, "x▁y"), (7, "</s> <|endoftext|> <unk> <0x0A>"), (8, "日本語 テキスト ﬁ①\n\n\n"), (9, "\n"),
    (10, " \n "), (None, "a b c"), (11, "\x1c a\x85 b\xa0 c"), (11, "\x1c a\x85 b\xa0 c"), (12, "ab" * 500 + " " + "é" * 300 + " 12345" * 40),
    (13, "it's we'll \n 's  't\n\n x"), (14, "word " * 300), (15, "x▁y " * 200), (16, "ñandú " * 100 + "\n" + "z" * 900),
]


def brute(docs):
    """Whole texts, token by token."""
    a_tok, b_tok, known = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), alignment.pair_of(A, B)
    a_tok.encode_special_tokens = True
    found, counts = [], Counter()
    for doc_id, text in docs:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if not text or any(b"".join(names[i] for i in ids) != want for ids, names in ((a, known.a_bytes), (b, known.b_bytes))):
            found.append((doc_id, [], [], [], []))
            continue
        spans = []
        for ids, names in ((a, known.a_bytes), (b, known.b_bytes)):
            ends = [0]
            for i in ids:
                ends.append(ends[-1] + len(names[i]))
            spans.append(list(zip(ids, pairwise(ends))))
        cuts = sorted({e for _, (_, e) in spans[0]} & {e for _, (_, e) in spans[1]})
        groups, links, start = [], [], 0
        for cut in cuts:
            ga, gb = ([t for t in side if start < t[1][1] <= cut] for side in spans) if len(cuts) < 50 else ([], [])
            start = cut
            groups.append((ga, gb))
        if len(cuts) >= 50:
            groups, at = [], [0, 0]
            for cut in cuts:
                both = []
                for i, side in enumerate(spans):
                    x = at[i]
                    while at[i] < len(side) and side[at[i]][1][1] <= cut:
                        at[i] += 1
                    both.append(side[x : at[i]])
                groups.append(tuple(both))
        links = [(i, j) for ga, gb in groups for i, (p, q) in ga for j, (r, s) in gb if max(p, r) < min(q, s)]
        counts.update(links)
        found.append((doc_id, a, b, [",".join(str(i) for i, _ in ga) + "|" + ",".join(str(j) for j, _ in gb) for ga, gb in groups], links))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return sorted([
        (d, len(a), len(b), len(g), len(x), sum(counts[p] == top[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for d, a, b, g, x in found], key=str)


def test_equals_whole_texts_for_any_range(spark):
    df = spark.createDataFrame(HARD, "doc_id long, text string")
    want = brute(HARD)
    for size in (61, alignment.RANGE):
        assert cases.rows(alignment.align(df, A, B, range_bytes=size).select(*COLUMNS)) == want, size


def test_registered_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in table(spark, d, "documents").select("doc_id", "text").collect()]
    assert cases.rows(op11_tokenizer_alignment(spark, d)) == brute(docs)


def test_edges(spark):
    plain = cases.documents(spark)
    got = cases.rows(alignment.align(cases.with_clashes(plain), A, B, range_bytes=1000).select(*COLUMNS))
    assert got == brute([(r.doc_id, r.text) for r in plain.collect()])
    assert alignment.align(cases.documents(spark, []), A, B).count() == 0


def cut_fragment(text, borders):
    """Fragments of a text's byte ranges, from its whole encoding."""
    import numpy as np

    pair = alignment.pair_of(A, B)
    a, b = np.array(pair.a.encode(" " + text, add_special_tokens=False).ids), np.array(pair.b.encode(text))
    ends = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
    out = []
    for start, end in pairwise(borders):
        a0, a1, a2, a3, b0, b1, b2, b3, cut = alignment.fragment(a, ends[0], b, ends[1], start, end)
        t = lambda x, p, q: tuple(x[p:q].tolist())
        closed = ((t(a, a1, a2), t(b, b1, b2)),) if a2 > a1 else ()
        out.append(alignment.Fragment((t(a, a0, a1), t(b, b0, b1)), closed, (t(a, a2, a3), t(b, b2, b3)), cut))
    return out


def flat(x):
    """Closed groups as ids: a run of several groups and the groups one by one are the same."""
    return [sum((g[i] for g in x.closed), ()) for i in (0, 1)], x.prefix, x.suffix, x.cut


def test_fragments_form_a_monoid():
    rng = random.Random(3)
    text = "internationalisation of naïve déjà-vu tokenisers 1234567 " + "qwertzuiopasdfgh" * 6
    size = len((" " + text).encode())
    for _ in range(30):
        parts = cut_fragment(text, [0, *sorted(rng.sample(range(1, size), 7)), size])
        assert all(alignment.compose(alignment.EMPTY, p) == p == alignment.compose(p, alignment.EMPTY) for p in parts)
        while len(parts) > 1:  # any tree
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [alignment.compose(parts[i], parts[i + 1])]
        whole = cut_fragment(text, [0, size])[0]
        assert flat(parts[0]) == flat(whole) and whole.prefix == whole.suffix == ((), ())
    several = [cut_fragment(text, [0, a, a + 2, size]) for a in range(2, size - 3)]
    for x, y, z in several:
        assert alignment.compose(alignment.compose(x, y), z) == alignment.compose(x, alignment.compose(y, z))
    assert any(f.suffix != ((), ()) for parts in several for f in parts) and any(not f.cut for parts in several for f in parts)  # borders inside groups


def test_byte_ranges_cover_a_text_and_spare_long_segments():
    for text in ("word " * 500, "x" * 9000 + " tail" * 200, ("y" * 5000 + " ") * 3, "é" * 70, "a b\nc " * 90 + "z" * 4500):
        ranges = list(alignment.byte_ranges(text, 256, 4096))
        whole = (" " + text).encode()
        assert ranges[0][0] == 0 and ranges[-1][1] == len(whole)
        assert all(x[1] == y[0] for x, y in pairwise(ranges))
        for start, end, at, part in ranges:
            raw = part.encode()
            assert at <= start < end <= at + len(raw) and whole[at : at + len(raw)] == raw
        encoded = sum(len(r[3].encode()) for r in ranges)
        assert encoded <= len(whole) + 4096 * len(ranges)
        assert sum("x" * 5000 in r[3] for r in ranges) <= 1


def test_forgetting_segments_changes_nothing():
    docs = [(i, cases.prose(i, 40) + " " + t) for i, (_, t) in enumerate(HARD) if t]
    small = alignment.pair_of(A, B)
    keep = []
    for kept in (10, 10**6):
        small.forget()
        for one in range(len(docs)):
            if len(small.known) > kept:
                small.forget()
            ids = small.lookup(alignment.SEGMENT.findall(" " + docs[one][1]))
            keep.append(b";".join([small.text[i] for i in ids]))
    assert keep[: len(docs)] == keep[len(docs) :]


def test_blocks_are_small_and_the_worker_keeps_no_segments_after_its_task(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=2000)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    blocks = alignment._short_blocks(A, B)

    def sizes(batches):
        import pyarrow as pa

        moved = sum(len(b.column(c)[0].as_py()) for b in blocks(batches) for c in ("unit_at", "units", "pair_at", "unit_pairs"))
        yield pa.RecordBatch.from_arrays([pa.array([moved]), pa.array([len(alignment.pair_of(A, B).known)])], ["moved", "known"])

    row = docs.mapInArrow(sizes, "moved long, known long").first()
    assert 0 < row.moved < 2.5 * 40 * 2000 and row.known == 0  # four bytes for each segment uncompressed
