import random
import zlib

import cases
import numpy as np
from tokenizers import Tokenizer

from formflow.llm import packing
from formflow.llm.queries import tokenizer_path

ODD = ["a\x1cb  $\x1c$ don't<|endoftext|>x", "", "  ", "ÉCOLE É́ ́x ΣΑΣ İstanbul 1a2 ½ a b　c", "x" * 3000, "it's'll 'd", "a\u0085b c", "﻿ab ​ c", "<|startoftext|> <|ENDOFTEXT|>"]


def test_ids_are_the_tokenizers(monkeypatch):
    plain = Tokenizer.from_file(tokenizer_path())
    texts = ODD + [cases.prose(i, 50) for i in range(20)] + ODD
    for kept in (packing.KEPT_CHUNKS, 3):
        monkeypatch.setattr(packing, "KEPT_CHUNKS", kept)
        encoder = packing.ChunkEncoder(tokenizer_path())
        for part in (texts, texts[::-1], []):
            ids, counts = encoder.encode(part)
            at = np.cumsum(counts) - counts
            for text, a, n in zip(part, at, counts):
                assert ids[a : a + n].tolist() == plain.encode(text, add_special_tokens=False).ids, text
        assert kept > 3 or len(encoder.known) < 200


def applied(rules):
    """(length, rank) -> (sequence, offset)"""
    return {(length, first + j): (seq + j // each, offset + j % each * length) for length, first, n, each, seq, offset in rules for j in range(n)}


def test_supersteps_fill_sequences_without_gaps():
    rng = random.Random(4)
    for capacity, n in ((10, 1), (10, 50), (64, 300), (4096, 2000)):
        for _ in range(5):
            counts = {}
            for _ in range(n):
                length = min(capacity, max(1, int(rng.lognormvariate(np.log(capacity / 6), 1))))
                counts[length] = counts.get(length, 0) + 1
            places = applied(packing.plan_runs(counts, capacity))
            assert len(places) == sum(counts.values())
            spans = {}
            for (length, rank), (seq, offset) in places.items():
                assert rank < counts[length]
                spans.setdefault(seq, []).append((offset, offset + length))
            for own in spans.values():
                own.sort()
                assert own[0][0] == 0 and own[-1][1] <= capacity and all(a[1] == b[0] for a, b in zip(own, own[1:]))
            assert sorted(spans) == list(range(len(spans)))
            assert len(spans) <= reference_best_fit(counts, capacity)


def reference_best_fit(counts, capacity):
    """Best-fit decreasing, one piece after the other."""
    gaps = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


def test_all_documents_are_packed(spark):
    docs = cases.with_clashes(cases.documents(spark))
    plain = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack_documents(docs, tokenizer_path(), capacity=512).collect()
    ids = [plain.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()]
    want = sorted((len(x), k, zlib.crc32(np.array(x[k * 512 : (k + 1) * 512], dtype="<u4").tobytes())) for x in ids for k in range(-(-len(x) // 512)))
    assert sorted((r.length + r.start if r.start + r.length == 0 else next(len(x) for x in ids if len(x) > r.start and zlib.crc32(
        np.array(x[r.start : r.start + r.length], dtype="<u4").tobytes()) == r.ids_crc32), r.piece, r.ids_crc32) for r in rows) == want
    assert all(r.start == r.piece * 512 for r in rows)
    full = {}
    for r in rows:
        full.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in full.values():
        own.sort()
        assert sum(n for _, n in own) <= 512 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[0][0] == 0


def test_sequences_hold_the_ids(spark):
    docs = cases.documents(spark)
    plain = Tokenizer.from_file(tokenizer_path())
    out = packing.sequences(docs, tokenizer_path(), capacity=4096).collect()
    total = sum(len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sum(len(r.ids) for r in out) == total and all(0 < len(r.ids) <= 4096 for r in out)


def test_empty(spark):
    assert packing.pack_documents(cases.documents(spark, []), tokenizer_path()).isEmpty()
