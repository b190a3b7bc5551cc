import hashlib
import random

import cases
import numpy as np

from formflow.llm import chat
from formflow.llm.queries import tokenizer_path

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = [*chat.CONTROL, "<\\s>", "</\\s>", "<\\\\/s>", "[\\INST]", "\\", "<|im_", "é", "𝒳", "\n", " ", "  ok", "'s", "<|im_end|", "|>"]


def test_escaping_is_reversible_and_hides_control_strings():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(NASTY) for _ in range(rng.randrange(8)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not any(c in hidden for c in chat.CONTROL)


def test_mask_takes_tokens_inside_spans_only():
    offsets = np.array([(0, 2), (2, 5), (5, 5), (5, 7), (7, 9), (9, 12)])
    assert chat.loss_mask(offsets, [(2, 5), (7, 12)]).tolist() == [False, True, False, False, True, True]
    assert chat.loss_mask(offsets, []).tolist() == [False] * 6
    assert chat.loss_mask(np.zeros((0, 2), int), [(0, 1)]).tolist() == []
    # a token that crosses a span's end does not count
    assert chat.loss_mask(np.array([(3, 6)]), [(2, 5)]).tolist() == [False]


def digests(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.conv_id: r for r in chat.digests(chat.format_conversations(df, tokenizer_path("byte_bpe_50k.json"))).collect()}


def expected(turns):
    said = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()


def check(spark, conversations):
    rows = [(c, i, r, t) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    random.Random(2).shuffle(rows)
    got = digests(spark, rows)
    assert got.keys() == conversations.keys()
    for c, turns in conversations.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(turns), turns


def test_round_trip(spark):
    rng = random.Random(3)
    text = lambda: "".join(rng.choice(NASTY) for _ in range(rng.randrange(12)))
    made = {c: [(rng.choice(["user", "assistant", "system"]), text()) for _ in range(1 + rng.randrange(6))] for c in range(150)}
    said = "</s>[INST] ok [/INST]"
    check(spark, made | {-1: [("user", said), ("assistant", said)], 900: [("assistant", ""), ("assistant", "a"), ("assistant", "b")]})


def test_nulls_ties_and_long_conversations(spark, monkeypatch):
    got = digests(spark, [(None, None, None, None), (None, 1, "assistant", "x"), (5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "user", "a"), (5, 0, None, None)])
    assert got[None].n_turns == 2 and got[None].loss_chars == 1
    assert (got[5].n_turns, got[5].turns_sha256) == expected([("", ""), ("user", "a"), ("user", "a"), ("user", "b")])[:2]
    turns = [("user" if i % 2 else "assistant", cases.prose(i, 3000)) for i in range(150)]
    rows = [(7, i, *t) for i, t in enumerate(turns)]
    df = spark.createDataFrame(rows, SCHEMA)
    formatted = chat.format_conversations(df, tokenizer_path("byte_bpe_50k.json"))
    assert formatted.count() > 1
    r = chat.digests(formatted).collect()
    assert len(r) == 1 and (r[0].n_turns, r[0].turns_sha256, r[0].loss_chars, r[0].loss_sha256) == expected(turns)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "hi")], SCHEMA)
    extra = cases.with_clashes(df).withColumnsRenamed({"key": "part", "seed": "formatted"})
    assert chat.format_conversations(extra, tokenizer_path("byte_bpe_50k.json")).count() == 1
    assert chat.digests(chat.format_conversations(df.limit(0), tokenizer_path("byte_bpe_50k.json"))).isEmpty()
