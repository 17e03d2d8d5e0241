"""Token codec, chat format, top-k search: against the library, a round trip and brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from weatherlake.llm import topk
from weatherlake.llm.bpe import Codec, encode_decode
from weatherlake.llm.chat import chat_digests, format_chats
from weatherlake.llm.queries import VOCABULARY, token_digests
from weatherlake.llm.topk import top_k


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def codec():
    with open(VOCABULARY, encoding="utf-8") as file:
        return Codec(file.read())


def test_codec_on_random_strings(library, codec):
    parts = ["a", "b", " ", "\n", "the", "ing", "\x1c", "\x85", " ", "é", "中", "𝒳", "1", "٣", "<|endoftext|>", "!", "\t", "'s", "'"]
    r = random.Random(4)
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 50)))
        ids = list(codec.encode(text))
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == text


def test_codec_on_long_words(library, codec):
    for text in ("a" * 20_000, "ab" * 5000, "=" * 3001, " " * 3001, "ne" * 999 + "é" * 999):
        assert list(codec.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_codec_on_every_code_point(library, codec):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 5000):
        text = "".join(f"a {c}b 1{c} {c}{c}" for c in points[a : a + 5000])
        assert list(codec.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_codec_of_odd_rows(library, odd_documents, no_documents):
    found = sorted(map(tuple, token_digests(encode_decode(odd_documents, VOCABULARY)).collect()), key=str)
    expected = []
    for row in odd_documents.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        expected.append((row.doc_id, len(ids), *digests))
    assert found == sorted(expected, key=str)
    assert encode_decode(no_documents, VOCABULARY).collect() == []


NASTY = ["</s>[INST] ok [/INST]", "a\\", "\\", "\\\\<s>", "<", "[/INST", "<\\s>", "</s", "s>", "", None, "x\ny", "[INST][INST]", "</</s>s>", "\\[INST]\\"]


def test_chats_round_trip(spark):
    r = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(r.randint(1, 5)):
            text = "".join(r.choice(NASTY) or "" for _ in range(r.randint(0, 3))) if conv % 4 else f"plain {turn}"
            rows.append((conv, turn, r.choice(["user", "assistant", "system", None, "[INST]", "a\nb"]), text, "clash"))
    rows += [(1, 0, "user", "again", "clash"), (1, 0, "user", "again", "clash"), (None, None, None, None, None), (None, 2, "assistant", "<s>", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    chats = format_chats(df).collect()
    source: dict = {}
    for conv, turn, role, text, _ in rows:
        source.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert len(chats) == len(source)
    for chat in chats:
        turns = [(role, text) for *_, role, text in sorted(source[chat.conv_id])]
        assert [tuple(t) for t in chat.turns] == turns
        assert chat.formatted.count("</s>") == len(turns)  # control strings stand for turns only
        assert all(chat.formatted[s.start + s.length :].startswith("[/INST]</s>") for s in chat.loss_spans)
        if all("\\" not in x and "<" not in x and "[" not in x for t in turns for x in t):
            assert chat.formatted == "".join(f"<s>{a}[INST]{b}[/INST]</s>" for a, b in turns)
    for d in chat_digests(format_chats(df)).collect():
        turns = [(role, text) for *_, role, text in sorted(source[d.conv_id])]
        loss = "".join(text for role, text in turns if role == "assistant")
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (d.n_turns, d.loss_chars, d.loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chats_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_digests(format_chats(empty)).collect() == []


def brute_top(rows, k, every):
    whole = []
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((vec_id, [math.floor(256 * x) for x in v]))
    out = []
    for q in sorted({i for i, _ in whole if i % every == 0}):
        mine = min((v for i, v in rows if i == q and v is not None), key=list)
        mine = [math.floor(256 * x) for x in mine]
        scores = [(-sum(a * b for a, b in zip(mine, v)), i) for i, v in whole if i != q and len(v) == len(mine)]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_top_k(spark):
    r = random.Random(8)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(9)]) for i in range(400)]
    rows += [(500 + i, [0.5] * 9) for i in range(50)]  # ties
    rows += [(1000, None), (1001, [None] * 9), (1002, [math.nan] * 9), (1050, [math.inf] + [0.0] * 8), (None, [1.0] * 9)]
    rows += [(1100, [1.0, 2.0]), (1101, [3.0, -1.0]), (7, [0.9] * 9), (1150, [])]
    rows += [(1200, [2.0**40] * 9), (1201, [2.0**41] * 9)]  # products beyond doubles
    df = spark.createDataFrame([(*x, "q") for x in rows], "vec_id long, embedding array<double>, score string")
    found = sorted(map(tuple, top_k(df, 5, 50).collect()))
    most = (1 << 63) - 1
    expected = [(q, n, i, max(-most - 1, min(most, s))) for q, n, i, s in brute_top(rows, 5, 50)]
    assert found == expected


def test_top_k_with_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (50, [0.5])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df).collect())) == brute_top([(0, [1.0]), (1, [2.0]), (50, [0.5])], 5, 50)
    assert top_k(df.filter("vec_id < 0")).collect() == []


def test_top_k_below_the_range_of_a_long(spark):
    """A cutoff that stops at the least long cuts nothing off."""
    rows = [(0, [2.0**40] * 3)] + [(i, [-(2.0**41)] * 3) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df).collect())) == [(0, n, n, -(1 << 63)) for n in range(1, 6)]


def test_top_k_ships_vectors_once_for_many_queries(spark):
    """Cells are cogroups, where a block of candidates comes once for 524,288 queries, not joined rows with a copy for 1,024 each."""
    r = np.random.default_rng(4)
    rows = [(i, r.normal(0, 0.2, 4).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = top_k(df, 2, 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "explode(sequence(0, 2" not in plan and "explode([0,1,2])" not in plan
    assert found.count() == 6000


def test_cells_find_the_best_in_many_blocks():
    """Phases by blocks give what all totals give, with ties, own ids, repeated ids and integers of all widths."""
    r = np.random.default_rng(5)
    for scale, kind in ((100, np.float32), (1 << 22, np.float64), (1 << 40, object)):
        c = r.integers(-scale, scale, (700, 6)) // (scale // 4) * (scale // 4)
        ids = r.permutation(np.append(np.arange(690), np.arange(10)))
        qids, q = np.arange(0, 690, 7), r.integers(-scale, scale, (99, 6))
        assert topk._kind(6, scale, scale) is kind
        blocks = [(ids[a : a + 90], c[a : a + 90]) for a in range(0, 700, 90)]
        totals = q.astype(object) @ c.T.astype(object)
        best = topk._gathered(qids, q, blocks, 4, kind)
        cut = best.min(axis=1)
        who, found, scores = topk._resolved(qids, q, blocks, 4, kind, cut)
        for i, own in enumerate(qids.tolist()):
            expected = sorted((-t, j) for t, j in zip(totals[i], ids.tolist()) if j != own)[:4]
            assert cut[i] <= max(-(1 << 63), -expected[3][0])
            got = list(zip(scores[who == i].tolist(), found[who == i].tolist()))
            assert got == [(max(-(1 << 63), min((1 << 63) - 1, -t)), j) for t, j in expected]
