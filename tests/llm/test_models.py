"""Trained operators: held-out quality, exact base counts, and defined results for odd rows."""

from __future__ import annotations

import itertools
import math
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from weatherlake.llm import common, language_model, quality, toxicity
from weatherlake.llm.language_model import (
    RARE, START, RarePairs, Seating, ShardState, TableCounts, _binary, _pack, _pair_discount, _pair_names, score_documents,
)
from weatherlake.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.01"


def area(scores, labels):
    """Chance that a positive scores above a negative, ties half."""
    scores, labels = np.array(scores), np.array(labels)
    above = scores[labels == 1][:, None] - scores[labels == 0][None, :]
    return ((above > 0) + 0.5 * (above == 0)).mean()


@pytest.mark.parametrize("name, label, folds, fold, least", [("op2_quality", "quality", 3, 1, 0.95), ("op3_toxicity", "toxic", 5, 0, 0.85)])
def test_held_out_rows(spark, name, label, folds, fold, least):
    found = LLM_QUERIES[name](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    assert area([r.score for r in held], [r[label] for r in held]) > least


def test_odd_rows_get_scores(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (8, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for docs, n in ((odd_documents, odd_documents.count()), (no_documents, 0)):
        stats = quality.document_statistics(docs)
        for known in (labels, labels.limit(0)):
            scores = quality.score(stats, quality.train(stats, known)).collect()
            assert len(scores) == n and all(0 <= r.score <= 1 for r in scores)
            net = toxicity.train(docs, known)
            scores = toxicity.score(docs, net).collect()
            assert len(scores) == n and all(0 <= r.score <= 1 for r in scores)
            assert toxicity.clean(docs, net).columns == docs.columns


def test_isotonic_pools_violators():
    x, y = quality.isotonic([0, 1, 2, 3], [0.0, 0.6, 0.2, 1.0], [1, 1, 1, 2])
    assert y == (0.0, 0.4, 1.0) and x == (0.0, 1.5, 3.0)


def test_toxicity_finds_planted_words():
    rng = np.random.default_rng(0)
    docs, y = [], []
    for i in range(600):
        words = [f"w{rng.integers(400)}" for _ in range(60)]
        if i % 3 == 0:
            words[rng.integers(60)] = f"bad{rng.integers(3)}"
        docs.append(toxicity.word_ids([" ".join(words).encode()])[0])
        y.append(float(i % 3 == 0))
    net = toxicity.fit(docs[:450], np.array(y[:450], np.float32), ["en"] * 450)
    p = net.probability(np.concatenate([net.logits(d, np.array([len(d)])) for d in docs[450:]]))
    assert ((p >= 0.5) == (np.array(y[450:]) > 0)).mean() > 0.95
    assert "en" in net.thresholds


def test_toxicity_thresholds_use_all_labelled_rows(spark):
    """A rare language and documents too long for the fit have thresholds too, those with most right decisions."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        words = [f"w{rng.integers(400)}" for _ in range(600 if i % 10 == 0 else 40)]
        if i % 3 == 0:
            words[rng.integers(40)] = f"bad{rng.integers(3)}"
        rows.append((i, " ".join(words), "rare" if i % 10 == 0 else "en", int(i % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    net = toxicity.train(df, df.select("doc_id", "toxic"), rows=200, most_bytes=1000)
    assert "rare" in net.thresholds
    found = {r.doc_id: r for r in toxicity.score(df, net).collect()}
    rare = [(found[i].score, t) for i, _, lang, t in rows if lang == "rare"]  # none of them is trained on
    right = lambda cut: sum((p >= cut) == (t == 1) for p, t in rare)
    assert right(net.thresholds["rare"]) >= max(right(c) for c in [0.05, 0.95] + [p for p, _ in rare if 0.05 < p < 0.95]) - 1


def test_toxicity_fit_leaves_the_driver(spark, monkeypatch):
    """A task fits on the sample; the driver only gets the net and the ids trained on."""
    rows = [(i, f"w{i % 7} {'bad' if i % 3 == 0 else 'good'} w{i % 5}", "en", int(i % 3 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    driver, fit = os.getpid(), toxicity.fit

    def elsewhere(docs, y, langs):
        assert os.getpid() != driver and len(docs) == len(y) == 200
        return fit(docs, y, langs)

    monkeypatch.setattr(toxicity, "fit", elsewhere)
    net = toxicity.train(df, df.select("doc_id", "toxic"))
    assert {r.doc_id for r in toxicity.score(df, net).collect() if r.rejected} == set(range(0, 200, 3))


def test_seating_keeps_customers_and_follows_the_process():
    rng = np.random.default_rng(1)
    seats = Seating(np.full(20_000, 3), np.ones(20_000, dtype=np.int64))
    for _ in range(60):
        seats.update(np.full(20_000, 0.7), 0.4, rng)
    sums = np.add.reduceat(seats.sizes, seats.starts)
    assert (sums == 3).all() and (seats.sizes > 0).all()
    # Weights of 1, 2, 3 tables for three customers, new tables weighing a each time.
    a, d = 0.7, 0.4
    weights = np.array([a * (1 - d) * (2 - d), 3 * a * a * (1 - d), a**3])
    share = np.bincount(seats.tables(), minlength=4)[1:] / 20_000
    assert np.abs(share - weights / weights.sum()).max() < 0.015


def test_sweep_seats_every_customer_and_keeps_the_seating():
    """One sweep from one table brings a dish of 200 customers near its process; the customers may change."""
    rng = np.random.default_rng(2)
    small, fresh = Seating(np.full(20_000, 3), np.ones(20_000, dtype=np.int64)), np.full(20_000, 0.7)
    for _ in range(12):
        small.sweep(fresh, 0.4, rng)
    weights = np.array([0.7 * 0.6 * 1.6, 3 * 0.49 * 0.6, 0.7**3])
    share = np.bincount(small.tables(), minlength=4)[1:] / 20_000
    assert np.abs(share - weights / weights.sum()).max() < 0.015
    large = Seating(np.array([200] * 300 + [3000] * 3), np.ones(303, dtype=np.int64))
    means = []
    for _ in range(8):
        large.sweep(np.full(303, 20.0), 0.7, rng)
        sums = np.add.reduceat(large.sizes, large.starts)
        assert (sums == large.customers).all() and (large.sizes > 0).all()
        means.append(large.tables()[:300].mean())
    assert means[0] > 0.7 * means[-1] > 10
    changed = np.array([150] * 300 + [4000] * 3)
    large.sweep(np.full(303, 20.0), 0.7, rng, changed)
    assert (np.add.reduceat(large.sizes, large.starts) == changed).all()
    again = Seating.of(large.sizes, changed)
    assert (again.starts == large.starts).all()


def base_scores(rows):
    texts = [(t or "").translate({c: c + 32 for c in range(65, 91)}) for _, t in rows]
    import re

    tokens = [re.findall(r"[^\x20\x09-\x0D]+", t) + [None] for t in texts]
    train = [zlib.crc32(str("" if i is None else i).encode()) % 7 != 2 for i, _ in rows]
    counts = Counter(w for ws, t in zip(tokens, train) if t for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, not t, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6))
        for (i, _), ws, t in zip(rows, tokens, train)
    ]


def train_rows():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2


def test_language_model_base_is_exact(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    found = score_documents(odd_documents, train_rows()).collect()
    got = [(*tuple(r)[:5], round(r.base_score, 6)) for r in found]
    assert sorted(got, key=str) == sorted(base_scores(rows), key=str)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert score_documents(no_documents, train_rows()).collect() == []
    none = score_documents(odd_documents, F.lit(False)).collect()
    assert all(r.score == pytest.approx(0.0) and r.train_tokens == 0 for r in none)


def test_language_model_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = score_documents(docs, train_rows()).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_language_model_ranks_short_texts(spark):
    """More frequent words are likelier, and distinct texts share at most the whole probability."""
    texts = ["a", "a", "b", "b", "b", "c", "d", "", "a b", "c a", "b b a"]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(100 + i, t, False) for i, t in enumerate(["a", "b", "c", "d", "unseen", ""])]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    found = {r.doc_id: r.score for r in score_documents(df, F.col("train")).collect() if r.doc_id >= 100}
    assert 10 ** found[101] > 10 ** found[103] > 10 ** found[104]
    assert sum(10**s for s in found.values()) < 1.0


def test_rare_contexts_have_restaurants(spark):
    """Words after a context of 2 in 26,000 tokens are told apart, and their probabilities sum to 1."""
    filler = [f"w{i % 40} w{i * 7 % 40} w{i * 3 % 40}" for i in range(6000)]
    texts = [*filler, "alpha beta", "alpha beta", "gamma delta", "gamma delta", "alpha w1"]
    words = [f"w{i}" for i in range(40)] + ["alpha", "beta", "gamma", "delta", "unseen"]
    asked = ["alpha", "alpha beta", "alpha delta"] + [f"alpha {w}" for w in words]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(10_000 + i, t, False) for i, t in enumerate(asked)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    found = {r.doc_id - 10_000: r.score for r in score_documents(df, F.col("train")).collect() if r.doc_id >= 10_000}
    assert found[1] > found[2] + 1
    # P(alpha) P(w | alpha) P(end | w) for every w; the end is nearly sure only after beta and delta, so bounds are loose.
    assert sum(10 ** found[3 + i] for i in range(len(words))) < 10 ** found[0] * 4


def test_probabilities_of_all_short_texts_sum_to_one_at_most(spark, monkeypatch):
    """With every context but the start rare, the texts of up to four words have nearly the whole probability."""
    monkeypatch.setattr(language_model, "CONTEXT_SHARE", 2)
    texts = ["a b", "a b", "a b", "a c", "b", "b c", "c", "a b c", "a b", "c b"] * 3
    asked = [" ".join(t) for n in range(5) for t in itertools.product(["a", "b", "c", "unseen"], repeat=n)]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(1000 + i, t, False) for i, t in enumerate(asked)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    found = {r.doc_id - 1000: r.score for r in score_documents(df, F.col("train")).collect() if r.doc_id >= 1000}
    assert 0.9 < sum(10**s for s in found.values()) < 1.0
    assert found[asked.index("a b")] > found[asked.index("a a")] + 0.5


def test_rare_pairs_are_normalised():
    """Own shares and the rest of a rare context sum to 1 over its words, whatever their own probabilities."""
    words = np.sort(np.array([5, 9, 1 << 40, 3 << 50], np.uint64))
    context = np.array([RARE, RARE, RARE, START])
    state = ShardState(words, np.arange(4), context, np.array([2, 1, 3, 6]), np.array([9, 9, 9], np.uint64))
    assert state.direct.tolist() == [1, 1, 1, 0] and state.count.tolist() == [2, 1, 3, 6]
    state.count[1] = 6  # the context occurs as often as words follow it
    count, contexts = state.rare
    own = {"rare_per_word": _pack(state.direct), "rare_count": _pack(count), "rare_context": contexts.tobytes(), "rare_words": None, "origin": None, "followers": None}
    t = np.array([3])
    answer = {**dict.fromkeys(own), "origin": 0, "followers": _pack(t)}
    known = {**dict.fromkeys(own), "rare_words": np.array([9], np.uint64).tobytes(), "followers": _pack(t)}
    rare = RarePairs([own, answer, known], 0.6, words, state.count)
    p = np.array([0.1, 0.2, 0.3, 0.4])
    added = rare.of(_pair_names(words, np.full(4, 9, np.uint64)))
    assert added[3] == 0 and (10 ** rare.log_share[1] * (added + p)).sum() == pytest.approx(1.0)


def test_drawn_tables_follow_the_process():
    rng = np.random.default_rng(4)
    a, d = 0.7, 0.4
    tables = TableCounts(d).draw(np.full(40_000, 3), np.full(40_000, a), rng)
    weights = np.array([a * (1 - d) * (2 - d), 3 * a * a * (1 - d), a**3])
    assert np.abs(np.bincount(tables, minlength=4)[1:] / 40_000 - weights / weights.sum()).max() < 0.01
    mixed = np.array([1, 2, 700, 1024, 5, 1])
    drawn = TableCounts(0.7).draw(np.tile(mixed, 300), np.full(1800, 20.0), rng).reshape(300, -1)
    assert (drawn >= 1).all() and (drawn <= mixed).all() and (drawn[:, [0, 5]] == 1).all()
    # Where customers move one by one, many sweeps lead to the same distribution.
    seats, means = Seating(np.full(600, 100), np.ones(600, dtype=np.int64)), []
    for _ in range(40):
        seats.sweep(np.full(600, 8.0), 0.7, rng)
        means.append(seats.tables().mean())
    drawn = TableCounts(0.7).draw(np.full(6000, 100), np.full(6000, 8.0), rng)
    assert drawn.mean() == pytest.approx(np.mean(means[20:]), rel=0.03)


def test_pair_discount_counts_every_shard(spark):
    """Pairs once and twice of all shards, not of the first alone."""
    def row(shard, words, counts):
        n = len(words)
        context = np.full(n, START, np.uint16)
        return (shard, _binary(np.array(words, np.uint64)), _pack(np.ones(n, np.int64)), _binary(context), _pack(np.array(counts)))

    rows = [row(0, [1, 2], [1, 2]), row(1, [11, 12, 13], [1, 1, 1]), row(1, [13, 14], [1, 2])]
    df = spark.createDataFrame(rows, "shard int, words binary, per_word binary, context binary, trained binary")
    assert _pair_discount(df) == pytest.approx(3 / (3 + 2 * 3))


def test_language_model_returns_perplexity(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "c"), (3, "unseen a")], "doc_id long, text string")
    for r in score_documents(df, F.col("doc_id") < 3).collect():
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) and r.perplexity > 1


def test_packed_numbers_come_back():
    rng = np.random.default_rng(8)
    for a in ([], [0], [255, 256], [0, 1 << 40, 3], rng.integers(0, 70_000, 999)):
        assert language_model._unpack(_pack(np.array(a, np.int64))).tolist() == list(a)
    assert len(_pack(rng.integers(0, 300, 10_000))) < 12_500 and len(_pack(np.ones(10_000, np.int64))) < 100


def test_texts_are_kept_by_places_of_their_pairs():
    """Places lead back to words and contexts, also of words and pairs that no training row has, and each text keeps its counts."""
    rng = np.random.default_rng(9)
    hashes = np.sort(rng.integers(1, 1 << 63, 30, dtype=np.uint64))
    blocks = []
    for _ in range(5):
        words = np.sort(rng.choice(hashes, 12, replace=False))
        per_word = rng.integers(1, 6, 12)
        context = rng.choice([RARE, RARE, START, 2, 3], per_word.sum())
        rare = rng.choice(hashes, (context == RARE).sum())
        trained = rng.integers(0, 3, len(context)) * (np.repeat(words, per_word) != hashes[4])
        per_pair = rng.integers(1, 4, len(context))
        blocks.append((words, per_word, context, rare, trained, per_pair, rng.integers(0, 9, per_pair.sum()), rng.integers(1, 500, per_pair.sum())))
    words, per_word, context, rare, trained, per_pair, doc, times = (np.concatenate(x) for x in zip(*blocks))
    state = ShardState(words, np.repeat(np.arange(len(words)), per_word), context, trained, rare)
    count, behind = state.rare
    assert hashes[4] not in state.words
    pairs = [(state.words[k >> 16], k & 0xFFFF, 0) for k in state.pair_key.tolist()]
    pairs += [(w, RARE, b) for w, b in zip(np.repeat(state.words, state.direct), behind)]
    total = Counter()
    at = iter(rare.tolist())
    pair_of = [(w, c, next(at) if c == RARE else 0) for w, c in zip(np.repeat(words, per_word).tolist(), context.tolist())]
    for p, n in zip(pair_of, trained.tolist()):
        total[p] += n
    assert {tuple(map(int, p)): n for p, n in zip(pairs, [*state.pair_count.tolist(), *count.tolist()])} == {p: n for p, n in total.items() if n}

    def known(p):  # what scoring needs of a pair: without training tokens of the word or the pair less of it
        w = p[0] if p[0] in state.words else None
        return (w, p[1], p[2] if total[p] else None)

    per_row = np.array([len(b[2]) for b in blocks])
    unpacked = language_model._placed(state.codes, per_row, per_pair, doc, times)
    entry_at, pair_at = np.append(0, np.cumsum(per_pair)), np.append(0, np.cumsum(per_row))
    for row, packed in enumerate(unpacked):
        steps, n, docs, often = map(language_model._unpack, packed)
        places = np.cumsum(steps)
        assert (steps >= 0).all()
        found = []
        for p in places.tolist():
            if p < len(pairs):
                found.append(known(tuple(map(int, pairs[p]))))
            else:
                w, c = divmod(p - len(pairs), 1 << 16)
                found.append((int(state.words[w]) if w < state.kinds else None, c, None))
        got = sorted(zip(map(str, np.repeat(np.array([str(f) for f in found]), n)), docs.tolist(), often.tolist()))
        want = []
        for i in range(pair_at[row], pair_at[row + 1]):
            want += [(str(known(pair_of[i])), d, t) for d, t in zip(doc[entry_at[i] : entry_at[i + 1]].tolist(), times[entry_at[i] : entry_at[i + 1]].tolist())]
        assert got == sorted(want)


def test_language_model_keeps_little_on_disk(spark, tmp_path, monkeypatch):
    """Texts are shuffled with their hashes once, and tables that nothing reads again are deleted."""
    monkeypatch.setattr(common, "checkpoint_root", lambda spark: str(tmp_path))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    found = score_documents(docs, train_rows())
    assert spark.conf.get(name, None) == before
    assert not set(found.inputFiles()) & set(docs.inputFiles())
    assert sorted(f.name.split("-")[0] for f in tmp_path.iterdir()) == ["followers", "seats", "seats"]
    assert found.count() == docs.count()


def test_rare_contexts_have_sampled_seatings(spark, monkeypatch):
    """Scores are those of frequent contexts, also for pairs that no training row has, whichever contexts count as rare."""
    rng = np.random.default_rng(11)
    likely = 1 / np.arange(1, 2001)
    texts = ["w0 " + " ".join(f"w{j}" for j in rng.choice(2000, 60, p=likely / likely.sum())) for _ in range(300)]
    rows = [(i, t, i % 5 != 0) for i, t in enumerate([*texts, "unseen w1", "w1 unseen"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    scores = []
    for share in (1_000_000, 1):  # every context is frequent, every one but the start is rare
        monkeypatch.setattr(language_model, "CONTEXT_SHARE", share)
        found = {r.doc_id: r for r in score_documents(df, F.col("train")).collect()}
        scores.append(np.array([found[i].score / found[i].n_tokens for i in range(len(rows))]))
    assert np.abs(scores[0] - scores[1]).mean() < 0.006


def test_drawn_tables_follow_the_process_with_a_step():
    """As more tables open in a small restaurant, another one weighs more."""
    rng = np.random.default_rng(12)
    a, b, d = 0.7, 0.5, 0.4
    tables = TableCounts(d).draw(np.full(40_000, 3), np.full(40_000, a), rng, np.full(40_000, b))
    weights = np.array([a * (1 - d) * (2 - d), 3 * a * (a + b) * (1 - d), a * (a + b) * (a + 2 * b)])
    assert np.abs(np.bincount(tables, minlength=4)[1:] / 40_000 - weights / weights.sum()).max() < 0.01


def test_groups_sum_the_tables_of_rare_contexts():
    """Contexts 5, 9 and 1 << 63 of two shards in two groups: words behind each, and tables beyond one for each word."""
    asks = {
        0: ([5, 9, 1 << 63], [0, 0, 1, 2], [3, 1, 2, 1]),  # contexts; of each pair the context's number and the customers
        1: ([9, 1 << 63], [0, 1], [2, 2]),
    }
    rows = [
        {"shard": s, "rare_kinds": _binary(np.array(c, np.uint64)), "rare_number": _pack(np.array(n)), "rare_count": _pack(np.array(k))}
        for s, (c, n, k) in asks.items()
    ]
    kinds = pa.schema([("shard", pa.int32()), ("rare_kinds", pa.binary()), ("rare_number", pa.binary()), ("rare_count", pa.binary())])
    asked = pa.Table.from_batches(language_model._asked(2)([pa.RecordBatch.from_pylist(rows, schema=kinds)]))
    sent = {(0, 0): [4, 5], (1, 0): [7], (1, 1): [1]}  # by shard and group, of contexts behind several of a word
    names = {"shard": pa.int32(), "origin": pa.int32(), "extra": pa.list_(pa.binary())}
    above, extra = {}, {}
    for group in (0, 1):
        key = (pa.scalar(group, pa.int32()),)
        told = language_model._answered(2)(key, asked.filter(pc.equal(asked.column("shard"), group)))
        links = told.filter(pc.or_(pc.is_valid(told.column("links")), pc.is_valid(told.column("every"))))
        for final, out in ((False, above), (True, extra)):
            rows = [{"shard": g, "origin": s, "extra": [_pack(np.array(x))] * (language_model.SAMPLES if final else 1)} for (s, g), x in sent.items() if g == group]
            found = language_model._summed_tables(final)(key, pa.Table.from_pylist(rows, schema=pa.schema(names.items())), links)
            out |= {(r["shard"], group): [language_model._unpack(x).tolist() for x in r["extra"]] for r in found.to_pylist()}
    # Different words behind 5: 2, behind 9: 1 and 1, behind 1 << 63: 1 and 1.
    assert above == {(0, 0): [[2 + 4, 2 + 5 + 7]], (1, 0): [[2 + 5 + 7]], (1, 1): [[2 + 1]]}
    assert extra == {(0, 0): [[4, 12]] * 3, (0, 1): [[1]] * 3, (1, 0): [[12]] * 3, (1, 1): [[1]] * 3}
