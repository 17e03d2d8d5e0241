"""Exact and near dedup, repeated passages, mixing: against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from samples import prose

from weatherlake.llm import near_dedup
from weatherlake.llm.exact_dedup import exact_dedup
from weatherlake.llm.mixing import mix
from weatherlake.llm.near_dedup import near_duplicates
from weatherlake.llm.repeats import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("digest_bytes", [16, 1])  # one byte: most names stand for several contents
def test_exact_dedup(odd_documents, digest_bytes):
    found = sorted(map(tuple, exact_dedup(odd_documents, digest_bytes=digest_bytes).collect()), key=str)
    groups = defaultdict(list)
    for row in odd_documents.collect():
        groups[lower(row.text)].append(row.doc_id)
    expected = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        left = True
        for i in ids:
            expected.append((i, best, len(ids), i == best and left, hashlib.sha256(text).hexdigest()))
            left = left and i != best
    assert found == sorted(expected, key=str)


def test_exact_dedup_of_nothing(no_documents):
    assert exact_dedup(no_documents).collect() == []


def bag(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_classes(rows):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    bags = [bag(r.text) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            shared = sum((bags[i] & bags[j]).values())
            union = sum((bags[i] | bags[j]).values())
            if shared * 5 >= union * 4:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def near_case(spark, docs, **options):
    rows = docs.collect()
    labels = brute_classes(rows)
    ids = defaultdict(list)
    for label, row in zip(labels, rows):
        ids[label].append(row.doc_id)
    expected = Counter(
        (row.doc_id, min((i for i in ids[x] if i is not None), default=None), len(ids[x])) for x, row in zip(labels, rows)
    )
    found = near_duplicates(docs, **options).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in found) == expected
    kept = Counter(r.class_id for r in found if r.kept)
    assert all(r.doc_id == r.class_id for r in found if r.kept)
    assert sum(kept.values()) == len(ids)


def test_near_duplicates_of_odd_rows(spark, odd_documents):
    near_case(spark, odd_documents)


def test_near_duplicates_in_chains_and_hot_groups(spark):
    """Neighbours in a chain are linked, its ends are not; copies with edits of their own share a base."""
    words = prose(11, 200).split()
    chain = [" ".join(words[:k] + prose(12, 200).split()[k:]) for k in range(0, 120, 8)]
    base = prose(13, 150).split()
    edited = []
    for i in range(60):
        copy = list(base)
        for j in (i, i + 40, i + 80):
            copy[j] = f"edit{i}"
        edited.append(" ".join(copy))
    texts = chain + edited + [" ".join(base)] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near_case(spark, docs)


def test_near_duplicates_around_a_common_base(spark):
    """Copies at the edge of the threshold, cut ones, such with common edits, repeated shingles; the base itself may be missing."""
    rng = random.Random(5)
    base = prose(14, 160).split()
    texts = []
    for i in range(90):
        copy = list(base)
        for _ in range(rng.randint(1, 9)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(4)}"
        if i % 3 == 0:
            copy = copy[: rng.randint(110, 150)]
        if i % 5 == 0:
            copy += base[20 : 20 + rng.randint(6, 40)]
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near_case(spark, docs)
    near_case(spark, docs, bands=60, rows=2)


def test_near_duplicates_start_few_jobs(spark):
    """The driver plans every job and keeps its figures, so its memory follows their number; all rounds run here."""
    rng = random.Random(6)
    base = prose(15, 160).split()
    texts = []
    for i in range(90):
        copy = list(base)
        for _ in range(rng.randint(1, 9)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(4)}"
        texts.append(" ".join(copy[: rng.randint(120, 160)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    context = spark.sparkContext
    context.setJobGroup("near-duplicates", "")
    try:
        assert near_duplicates(docs, bands=60, rows=2).count() == len(texts)
    finally:
        context._jsc.clearJobGroup()
    assert len(context.statusTracker().getJobIdsForGroup("near-duplicates")) <= 105


def test_words_that_polynomials_confuse(spark):
    """Thue-Morse words of 1,024 letters and their complements are different texts."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    docs = spark.createDataFrame([(1, word), (2, word.translate(str.maketrans("ab", "ba")))], "doc_id long, text string")
    near_case(spark, docs)


def test_near_duplicates_of_nothing(no_documents):
    assert near_duplicates(no_documents).collect() == []


def test_signatures_estimate_weighted_jaccard():
    import numpy as np

    shingles = np.arange(40, dtype=np.uint64) * np.uint64(977)
    a = np.array([1, 3, 7, 2] * 10)
    b = np.array([2, 3, 3, 2] * 10)
    owner = np.repeat([0, 1], 40)
    values = near_dedup.signatures(owner, np.concatenate([shingles] * 2), np.concatenate([a, b]), 2, 4000)
    agree = (values[0] == values[1]).mean()
    assert abs(agree - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def brute_repeats(rows):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        text = (rows[i][1] or "").encode()
        gone = bytearray(len(text))
        for s in range(len(text) - 99):
            if text[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(text[s : s + 100])
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((rows[i][0], len(text), len(re.findall(b"\1+", bytes(gone))), kept))
    return out


def test_repeats(spark):
    shared, line = prose(21, 60), prose(22, 18)
    rows = [(i, prose(30 + i, 40) + shared[i % 7 :] + prose(60 + i, 30)) for i in range(30)]
    rows += [(100 + i, prose(200 + i, 10) + line + prose(300 + i, 10)) for i in range(40)]
    rows += [(200, "x" * 450), (201, "ab" * 300), (202, None), (203, ""), (204, "short"), (None, shared), (None, None)]
    rows += [(205, prose(400, 2000)), (206, prose(400, 2000)), (207, "z" + prose(400, 2000)[5:])]
    found = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = Counter((r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in found)
    assert found == Counter(brute_repeats(rows))


def test_repeats_cross_pieces_of_long_texts(spark, monkeypatch):
    """Pieces are cut anywhere; what stays must not depend on it."""
    from weatherlake.llm import repeats

    monkeypatch.setattr(repeats, "PIECE", 700)
    rows = [(1, prose(5, 700)), (2, prose(6, 20) + prose(5, 700)[333:]), (3, prose(5, 700)[100:2000])]
    found = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in found) == Counter(brute_repeats(rows))


def test_repeats_of_odd_rows(odd_documents, no_documents):
    found = Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in remove_repeats(odd_documents).collect())
    expected = brute_repeats([(r.doc_id, r.text) for r in odd_documents.collect()])
    # Rows of one id follow each other in either order, so only their sums are fixed.
    assert sum(n * k for (_, n, _), k in found.items()) == sum(e[1] for e in expected)
    unique = {1, 2, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15}
    assert {k for k in found if k[0] in unique} == {(e[0], e[1], e[3]) for e in expected if e[0] in unique}
    assert remove_repeats(no_documents).collect() == []


def size(text):
    return len(WORD.findall(text or ""))


def test_mix_targets_and_shares(spark):
    rows = [(i, prose(i, 20 + i % 30), ["a", "b", "c", "d", None][min(i % 9, 4)]) for i in range(900)]
    rows += [(5000, "", "e"), (5001, None, "e"), (5002, "w " * 10, "tiny"), (None, "x y", "b")]
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in found) == sorted((i is None, i or 0, size(t)) for i, t, _ in rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    targets, free, rest = {}, set(order), sum(sizes.values())
    while True:  # reshare until none is above three times its size
        level = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        above = [s for s in free if level[s] > 3 * sizes[s]]
        if not above:
            targets.update(level)
            break
        for s in above:
            targets[s] = 3 * sizes[s]
            rest -= targets[s]
            free.discard(s)
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    largest = Counter()
    for _, text, source in rows:
        largest[source] = max(largest[source], size(text))
    for s in order:
        assert abs(taken[s] - targets[s]) <= largest[s]
    again = mix(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string")).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mix_of_odd_rows(odd_documents, no_documents):
    assert len(mix(odd_documents).collect()) == odd_documents.count()
    assert mix(no_documents).collect() == []
