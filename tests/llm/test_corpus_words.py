"""Spelling variants, benchmark passages and collocations against brute force on small tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from samples import prose

from weatherlake.llm import collocations as phrases, decontaminate, spelling
from weatherlake.llm.words import hashed_words


@pytest.mark.parametrize("texts", [[], [b""], [b"", b""], [b" "], [b"", b"a b"]])
def test_empty_buffers_have_no_words(texts):
    hashes, counts = hashed_words(texts)
    assert len(hashes) == counts.sum() and len(counts) == len(texts)


@pytest.mark.parametrize("bits", [8, 10, 11, 13])
def test_built_words_have_names_of_their_own(bits):
    """Thue-Morse words and their complements, over which polynomials modulo 2**64 agree."""
    word = bytes(b"ab"[bin(i).count("1") % 2] for i in range(1 << bits))
    other = word.translate(bytes.maketrans(b"ab", b"ba"))
    hashes, counts = hashed_words([word, other, b"x " + word.upper()])
    assert counts.tolist() == [1, 1, 2]
    assert hashes[0] != hashes[1] and hashes[0] == hashes[3]


# --- spelling ---------------------------------------------------------------------------

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_words(rows, noise=97):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[a-z\u00c0-\u00ff]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_forms(words):
    found = {}
    for w, n in words.items():
        near = [x for x in words if x != w and one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        found[w] = [form, n, len(near), words[form] if form else None]
    for w, row in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        row.append(root)
    return found


def variants(seed, n):
    """Words and misspellings of them, some as anagrams, some with accented letters."""
    r = random.Random(seed)
    base = ["".join(r.choice("abcdeéÿ") for _ in range(r.randint(5, 9))) for _ in range(12)]
    words = []
    for _ in range(n):
        w = r.choice(base)
        for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
            at = r.randrange(len(w))
            w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice("abÀ×") + w[at:], w[:at] + "c" + w[at + 1 :], "".join(r.sample(w, len(w)))])
        words.append(r.choice([w, w.upper(), w.capitalize()]))
    return words


@pytest.mark.parametrize("block_words", [500, 8, 1])
def test_spelling_forms(spark, block_words):
    texts = [" ".join(variants(i, 120)) for i in range(8)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3]), (9, None), (10, ""), (11, "漢字 x" * 50)]
    rows.append((12, ("q" * 300 + " ") * 3 + ("q" * 299 + "r ") * 9 + "-".join(["œuvre", "Œuvre", "naïve"] * 4)))
    rows.append((13, "lmnop " * 99 + "lmnopr " * 40 + "lmnoprs " * 16 + "lmnoprst " * 6))  # a chain of forms
    docs = spark.createDataFrame([(*row, "en", 1) for row in rows], "doc_id long, text string, word string, n int")
    words = spelling.vocabulary(docs)
    expected = brute_words(rows)
    assert {r.word: r.n for r in words.collect()} == expected
    found = {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in spelling.spelling_forms(words, block_words=block_words).collect()}
    assert found == brute_forms(expected)
    assert found["lmnoprst"][0] == "lmnoprs" and found["lmnoprst"][4] == "lmnop"


def test_long_words_lose_the_right_letter(spark):
    rows = [(i, " ".join(["x" * k + "yz" * 40 for k in range(60)])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word: r.n for r in spelling.vocabulary(docs, noise=3).collect()} == brute_words(rows, 3)


def test_spelling_of_nothing(spark, no_documents, odd_documents):
    assert spelling.spelling_forms(spelling.vocabulary(no_documents)).collect() == []
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert {r.word: r.n for r in spelling.vocabulary(odd_documents).collect()} == brute_words(rows)


# --- benchmark passages -----------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_passages(docs, items, window=10):
    out = []
    for doc, text in docs:
        text = text or ""
        spans = [m.span() for m in WORD.finditer(text.translate(LOWER))]
        words = [text.translate(LOWER)[a:b] for a, b in spans]
        hit, ids = set(), set()
        for item, other in items:
            w = WORD.findall((other or "").translate(LOWER))
            size = min(window, len(w))
            for i in range(len(w) - size + 1 if w else 0):
                for j in range(len(words) - size + 1):
                    if words[j : j + size] == w[i : i + size]:
                        hit.update(range(j, j + size))
                        if item is not None:
                            ids.add(str(item))
        runs = []
        for i in sorted(hit):
            if runs and runs[-1][1] == i:
                runs[-1][1] = i + 1
            else:
                runs.append([i, i + 1])
        out.append((doc, len(words), len(hit), [(spans[a][0], spans[b - 1][1]) for a, b in runs], sorted(ids)))
    return sorted(out, key=str)


@pytest.mark.parametrize("automaton_words, piece", [(1_000_000, 1 << 20), (40, 64)])
def test_benchmark_passages(spark, odd_documents, monkeypatch, automaton_words, piece):
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    base, long = prose(2, 400), prose(1, 30_000)
    items = [
        (1, " ".join(base.split()[20:45])), (2, "One, TWO"), (3, " ".join(long.split()[500:512]).upper()), (3, "three four"), (4, None), (5, "..."),
        (None, " ".join(base.split()[100:110])), (6, " ".join(base.split()[25:40]) + " other words"), (7, "é" * 300 + " 漢字 x"), (8, prose(5, 9)),
    ]
    benchmark = spark.createDataFrame([(*item, 0) for item in items], "item_id long, text string, words int")
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    rows += [(90, "x " + base.replace(" ", "  ;\n") + " é"), (91, "one,two-one TWO")]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, runs int")
    found = decontaminate.find_benchmark_passages(docs, benchmark, automaton_words=automaton_words).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, [(s.start, s.end) for s in r.spans], r["items"]) for r in found), key=str) == brute_passages(rows, items)
    assert sum(r.n_hit > 0 for r in found) > 8


def test_no_benchmark_and_no_documents(spark, odd_documents, no_documents):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.find_benchmark_passages(odd_documents, none).collect()
    assert len(found) == odd_documents.count() and not any(r.n_hit or r["items"] or r.spans for r in found)
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.find_benchmark_passages(no_documents, some).collect() == []


# --- collocations -----------------------------------------------------------------------


def brute_phrases(rows, longest, least, best):
    grams, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                grams[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in candidates.items():
            if any(b >= a and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h))) for h, b in candidates.items()):
                continue
            score, _, left, right = min((1000 * a * sizes[lang] // (f[g[:c]] * f[g[c:]]), c, f[g[:c]], f[g[c:]]) for c in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("bits, slice_bytes, piece", [(25, 8 << 20, 1 << 20), (15, 500, 100)])
def test_collocations(spark, monkeypatch, bits, slice_bytes, piece):
    """A bitmap that is too small only costs counters; slices and pieces may be of any size."""
    monkeypatch.setattr(phrases, "BITS", bits)
    monkeypatch.setattr(phrases, "SLICE", slice_bytes)
    monkeypatch.setattr(phrases, "PIECE", piece)
    r = random.Random(3)
    common = ["of the", "In  Spite\tof the", "é à", "a b c d e f", "new york city", "x"]
    rows = [(r.choice(["en", "en", "en", None, "und", "fr"]), " ".join(r.choice(common) + r.choice(["", "", ".", ",", "\n", " w%d" % r.randint(0, 5)]) for _ in range(60))) for _ in range(40)]
    rows += [("en", None), (None, ""), ("de", "..."), ("xx", "one"), ("en", rows[0][1])]
    docs = spark.createDataFrame([(i, t, lang, 1, 2) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, f int, phrase int")
    found = phrases.collocations(docs, longest=4, least=5, best=30).collect()
    assert sorted(map(tuple, found)) == brute_phrases(rows, 4, 5, 30)
    assert len(found) > 30 and {row.lang for row in found} >= {"en", "und", "fr"}


def test_collocations_of_nothing(spark, no_documents, odd_documents):
    assert phrases.collocations(no_documents).collect() == []
    rows = [(row.lang, row.text) for row in odd_documents.collect()]
    assert sorted(map(tuple, phrases.collocations(odd_documents, least=3).collect())) == brute_phrases(rows, 5, 3, 2000)


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**12, 10**13, 3 * 10**12, 7)], "a long, n long, l long, r long")
    score = row.select(phrases._score("a", "n", "l", "r").alias("s")).first().s
    assert score == 1000 * 10**12 * 10**13 // (3 * 10**12 * 7)
