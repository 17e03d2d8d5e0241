"""Language-model scores from a hierarchical Pitman-Yor model.

Every context word has a restaurant whose customers are the words that follow it.  All these restaurants
share one parent, the unigram restaurant, whose customers are the tables of its children, and whose base is
uniform over the vocabulary and one unknown word.  A word's probability is the mean of the predictive
probabilities of several seatings.

Frequent contexts are words with at least one in ``CONTEXT_SHARE`` of all training tokens, and the start of a text, so
there are at most CONTEXT_SHARE + 1 of them, whatever the corpus.  All other contexts, of any number, are rare.  The tables
of all contexts and the parent's are sampled by Gibbs sweeps; the two kinds differ in how the shards learn their totals.

Counts and seatings cover all words and are dealt by word: a shard holds all restaurants' customers of its words.  Of
frequent contexts, the totals, of bounded number, are shared.  Rare contexts are dealt by ranges of their hashes to groups.  A
group is told once which shards have pairs of its contexts, counts the different words f behind each, and in every
sweep sums the tables that these words have beyond one each and sends the totals to the shards that have pairs of two customers or more;
a single customer has one table in every seating.

With c(w) customers of w at t(w) of T tables after a rare u with c customers, w has the probability
share(u) * (own + rest * p(w)), where share = (s + d f) / (s + c), own = (c(w) - d t(w)) / (s + d f) and
rest = (s + d T) / (s + d f).  Only share is the same in all samples, so f and all samples' T go to the shards of the words seen after u, also
where no training row has the pair; the shard of u adds log share(u) for each u in a document, and the shard of w the other factor.

A sweep seats all customers again, given the totals that all shards had
after the sweep before; the seatings are kept between sweeps.  The number of tables of a dish with up to ``DIRECT``
customers is drawn from its exact distribution given these totals, in rare contexts given those of the other dishes;
customers of larger dishes leave and sit down again: up to
``STEPS`` customers of a dish move one by one, of more a share of 1 / STEPS at once.

Documents travel once as packed counts of (word, context, document), so a frequent word costs a shard no
more than one entry per document.  The shard keeps them with its seats, where places in its lists of pairs stand for the
hashes: first the pairs with frequent contexts, then those with rare ones, then pairs that no training row has.  Of the last
ones the rare contexts are listed beside, in the same order.
"""

from __future__ import annotations

import sys
import types
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from weatherlake.llm.common import Shared, forget, in_small_batches, keep, shuffles_dropped
from weatherlake.llm.words import _mix, encoded, hashed_words, slices

CONTEXT_SHARE = 10_000  # decides only how a context's totals reach the shards; the tables of all contexts are sampled
BLOCK_TOKENS, BLOCK_DOCS = 1_000_000, 60_000
SHARD_BYTES = 6 << 20
SHARDS_OF_GROUP = 16  # so many shards have as many words as a group has rare contexts
BURN_IN, SAMPLES, STEPS = 4, 3, 256
DIRECT = 1024
STRENGTH = (10.0, 2.0)  # of the parent and of the contexts, rare ones included
END = np.uint64(0x0123456789ABCDEF)
RARE, START = 0, 1
WORKER = "weatherlake_worker_tables"  # a module of the Python worker that outlives its tasks


def _shard(words: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the word hash, so sorted words are sorted by shard."""
    return ((words >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _blocks(batches, extra: list[str]):
    """Words (with the end of each text), text numbers and the columns ``extra`` of blocks of rows."""
    held, tokens = [], 0

    def block():
        words = np.concatenate([h[0] for h in held])
        counts = np.concatenate([h[1] for h in held])
        ends = np.cumsum(counts + 1)
        out = np.full(int(counts.sum()) + len(counts), END, dtype=np.uint64)
        inner = np.ones(len(out), dtype=bool)
        inner[ends - 1] = False
        out[inner] = words
        columns = {c: [x for h in held for x in h[2][c]] for c in extra}
        return out, np.repeat(np.arange(len(counts)), counts + 1), counts + 1, columns

    for rows in (part for batch in batches for part in slices(batch, "_text", 1 << 19)):
        for a in range(0, rows.num_rows, BLOCK_DOCS // 2):
            part = rows.slice(a, BLOCK_DOCS // 2)
            words, counts = hashed_words(encoded(part.column("_text").to_pylist()))
            held.append((words, counts, {c: part.column(c).to_pylist() for c in extra}))
            tokens += len(words) + len(counts)
            if tokens >= BLOCK_TOKENS or sum(len(h[1]) for h in held) >= BLOCK_DOCS // 2:
                yield block()
                held, tokens = [], 0
    if held:
        yield block()


def _binary(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _pack(a: np.ndarray) -> bytes:
    """Whole numbers from 0, compressed: the lowest bytes of all numbers, then the next ones, as far as any number needs."""
    a = np.asarray(a).astype(np.uint64)
    width = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
    planes = np.stack([(a >> np.uint64(8 * i)).astype(np.uint8) for i in range(width)])
    return np.array([len(a), width], dtype=np.int64).tobytes() + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _unpack(b: bytes) -> np.ndarray:
    n, width = np.frombuffer(b, np.int64, 2).tolist()
    planes = np.frombuffer(pa.Codec("zstd").decompress(b[16:], n * width, asbytes=True), np.uint8).reshape(width, n)
    a = planes[0].astype(np.int64)
    for i in range(1, width):
        a |= planes[i].astype(np.int64) << (8 * i)
    return a


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _counted(shards: int):
    def run(batches):
        for words, owner, _, columns in _blocks(batches, ["train"]):
            words = words[np.array(columns["train"], dtype=bool)[owner]]
            found, counts = np.unique(words, return_counts=True)
            cuts = np.searchsorted(_shard(found, shards), np.arange(shards + 1))
            rows = [
                (s, _binary(found[a:b]), _pack(counts[a:b])) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a
            ]
            yield _table(rows, ["shard", "words", "counts"], [pa.int32(), pa.binary(), pa.binary()])

    return run


def _joined(column, kind=None) -> np.ndarray:
    """The arrays of all rows, packed ones without ``kind``."""
    parts = [_unpack(b) if kind is None else np.frombuffer(b, dtype=kind) for b in column.to_pylist() if b is not None]
    return np.concatenate(parts) if parts else np.zeros(0, kind or np.int64)


def _summed_vocabulary(table: pa.Table) -> pa.Table:
    words, at = np.unique(_joined(table.column("words"), np.uint64), return_inverse=True)
    counts = np.bincount(at, weights=_joined(table.column("counts"))).astype(np.int64)
    return pa.table({"word": pa.array(words.view(np.int64)), "count": pa.array(counts)})


@dataclass
class Corpus:
    """Totals of the training text and the contexts; its size does not depend on the corpus."""

    shards: int
    tokens: int
    kinds: int
    contexts: np.ndarray  # sorted hashes; context i has number i + 2
    customers: np.ndarray  # tokens behind each context number
    discounts: tuple = (0.8, 0.8, 0.8)  # of the parent, frequent and rare contexts
    totals: np.ndarray | None = None  # set after sampling, per sample: parent's customers and tables, then tables by context

    @property
    def base(self) -> float:
        return 1.0 / (self.kinds + 1)


REQUEST = (
    "block long, shard int, words binary, per_word binary, context binary, rare binary, trained binary, per_pair binary, "
    "doc binary, times binary, docs int, doc_ids array<{kind}>, held_out array<boolean>, sizes array<long>"
)


def _context_numbers(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    at = np.searchsorted(contexts, words)
    known = np.zeros(len(words), dtype=bool)
    if len(contexts):
        known = contexts[np.minimum(at, len(contexts) - 1)] == words
    return np.where(known, at + 2, RARE)


def _pair_names(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each pair of a word and the rare context before it."""
    return _mix(words + _mix(contexts + np.uint64(0x9E3779B97F4A7C15)))


def _requests(corpus, kind_of_id):
    """Packed counts by block and shard, and for each block a row (without words) that describes its documents."""

    def run(batches):
        from pyspark import TaskContext

        c = corpus.value
        names = [f.split()[0] for f in REQUEST.split(", ")]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 8, pa.int32(), pa.list_(kind_of_id), pa.list_(pa.bool_()), pa.list_(pa.int64())]
        number = TaskContext.get().partitionId() << 32
        for words, owner, sizes, columns in _blocks(batches, ["doc_id", "train"]):
            train = np.array(columns["train"], dtype=bool)
            start = np.zeros(len(words), dtype=bool)
            start[np.cumsum(sizes) - sizes] = True
            rows = [(number, number % c.shards, *[None] * 8, len(sizes), columns["doc_id"], (~train).tolist(), sizes.tolist())]
            for a in range(0, len(words), BLOCK_TOKENS):  # a very long text takes several parts
                low = max(a - 1, 0)  # the word before is the context
                kinds_here, place = np.unique(words[low : a + BLOCK_TOKENS], return_inverse=True)
                before = np.concatenate((place[:1], place[:-1]))[a - low :]
                before = np.where(start[a : a + BLOCK_TOKENS], len(kinds_here), before)
                number_of = np.append(_context_numbers(c.contexts, kinds_here), START)
                # Word, context and text in one number; parts are small enough for that.
                bits, doc_bits = (len(kinds_here) + 1).bit_length(), 16
                entries = place[a - low :].astype(np.uint64) << np.uint64(bits + doc_bits)
                entries |= before.astype(np.uint64) << np.uint64(doc_bits) | owner[a : a + BLOCK_TOKENS].astype(np.uint64)
                entries.sort()
                entry = np.flatnonzero(np.concatenate(([True], entries[1:] != entries[:-1])))
                held = entries[entry]
                times = np.diff(np.append(entry, len(entries)))
                doc = (held & np.uint64(0xFFFF)).astype(np.int64)
                both = held >> np.uint64(doc_bits)
                pair = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
                both = both[pair]
                first = (both >> np.uint64(bits)).astype(np.int64)
                behind = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
                context = number_of[behind]
                per_pair = np.diff(np.append(pair, len(entry)))
                trained = np.add.reduceat(np.where(train[doc], times, 0), pair)
                word = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
                per_word = np.diff(np.append(word, len(pair)))
                distinct = kinds_here[first[word]]
                cuts = np.searchsorted(_shard(distinct, c.shards), np.arange(c.shards + 1))
                pair_at, entry_at = np.append(word, len(pair)), np.append(pair, len(entry))
                for s, (i, j) in enumerate(zip(cuts, cuts[1:])):
                    if i == j:
                        continue
                    p, q = pair_at[i], pair_at[j]
                    e, f = entry_at[p], entry_at[q]
                    rows.append((
                        number, s, _binary(distinct[i:j]), _pack(per_word[i:j]),
                        _pack(context[p:q]), _binary(kinds_here[behind[p:q][context[p:q] == RARE]]), _pack(trained[p:q]),
                        _pack(per_pair[p:q]), _pack(doc[e:f]), _pack(times[e:f]), len(sizes), None, None, None,
                    ))
            number += 1
            yield _table(rows, names, kinds)

    return run


class Seating:
    """Customers of many dishes at tables; ``sizes`` holds the tables of each dish in turn."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray):
        self.customers = customers
        tables = np.clip(tables, 1, customers)
        self.starts = np.cumsum(tables) - tables
        self.sizes = np.ones(int(tables.sum()), dtype=np.int64)
        self.sizes[self.starts] = customers - tables + 1

    @staticmethod
    def of(sizes: np.ndarray, customers: np.ndarray) -> Seating:
        """From the tables of all dishes in turn."""
        seats = Seating.__new__(Seating)
        seats.sizes, seats.customers = sizes, customers
        seats.starts = np.searchsorted(np.cumsum(sizes) - sizes, np.cumsum(customers) - customers)
        return seats

    def tables(self) -> np.ndarray:
        return np.add.reduceat((self.sizes > 0).astype(np.int64), self.starts) if len(self.starts) else self.starts

    def _pick(self, weights: np.ndarray, draw: np.ndarray) -> np.ndarray:
        """For each dish the table at which the running sum of its weights passes ``draw``."""
        sums = np.cumsum(weights)
        first = sums[self.starts] - weights[self.starts]
        ends = np.append(self.starts[1:], len(weights)) - 1
        return np.clip(np.searchsorted(sums, first + draw, side="right"), self.starts, ends)

    def update(self, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        """One customer of each dish leaves and is seated again; ``fresh`` is the weight of a new table."""
        if not len(self.starts):
            return
        at = self._pick(self.sizes.astype(np.float64), rng.random(len(self.starts)) * self.customers)
        ends = np.append(self.starts[1:], len(self.sizes))
        empty = self.sizes[at] == 0  # only rounding leads here: then take the dish's largest table
        for i in np.flatnonzero(empty):
            at[i] = self.starts[i] + self.sizes[self.starts[i] : ends[i]].argmax()
        self.sizes[at] -= 1
        weights = np.where(self.sizes > 0, self.sizes - discount, 0.0)
        joined = np.add.reduceat(weights, self.starts)
        draw = rng.random(len(self.starts)) * (joined + fresh)
        sits = draw < joined
        to = self._pick(weights, draw)
        sits &= self.sizes[to] > 0
        self.sizes[to[sits]] += 1
        fresh_ones = np.flatnonzero(~sits)
        self.sizes = np.insert(self.sizes, ends[fresh_ones], 1)
        lengths = ends - self.starts
        lengths[fresh_ones] += 1
        keep_table = self.sizes > 0
        owner = np.repeat(np.arange(len(lengths)), lengths)[keep_table]
        self.sizes = self.sizes[keep_table]
        self.starts = np.searchsorted(owner, np.arange(len(lengths)))

    def sweep(self, fresh: np.ndarray, discount: float, rng: np.random.Generator, customers: np.ndarray | None = None) -> None:
        """Every customer leaves once and is seated again; before that ``customers``, if given, come in or go.

        A table is found by the customers at it: one of the dish's seated customers is drawn, and its table of n is
        taken with chance 1 - discount / n.
        """
        n = self.customers if customers is None else customers
        dishes = len(n)
        if not dishes:
            return
        of_table = np.repeat(np.arange(dishes), np.diff(np.append(self.starts, len(self.sizes))))
        table = np.repeat(np.arange(len(self.sizes)), self.sizes)
        dish = of_table[table]
        table = table[np.lexsort((rng.random(len(table)), dish))]
        rank = np.arange(len(table)) - (np.cumsum(self.customers) - self.customers)[dish]
        first, total = np.cumsum(n) - n, int(n.sum())
        stay = rank < n[dish]
        seat = np.full(total, -1)
        seat[first[dish[stay]] + rank[stay]] = table[stay]
        owner = np.repeat(np.arange(dishes), n)
        used = len(self.sizes)
        size = np.concatenate([np.bincount(table[stay], minlength=used), np.zeros(2 * total, dtype=np.int64)])
        of_table = np.concatenate([of_table, np.zeros(2 * total, dtype=np.int64)])
        tables = np.bincount(of_table[:used][size[:used] > 0], minlength=dishes)
        seated = np.bincount(dish[stay], minlength=dishes)

        def sit(who):
            nonlocal used
            weight = (seated - discount * tables)[owner[who]] if len(who) > dishes else seated[owner[who]] - discount * tables[owner[who]]
            new = rng.random(len(who)) * (weight + fresh[owner[who]]) >= weight
            rest, found = who[~new], np.full(int((~new).sum()), -1)
            open_ = np.arange(len(rest))
            while len(open_):
                at = owner[rest[open_]]
                to = seat[first[at] + (rng.random(len(at)) * n[at]).astype(np.int64)]
                good = (to >= 0) & (rng.random(len(at)) >= discount / np.maximum(size[to], 1))
                found[open_[good]] = to[good]
                open_ = open_[~good]
            opened = used + np.arange(int(new.sum()))
            used += len(opened)
            of_table[opened] = owner[who[new]]
            seat[rest], seat[who[new]] = found, opened
            np.add.at(size, seat[who], 1)
            np.add.at(tables, of_table[opened], 1)
            np.add.at(seated, owner[who], 1)

        sit(np.flatnonzero(seat < 0))
        turn = (np.arange(total) - first[owner]) // (-(-n // STEPS))[owner]
        order = np.argsort(turn, kind="stable")
        cuts = np.searchsorted(turn[order], np.arange(int(turn.max()) + 2))
        for who in (order[a:b] for a, b in zip(cuts, cuts[1:])):
            if len(who) == 0:
                continue
            left = seat[who]
            np.subtract.at(size, left, 1)
            closed = np.unique(left[size[left] == 0])
            np.subtract.at(tables, of_table[closed], 1)
            np.subtract.at(seated, owner[who], 1)
            seat[who] = -1
            sit(who)
        some = np.flatnonzero(size[:used] > 0)
        some = some[np.argsort(of_table[some], kind="stable")]
        self.sizes, self.customers = size[some], n
        self.starts = np.searchsorted(of_table[some], np.arange(dishes))


class TableCounts:
    """Draws how many tables the customers of a dish take, where a new table weighs the same each time or more by a step.

    t tables of n customers have a chance in proportion to fresh ** t * S(n, t), where S are generalised Stirling numbers:
    S(n + 1, t) = S(n, t - 1) + (n - t * discount) * S(n, t).  With a step, fresh * (fresh + step) * ... stands for fresh ** t.
    """

    def __init__(self, discount: float):
        self.logs = np.full((DIRECT + 1, DIRECT), -np.inf)  # by customers and tables - 1
        self.logs[1, 0] = 0.0
        for n in range(1, DIRECT):
            t = np.arange(1, n + 1)
            self.logs[n + 1, :n] = np.log(n - t * discount) + self.logs[n, :n]
            self.logs[n + 1, 1 : n + 1] = np.logaddexp(self.logs[n + 1, 1 : n + 1], self.logs[n, :n])

    def draw(self, customers: np.ndarray, fresh: np.ndarray, rng: np.random.Generator, step: np.ndarray | None = None) -> np.ndarray:
        tables = np.ones(len(customers), dtype=np.int64)
        order = np.argsort(customers, kind="stable")
        order = order[np.searchsorted(customers[order], 2) :]
        end = len(order)
        while end:  # largest first, in pieces of bounded size
            most = int(customers[order[end - 1]])
            some = order[max(0, end - max(1, (1 << 18) // most)) : end]
            if step is None:
                weights = np.log(fresh[some])[:, None] * np.arange(1, most + 1)
            else:
                weights = np.cumsum(np.log(fresh[some][:, None] + step[some][:, None] * np.arange(most)), axis=1)
            weights += self.logs[customers[some], :most]
            weights -= weights.max(axis=1, keepdims=True)
            sums = np.cumsum(np.exp(weights, out=weights), axis=1, out=weights)
            tables[some] = 1 + (sums <= (rng.random(len(some)) * sums[:, -1])[:, None]).sum(axis=1)
            end -= len(some)
        return np.minimum(tables, np.maximum(customers, 1))


def _worker_draws(discounts: tuple) -> list[TableCounts]:
    """TableCounts of some discounts, made once per Python worker; a worker keeps those it used last."""
    held = sys.modules.setdefault(WORKER, types.ModuleType(WORKER))
    if getattr(held, "discounts", None) != discounts:
        held.draws, held.discounts = [TableCounts(d) for d in discounts], discounts
    return held.draws


SEATED = (
    "shard int, count binary, direct binary, per_word binary, context binary, pair_count binary, pair_tables array<binary>, "
    "parent_customers array<binary>, parent_tables array<binary>, drawn binary, sizes binary, parent_drawn binary, parent_sizes binary, "
    "several_per_word binary, several_number binary, several_count binary, several_tables array<binary>, several_drawn binary, "
    "several_sizes binary, totals binary"
)
# The words, and those in rare contexts: how many contexts each has, counts of the pairs and numbers of the contexts in a list of
# these, which also has the contexts of pairs that no training row has; how many occur once and twice.
RARE_PAIRS = "words binary, rare_per_word binary, rare_count binary, rare_number binary, rare_kinds binary, once long, twice long"
# Rows of blocks: steps between the sorted places of the pairs, and what REQUEST has of their documents.
TEXTS = (
    "block long, steps binary, per_pair binary, doc binary, times binary, unseen binary, docs int, "
    "doc_ids array<{kind}>, held_out array<boolean>, text_sizes array<long>"
)
# What shards ask of a group: their rare contexts, how many of their words follow each, and which ones are behind two or more of a word.
ASKED = "shard int, origin int, rare_words binary, followers binary, several binary"
# Different words behind rare contexts: of the group ``origin`` those that ``shard`` asked for; without it, its own.  Rows with links
# or with ``every`` are for groups: steps between the places of what ``origin`` asked for, and the words behind each context.
FOLLOWERS = f"{ASKED}, links binary, every binary"
# Tables beyond one for each word: from the shard ``origin`` to a group.
SENT = "shard int, origin int, extra array<binary>"


class ShardState:
    """One shard's words, its (word, context) pairs and their seatings."""

    def __init__(self, words, owner, context, count, rare):
        """``owner``, ``context``, ``count`` describe pairs of words, ``rare`` the rare contexts in turn; every pair starts with one table.

        Words and pairs that are not in training rows have count 0.
        """
        frequent = context != RARE
        found, place = np.unique(words, return_inverse=True)
        known = np.bincount(place[owner], weights=count, minlength=len(found)) > 0
        self.words = found[known]  # sorted
        self.kinds = len(self.words)
        place = np.where(known, np.cumsum(known) - 1, self.kinds)[place][owner]  # of each pair; unknown words come last
        self.count = self._by_word(place, count)  # training tokens of each word
        self.pair_key, self.pair_count, at = self._trained(place[frequent] << 16 | context[frequent], count[frequent])
        # Contexts have numbers here, in the order of their hashes.
        contexts, number = np.unique(rare, return_inverse=True)
        key, times, rare_at = self._trained(place[~frequent] << 32 | number, count[~frequent])
        dish, rare_number = key >> 32, key & 0xFFFFFFFF
        self.rare = (times, contexts[rare_number])  # word by word
        self.contexts, self.rare_number = contexts, rare_number
        self.unseen = np.flatnonzero(~frequent)[rare_at < 0]  # pairs with rare contexts that no training row has
        self.unseen_number = number[rare_at < 0]
        # Of the pairs with several customers the words and the contexts, numbered among those of such pairs.
        several = times > 1
        self.several_key = dish[several] << 32 | np.unique(rare_number[several], return_inverse=True)[1]
        self.several_count = times[several]
        _, large = self._split(self.several_count)
        self.several_drawn = np.ones(int((~large).sum()), dtype=np.int64)
        self.several_seats = Seating(self.several_count[large], np.ones(int(large.sum()), dtype=np.int64))
        # Where each pair stands: among trained pairs, or behind them by word and context.
        self.codes = (len(self.pair_key) + len(key)) + (place << 16 | context)
        self.codes[np.flatnonzero(frequent)[at >= 0]] = at[at >= 0]
        self.codes[np.flatnonzero(~frequent)[rare_at >= 0]] = len(self.pair_key) + rare_at[rare_at >= 0]
        # Words in rare contexts have one table each, and some have more.
        self.direct = self._by_word(dish, np.ones(len(dish)))
        self.pair_tables, self.parent_customers, self.parent_tables, self.several_tables = [], [], [], []  # per sample
        mid, large = self._split(self.pair_count)
        self.drawn = np.ones(int(mid.sum()), dtype=np.int64)
        self.seats = Seating(self.pair_count[large], np.ones(int(large.sum()), dtype=np.int64))
        customers = self.customers(self.tables())
        mid, large = self._split(self.count)
        self.parent_drawn = np.ones(int(mid.sum()), dtype=np.int64)
        self.parent = Seating(customers[large], np.ones(int(large.sum()), dtype=np.int64))

    @staticmethod
    def _trained(pairs, count):
        """Sorted pairs with training tokens, these tokens, and for each given pair its place there or -1."""
        found, at = np.unique(pairs, return_inverse=True)
        total = np.bincount(at, weights=count, minlength=len(found)).astype(np.int64)
        some = total > 0
        return found[some], total[some], np.where(some, np.cumsum(some) - 1, -1)[at]

    @staticmethod
    def _split(count):
        """Dishes whose tables are drawn, and those whose customers are seated; a single customer has its own table."""
        return (count > 1) & (count <= DIRECT), count > DIRECT

    def _by_word(self, dish, values):
        return np.bincount(dish, weights=values, minlength=self.kinds)[: self.kinds].astype(np.int64)

    def tables(self) -> np.ndarray:
        """Tables of each pair; a single customer has its own table in every seating."""
        tables = np.ones(len(self.pair_key), dtype=np.int64)
        mid, large = self._split(self.pair_count)
        tables[mid], tables[large] = self.drawn, self.seats.tables()
        return tables

    def several(self) -> np.ndarray:
        """Tables of each pair of several customers in a rare context."""
        tables = np.ones(len(self.several_key), dtype=np.int64)
        mid, large = self._split(self.several_count)
        tables[mid], tables[large] = self.several_drawn, self.several_seats.tables()
        return tables

    def extra(self, tables: np.ndarray, contexts: int) -> np.ndarray:
        """Tables beyond one for each word, by rare context with pairs of several customers."""
        return np.bincount(self.several_key & 0xFFFFFFFF, weights=tables - 1, minlength=contexts).astype(np.int64)

    def customers(self, tables: np.ndarray) -> np.ndarray:
        return self.direct + self._by_word(self.pair_key >> 16, tables) + self._by_word(self.several_key >> 32, self.several() - 1)

    def roots(self) -> np.ndarray:
        roots = (self.count > 0).astype(np.int64)
        mid, large = self._split(self.count)
        roots[mid], roots[large] = self.parent_drawn, self.parent.tables()
        return roots

    def totals(self) -> np.ndarray:
        """The parent's customers and tables, then the tables of each frequent context, up to the last one here."""
        by_context = np.bincount(self.pair_key & 0xFFFF, weights=self.tables())
        return np.concatenate([[self.customers(self.tables()).sum(), self.roots().sum()], by_context])

    def sweep(self, corpus: Corpus, totals: np.ndarray, seed: list[int], sample: bool, draws: list, above: np.ndarray) -> None:
        """Seat all customers again, given the ``totals`` of all shards and the tables ``above`` of rare contexts with pairs of several.

        ``draws`` are TableCounts of parent, frequent and rare contexts.
        """
        (d0, d1, d2), (s0, s1) = corpus.discounts, STRENGTH
        rng = np.random.default_rng(seed)
        opened = (s0 + d0 * totals[1]) * corpus.base
        unigram = (self.customers(self.tables()) - d0 * self.roots() + opened) / (s0 + totals[0])
        fresh = (s1 + d1 * totals[2:])[self.pair_key & 0xFFFF] * unigram[self.pair_key >> 16]
        mid, large = self._split(self.pair_count)
        self.drawn = draws[1].draw(self.pair_count[mid], fresh[mid], rng)
        self.seats.sweep(fresh[large], d1, rng)
        own, tables = unigram[self.several_key >> 32], above[self.several_key & 0xFFFFFFFF]
        mid, large = self._split(self.several_count)
        others = (tables - self.several())[mid]
        self.several_drawn = draws[2].draw(self.several_count[mid], own[mid] * (s1 + d2 * others), rng, own[mid] * d2)
        self.several_seats.sweep((own * (s1 + d2 * tables))[large], d2, rng)
        customers = self.customers(self.tables())
        mid, large = self._split(self.count)
        self.parent_drawn = draws[0].draw(customers[mid], np.full(int(mid.sum()), opened), rng)
        self.parent.sweep(np.full(int(large.sum()), opened), d0, rng, customers[large])
        if sample:
            self.pair_tables.append(self.tables())
            self.parent_customers.append(customers)
            self.parent_tables.append(self.roots())
            self.several_tables.append(self.several())

    def row(self, shard: int) -> tuple:
        lists = [[_pack(x) for x in v] for v in (self.pair_tables, self.parent_customers, self.parent_tables)]
        # Sizes of a dish's tables follow each other and sum to its customers, so their cuts need not be kept.
        return (
            shard, _pack(self.count), _pack(self.direct), _pack(self._by_word(self.pair_key >> 16, np.ones(len(self.pair_key)))),
            _binary((self.pair_key & 0xFFFF).astype(np.uint16)), _pack(self.pair_count),
            *lists, _pack(self.drawn), _pack(self.seats.sizes), _pack(self.parent_drawn), _pack(self.parent.sizes),
            _pack(self._by_word(self.several_key >> 32, np.ones(len(self.several_key)))), _pack(self.several_key & 0xFFFFFFFF),
            _pack(self.several_count), [_pack(x) for x in self.several_tables], _pack(self.several_drawn), _pack(self.several_seats.sizes),
            _pack(self.totals()),
        )

    @staticmethod
    def of(row: dict) -> ShardState:
        state = ShardState.__new__(ShardState)
        per_word = _unpack(row["per_word"])
        state.pair_key = np.repeat(np.arange(len(per_word)), per_word) << 16 | np.frombuffer(row["context"], np.uint16)
        per_word = _unpack(row["several_per_word"])
        state.several_key = np.repeat(np.arange(len(per_word)), per_word) << 32 | _unpack(row["several_number"])
        for name in ("count", "direct", "pair_count", "several_count", "several_drawn"):
            setattr(state, name, _unpack(row[name]))
        for name in ("pair_tables", "parent_customers", "parent_tables", "several_tables"):
            setattr(state, name, [_unpack(b) for b in row[name]])
        state.kinds = len(state.count)
        state.drawn, state.parent_drawn = _unpack(row["drawn"]), _unpack(row["parent_drawn"])
        state.seats = Seating.of(_unpack(row["sizes"]), state.pair_count[state.pair_count > DIRECT])
        state.several_seats = Seating.of(_unpack(row["several_sizes"]), state.several_count[state.several_count > DIRECT])
        state.parent = Seating.of(_unpack(row["parent_sizes"]), state.customers(state.tables())[state.count > DIRECT])
        return state


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


KINDS_SEATED = [
    pa.int32(), *[pa.binary()] * 5, *[pa.list_(pa.binary())] * 3, *[pa.binary()] * 7, pa.list_(pa.binary()), *[pa.binary()] * 3
]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the ranges in turn."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def _placed(codes, per_row, per_pair, doc, times):
    """The texts of each row with pairs in the order of their places: steps, per_pair, doc and times."""
    row = np.repeat(np.arange(len(per_row)), per_row)
    order = np.lexsort((codes, row))
    entry = _ranges((np.cumsum(per_pair) - per_pair)[order], per_pair[order])
    codes, per_pair, doc, times = codes[order], per_pair[order], doc[entry], times[entry]
    pair_at = np.append(0, np.cumsum(per_row))
    entry_at = np.append(0, np.cumsum(per_pair))[pair_at]
    for p, q, e, f in zip(pair_at, pair_at[1:], entry_at, entry_at[1:]):
        yield _pack(np.diff(codes[p:q], prepend=0)), _pack(per_pair[p:q]), _pack(doc[e:f]), _pack(times[e:f])


def _first_seats(kind_of_id):
    """Of each shard the first seats, and the texts by places of their pairs."""
    lists = [pa.list_(kind_of_id), pa.list_(pa.bool_()), pa.list_(pa.int64())]
    kinds = [*KINDS_SEATED, *[pa.binary()] * 5, pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 5, pa.int32(), *lists]
    names = _names(f"{SEATED}, {RARE_PAIRS}, {TEXTS}")
    no_seats, no_texts = len(_names(f"{SEATED}, {RARE_PAIRS}")) - 1, len(_names(TEXTS))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        heads = table.filter(pc.is_null(table.column("words")))  # they describe blocks
        texts = table.filter(pc.is_valid(table.column("words")))
        words = _joined(texts.column("words"), np.uint64)
        owner = np.repeat(np.arange(len(words)), _joined(texts.column("per_word")))
        rare = _joined(texts.column("rare"), np.uint64)
        state = ShardState(words, owner, _joined(texts.column("context")), _joined(texts.column("trained")), rare)
        rows = []
        if state.kinds or len(state.contexts):
            count, _ = state.rare
            rows.append((
                *state.row(shard), _binary(state.words), _pack(state.direct), _pack(count), _pack(state.rare_number), _binary(state.contexts),
                int((count == 1).sum()), int((count == 2).sum()), *[None] * no_texts,
            ))
        no_seat = (shard, *[None] * no_seats)
        for r in heads.select(["block", "docs", "doc_ids", "held_out", "sizes"]).to_pylist():
            rows.append((*no_seat, r["block"], *[None] * 5, r["docs"], r["doc_ids"], r["held_out"], r["sizes"]))
        per_pair = [_unpack(b) for b in texts.column("per_pair").to_pylist()]
        per_row = np.array([len(n) for n in per_pair], dtype=np.int64)
        per_pair = np.concatenate([np.zeros(0, np.int64), *per_pair])
        placed = _placed(state.codes, per_row, per_pair, _joined(texts.column("doc")), _joined(texts.column("times")))
        # Contexts of unseen pairs in the same order.
        row = np.repeat(np.arange(len(per_row)), per_row)[state.unseen]
        number = state.unseen_number[np.lexsort((state.codes[state.unseen], row))]
        cuts = np.searchsorted(row, np.arange(len(per_row) + 1))
        for i, (block, docs, text) in enumerate(zip(texts.column("block").to_pylist(), texts.column("docs").to_pylist(), placed)):
            rows.append((*no_seat, block, *text, _pack(number[cuts[i] : cuts[i + 1]]), docs, None, None, None))
        return pa.Table.from_batches([_table(rows, names, kinds)])

    return run


def _asked(groups: int):
    """The rare contexts of each shard's pairs, to the groups of these contexts."""

    def run(batches):
        for row in (row for batch in batches for row in batch.to_pylist()):
            words, number = np.frombuffer(row["rare_kinds"], np.uint64), _unpack(row["rare_number"])
            times = np.bincount(number, minlength=len(words))
            several = np.unique(number[_unpack(row["rare_count"]) > 1])
            cuts = np.searchsorted(_shard(words, groups), np.arange(groups + 1))
            rows = []
            for group, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    i, j = np.searchsorted(several, [a, b])
                    rows.append((group, row["shard"], _binary(words[a:b]), _pack(times[a:b]), _pack(np.diff(several[i:j] - a, prepend=0))))
            yield _table(rows, _names(ASKED), [pa.int32(), pa.int32(), *[pa.binary()] * 3])

    return run


def _answered(shards: int):
    """Different words after each rare context of a group, to each shard that asked and to the context's own shard."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        words, at = np.unique(_joined(table.column("rare_words"), np.uint64), return_inverse=True)
        followers = np.bincount(at, weights=_joined(table.column("followers")), minlength=len(words)).astype(np.int64)
        trained = followers > 0
        own, told = words[trained], followers[trained]
        cuts = np.searchsorted(_shard(own, shards), np.arange(shards + 1))
        rows = [(s, None, _binary(own[a:b]), _pack(told[a:b]), *[None] * 3) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        rows.append((group, *[None] * 5, _pack(followers)))
        a = 0
        for r in table.select(["origin", "rare_words", "several"]).to_pylist():
            places = at[a : (a := a + len(r["rare_words"]) // 8)]
            rows.append((r["origin"], group, None, _pack(followers[places]), *[None] * 3))
            rows.append((group, r["origin"], None, None, r["several"], _pack(np.diff(places, prepend=0)), None))
        return pa.Table.from_batches([_table(rows, _names(FOLLOWERS), [pa.int32(), pa.int32(), *[pa.binary()] * 5])])

    return run


def _summed_tables(final: bool):
    """What a group tells the shards: the tables of contexts with pairs of several customers there, or finally what
    every context has beyond one table for each word, by sample."""

    def run(key: tuple[pa.Scalar, ...], sent: pa.Table, links: pa.Table) -> pa.Table:
        group, links = key[0].as_py(), links.to_pylist()
        every = next(_unpack(r["every"]) for r in links if r["every"] is not None)
        places = {r["origin"]: np.cumsum(_unpack(r["links"])) for r in links if r["links"] is not None}
        several = {r["origin"]: places[r["origin"]][np.cumsum(_unpack(r["several"]))] for r in links if r["links"] is not None}
        sums = np.zeros((SAMPLES if final else 1, len(every)), dtype=np.int64)
        for r in sent.to_pylist():
            for total, extra in zip(sums, r["extra"], strict=True):
                total[several[r["origin"]]] += _unpack(extra)
        if not final:
            sums += every
        rows = [(origin, group, [_pack(x[at]) for x in sums]) for origin, at in (places if final else several).items() if len(at)]
        return pa.Table.from_batches([_table(rows, _names(SENT), [pa.int32(), pa.int32(), pa.list_(pa.binary())])])

    return run


class RarePairs:
    """What a shard knows of rare contexts: the pairs of its words, and the contexts among its words."""

    def __init__(self, rows: list[dict], discount: float, words: np.ndarray, count: np.ndarray, numbered: bool = False):
        """``words`` of the shard and their training tokens; ``rows`` hold its pairs, and answers and own contexts of FOLLOWERS.

        ``rare_context`` names the contexts by their hashes, or (``numbered``) by their places among those asked for.
        """
        s1 = STRENGTH[1]
        self.words, self.context = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        # Of each pair the places of its word and its context, and what it adds with one table.
        self.dish, self.number, self.own = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.log_share = np.zeros(len(words) + 1)  # last: unknown word
        answers = sorted((r["origin"], r["followers"]) for r in rows if r["origin"] is not None)
        # Words are sorted by group, so the answers of the groups follow each other.
        self.below = s1 + discount * np.concatenate([np.zeros(0, np.int64), *[_unpack(b) for _, b in answers]])
        for row in rows:
            if row["rare_per_word"] is not None:
                self.dish = np.repeat(np.arange(len(words)), _unpack(row["rare_per_word"]))
                self.words, self.context = words[self.dish], np.frombuffer(row["rare_context"], np.uint64)
                self.number = self.context.astype(np.int64) if numbered else np.unique(self.context, return_inverse=True)[1]
                self.count = _unpack(row["rare_count"])
                self.own = (self.count - discount) / self.below[self.number]
            elif row["rare_words"] is not None:
                followers = _unpack(row["followers"])
                at = np.searchsorted(words, np.frombuffer(row["rare_words"], np.uint64))
                self.log_share[at] = np.log10((s1 + discount * followers) / (s1 + count[at]))

    def of(self, names: np.ndarray) -> np.ndarray:
        """What the pairs of these names add to the words' own probabilities; 0 for those that do not occur."""
        if not len(self.own):
            return np.zeros(len(names))
        known = _pair_names(self.words, self.context)
        order = np.argsort(known)
        at = order[np.minimum(np.searchsorted(known, names, sorter=order), len(order) - 1)]
        return np.where(known[at] == names, self.own[at], 0.0)


def _swept(corpus, totals, number: int):
    """Seats of a shard after another sweep, and its tables for the groups of rare contexts; in the last sweep those of all samples."""
    names = _names(f"{SEATED}, target int, extra array<binary>")

    def run(key: tuple[pa.Scalar, ...], seated: pa.Table, told: pa.Table) -> pa.Table:
        c, shard, rows = corpus.value, key[0].as_py(), []
        draws = _worker_draws(c.discounts)
        answers = sorted((r["origin"], r["extra"][0]) for r in told.to_pylist())
        above = [_unpack(b) for _, b in answers]
        cuts = np.cumsum([len(x) for x in above])
        above = np.concatenate([np.zeros(0, np.int64), *above])
        for row in seated.to_pylist():
            state = ShardState.of(row)
            state.sweep(c, totals.value, [17, shard, number], number >= BURN_IN, draws, above)
            rows.append((*state.row(shard), None, None))
            sampled = state.several_tables if number == BURN_IN + SAMPLES - 1 else [state.several()]
            extra = [np.split(state.extra(x, len(above)), cuts[:-1]) for x in sampled]
            for i, (group, _) in enumerate(answers):
                rows.append((shard, *[None] * (len(names) - 3), group, [_pack(x[i]) for x in extra]))
        return pa.Table.from_batches([_table(rows, names, [*KINDS_SEATED, pa.int32(), pa.list_(pa.binary())])])

    return run


def _totals(batches):
    sums = np.zeros(0, dtype=np.int64)
    for packed in (b for batch in batches for b in batch.column("totals").to_pylist()):
        values = _unpack(packed)
        sums = np.pad(sums, (0, max(0, len(values) - len(sums))))
        sums[: len(values)] += values
    some = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[some])], ["at", "total"])


def _scored(corpus, kind_of_id):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, seated: pa.Table) -> pa.Table:
        c = corpus.value
        shard = key[0].as_py()
        # Every shard with trained words has a row of seats.
        seated = seated.to_pylist()
        state = next((ShardState.of(r) for r in seated if r["pair_count"] is not None), None)
        known = next((np.frombuffer(r["words"], np.uint64) for r in seated if r["words"] is not None), np.zeros(0, np.uint64))
        (d0, d1, d2), (s0, s1) = c.discounts, STRENGTH
        unigrams = []
        for s in range(SAMPLES):
            n0, t0 = c.totals[s, 0], c.totals[s, 1]
            own = np.append(state.parent_customers[s] - d0 * state.parent_tables[s] if state else [], 0.0)  # last: unknown word
            unigrams.append((own + (s0 + d0 * t0) * c.base) / (s0 + n0))
        counts = np.append(state.count if state else np.zeros(0, np.int64), 0)
        pairs = [
            {**r, "rare_context": None if r["rare_number"] is None else _binary(_unpack(r["rare_number"]).astype(np.uint64))}
            for r in seated if r["extra"] is None
        ]
        rare = RarePairs(pairs, d2, known, counts, numbered=True)
        told = [x for _, x in sorted((r["origin"], r["extra"]) for r in seated if r["extra"] is not None)]
        # By sample what the word's own probability counts behind each rare context; last: another context.
        rest = [np.append(1.0 + d2 * np.concatenate([np.zeros(0), *[_unpack(x[s]) for x in told]]) / rare.below, 1.0) for s in range(SAMPLES)]
        rare_own = SAMPLES * rare.own
        if state and len(rare.own):
            some = np.flatnonzero(rare.count > 1)
            rare_own[some] -= d2 * (sum(state.several_tables) - SAMPLES) / rare.below[rare.number[some]]
        # Of each place the word and the context; places of pairs that no training row has follow and tell them themselves.
        frequent = state.pair_key if state else np.zeros(0, np.int64)
        trained = np.concatenate((frequent, rare.dish << 16 | RARE))
        rows = []
        for row in table.to_pylist():
            if row["steps"] is None:  # describes a block
                rows.append((row["block"], None, *[None] * 4, row["doc_ids"], row["held_out"], row["text_sizes"]))
                continue
            at = np.cumsum(_unpack(row["steps"]))
            n, m = np.searchsorted(at, [len(frequent), len(trained)])  # frequent pairs, then rare ones, then others
            wanted = np.concatenate((trained[at[:m]], at[m:] - len(trained)))
            place, context = wanted >> 16, wanted & 0xFFFF
            inside = context != RARE
            below = s1 + c.customers[context]
            number = np.full(len(wanted), -1)
            number[n:m] = rare.number[at[n:m] - len(frequent)]
            number[m:][~inside[m:]] = _unpack(row["unseen"])
            mean = np.zeros(len(wanted))
            for s in range(SAMPLES):
                p = unigrams[s][place]
                share = np.where(inside, (s1 + d1 * c.totals[s, 2:][context]) / below, rest[s][number])
                own = np.zeros(len(wanted))
                if n:
                    own[:n] = (state.pair_count[at[:n]] - d1 * state.pair_tables[s][at[:n]]) / below[:n]
                mean += own + share * p
            mean[n:m] += rare_own[at[n:m] - len(frequent)]
            count = counts[place]
            values = np.stack([
                np.log10(mean / SAMPLES) + rare.log_share[place], np.log10((count + 1.0) / (c.tokens + c.kinds + 1.0)), (count > 0).astype(float)
            ])
            pair = np.repeat(np.arange(len(wanted)), _unpack(row["per_pair"]))
            doc, times = _unpack(row["doc"]), _unpack(row["times"])
            some = np.flatnonzero(np.bincount(doc))
            score, base, seen = (np.bincount(doc, weights=v[pair] * times)[some] for v in values)
            rows.append((row["block"], shard, _pack(some), _binary(score), _binary(base), _pack(np.rint(seen)), None, None, None))
        names = [f.split()[0] for f in PARTIAL.split(", ")]
        lists = [pa.list_(kind_of_id), pa.list_(pa.bool_()), pa.list_(pa.int64())]
        return pa.Table.from_batches([_table(rows, names, [pa.int64(), pa.int32(), *[pa.binary()] * 4, *lists])])

    return run


PARTIAL = (
    "block long, shard int, docs binary, score binary, base binary, known binary, "
    "doc_ids array<{kind}>, held_out array<boolean>, sizes array<long>"
)


def _assembled(tokens: int, kind_of_id):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (-1 if r["shard"] is None else r["shard"], r["score"] or b""))
        head = rows[0]
        sums = np.zeros((3, len(head["sizes"])))
        for r in rows[1:]:  # only documents that have words of the shard
            docs = _unpack(r["docs"])
            sums[:, docs] += np.stack([np.frombuffer(r["score"]), np.frombuffer(r["base"]), _unpack(r["known"])])
        return pa.table({
            "doc_id": pa.array(head["doc_ids"], kind_of_id), "held_out": pa.array(head["held_out"]),
            "n_tokens": pa.array(head["sizes"], pa.int64()), "n_known": pa.array(sums[2].astype(np.int64)),
            "train_tokens": pa.array([tokens] * len(head["sizes"]), pa.int64()), "base_score": pa.array(sums[1]), "score": pa.array(sums[0]),
            "perplexity": pa.array(10.0 ** (-sums[0] / np.array(head["sizes"]))),
        })

    return run


def score_documents(df: DataFrame, train, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all rows by a model of the rows for which the boolean column ``train`` holds.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigram), score (log10 of the
    text's probability) and perplexity (10 to the power of -score / n_tokens).  Words have A-Z lower-cased; every text ends in an end token, so null and empty texts have one
    token.  Repeated rows count as often as they occur.  With no training rows both scores are uniform.
    Words are named by 64-bit hashes.  Other columns are left out; an empty table gives an empty result.
    """
    spark = df.sparkSession
    rows = in_small_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), train.alias("train"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    arrow_kind = rows.select("doc_id").limit(0).toArrow().schema.field(0).type
    size = rows.agg(F.sum(F.octet_length("_text")).alias("n")).first()["n"] or 0
    shards = max(4, -(-size // SHARD_BYTES))

    with shuffles_dropped(spark):
        corpus, texts, seated = _fitted(rows, int(shards), kind, arrow_kind)
    parts = texts.groupBy("shard").cogroup(seated.groupBy("shard")).applyInArrow(
        _scored(Shared(spark, corpus), arrow_kind), PARTIAL.format(kind=kind)
    )
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return parts.groupBy("block").applyInArrow(_assembled(corpus.tokens, arrow_kind), schema)


def _fitted(rows: DataFrame, shards: int, kind: str, arrow_kind) -> tuple[Corpus, DataFrame, DataFrame]:
    """Totals, and by shard the texts and what scores them."""
    spark = rows.sparkSession
    counted = rows.mapInArrow(_counted(shards), "shard int, words binary, counts binary")
    vocabulary = keep(counted.groupBy("shard").applyInArrow(_summed_vocabulary, "word long, count long"), "vocabulary")
    facts = vocabulary.agg(
        F.sum("count").alias("n"), F.count("*").alias("v"), F.sum((F.col("count") == 1).cast("long")).alias("n1"),
        F.sum((F.col("count") == 2).cast("long")).alias("n2"), F.sum(F.when(F.col("word") == int(END), F.col("count"))).alias("docs"),
    ).first()
    tokens, docs = facts["n"] or 0, facts["docs"] or 0
    often = vocabulary.filter((F.col("count") * CONTEXT_SHARE >= tokens) & (F.col("word") != int(END))).toPandas()
    forget(vocabulary)
    hashes = often["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    corpus = Corpus(
        shards, tokens, facts["v"] or 0, hashes[order], np.concatenate([[0, docs], often["count"].to_numpy(np.int64)[order]])
    )
    counts = rows.mapInArrow(_requests(Shared(spark, corpus), arrow_kind), REQUEST.format(kind=kind))
    texts = f"shard int, {TEXTS.format(kind=kind)}"
    kept = keep(counts.groupBy("shard").applyInArrow(_first_seats(arrow_kind), f"{SEATED}, {RARE_PAIRS}, {TEXTS.format(kind=kind)}"), "seats")
    first = kept.filter("words is not null")
    # Discounts from how many kinds occur once and twice.
    frequent = first.select("shard", "words", "per_word", "context", F.col("pair_count").alias("trained"))
    found = first.agg(F.sum("once"), F.sum("twice")).first()
    corpus.discounts = (_discount(facts["n1"], facts["n2"]), _pair_discount(frequent), _discount(*found))
    groups = max(4, -(-shards // SHARDS_OF_GROUP))
    asked = first.select("shard", "rare_number", "rare_count", "rare_kinds").mapInArrow(_asked(groups), ASKED)
    followers = keep(asked.groupBy("shard").applyInArrow(_answered(shards), FOLLOWERS), "followers")
    links = followers.filter("links is not null or every is not null").select("shard", "origin", "several", "links", "every")
    restaurants = len(corpus.customers)
    shared = Shared(spark, corpus)

    def summed(seated: DataFrame) -> np.ndarray:
        found = seated.select("totals").mapInArrow(_totals, "at int, total long").groupBy("at").agg(F.sum("total").alias("total")).toPandas()
        totals = np.zeros(2 + restaurants)
        totals[found["at"]] = found["total"]
        return totals

    def told(sent: DataFrame, final: bool = False) -> DataFrame:
        return sent.groupBy("shard").cogroup(links.groupBy("shard")).applyInArrow(_summed_tables(final), SENT)

    seated, sent = first.select(*_names(SEATED)), spark.createDataFrame([], SENT)
    totals = [summed(seated)]
    before = None  # the first ones stay with the texts
    for number in range(BURN_IN + SAMPLES):
        run = _swept(shared, spark.sparkContext.broadcast(totals[-1]), number)
        swept = seated.groupBy("shard").cogroup(told(sent).groupBy("shard")).applyInArrow(run, f"{SEATED}, target int, extra array<binary>")
        swept = keep(swept, "seats")
        seated = swept.filter("target is null").select(*_names(SEATED))
        sent = swept.filter("target is not null").select(F.col("target").alias("shard"), F.col("shard").alias("origin"), "extra")
        totals.append(summed(seated))
        if before is not None:
            forget(before)
        before = swept
    corpus.totals = np.stack(totals[-SAMPLES:])
    rare = first.select("shard", "words", "rare_per_word", "rare_count", "rare_number")
    followers = followers.filter("links is null and every is null").select("shard", "origin", "rare_words", "followers")
    seated = seated.drop("totals")
    for more in (rare, followers, told(sent, final=True)):
        seated = seated.unionByName(more, allowMissingColumns=True)
    return corpus, kept.filter("block is not null").select(*_names(texts)), seated


def _discount(once, twice) -> float:
    return float(np.clip((once or 0) / max(1, (once or 0) + 2 * (twice or 0)), 0.05, 0.95))


def _pair_discount(rows: DataFrame) -> float:
    def run(table: pa.Table) -> pa.Table:
        words = _joined(table.column("words"), np.uint64)
        owner = np.repeat(words, _joined(table.column("per_word")))
        context = _joined(table.column("context"), np.uint16).astype(np.uint64)
        inside = context != RARE
        key = (owner * np.uint64(0x9E3779B97F4A7C15) + context)[inside]
        _, at = np.unique(key, return_inverse=True)
        total = np.bincount(at, weights=_joined(table.column("trained"))[inside])
        return pa.table({"once": pa.array([int((total == 1).sum())]), "twice": pa.array([int((total == 2).sum())])})

    some = rows.select("shard", "words", "per_word", "context", "trained").groupBy("shard")
    found = some.applyInArrow(run, "once long, twice long").agg(F.sum("once"), F.sum("twice")).first()
    return _discount(*found) if found[0] is not None else 0.8
