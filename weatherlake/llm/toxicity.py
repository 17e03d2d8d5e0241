"""Toxicity scores by a convolutional text classifier trained in numpy.

Words are named by two hashes; a word's vector is the two embeddings side by side, so that two
words are confused only if both hashes meet.  Filters of several widths slide over the whole text, the maximum
of each over all positions goes to a logistic output.  The fit uses a bounded sample of labelled rows
in one task; scoring runs in all.  A Platt scale makes the output a probability, and thresholds for
rejection are set by language, both from counts over all labelled rows that the fit did not train on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from weatherlake.llm.common import Shared, in_small_batches
from weatherlake.llm.words import LETTERS, encoded, give_back, hashed_words, slices

BUCKETS, WIDTH_EACH = 1 << 18, 6
WIDTHS, FILTERS = (1, 2, 3), 12
# Bounds of the sample that the fit uses.
SAMPLE_ROWS, SAMPLE_BYTES = 12_000, 60_000
STEPS, BATCH, LEFT_OUT = 400, 64, 5
LEAST_OF_LANGUAGE = 25
# Logits are counted in bins of this width when scale and thresholds are set.
BIN, MOST_LOGIT = 1 / 256, 40.0


def word_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two bucket numbers per word, shape (words, 2), and words per text; bucket 0 is padding."""
    h, counts = hashed_words(texts, LETTERS)
    first = h % np.uint64(BUCKETS - 1) + np.uint64(1)
    second = (h >> np.uint64(32)) % np.uint64(BUCKETS - 1) + np.uint64(1)
    return np.stack([first, second], axis=1).astype(np.int32), counts


@dataclass
class Network:
    tables: list = field(default_factory=lambda: [np.zeros((BUCKETS, WIDTH_EACH), np.float32) for _ in range(2)])
    kernels: dict = field(default_factory=dict)
    bias: dict = field(default_factory=dict)
    out: np.ndarray | None = None
    offset: float = 0.0
    scale: tuple = (1.0, 0.0)
    thresholds: dict = field(default_factory=dict)

    def layout(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with padding behind each text, and the start of each text."""
        pad = max(WIDTHS) - 1
        ends = np.cumsum(counts)
        starts = ends - counts + pad * np.arange(len(counts))
        spread = np.zeros((len(ids) + pad * len(counts), 2), dtype=np.int32)
        spread[np.arange(len(ids)) + pad * np.repeat(np.arange(len(counts)), counts)] = ids
        return spread, starts

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate([t[ids[:, i]] for i, t in enumerate(self.tables)], axis=1)

    def convolved(self, x: np.ndarray, width: int) -> np.ndarray:
        """Filter values at each position; positions near the end see padding."""
        total = x @ self.kernels[width][0]
        for k in range(1, width):
            total[:-k] += (x @ self.kernels[width][k])[k:]
        return total

    def pooled(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        spread, starts = self.layout(ids, counts)
        x = self.vectors(spread)
        parts = [np.maximum.reduceat(self.convolved(x, w), starts, axis=0) + self.bias[w] for w in WIDTHS]
        return np.maximum(np.concatenate(parts, axis=1), 0.0)

    def logits(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.pooled(ids, counts) @ self.out + self.offset if len(counts) else np.zeros(0)

    def probability(self, logits: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1.0 / (1.0 + np.exp(-np.clip(a * logits + b, -40, 40)))


def _platt(logits: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> tuple[float, float]:
    """Newton steps for a, b of sigmoid(a x + b), with smoothed targets and a positive slope; ``times`` counts each row."""
    times = np.ones(len(y)) if times is None else times
    n1 = (times * y).sum()
    n0 = times.sum() - n1
    if not n1 or not n0:
        return 1.0, 0.0
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([logits, np.ones_like(logits)], axis=1).astype(np.float64)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x * (times * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hessian, x.T @ (times * (p - goal)) + 1e-3 * (w - [1.0, 0.0])), -2, 2)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def _threshold(p: np.ndarray, toxic: np.ndarray, harmless: np.ndarray) -> float:
    """The cut with most right decisions, midway between neighbouring scores, nearest to 0.5 in a tie.

    ``toxic`` and ``harmless`` count the rows of each score.
    """
    order = np.argsort(p)
    p, toxic, harmless = p[order], toxic[order], harmless[order]
    cuts = np.concatenate([[0.0], (p[1:] + p[:-1]) / 2, [1.0]])
    right = np.concatenate([[0], np.cumsum(harmless)]) + toxic.sum() - np.concatenate([[0], np.cumsum(toxic)])
    best = np.flatnonzero(right == right.max())
    return float(np.clip(cuts[best[np.argmin(np.abs(cuts[best] - 0.5))]], 0.05, 0.95))


def fit(docs: list[np.ndarray], y: np.ndarray, langs: list, seed: int = 11) -> Network:
    """Train on documents given as (words, 2) bucket arrays."""
    rng = np.random.default_rng(seed)
    net, dims = Network(), 2 * WIDTH_EACH
    for w in WIDTHS:
        net.kernels[w] = rng.normal(0, 0.5, (w, dims, FILTERS)).astype(np.float32)
        net.bias[w] = np.zeros(FILTERS, np.float32)
    net.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
    n = len(docs)
    if not n or y.min() == y.max():
        net.offset = 4.0 if n and y.max() else -4.0
        return net
    left = ~trained_rows(y)
    train = np.flatnonzero(~left)
    weight = np.where(y > 0, np.sqrt((y == 0).sum() / max(1, (y > 0).sum())), 1.0)
    seen = [np.zeros((BUCKETS, 1), np.float32) for _ in range(2)]
    slopes: dict = {}

    def step(name, value, gradient, rate):
        slopes[name] = slopes.get(name, 0.0) + gradient * gradient
        value -= rate * gradient / (np.sqrt(slopes[name]) + 1e-6)

    # Maximum pooling hands gradients to the strongest word only, so words that tell the classes
    # apart must stand out from the start: their first component begins as shrunk log-odds.
    for i, table in enumerate(net.tables):
        table[:] = rng.normal(0, 0.02, table.shape)
        present = np.zeros((2, BUCKETS), np.float32)
        for d in train:
            present[int(y[d]), np.unique(docs[d][:, i])] += 1
        sizes = np.array([[(y[train] == c).sum()] for c in (0, 1)])
        odds = np.diff(np.log((present + 0.5) / (sizes + 1.0)), axis=0)[0]
        table[:, 0] += 0.3 * odds * present.sum(axis=0) / (present.sum(axis=0) + 4.0)
        table[0] = 0.0
    for w in WIDTHS:
        for i in range(2):
            net.kernels[w][:, i * WIDTH_EACH] = rng.uniform(0.2, 0.6, (w, FILTERS)) * rng.choice([1, 1, 1, -1], FILTERS)
    queue = np.zeros(0, dtype=int)
    offset = np.zeros(1)
    for _ in range(STEPS):
        if len(queue) < BATCH:
            queue = np.concatenate([queue, rng.permutation(train)])
        pick, queue = queue[:BATCH], queue[BATCH:]
        counts = np.array([len(docs[i]) for i in pick])
        ids, starts = net.layout(np.concatenate([docs[i] for i in pick]), counts)
        x = net.vectors(ids)
        ends = np.append(starts[1:], len(ids))
        places, hidden = {}, []
        for w in WIDTHS:
            c = net.convolved(x, w)
            places[w] = np.stack([a + c[a:b].argmax(axis=0) for a, b in zip(starts, ends)])
            hidden.append(np.maximum(np.take_along_axis(c, places[w], 0) + net.bias[w], 0.0))
        h = np.concatenate(hidden, axis=1)
        p = 1 / (1 + np.exp(-np.clip(h @ net.out + offset[0], -30, 30)))
        error = ((p - y[pick]) * weight[pick] / len(pick)).astype(np.float32)
        back = error[:, None] * net.out[None] * (h > 0)
        step("out", net.out, h.T @ error + 1e-4 * net.out, 0.05)
        step("offset", offset, error.sum(keepdims=True), 0.05)
        touched, moves = [], []
        for j, w in enumerate(WIDTHS):
            g = back[:, j * FILTERS : (j + 1) * FILTERS]
            gradient = np.zeros_like(net.kernels[w])
            for k in range(w):
                at = np.minimum(places[w] + k, len(ids) - 1)
                xk = x[at] * (places[w] + k < len(ids))[..., None]
                gradient[k] = np.einsum("df,dfe->ef", g, xk)
                touched.append(ids[at].reshape(-1, 2))
                moves.append((g[..., None] * net.kernels[w][k].T[None]).reshape(-1, dims))
            step(("kernel", w), net.kernels[w], gradient, 0.03)
            step(("bias", w), net.bias[w], g.sum(axis=0), 0.03)
        touched, moves = np.concatenate(touched), np.concatenate(moves)
        for i, table in enumerate(net.tables):
            rows, back_to = np.unique(touched[:, i], return_inverse=True)
            gradient = np.zeros((len(rows), WIDTH_EACH), np.float32)
            np.add.at(gradient, back_to, moves[:, i * WIDTH_EACH : (i + 1) * WIDTH_EACH])
            gradient[rows == 0] = 0.0  # padding stays zero
            seen[i][rows] += (gradient * gradient).mean(axis=1, keepdims=True)
            table[rows] -= 0.15 * gradient / (np.sqrt(seen[i][rows]) + 1e-6)
    net.offset = float(offset[0])
    check = np.flatnonzero(left) if left.any() else train
    logits = np.concatenate([net.logits(docs[i], np.array([len(docs[i])])) for i in check])
    net.scale = _platt(logits, y[check])
    p, truth = net.probability(logits), y[check]
    net.thresholds = {None: _threshold(p, truth, 1 - truth)}
    for lang in {langs[i] for i in check}:
        own = np.array([langs[i] == lang for i in check])
        if lang is not None and own.sum() >= LEAST_OF_LANGUAGE and 0 < truth[own].sum() < own.sum():
            net.thresholds[lang] = _threshold(p[own], truth[own], 1 - truth[own])
    return net


def trained_rows(y: np.ndarray) -> np.ndarray:
    """Whether ``fit`` trains on each row; the others only check."""
    left = np.arange(len(y)) % LEFT_OUT == 0
    if len(set(y[left])) < 2 or len(set(y[~left])) < 2:
        left[:] = False
    return ~left


def _fitted(kind_of_id):
    """Fits on all rows of the one partition; gives the pickled net and the ids that it trained on."""

    def run(batches):
        docs, y, langs, ids = [], [], [], []
        for rows in (part for batch in batches for part in slices(batch, "_text")):
            words, counts = word_ids(encoded(rows.column("_text").to_pylist()))
            docs += np.split(words, np.cumsum(counts)[:-1])
            for held, name in ((y, "_label"), (langs, "lang"), (ids, "doc_id")):
                held += rows.column(name).to_pylist()
        y = np.array(y, dtype=np.float32)
        net = cloudpickle.dumps(fit(docs, y, langs))
        trained = list({i for i, t in zip(ids, trained_rows(y)) if t})
        arrays = [pa.array([net], pa.binary()), pa.array([trained], pa.list_(kind_of_id))]
        del docs
        yield pa.RecordBatch.from_arrays(arrays, ["net", "trained"])
        give_back()

    return run


def _counted(shared):
    def run(batches):
        model = shared.value
        for rows in (part for batch in batches for part in slices(batch, "_text", 1 << 19)):
            ids, counts = word_ids(encoded(rows.column("_text").to_pylist()))
            logits = np.clip(model.logits(ids, counts).astype(np.float64), -MOST_LOGIT, MOST_LOGIT)
            arrays = [rows.column("doc_id"), rows.column("lang"), pa.array(np.floor(logits / BIN).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang", "bin"])

    return run


def calibrate(texts: DataFrame, labels: DataFrame, net: Network) -> None:
    """Set scale and thresholds from the counts by language, bin of the logit and label of all rows with a label.

    ``texts`` has doc_id, _text, lang; ``labels`` one row of doc_id and _label per id.  Without rows of both labels
    the net stays as it is.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()
    # Texts are scored before the join, so that only ids and bins are shuffled.
    shared = Shared(texts.sparkSession, net)
    bins = texts.mapInArrow(_counted(shared), f"doc_id {kind}, lang string, bin int")
    toxic = F.sum((F.col("_label") > 0).cast("long")).alias("toxic")
    found = bins.join(labels, "doc_id").groupBy("lang", "bin").agg(toxic, F.count("*").alias("n")).toPandas()
    shared.drop()
    positive, harmless = found["toxic"].to_numpy(np.float64), (found["n"] - found["toxic"]).to_numpy(np.float64)
    if not positive.sum() or not harmless.sum():
        return
    middle = (found["bin"].to_numpy(np.float64) + 0.5) * BIN
    y = np.repeat([1.0, 0.0], len(middle))
    net.scale = _platt(np.tile(middle, 2), y, np.concatenate([positive, harmless]))

    def cut(rows):
        at, place = np.unique(middle[rows], return_inverse=True)
        sums = [np.bincount(place, weights=v[rows]) for v in (positive, harmless)]
        return _threshold(net.probability(at), *sums)

    net.thresholds = {None: cut(np.ones(len(middle), dtype=bool))}
    for lang in found["lang"].dropna().unique():
        own = (found["lang"] == lang).to_numpy()
        if positive[own].sum() + harmless[own].sum() >= LEAST_OF_LANGUAGE and positive[own].sum() and harmless[own].sum():
            net.thresholds[lang] = cut(own)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> Network:
    """Fit on at most ``rows`` labelled documents of at most ``most_bytes`` bytes, those with the least hash of their id.

    ``docs`` has doc_id, text, lang; ``labels`` has doc_id and the label.  Rows without id, text or label are not used.
    Scale and thresholds come from all labelled documents of any length whose ids were not trained on.
    """
    order = F.xxhash64(F.lit(3), "doc_id")
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("_label")).na.drop()
    known = known.groupBy("doc_id").agg(F.max("_label").alias("_label"))
    sample = known.orderBy(order, "doc_id").limit(rows)
    texts = in_small_batches(docs).select("doc_id", F.col("text").alias("_text"), F.col("lang").cast("string").alias("lang"))
    texts = texts.filter("_text is not null")
    short = texts.filter(F.octet_length("_text") <= most_bytes)
    # Broadcast: the sample has at most ``rows`` rows of an id and a label.
    used = short.join(F.broadcast(sample), "doc_id").orderBy(order, "doc_id", F.xxhash64("_text")).limit(rows)
    kind = used.schema["doc_id"].dataType.simpleString()
    used = used.select("doc_id", "_text", "_label", "lang")
    # A task fits, so that the driver holds the net alone and never the sample.
    run = _fitted(used.select("doc_id").limit(0).toArrow().schema.field(0).type)
    found = used.coalesce(1).mapInArrow(run, f"net binary, trained array<{kind}>").toArrow()
    if found.num_rows:
        net, trained = cloudpickle.loads(found.column("net")[0].as_py()), found.column("trained")[0].as_py()
    else:  # no partition at all
        net, trained = fit([], np.zeros(0, np.float32), []), []
    del found
    give_back()
    trained = docs.sparkSession.createDataFrame([(i,) for i in trained], f"doc_id {kind}")
    # Broadcast: at most ``rows`` ids.
    calibrate(texts, known.join(F.broadcast(trained), "doc_id", "left_anti"), net)
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, score, threshold (of the row's language) and rejected for every row.

    Null and empty texts are scored as a text without words, unknown or null languages have the common threshold.
    Rows are handled one by one, so repeated rows and null ids stay as they are.
    """
    shared = Shared(docs.sparkSession, net)  # its size does not depend on the table

    def run(batches):
        model = shared.value
        for rows in (part for batch in batches for part in slices(batch, "_text", 1 << 19)):
            ids, counts = word_ids(encoded(rows.column("_text").to_pylist()))
            p = model.probability(model.logits(ids, counts).astype(np.float64))
            common = model.thresholds.get(None, 0.5)
            cut = np.array([model.thresholds.get(x, common) for x in rows.column("lang").to_pylist()])
            arrays = [rows.column("doc_id"), pa.array(p), pa.array(cut, pa.float64()), pa.array(p >= cut, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "score", "threshold", "rejected"])

    rows = in_small_batches(docs).select("doc_id", F.col("text").alias("_text"), F.col("lang").cast("string").alias("lang"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, threshold double, rejected boolean")


def clean(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    shared = Shared(docs.sparkSession, net)

    def run(batches):
        model = shared.value
        common = model.thresholds.get(None, 0.5)
        for rows in (part for batch in batches for part in slices(batch, "text", 1 << 19)):
            ids, counts = word_ids(encoded(rows.column("text").to_pylist()))
            p = model.probability(model.logits(ids, counts).astype(np.float64))
            cut = np.array([model.thresholds.get(x, common) for x in rows.column("lang").to_pylist()])
            yield rows.filter(pa.array(p < cut, pa.bool_()))

    return in_small_batches(docs).mapInArrow(run, docs.schema)
