"""Near-duplicate detection by BagMinHash, bands and verified multiset overlap.

A text is a bag of five-word shingles with multiplicities as weights.  Weights are cut into dyadic
blocks [0,1), [1,2), [2,4), ...; every shingle and block has a Poisson process of its own, seeded by both,
whose points carry a signature component and a place in the block.  Points at places beyond the weight
are thinned out.  The first point of each component is its signature value, and two bags agree in a component
with probability equal to their weighted Jaccard similarity.  Points are drawn in rising order and a
process ends where it passes the largest value still wanted, so long texts cost little more than one point a shingle.

Equal bags are folded into one node first.  Nodes that share a band are candidates; within a
bucket they are compared to its leaders, the member in most candidate pairs and one by chance.
Buckets that then still hold several components are opened up: with the most common member as
base, a pair's overlap is what both share with the base, at most the smaller of
the two shares, and what they share beyond it.  If neither is lighter than the base and they are not both linked to it,
the first part falls short of the threshold (a node not linked to the base B shares less than 4/9 of its own and B's
weight with it), so the pair must share a shingle beyond the base: nodes meet again by base and such a shingle, and of many
copies with edits of their own only those with common edits do.  Of those shingles, in a fixed order, a node shows as
many as leave less than the weight it needs.  Pairs with a node lighter than the base whose share
alone could suffice meet by the base.  A pair counts when its multiset overlap reaches the threshold.

Two exact bounds spare more comparisons: a pair's overlap is at most the smaller weight, and at most the weight of
those shingles of either node that any other candidate has at all.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weatherlake.functions.joins import lookup_join
from weatherlake.llm.common import in_small_batches, keep, probe_join
from weatherlake.llm.words import _mix, encoded, hashed_words, slices

SHINGLE = 5
BANDS, ROWS = 40, 5
SIMILARITY = (4, 5)  # overlap / union of at least 4/5
CHANCE_LEADERS = 1
_M = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle hash and multiplicity of the distinct shingles of all texts, ordered by both.

    A text of one to four words has one shingle, all its words; an empty text has none.
    """
    words, counts = hashed_words(texts)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    if not len(words):
        return owner, words, owner
    at = np.arange(len(words))
    rest = ends[owner] - at  # words left, this one included
    value = np.zeros(len(words), np.uint64)
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    for k in range(SHINGLE):
        value = value * _M + np.where(k < rest, padded[k : k + len(words)], np.uint64(k))
    first = at == (ends - counts)[owner]
    whole = (rest >= SHINGLE) | first
    owner, value = owner[whole], _mix(value[whole])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])))
    starts = np.flatnonzero(new)
    return owner[starts], value[starts], np.diff(np.append(starts, len(owner)))


def _uniform(key: np.ndarray, step: int, salt: int) -> np.ndarray:
    h = _mix(key + np.uint64((step * 4 + salt) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def signatures(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int, size: int) -> np.ndarray:
    """First points of each component, shape (texts, size); inf in rows of empty bags."""
    parts = []
    for block in range(int(count.max(initial=0)).bit_length() + 1):
        low, high = (0, 1) if block == 0 else (1 << (block - 1), 1 << block)
        has = count > low
        share = np.minimum((count[has] - low) / (high - low), 1.0)
        key = _mix(shingle[has] + np.uint64((block + 1) * int(_M) % (1 << 64)))
        parts.append((owner[has], key, np.full(len(key), float(high - low)), share))
    owner, key, rate, share = (np.concatenate(p) for p in zip(*parts))
    found = np.full(texts * size, np.inf)
    x, step = np.zeros(len(key)), 0
    while len(key):
        x = x - np.log(_uniform(key, step, 0)) / rate
        inside = _uniform(key, step, 1) < share
        component = (_uniform(key, step, 2) * size).astype(np.int64)
        np.minimum.at(found, (owner * size + component)[inside], x[inside])
        wanted = found.reshape(texts, size).max(axis=1)
        going = x < wanted[owner]
        owner, key, rate, share, x = owner[going], key[going], rate[going], share[going], x[going]
        step += 1
    return found.reshape(texts, size)


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit name per band, with the band's number mixed in."""
    bits = values.view(np.uint64).reshape(len(values), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(values), bands)).copy()
    for r in range(rows):
        key = _mix(key * _M + bits[:, :, r])
    return key.view(np.int64)


def _digests(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int) -> tuple[list[bytes], np.ndarray]:
    """A digest of each bag, and where it starts."""
    edges = np.searchsorted(owner, np.arange(texts + 1))
    names = [
        hashlib.blake2b(shingle[a:b].tobytes() + count[a:b].tobytes(), digest_size=16).digest()
        for a, b in zip(edges, edges[1:])
    ]
    return names, edges


def _named(batches):
    """node and text, once per slice."""
    for part in (p for batch in batches for p in slices(batch, "_text")):
        texts = part.column("_text").to_pylist()
        names, _ = _digests(*bags(encoded(texts)), len(texts))
        first = dict(zip(names, texts))
        yield pa.RecordBatch.from_arrays([pa.array(first.keys(), pa.binary()), pa.array(first.values(), pa.string())], ["node", "text"])


def _signed(bands: int, rows: int):
    def run(batches):
        for part in (p for batch in batches for p in slices(batch, "_text", 1 << 19)):
            texts = encoded(part.column("_text").to_pylist())
            owner, shingle, count = bags(texts)
            nodes, edges = _digests(owner, shingle, count, len(texts))
            keys = band_keys(signatures(owner, shingle, count, len(texts), bands * rows), bands, rows)
            filled = edges[1:] > edges[:-1]
            bounds = np.append(0, np.cumsum(filled) * bands)
            listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(keys[filled].reshape(-1)))
            weights = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
            arrays = [part.column("doc_id"), part.column("text_md5"), pa.array(nodes, pa.binary()), pa.array(weights), listed]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_md5", "node", "weight", "bands"])

    return run


class _Bags(OrderedDict):
    """Bags of the nodes met last."""

    def of(self, node: bytes, text: str) -> tuple[np.ndarray, np.ndarray]:
        if node not in self:
            if len(self) > 64:
                self.popitem(last=False)
            self[node] = bags(encoded([text]))[1:]
        return self[node]


def _verified(similarity: tuple[int, int]):
    num, den = similarity

    def run(batches):
        known = _Bags()
        for batch in (p for b in batches for p in slices(b, "_text_b")):
            keep_rows = []
            for row in batch.to_pylist():
                s1, c1 = known.of(row["a"], row["_text_a"])
                s2, c2 = known.of(row["b"], row["_text_b"])
                _, i, j = np.intersect1d(s1, s2, assume_unique=True, return_indices=True)
                shared = int(np.minimum(c1[i], c2[j]).sum())
                keep_rows.append(shared * den >= num * (int(c1.sum() + c2.sum()) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep_rows, pa.bool_()))

    return run


def _both_ways(edges: DataFrame) -> DataFrame:
    """node, other: every edge from both its ends; the edges are worked out once."""
    ways = [F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in (("a", "b"), ("b", "a"))]
    return edges.select(F.explode(F.array(*ways)).alias("_way")).select("_way.node", "_way.other").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of each connected component, for all nodes with an edge."""
    return _spread(keep(_both_ways(edges), "links"))


def _spread(both: DataFrame) -> DataFrame:
    """The components of a kept table of edges from both their ends.

    Labels spread to neighbours and then jump to their label's label; few rounds suffice.
    """
    labels = keep(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        near = lookup_join(both, theirs, ["other"]).groupBy("node").agg(F.min("theirs").alias("near"))
        best = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = lookup_join(best, jump, ["label"])
        moved = keep(moved.select("node", F.least("label", "further").alias("label"), "old"), "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The labels after further links: only the components that these touch are joined, each as one node."""
    if labels is None:
        return components(links)
    for side in ("a", "b"):
        links = probe_join(links, labels.select(F.col("node").alias(side), F.col("label").alias("_top")), [side], "left")
        links = links.withColumn(side, F.coalesce("_top", side)).drop("_top")
    both = keep(_both_ways(links.filter("a <> b")), "links")
    if both.isEmpty():
        return labels
    moved = _spread(both)
    tops = moved.select(F.col("node").alias("label"), F.col("label").alias("_top"))
    old = probe_join(labels, tops, ["label"], "left").select("node", F.coalesce("_top", "label").alias("label"))
    return keep(old.union(moved.join(labels, "node", "left_anti").select("node", "label")), "labels")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept, text_md5.

    Classes are the connected components of pairs whose weighted Jaccard similarity of five-word shingles is
    at least ``similarity``; the class id is its least doc_id, and that row is kept.  Words have A-Z
    lower-cased.  Null counts as empty; texts without words form one class.  Repeated rows are in one
    class, and of those with its id one is kept, by text digest; null ids lose to any other.  text_md5
    tells rows with equal ids apart.  Other columns are left out.
    """
    source = in_small_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_md5 string, node binary, weight long, bands array<long>"
    signed = source.withColumn("text_md5", F.md5(F.coalesce("_text", F.lit("")).cast("binary")))
    signed = keep(signed.mapInArrow(_signed(bands, rows), schema), "signatures")
    nodes = signed.groupBy("node").agg(F.first("bands").alias("bands"), F.first("weight").alias("weight"))
    spread = nodes.select("node", "weight", F.explode("bands").alias("key"))
    sizes = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = keep(lookup_join(spread, sizes, ["key"]), "buckets")  # key, node, weight, n
    # One text of each node that has a candidate; copies are dropped as soon as they meet.
    texts = source.select("_text").mapInArrow(_named, "node binary, text string")
    texts = keep(texts.join(shared.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "texts")
    own = probe_join(shared, _own_weights(texts), ["node"], "left")
    met = F.col("weight") - F.coalesce("own", F.lit(0))
    own = own.select("key", F.col("node"), "weight", "n", met.alias("met"))
    # Similarity to any other node is at most met / weight.
    shared = keep(own.filter(F.col("met") * similarity[1] >= F.col("weight") * similarity[0]), "buckets")
    labels = _linked(shared, texts, similarity)

    members = signed.groupBy("doc_id", "text_md5", "node").agg(F.count(F.lit(1)).alias("_copies"))
    members = members.withColumn("_node", F.col("node"))
    members = probe_join(members, labels, ["node"], "left").select(
        "doc_id", "text_md5", "_copies", F.coalesce("label", "_node").alias("label")
    )
    first = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_md5")
    groups = members.groupBy("label").agg(F.min(first).alias("_first"), F.sum("_copies").alias("class_size"))
    found = lookup_join(members, groups, ["label"]).withColumn("_this", first)
    found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    kept = F.col("_this").eqNullSafe(F.col("_first")) & (F.col("_copy") == 1)
    return found.select("doc_id", F.col("_first.doc_id").alias("class_id"), "class_size", kept.alias("kept"), "text_md5")


def _shingled(batches):
    """A long name of the node, shingle and multiplicity."""
    for part in (p for batch in batches for p in slices(batch, "text")):
        owner, shingle, count = bags(encoded(part.column("text").to_pylist()))
        names = np.array([int.from_bytes(n[:8], "big", signed=True) for n in part.column("node").to_pylist()], dtype=np.int64)
        arrays = [pa.array(names[owner]), pa.array(shingle.view(np.int64)), pa.array(count.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, ["name", "shingle", "times"])


def _own_weights(texts: DataFrame) -> DataFrame:
    """node, own: the weight of its shingles that no other candidate has."""
    shingles = texts.mapInArrow(_shingled, "name long, shingle long, times long")
    alone = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"), F.sum("times").alias("times"))
    own = alone.filter("n = 1").groupBy("name").agg(F.sum("times").alias("own"))
    # Nodes whose names collide go without, which only costs comparisons.
    name = F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long")
    names = texts.select("node", name.alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.first("node").alias("node"))
    return lookup_join(own, names.filter("n = 1"), ["name"]).select("node", "own")


def _beyond(similarity: tuple[int, int]):
    """What b shares with its base a, whether they are linked, and the shingles that b has beyond a."""
    num, den = similarity
    names = ["a", "b", "weight", "base", "light", "linked", "shingles", "extras"]

    def run(batches):
        known = _Bags()
        for batch in (p for b in batches for p in slices(b, "_text_b")):
            rows = []
            for row in batch.to_pylist():
                s1, c1 = known.of(row["a"], row["_text_a"])
                s2, c2 = known.of(row["b"], row["_text_b"])
                _, i, j = np.intersect1d(s1, s2, assume_unique=True, return_indices=True)
                extra = c2.copy()
                extra[j] -= np.minimum(c1[i], c2[j])
                lead, weight = int(c1.sum()), int(c2.sum())
                base = weight - int(extra.sum())
                more = np.flatnonzero(extra)
                linked = base * den >= num * (lead + weight - base)
                rows.append((row["a"], row["b"], weight, base, weight < lead, linked, s2[more].view(np.int64), extra[more].astype(np.int64)))
            kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return run


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = lookup_join(pairs, texts.select(F.col("node").alias(side), F.col("text").alias(f"_text_{side}")), [side])
    return pairs


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members of buckets that hold several components, with their labels."""
    plain = members.drop("label")
    if labels is None:
        return plain.withColumn("label", F.col("node"))
    members = probe_join(plain, labels, ["node"], "left").withColumn("label", F.coalesce("label", "node"))
    split = members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    return keep(lookup_join(members, split.filter("x <> y").select("key"), ["key"]), "open-buckets")


def _leaders(members: DataFrame, popular: DataFrame, chances: int = 0) -> DataFrame:
    """Of each bucket the member in most candidate pairs, and as many by chance as ``chances`` says, all in one shuffle."""
    ranks = [F.col("_popular"), *(F.xxhash64(F.lit(turn), "node") for turn in range(1, chances + 1))]
    fields = ("node", "weight", "base", "more", "label")
    best = [F.max(F.struct(rank.alias("rank"), *fields)).alias(f"_l{i}") for i, rank in enumerate(ranks)]
    chosen = lookup_join(members, popular, ["node"]).groupBy("key").agg(*best)
    each = [F.struct(*[F.col(f"_l{i}.{c}").alias(f"_{c}") for c in fields]) for i in range(len(ranks))]
    if not chances:
        return chosen.select("key", each[0].alias("_l")).select("key", "_l.*")
    return chosen.select("key", F.explode(F.array_distinct(F.array(*each))).alias("_l")).select("key", "_l.*")


def _pairs(members: DataFrame, others: DataFrame, similarity: tuple[int, int], *also) -> DataFrame:
    """Pairs of a bucket in different components whose bounds reach the threshold."""
    num, den = similarity
    pairs = lookup_join(members, others, ["key"]).filter(F.col("label") != F.col("_label"))
    most = F.least("base", "_base") + F.least("more", "_more")  # bounds the overlap
    pairs = pairs.filter(most * den >= (F.col("weight") + F.col("_weight") - most) * num)
    for condition in also:
        pairs = pairs.filter(condition)
    return pairs.select(F.least("_node", "node").alias("a"), F.greatest("_node", "node").alias("b")).distinct()


def _others(members: DataFrame) -> DataFrame:
    return members.select("key", *[F.col(c).alias(f"_{c}") for c in ("node", "weight", "base", "more", "label")])


def _opened(members: DataFrame, popular: DataFrame, texts: DataFrame, similarity: tuple[int, int]):
    """What the members of open buckets share with their base: verified links to it, members by base and shingle beyond it, and
    members by base whose share alone could reach the threshold."""
    num, den = similarity
    chosen = _leaders(members, popular).select("key", F.col("_node").alias("a"))
    met = lookup_join(members.select("key", F.col("node").alias("b")), chosen, ["key"]).select("a", "b").distinct()
    schema = "a binary, b binary, weight long, base long, light boolean, linked boolean, shingles array<long>, extras array<long>"
    found = keep(_with_texts(met, texts).mapInArrow(_beyond(similarity), schema), "beyond")
    rows = found.select(
        "a", F.col("b").alias("node"), "weight", "base", F.explode(F.arrays_zip("shingles", "extras")).alias("_s")
    ).select("a", "node", "weight", "base", F.col("_s.shingles").alias("shingle"), F.col("_s.extras").alias("extra"))
    common = rows.groupBy("a", "shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "shingle")
    rows = lookup_join(rows, common, ["a", "shingle"])
    whole = Window.partitionBy("a", "node")
    before = whole.orderBy("shingle").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("more", F.sum("extra").over(whole)).withColumn("before", F.coalesce(F.sum("extra").over(before), F.lit(0)))
    # Any partner shares at least this much beyond the base.
    need = F.greatest(F.lit(1), F.ceil(F.col("weight") * num / den).cast("long") - F.col("base"))
    shown = rows.filter((F.col("base") + F.col("more")) * den >= F.col("weight") * num).filter(F.col("more") - F.col("before") >= need)
    beyond = shown.select(F.xxhash64("a", "shingle").alias("key"), "node", "weight", "base", "more")
    alone = found.filter(F.col("base") * den >= F.col("weight") * num)
    alone = alone.select(F.xxhash64("a").alias("key"), F.col("b").alias("node"), "weight", "base", F.lit(0).cast("long").alias("more"), "light")
    return found.filter("linked and a <> b").select("a", "b"), keep(beyond, "beyond-buckets"), alone


def _linked(shared: DataFrame, texts: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Component labels of the nodes that have a verified link."""
    popular = shared.groupBy("node").agg(F.sum("n").alias("_popular"))
    buckets = shared.select("key", "node", "weight", F.col("met").alias("base"), F.lit(0).cast("long").alias("more"))
    labels = None

    def verified(pairs: DataFrame, known: DataFrame | None = None) -> DataFrame:
        links = _with_texts(pairs, texts).mapInArrow(_verified(similarity), "a binary, b binary")
        return _joined(labels, links if known is None else links.union(known))

    members = _labelled(buckets, labels)
    labels = verified(_pairs(members, _leaders(members, popular, CHANCE_LEADERS), similarity))
    members = _labelled(buckets, labels)
    if members.isEmpty():
        return labels
    links, beyond, alone = _opened(members, popular, texts, similarity)
    members = _labelled(beyond, labels)
    labels = verified(_pairs(members, _leaders(members, popular), similarity), links)
    # What is left is compared one by one.
    whole = beyond.withColumn("light", F.lit(None).cast("boolean")).unionByName(alone)
    members = _labelled(whole, labels)
    by_share = members.filter("light is null")
    by_base = members.filter("light is not null")
    pairs = _pairs(by_share, _others(by_share), similarity, F.col("_node") < F.col("node"))
    return verified(pairs.union(_pairs(by_base.filter("light"), _others(by_base), similarity)).distinct())
