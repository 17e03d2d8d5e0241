"""Exact top-k inner-product search by a three-phase uniform threshold.

Dimensions are dealt to ``LISTS`` score lists; a total is the sum of its lists' parts.
1. Every cell (group of queries x lane of candidates) takes the best entries of each of its lists and
   totals them.  The k-th best total gathered for a query is a safe cutoff.
2. The cutoff goes to all cells of the query's group.  A total that reaches it has a part of at least
   cutoff / LISTS in some list, so only such entries are collected.
3. Their totals are resolved exactly, and the best k per cell and then per query stay.

Vectors are packed where they are read, in the fewest bytes that hold all components of a block.  A cell is a cogroup of
packed blocks of both sides, each of bounded size, and goes through its lists tile by tile, so the memory of a task does
not grow with the table.  No vector table passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weatherlake.llm.common import keep, shuffles_dropped

LISTS = 2
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 2048
COMPONENTS = 1 << 18  # of a block at most, or nearly, if it has more than one vector
GROUP, LANE = 128, 256  # blocks of queries and of candidates in a cell
LANES = 64  # so many lanes at least, if they have LEAST candidates each
LEAST = 1 << 14
TILE = 512  # queries that meet a block of candidates at once
PENDING = 1 << 18  # entries held before all but the best k of each query go
LARGEST = 2.0**62  # a component beyond this has no integer form here
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1
BLOCK = "dims int, number long, n int, width int, ids binary, parts binary"


def _whole(vectors: pa.ListArray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each length the positions and integer components floor(256 x) of the vectors that take part."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    x = np.floor(256.0 * vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))  # null becomes NaN
    good = np.isfinite(x) & (np.abs(x) < LARGEST)
    held = np.maximum(lengths, 0)
    starts = np.cumsum(held) - held
    out = []
    for dims in np.unique(lengths[lengths >= 0]).tolist():
        at = np.flatnonzero(lengths == dims)
        cells = starts[at][:, None] + np.arange(dims)
        fine = good[cells].all(axis=1)
        out.append((dims, at[fine], x[cells[fine]].astype(np.int64)))
    return out


def _fitting(vectors: int, dims: int) -> int:
    """So many vectors of a block, or fewer if they are long."""
    return max(1, min(vectors, COMPONENTS // max(dims, 1)))


def _packed(table, number: int, split: bool = True) -> pa.Table:
    """Blocks of vectors of one length, numbered from ``number``; one for each length unless they are split."""
    ids, vectors = (pa.concat_arrays(c.chunks or [pa.array([], c.type)]) if isinstance(c, pa.ChunkedArray) else c for c in map(table.column, ("vec_id", "vector")))
    known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
    names = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    rows = []
    for dims, at, whole in _whole(vectors):
        at, whole = at[known[at]], whole[known[at]]
        step = _fitting(CANDIDATE_BLOCK, dims) if split else max(1, len(at))
        for a in range(0, len(at), step):
            block = whole[a : a + step]
            width = next(w for w in (1, 2, 4, 8) if w == 8 or (np.abs(block) < 1 << (8 * w - 1)).all())
            rows.append((dims, number + len(rows), len(block), width, names[at[a : a + step]].tobytes(), block.astype(f"i{width}").tobytes()))
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.Table.from_arrays(arrays, ["dims", "number", "n", "width", "ids", "parts"])


def _pack_candidates(batches):
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() * 0x9E3779B1 & 0x7FFFFFFF  # blocks of a partition go to lanes in turn
    for batch in batches:
        table = _packed(batch, number)
        number += table.num_rows
        yield from table.to_batches()


def _pack_queries(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    packed = _packed(table, 0, split=False)
    return packed.set_column(1, "number", pa.array([key[0].as_py()] * packed.num_rows, pa.int64()))


def _vectors(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer components of each block, not copied."""
    facts = table.select(["n", "dims", "width"]).to_pylist()
    ids, parts = (table.column(c) for c in ("ids", "parts"))
    return [
        (np.frombuffer(i.as_buffer(), dtype=np.int64), np.frombuffer(p.as_buffer(), dtype=f"i{f['width']}").reshape(f["n"], f["dims"]))
        for f, i, p in zip(facts, ids, parts)
    ]


def _largest(parts: np.ndarray) -> float:
    """The largest size of a component; the least value of a type has none in its own type."""
    return max(float(parts.max(initial=0)), -float(parts.min(initial=0)))


def _kind(dims: int, q: float, c: float):
    """A type in which totals of components up to ``q`` and ``c`` are exact."""
    bound = q * c * max(dims, 1)
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object


def _lists(q: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    """Scores of every query and candidate in each list; exact in the type of ``q`` and ``c``."""
    edges = [q.shape[1] * j // LISTS for j in range(LISTS + 1)]
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(edges, edges[1:])]


def _own(qids: np.ndarray, cids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs in which a query meets its own id; queries ascend."""
    order = np.argsort(cids, kind="stable")
    low, high = (np.searchsorted(cids[order], qids, side=side) for side in ("left", "right"))
    who = np.repeat(np.arange(len(qids)), high - low)
    turn = np.arange(len(who)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    return who, order[low[who] + turn]


def _tiles(qids, q, cids, c):
    """List scores of some queries and all candidates, and the number of the first of these queries."""
    who, what = _own(qids, cids)
    for a in range(0, len(q), TILE):
        lists = _lists(q[a : a + TILE], c)
        x, y = np.searchsorted(who, [a, a + TILE])
        for part in lists:
            part[who[x:y] - a, what[x:y]] = -np.inf
        yield a, lists


def _ranked(who: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries in the order of ``who``: the different ones, for each entry its place among these, and its turn."""
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(who)), dtype=bool), who[1:] != who[:-1])))
    counts = np.diff(np.append(first, len(who)))
    return who[first], np.repeat(np.arange(len(first)), counts), np.arange(len(who)) - np.repeat(first, counts)


def _merged(top: np.ndarray, who: np.ndarray, values: np.ndarray) -> None:
    """Puts values of queries among the best ones of each, which ascend."""
    k = top.shape[1]
    order = np.lexsort((-values, who))
    some, place, turn = _ranked(who[order], k)
    best = turn < k
    fresh = np.full((len(some), k), -np.inf, dtype=top.dtype)
    fresh[place[best], turn[best]] = values[order][best]
    top[some] = np.sort(np.concatenate([top[some], fresh], axis=1), axis=1)[:, k:]


def _longs(values: np.ndarray) -> np.ndarray:
    """Scores beyond a long stop at its range; so does a missing one."""
    if values.dtype != object:
        return np.where(np.isfinite(values), values, float(LEAST_LONG)).astype(np.int64)
    return np.array([int(max(LEAST_LONG, min(MOST_LONG, x))) if x != -np.inf else LEAST_LONG for x in values.flat], dtype=np.int64).reshape(values.shape)


def _gathered(qids, q, blocks, k: int, kind) -> np.ndarray:
    """The k best totals of each query among the best entries of its lists; the least long where there are fewer."""
    q = q.astype(kind)
    tops = [np.full((len(q), k), -np.inf, dtype=kind) for _ in range(LISTS + 1)]  # of the lists, then of the totals
    for number, (cids, c) in enumerate(blocks):
        held = []
        for a, lists in _tiles(qids, q, cids, c.astype(kind)):
            found = np.zeros(lists[0].shape, dtype=bool)
            for part, top in zip(lists, tops):
                if number:
                    found |= part > top[a : a + TILE, :1]
                else:  # no entry below the k-th best of a few is one of the best
                    few = part[:, : 64 * k]
                    found |= part >= np.partition(few, -k, axis=1)[:, -k, None] if few.shape[1] >= k else part > -np.inf
            at = np.flatnonzero(found)
            held.append((at // len(cids) + a, [part.reshape(-1)[at] for part in lists]))
        who = np.concatenate([h[0] for h in held])
        parts = [np.concatenate([h[1][j] for h in held]) for j in range(LISTS)]
        for top, values in zip(tops, [*parts, sum(parts[1:], parts[0])]):
            _merged(top, who, values)
    return _longs(tops[-1])


def _resolved(qids, q, blocks, k: int, kind, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries, ids and totals of the best k entries that reach the cutoff."""
    q = q.astype(kind)
    low = np.where(cut == LEAST_LONG, -np.inf, cut.astype(object) if kind is object else cut.astype(np.float64)).astype(kind)
    need = np.where(cut == LEAST_LONG, -np.inf, (-(-cut.astype(object) // LISTS) if kind is object else np.ceil(cut / LISTS))).astype(kind)
    last, last_id = low.copy(), np.full(len(q), MOST_LONG)  # what an entry must not be worse than
    best, held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)), []

    def settled():
        who, ids, totals = (np.concatenate(x) for x in zip(best, *held))
        order = np.lexsort((ids, -totals, who))
        who, ids, totals = who[order], ids[order], totals[order]
        _, _, turn = _ranked(who, k)
        full = turn == k - 1
        last[who[full]], last_id[who[full]] = totals[full], ids[full]
        return who[turn < k], ids[turn < k], totals[turn < k]

    for cids, c in blocks:
        for a, lists in _tiles(qids, q, cids, c.astype(kind)):
            collected = lists[0] >= need[a : a + TILE, None]
            for part in lists[1:]:
                collected |= part >= need[a : a + TILE, None]
            at = np.flatnonzero(collected)
            total = lists[0].reshape(-1)[at]
            for part in lists[1:]:
                total = total + part.reshape(-1)[at]
            who, ids = at // len(cids) + a, cids[at % len(cids)]
            some = (total > last[who]) | (total == last[who]) & (ids <= last_id[who]) & (total != -np.inf)
            held.append((who[some], ids[some], total[some]))
            if sum(len(h[0]) for h in held) > PENDING:
                best, held = settled(), []
    who, ids, totals = settled()
    return who, ids, _longs(totals)


def _cells(k: int, cut: bool):
    """Phase 1 of a cell, or phases 2 and 3 where the queries bring their cutoffs."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = _vectors(right)
        most = max([0.0, *(_largest(c) for _, c in blocks)])
        out = []
        bare = left.drop_columns(["ids", "parts"]).to_pylist()
        for row, (qids, q) in zip(bare, _vectors(left)) if blocks else []:
            kind = _kind(row["dims"], _largest(q), most)
            if cut:
                who, ids, totals = _resolved(qids, q, blocks, k, kind, np.frombuffer(row["cuts"], dtype=np.int64))
                out.append(pa.table({"query_id": qids[who], "vec_id": ids, "score": totals}))
            else:
                out.append((row["dims"], row["number"], _gathered(qids, q, blocks, k, kind).tobytes()))
        if cut:
            return pa.concat_tables([pa.table({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")}), *out])
        kinds = {"dims": pa.int32(), "number": pa.int64(), "totals": pa.binary()}
        return pa.table({c: pa.array([r[i] for r in out], kind) for i, (c, kind) in enumerate(kinds.items())})

    return run


def _cutoffs(k: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        totals = [np.frombuffer(b, dtype=np.int64).reshape(-1, k) for b in table.column("totals").to_pylist()]
        best = totals[0]
        for other in totals[1:]:
            best = np.sort(np.concatenate([best, other], axis=1), axis=1)[:, -k:]
        return pa.table({
            "dims": pa.array([key[0].as_py()], pa.int32()), "number": pa.array([key[1].as_py()], pa.int64()),
            "cuts": pa.array([best.min(axis=1).tobytes()], pa.binary()),
        })

    return run


def top_k(
    df: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best inner products of each query among all other rows.

    Queries are the rows whose id ``every`` divides; components count as floor(256 x).  Ties go to the smaller
    vec_id; fewer than k candidates give fewer rows.  Vectors that are null or hold null, non-finite or (from
    2**62) unrepresentable components take no part, neither do rows without id.  Vectors meet those of equal length
    only.  Rows that repeat a query's id make one query (the least vector) and are no
    candidates of it; other repeated rows are candidates each.  Scores stop at the range of a long.
    """
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    packed = keep(rows.mapInArrow(_pack_candidates, BLOCK), "candidate-blocks")
    facts = packed.agg(F.sum("n").alias("n"), F.max("dims").alias("dims")).first()
    candidates, dims = facts["n"] or 0, facts["dims"] or 0
    asked = rows.filter(F.col("vec_id") % every == 0).filter("vector is not null")
    n_queries = rows.filter(F.col("vec_id") % every == 0).count()
    blocks = max(1, -(-n_queries // _fitting(QUERY_BLOCK, dims)))
    groups = -(-blocks // GROUP)
    lanes = max(1, -(-candidates // (LANE * _fitting(CANDIDATE_BLOCK, dims))), min(LANES, candidates // LEAST))
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = asked.withColumn("number", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long"))
    queries = keep(asked.groupBy("number").applyInArrow(_pack_queries, BLOCK), "query-blocks")

    def every_one(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    right = packed.withColumn("lane", F.pmod("number", F.lit(lanes)).cast("int")).withColumn("team", every_one(groups))
    cell = ["dims", "team", "lane"]

    def cells(blocks_of_queries: DataFrame, cut: bool, schema: str) -> DataFrame:
        left = blocks_of_queries.withColumn("team", F.pmod("number", F.lit(groups)).cast("int")).withColumn("lane", every_one(lanes))
        return left.groupBy(cell).cogroup(right.groupBy(cell)).applyInArrow(_cells(k, cut), schema)

    gathered = cells(queries, False, "dims int, number long, totals binary")
    with shuffles_dropped(df.sparkSession):  # the vectors shuffled for the first phase go before the second
        cutoffs = gathered.groupBy("dims", "number").applyInArrow(_cutoffs(k), "dims int, number long, cuts binary")
        cutoffs = keep(cutoffs, "cutoffs")
    found = cells(queries.join(cutoffs, ["dims", "number"]), True, "query_id long, vec_id long, score long")
    by_score = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
