"""Mixing sources to target weights by Efraimidis-Spirakis sampling; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weatherlake.llm.common import WORD, keep, probe_join

SOURCE_WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
KEY_BINS = 1 << 12


def text_weight(text: Column, size: Column) -> Column:
    """Quality weight of a document: near 1 for ordinary word lengths, less for very short or long ones."""
    mean_chars = F.length(text) / F.greatest(size, F.lit(1))
    return 1.0 / (1.0 + F.abs(F.coalesce(mean_chars, F.lit(0.0)) - 6.0) / 4.0)


def uniform(doc_id: Column, seed: str = "mix") -> Column:
    """A repeatable draw in (0, 1) from the md5 of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Target of each source, from ``source`` and ``source_size``.

    Sources by code point (null last) weigh ``weights`` in turn.  With targets min(level * weight,
    most * size) the level at which they share the sum of all sizes is what repeated resharing of
    the excess ends in.  Sources are capped in order of most * size / weight, so prefix sums
    over that order find how many are.  The windows run over one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")).cast("long")
    ranked = sizes.withColumn("_w", weight).withColumn("_all", F.sum("source_size").over(W.partitionBy()))
    by_ratio = W.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    ranked = ranked.withColumn("_rest", F.col("_all") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    ranked = ranked.withColumn("_ws", F.sum("_w").over(after))
    # A source is capped when it would reach its cap with all before it capped as well.
    capped = F.col("_w") * F.col("_rest") >= most * F.col("source_size") * F.col("_ws")
    ranked = ranked.withColumn("_capped", capped)
    # The first source in that order that is not capped sets the level.
    ratio = (F.col("source_size") / F.col("_w")).alias("ratio")
    first = F.struct(ratio, F.col("source").isNull().alias("last"), "source", "_rest", "_ws")
    ranked = ranked.withColumn("_free", F.min(F.when(~F.col("_capped"), first)).over(W.partitionBy()))
    level = (F.col("_w") * F.col("_free._rest")).cast("double") / F.col("_free._ws").cast("double")
    target = F.when(F.col("_capped"), (most * F.col("source_size")).cast("double")).otherwise(level)
    return ranked.select("source", "source_size", target.alias("target"))


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=SOURCE_WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: str = "mix",
    bins: int = KEY_BINS,
) -> DataFrame:
    """How many words of each document a mix takes, so that sources come near their targets.

    doc_id, size, source_size, target, taken, source, copies (how often the document is taken) and text_hash.

    A source's target holds so many complete epochs of all its documents; for the rest documents are
    drawn without repetition by ascending key -ln(u) / weight (Efraimidis-Spirakis), and the
    sizes are prefix-summed up to the budget.  The document at the budget's edge is taken if that
    brings the total nearer to it.

    To keep a hot source out of one task, keys fall into ``bins`` ranges that are summed first.  Bins
    wholly below the budget are taken whole; only the one bin that holds the edge is put in order.

    Null text has size 0; a null source is a source of its own, last in order; a null id draws as
    empty text.  Rows with equal ids draw equal keys and are told apart by size and text.
    An empty table gives an empty result.  Other columns are left out.
    """
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("_text")
    )
    rows = rows.withColumn("size", F.coalesce(F.regexp_count("_text", F.lit(WORD)), F.lit(0)).cast("long"))
    rows = rows.withColumn("_key", -F.log(uniform(F.col("doc_id"), seed)) / text_weight(F.col("_text"), F.col("size")))
    # Keys of weight 1 are exponential, so this maps them to about equal bins; it rises with the key.
    rows = rows.withColumn("_bin", F.floor((1.0 - F.exp(-F.col("_key"))) * bins))
    rows = keep(rows.withColumn("_tie", F.xxhash64("_text")).drop("_text"), "mix")

    binned = rows.groupBy("source", "_bin").agg(F.sum("size").alias("_words"))
    targets = source_targets(binned.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("_epochs", epochs.cast("long"))
    targets = targets.withColumn("_budget", F.col("target") - F.col("_epochs") * F.col("source_size"))

    in_order = W.partitionBy("source").orderBy("_bin")
    below = F.coalesce(F.sum("_words").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edges = probe_join(binned.withColumn("_below", below), targets, ["source"])
    whole = F.col("_below") + F.col("_words") <= F.col("_budget")
    edges = edges.select(
        "source", "_bin", "_below", "source_size", "target", "_epochs", "_budget",
        F.when(whole, "all").when(F.col("_below") >= F.col("_budget"), "none").otherwise("edge").alias("_part"),
    )
    facts = probe_join(rows, edges, ["source", "_bin"])
    sure = facts.filter("_part <> 'edge'").withColumn("_in", (F.col("_part") == "all").cast("long"))
    by_key = W.partitionBy("source", "_bin").orderBy("_key", "doc_id", "size", "_tie")
    ahead = F.col("_below") + F.coalesce(F.sum("size").over(by_key.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edge = facts.filter("_part = 'edge'").withColumn("_ahead", ahead)
    near = F.col("_budget") - F.col("_ahead") > F.col("size") / 2
    edge = edge.withColumn("_in", near.cast("long")).drop("_ahead")
    return sure.unionByName(edge).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * (F.col("_epochs") + F.col("_in"))).alias("taken"), "source",
        (F.col("_epochs") + F.col("_in")).alias("copies"), F.col("_tie").alias("text_hash"),
    )
