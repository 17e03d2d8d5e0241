"""Table profiling: counts, statistics, quantiles, samples and bag operations."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from weatherlake.functions.counting import Count

# Accuracy of the sketch that narrows an exact quantile.
SKETCH_ACCURACY = 10_000
# Ranges among the values near an exact quantile; one of them is ordered.
NEAR_PARTS = 256
# Size of a quantile sketch that is stored and merged, and bits of a distinct sketch (about 1.6 % error).
KLL_SIZE = 1000
HLL_BITS = 12


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def column_mean(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.mean(column).alias(f"mean_{column}"))


def group_stats(df: DataFrame, key: str, mean: Sequence[str] = (), largest: Sequence[str] = ()) -> DataFrame:
    measures = [F.mean(name).alias(f"mean_{name}") for name in mean]
    measures += [F.max(name).alias(f"max_{name}") for name in largest]
    return df.groupBy(key).agg(*measures)


def correlation(df: DataFrame, left: str, right: str) -> DataFrame:
    """Pearson correlation and sample covariance of two columns in one pass."""
    return df.agg(F.corr(left, right).alias("corr"), F.covar_samp(left, right).alias("covar_samp"))


def in_category(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == value)


def with_concat(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Concatenate columns as text; a NULL part makes the result NULL."""
    return df.withColumn(name, F.concat(*[F.col(column).cast("string") for column in columns]))


def widen(left: DataFrame, right: DataFrame, on: str, prefix: str = "right_") -> DataFrame:
    """Inner equi-join that puts the columns of both tables side by side; the non-key
    columns of the right table get a prefix so that no name is ambiguous."""
    renamed = right.withColumnsRenamed({name: f"{prefix}{name}" for name in right.columns if name != on})
    return left.join(renamed, on)


def describe_schema(df: DataFrame) -> DataFrame:
    """Name, type and nullability of every column, in column order."""
    rows = [
        (position, field.name, field.dataType.simpleString(), field.nullable)
        for position, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, "position INT, name STRING, type STRING, nullable BOOLEAN")


def full_summary(df: DataFrame) -> DataFrame:
    """summary and every column, as text: count, mean, stddev, min, quartiles and max of the whole table.

    Means, deviations and quartiles are those of numbers; a text column has none, even where some of its texts are numbers.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    ordered = [f.name for f in df.schema.fields if f.name not in numeric]
    numbers = df.select(*numeric).summary() if numeric else None
    texts = df.select(*[F.col(name).cast("string") for name in ordered]).summary("count", "min", "max") if ordered else None
    if numbers is None or texts is None:
        return numbers if texts is None else texts
    return numbers.join(texts, "summary", "left").select("summary", *df.columns)


def missing_by_column(df: DataFrame) -> DataFrame:
    """NULL count of every column from one scan, most missing first."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("column"), F.col(name).alias("missing")) for name in df.columns]
    )
    return counted.select(F.inline(pairs)).orderBy(F.desc("missing"), "column")


def rows_after_cleaning(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows without NULL in the required columns; NaN is a value."""
    return row_count(reduce(lambda kept, name: kept.filter(F.col(name).isNotNull()), required, df))


# --- quantiles --------------------------------------------------------------------------


def _numbers(df: DataFrame, column: str) -> DataFrame:
    values = df.select(F.col(column).cast("double").alias("v"))
    return values.filter(F.col("v").isNotNull() & ~F.isnan("v"))


def _ranks(probabilities: Sequence[float], quantiles: Sequence[Column]) -> Column:
    return F.array(
        *[F.struct(F.lit(float(p)).alias("probability"), q.alias("quantile")) for p, q in zip(probabilities, quantiles)]
    )


def approximate_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], error: float) -> DataFrame:
    """probability, quantile: quantiles within a relative rank error; error 0 means exact.

    The sketch holds about 1/error values; for error 0 it only narrows the search.
    """
    if error == 0:
        return exact_quantiles(df, column, probabilities)
    sketch = F.percentile_approx("v", list(map(float, probabilities)), math.ceil(1 / error))
    found = _numbers(df, column).agg(sketch.alias("q")).filter(F.col("q").isNotNull())
    return found.select(F.inline(_ranks(probabilities, [F.col("q")[i] for i in range(len(probabilities))])))


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """probability, quantile: the value at rank ceil(p * rows); values are compared as doubles.

    Three scans.  A sketch encloses every wanted rank.  A second scan counts the rows below each enclosure, and those
    inside (about 4/``SKETCH_ACCURACY`` of the rows) in ``NEAR_PARTS`` ranges of equal width; carrying the counts from range to
    range tells which range holds the rank.  The last scan, which is the result's own plan, orders the distinct values
    of that range.  What the first two find (a few numbers per probability and range) is fetched when
    this function is called.
    """
    values = _numbers(df, column)
    step = 2 / SKETCH_ACCURACY
    around = [min(max(p + shift, 0.0), 1.0) for p in probabilities for shift in (-step, step)]
    sketch = F.percentile_approx("v", around, SKETCH_ACCURACY).alias("b")
    found = values.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), sketch).first()
    asked = "probability double, quantile double"
    if not found.n:
        return df.sparkSession.createDataFrame([], asked)
    edges = [  # the search is open towards an end of the table
        (found.low if p - step <= 0 else found.b[2 * i], found.high if p + step >= 1 else found.b[2 * i + 1])
        for i, p in enumerate(probabilities)
    ]

    def place(low: float, high: float) -> Column:
        """Range of a value, never falling from one value to a greater one, infinite ones included."""
        share = F.try_divide(F.col("v") - F.lit(low), F.lit(high) - F.lit(low))
        inner = F.when(F.isnan(share) | share.isNull(), 0.0).otherwise(share)
        return F.when(F.col("v") >= high, NEAR_PARTS).otherwise(F.floor(inner * NEAR_PARTS)).cast("int")

    def hits(i: int, *also: Column) -> Column:
        low, high = edges[i]
        inside = reduce(lambda x, y: x & y, also, F.col("v").between(low, high))
        return F.when(inside, F.struct(F.lit(i).alias("i"), place(low, high).alias("part")))

    indexes = range(len(probabilities))
    below = Count(values, *[F.count_if(F.col("v") < edges[i][0]).alias(str(i)) for i in indexes])
    near = below.rows.select(F.inline(F.array_compact(F.array(*[hits(i) for i in indexes]))))
    counts = {(row.i, row.part): row.n for row in near.groupBy("i", "part").agg(F.count("*").alias("n")).collect()}
    ahead = below.get()
    holding = []  # rank number, its range, and its rank inside the range
    for i, p in enumerate(probabilities):
        rank, part = max(1, math.ceil(p * found.n)) - ahead[str(i)], 0
        while rank > counts.get((i, part), 0):
            rank, part = rank - counts.get((i, part), 0), part + 1
        holding.append((part, rank))

    chosen = [hits(i, place(*edges[i]) == part) for i, (part, _) in enumerate(holding)]
    distinct = values.select("v", F.inline(F.array_compact(F.array(*chosen)))).groupBy("i", "v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("v"))
    wanted = F.element_at(F.array(*[F.lit(rank) for _, rank in holding]), F.col("i") + 1)
    reached = distinct.withColumn("upto", upto).filter(F.col("upto") >= wanted)
    probability = F.element_at(F.array(*[F.lit(float(p)) for p in probabilities]), F.col("i") + 1)
    return reached.groupBy("i").agg(F.min("v").alias("quantile")).select(probability.alias("probability"), "quantile")


# --- sketches that merge ----------------------------------------------------------------


def quantile_sketches(df: DataFrame, column: str, *by: Column | str, size: int = KLL_SIZE) -> DataFrame:
    """One quantile sketch of a column per group, say per day: a few KB each, to be stored and merged later."""
    numbers = df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    sketch = F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(size))
    return numbers.groupBy(*by).agg(sketch.alias("sketch"))


def merged_quantiles(sketches: DataFrame, probabilities: Sequence[float], *by: Column | str) -> DataFrame:
    """probability, quantile (and groups): quantiles of any union of the sketched groups, without their rows.

    The rank error is about 2/``size`` of the sketches; merging adds none.
    """
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    names = merged.columns[:-1]
    wanted = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probabilities]
    return merged.filter(F.kll_sketch_get_n_double("sketch") > 0).select(*names, F.inline(_ranks(probabilities, wanted)))


def sketched_rank_errors(
    df: DataFrame, column: str, probabilities: Sequence[float], error: float, *by: Column | str
) -> DataFrame:
    """Whether each quantile from merged group sketches lies within its rank error, give or take one row."""
    found = merged_quantiles(quantile_sketches(df, column, *by), probabilities)
    quantiles = found.agg(F.map_from_entries(F.collect_list(F.struct("probability", "quantile"))).alias("m")).select("m").scalar()
    return _within(_numbers(df, column), probabilities, [F.element_at(quantiles, F.lit(float(p))) for p in probabilities], error)


def distinct_sketches(df: DataFrame, column: str, *by: Column | str) -> DataFrame:
    """One sketch of the distinct values of a column per group; sketches of several groups merge."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(HLL_BITS)).alias("sketch"))


def merged_distinct(sketches: DataFrame, *by: Column | str, name: str = "n_distinct") -> DataFrame:
    """Estimated distinct values in any union of the sketched groups; values in several groups count once."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def quantile_rows(df: DataFrame, column: str, probabilities: Sequence[float], errors: Sequence[float]) -> DataFrame:
    """One row per error and probability; no rows if there are no values."""
    parts = [
        approximate_quantiles(df, column, probabilities, error).select(F.lit(float(error)).alias("relative_error"), "*")
        for error in errors
    ]
    return reduce(DataFrame.union, parts)


def rank_errors(df: DataFrame, column: str, probabilities: Sequence[float], error: float) -> DataFrame:
    """Whether each approximate quantile lies within its rank error, give or take one row."""
    values = _numbers(df, column)
    sketch = F.percentile_approx("v", list(map(float, probabilities)), math.ceil(1 / error))
    found = values.agg(sketch.alias("q"))
    return _within(values, probabilities, [found.select(F.col("q")[i]).scalar() for i in range(len(probabilities))], error)


def _within(values: DataFrame, probabilities: Sequence[float], quantiles: Sequence[Column], error: float) -> DataFrame:
    """Count the rows below and up to each quantile, and compare with the rank it stands for."""
    indexes = range(len(probabilities))
    counted = values.agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("v") < quantiles[i]).alias(f"less{i}") for i in indexes],
        *[F.count_if(F.col("v") <= quantiles[i]).alias(f"upto{i}") for i in indexes],
    )
    slack = error * F.col("n") + 1
    within = [
        (F.col(f"less{i}") <= float(p) * F.col("n") + slack) & (F.col(f"upto{i}") >= float(p) * F.col("n") - slack)
        for i, p in enumerate(probabilities)
    ]
    rows = F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), ok.alias("within_error")) for p, ok in zip(probabilities, within)
    ])
    return counted.select(F.lit(float(error)).alias("relative_error"), F.inline(rows))


# --- samples and bags -------------------------------------------------------------------


def sample_rows(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def sample_by_key(df: DataFrame, key: str, percent: int = 1) -> DataFrame:
    """Rows whose key hashes into the first ``percent`` of 100 parts; the same rows every time."""
    part = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 6), 16, 10).cast("int") % 100
    return df.filter(part < percent)


def union_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right)


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` minus rows of ``right``, copies counted."""
    return left.exceptAll(right)
