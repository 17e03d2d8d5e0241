"""Reading the tables, intermediate tables in the shared folder, and column helpers."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weatherlake.session import checkpoint_root

# Characters that separate words; every operator that counts words uses this pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    This cuts the lineage: a lost executor costs the running tasks only, and what several
    jobs need is not computed again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a table that ``keep`` wrote and nothing reads again."""
    spark = df.sparkSession
    for name in {f.split("/")[-2] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark), name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query go when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def in_small_batches(df: DataFrame) -> DataFrame:
    """The table, with the session set to send rows to Python in small batches.

    Spark's default of 10,000 rows a batch is gigabytes where texts are long.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return df


class Shared:
    """A broadcast object whose class travels with it, so that executors need no copy of this package."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self):
        return {"_sent": self._sent}

    @property
    def value(self):
        if "_value" not in self.__dict__:
            self._value = cloudpickle.loads(self._sent.value)
        return self._value

    def drop(self) -> None:
        """Free it on driver and executors; a task that still asks for it fetches it again."""
        self._sent.unpersist()


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the decimal doc_id modulo ``folds``; a missing id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def probe_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join of a large table with a table of one row per key.

    The hash as the first key keeps a shuffle of its own for this join on both sides, which is
    what lets AQE split a hot key over tasks.
    """
    hashed = F.xxhash64(*keys)
    right = lookup.withColumnsRenamed({k: f"_r_{k}" for k in keys}).withColumn(
        "_r_probe", F.xxhash64(*[F.col(f"_r_{k}") for k in keys])
    )
    same = F.col("_probe") == F.col("_r_probe")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    joined = facts.withColumn("_probe", hashed).join(right, same, how)
    return joined.drop("_probe", "_r_probe", *[f"_r_{k}" for k in keys])
