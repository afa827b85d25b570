"""Session helpers: settings, the shared folder, settled tables and checked broadcasts."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side may be broadcast when an upper bound of its bytes is known and no larger than this.
BROADCAST_BYTES = 32 << 20

# Settings the plans rely on: run-time re-planning and splitting of hot join keys.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Without that setting a folder in the warehouse is taken.  A warehouse on a local disk is
    shared by a local session only; on a cluster it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local_path = warehouse.startswith("file:") or "://" not in warehouse
    if local_path and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{warehouse}/termloom-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has fixed contents, a short lineage that survives lost executors, and exact
    size statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Size(NamedTuple):
    """Upper bounds of a table: its rows and the bytes of its strings."""

    rows: int
    text_bytes: int = 0

    def times(self, n: int) -> Size:
        return Size(self.rows * n, self.text_bytes * n)

    def plus(self, other: Size) -> Size:
        return Size(self.rows + other.rows, self.text_bytes + other.text_bytes)


def measured(df: DataFrame) -> Size:
    """Size of a table by one pass over it."""
    texts = [F.octet_length(name) for name, kind in df.dtypes if kind == "string"]
    total = sum((F.coalesce(text, F.lit(0)) for text in texts), F.lit(0)).cast("bigint")
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(total), F.lit(0))).first()
    return Size(*row)


def bytes_of(df: DataFrame, size: Size) -> int:
    """Upper bound of the bytes of ``df``, a table without arrays that ``size`` bounds."""
    return size.rows * 16 * (len(df.columns) + 1) + size.text_bytes


def broadcast_if(df: DataFrame, size: Size) -> DataFrame:
    """Broadcast ``df``, a table without arrays, when ``size`` bounds it well enough."""
    return F.broadcast(df) if bytes_of(df, size) <= BROADCAST_BYTES else df


def spread(df: DataFrame) -> DataFrame:
    """Repartition a source that is read in fewer tasks than the cluster has cores.

    Only small inputs are; a large source has many splits and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def hold(df: DataFrame, name: str, value: Column, keep: list[str] | None = None) -> DataFrame:
    """Add column ``name``, computed once per row however often later columns use it.

    A plain projection may be copied into each place that reads it; a one-element explode is
    not.
    """
    columns = df.columns if keep is None else keep
    return df.select(*columns, F.explode(F.array(value)).alias(name))
