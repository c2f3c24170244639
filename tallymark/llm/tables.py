"""What the operators share: reading tables, row keys, checkpoints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Column of the row key where all of a table's columns are carried along.
KEY = "_row_key"


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; only where none is set and the master is this machine (tests) a temporary folder is."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not folder:
            import tempfile

            folder = tempfile.mkdtemp(prefix="tallymark-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def delete(spark: SparkSession, folder: str) -> None:
    """Removes a folder of any file system that the session can write."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder, so that lost executors lose nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def row_key(columns: list[str]) -> Column:
    return F.xxhash64(*columns)


def scale(spark: SparkSession, df: DataFrame, per: int = 8 << 20) -> int:
    """Number of hash buckets: a part for each ``per`` bytes of the files below, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size_in_bytes(df) // per))


def size_in_bytes(df: DataFrame) -> int:
    """File bytes of the tables below the plan, by Catalyst's estimates; leaves of unknown size count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 55)


def join_counted(rows: DataFrame, table: DataFrame, key: str, total: int, share: int = 1000, small: int = 1_000_000) -> DataFrame:
    """rows joined with a table of one row for each ``key`` and ``n``, its number of rows (``total`` in all): the rows of a key that holds over 1 / share of
    all stay where they are. Such keys are under ``share``, so they are broadcast; all other keys are met by a shuffle. A table that can't have over ``small`` rows, as
    there are no more rows in all, is broadcast whole."""
    rest = [c for c in table.columns if c not in (key, "n")]
    if total <= small:
        return rows.join(F.broadcast(table.drop("n")), key).select(*rows.columns, *rest)
    hot = F.col("n") * share > total
    near = rows.join(F.broadcast(table.filter(hot).select(key, F.struct(*rest).alias("_hot"))), key, "left")
    return near.filter("_hot IS NOT NULL").select(*rows.columns, "_hot.*").unionByName(near.filter("_hot IS NULL").drop("_hot").join(table.filter(~hot).drop("n"), key).select(*rows.columns, *rest))


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished stages: it does so for plans that the JVM has collected."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
