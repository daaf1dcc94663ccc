"""Session helpers: where intermediate tables go, and how table paths are read."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is the cluster's ``spark.checkpoint.dir``. Only on a single machine (a ``local`` master, as in tests) is a
    temporary folder made where that is unset; on a cluster executors would each write to a disk of their own, so there it is an error.
    """
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="brightledger-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        known = "file://" + own
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` as a table written once to the shared folder and read again.

    Used where a result has several readers: the lineage ends here, so a lost executor costs a read of
    the files and not the whole computation. The driver's file system deletes the files when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, or with underscores before it until no column has that name (in any letter case)."""
    low = {x.lower() for x in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def spread(df: DataFrame, most: int = 512 << 20) -> DataFrame:
    """``df`` over all cores, if it is small (``most`` bytes by Spark's estimate) and in fewer files than there are cores.

    Work per row that is heavy then does not wait for one task that reads one file. Larger inputs stay as they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    try:
        files = len(df.inputFiles())
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001  no estimate to be had: leave it
        return df
    return df.repartition(cores) if 0 < files < cores and size <= most else df


def fanned(df: DataFrame) -> DataFrame:
    """``df``, a result of few bytes but heavy work per row, in as many parts as a shuffle has or there are cores.

    Adaptive execution sizes parts by bytes and would leave such work to one task.
    """
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
