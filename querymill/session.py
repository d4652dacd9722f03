"""What the library needs to know about the session it is given."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables that every executor can reach.

    This is the session's ``spark.checkpoint.dir``, else the folder given with
    ``setCheckpointDir``, else the warehouse, on every master.
    """
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, prefix: str) -> str:
    """A path under the shared folder that nothing has been written to yet.

    All paths of one application lie in one folder named after it, which can be
    removed as a whole once the application has ended.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{application}/{prefix}_{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Remove everything this application has put below the shared folder.

    For the end of a job: frames that still read from there can no longer be computed.
    """
    application = spark.sparkContext.applicationId
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/{application}"
    )
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, prefix: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    Lineage ends at the files, so a lost executor costs a re-read and not a
    recomputation, and a result used several times is computed once.
    """
    path = fresh_path(df.sparkSession, prefix)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Session settings for a job that reads about ``input_bytes`` on ``cores`` cores.

    Scan splits grow from 128 MiB to 1 GiB so that very large inputs do not turn
    into millions of tasks. Shuffles start with many partitions (one for each 256
    MiB of input, however many that makes) and adaptive execution merges the small ones
    and splits the hot ones.
    """
    split = min(max(input_bytes // max(cores * 16, 1), 128 * MIB), 1024 * MIB)
    shuffle = max(cores, input_bytes // (256 * MIB))
    smallest = min(max(input_bytes // (cores * 64), MIB // 16), 16 * MIB)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(smallest),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
