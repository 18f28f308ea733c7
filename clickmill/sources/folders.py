"""Folders of the file system that a path names, through Hadoop's own client."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def hadoop_path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system and from its root."""
    hadoop, fs = hadoop_path(spark, path)
    return fs.makeQualified(hadoop).toString()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = hadoop_path(spark, path)
    return fs.exists(hadoop)


def drop(spark: SparkSession, path: str) -> None:
    hadoop, fs = hadoop_path(spark, path)
    fs.delete(hadoop, True)


def children(spark: SparkSession, path: str) -> list[str]:
    hadoop, fs = hadoop_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hadoop)]


def write_partitions(
    df: DataFrame, path: str, keys: Sequence[str], sort: Sequence[str], replace: str
) -> None:
    """Write by folders of `keys`, in full-size files; `replace` is `partitions` or `all`.

    Event ids hardly repeat, so no dictionary of them is tried.
    """
    out = df.hint("rebalance", *keys)
    if sort:
        out = out.sortWithinPartitions(*keys, *sort)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
        .option("parquet.enable.dictionary#event_id", "false")
        .partitionBy(*keys)
        .parquet(path)
    )


def require_marker(spark: SparkSession, folder: str) -> None:
    """Without the marker of a complete write a staged table would be dropped unseen."""
    if not exists(spark, f"{folder}/_SUCCESS"):
        raise OSError("staged writes need mapreduce.fileoutputcommitter.marksuccessfuljobs")
