"""What the operators share: folders for written intermediates, folds, sizes of the cluster."""

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Operator = Callable[..., DataFrame]
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under `spark.checkpoint.dir`, which all executors share.

    Only a local session may leave the setting out (as tests do); it then gets a folder of its own.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        top = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession, rows: int = 2000, size: int = 8 << 20) -> None:
    """From now on rows go to and from Python in batches of at most so many rows and bytes, unless the
    session has a setting of its own.

    What a batch makes out of whole texts or sets is held several times over, on both sides; the default of
    10,000 rows and 64 MB does not suit tasks that share 3 GB.
    """
    for what, value in (("Records", rows), ("Bytes", size)):
        name = f"spark.sql.execution.arrow.max{what}PerBatch"
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, str(value))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and still there if an executor is lost."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """For the side of a join that grows with the input: it is never gathered in the driver to be sent to every
    task. Spark sends what its limit allows by compressed or estimated sizes; what the driver holds is many times that.
    """
    return df.hint("merge")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def partitions(spark: SparkSession) -> int:
    """How finely the cluster wants shuffles dealt out."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def clash_free(*own: str) -> Callable[[Operator], Operator]:
    """For an operator whose first argument is a frame that it carries along: columns of the frame with one of
    the operator's `own` names go by another name inside and get theirs back at the end."""

    def wrap(operator: Operator) -> Operator:
        @wraps(operator)
        def kept(docs: DataFrame, *args, **kwargs) -> DataFrame:
            clashing = [c for c in docs.columns if c.lower() in own]
            names = {c: f"carried_{i}_{uuid.uuid4().hex}" for i, c in enumerate(clashing)}
            if not names:
                return operator(docs, *args, **kwargs)
            out = operator(docs.withColumnsRenamed(names), *args, **kwargs)
            return out.withColumnsRenamed({name: c for c, name in names.items()})

        return kept

    return wrap


def schema_of(df: DataFrame, columns: str) -> T.StructType:
    """The columns of a frame, and more of them as DDL."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(columns).fields])
