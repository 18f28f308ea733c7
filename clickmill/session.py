"""Spark session settings and the folder for written intermediates."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # The keyed upsert looks for a batch's ids in the whole target: a Bloom filter of up to 64 MB
    # spares the shuffle of target rows that cannot match.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(64 * 8 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "64000000",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "clickmill", master: str | None = None, **conf: str) -> SparkSession:
    """Session for the jobs; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a temporary folder: on a cluster the executors that read
    an intermediate are not those that wrote it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="clickmill-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
