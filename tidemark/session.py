"""Session defaults and durable intermediate results."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed streaming state outgrows the heap long before it outgrows local disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the one that the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder, which goes with the process;
    a cluster without it is an error, because a machine-local folder would be lost with its
    machine.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        if sc.applicationId not in _local_folders:
            folder = tempfile.TemporaryDirectory(prefix="tidemark-", ignore_cleanup_errors=True)
            atexit.register(folder.cleanup)
            _local_folders[sc.applicationId] = folder.name
        named = _local_folders[sc.applicationId]
    return f"{named}/tidemark-{sc.applicationId}"


def scratch(spark: SparkSession) -> str:
    """A new name for a table or a stream's checkpoint in the shared folder."""
    return f"{scratch_root(spark)}/table-{uuid.uuid4()}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, when nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows to a table in the shared folder and read them back.

    A written table survives lost executors and, unlike a checkpointed plan, comes
    back with its real size, which the planner needs in loops.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
