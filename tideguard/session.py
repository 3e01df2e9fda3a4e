"""Session settings, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tideguard", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: both come
    from spark-submit, and AQE coalesces the partitions to the data.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(STATE_STORE, ROCKS_DB)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def keep_state_on_disk(spark: SparkSession) -> None:
    """Stream state in RocksDB, which keyed state processors need; streams that run already keep what they have."""
    if spark.conf.get(STATE_STORE) != ROCKS_DB:
        spark.conf.set(STATE_STORE, ROCKS_DB)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back on a temporary folder: there the
    driver and the executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tideguard-")
    return _local_roots[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@dataclass
class Stored:
    """An intermediate table in the shared folder."""

    df: DataFrame
    path: str

    def discard(self) -> None:
        """Remove the files, once nothing lazy reads them any more."""
        spark = self.df.sparkSession
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def store(df: DataFrame, name: str, file_rows: int | None = None, codec: str | None = None) -> Stored:
    """Write ``df`` to the shared folder and read it back; at most ``file_rows`` rows in a file, if given.

    Cuts the lineage with something that survives a lost executor, and, unlike
    ``checkpoint()``, lets later reads prune columns.
    """
    path = fresh_path(df.sparkSession, name)
    limits = {"maxRecordsPerFile": file_rows} if file_rows else {}
    df.write.options(**limits).parquet(path, compression=codec)
    return Stored(df.sparkSession.read.schema(df.schema).parquet(path), path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``store`` for small tables that a lazy result goes on reading."""
    return store(df, name).df
