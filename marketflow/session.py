"""Session settings and the shared scratch folder.

Jobs never pick a machine-local temporary folder on their own: derived tables,
stream checkpoints and lineage cuts go under the folder the cluster names in
``spark.checkpoint.dir``. Only when the session has none (local tests) is a
local one created and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library is tuned for. AQE re-plans joins from runtime sizes,
# splits skewed join partitions, and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app_name: str = "marketflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``checkpoint_dir`` is the folder all executors share (``spark.checkpoint.dir``);
    anything but a local master needs one.

    ``shuffle_partitions`` should follow the data volume: about one partition
    per 128-256 MB of shuffled data on a cluster, the core count locally.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_dir is not None:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


NO_SHARED_DIR = ("spark.checkpoint.dir is not set: name a folder that the driver and all executors share "
                 "(build_session(checkpoint_dir=...), or --checkpoint-dir on the command line)")


def _local_dir(master: str) -> str:
    """A temporary folder, for masters whose executors are this process only."""
    if master.split("[")[0] != "local":
        raise RuntimeError(NO_SHARED_DIR)
    return tempfile.mkdtemp(prefix="marketflow-ckpt-")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a derived table through the file system it lies in."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    fs, target = _fs(spark, path)
    if not fs.rename(target, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not rename {path}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if it does not exist."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written beside its place, then renamed."""
    fs, target = _fs(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), "." + target.getName() + "." + uuid.uuid4().hex[:8])
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"could not write {path}")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Where none is set, a local master
    gets a temporary one and any other master is an error: executors would write
    to disks that nothing else can read."""
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext handle (Spark Connect)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
        configured = sc.getConf().get("spark.checkpoint.dir", None) or _local_dir(sc.master)
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    raise RuntimeError(NO_SHARED_DIR)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one derived table."""
    return f"{shared_dir(spark)}/marketflow/{name}-{uuid.uuid4().hex[:12]}"
