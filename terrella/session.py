"""Session settings and the shared folder for intermediate files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Runtime settings every plan of this library assumes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles methods above 8000 bytes; beyond that, splitting
    # the stage into smaller methods is several times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a running session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("terrella")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Executors on other machines must see it, so a temporary folder is only
    made up when the session runs inside a single JVM.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Folder of each application's scratch paths, by application and shared folder.
_SCRATCH: dict[tuple[str, str], str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application ends.

    All paths of an application lie in one folder. It is made before it is
    marked for removal, as Hadoop ignores marks on paths that do not exist.
    """
    context = spark.sparkContext
    key = (context.applicationId, shared_dir(spark))
    if key not in _SCRATCH:
        folder = f"{key[1]}/scratch-{uuid.uuid4().hex}"
        hadoop_path = context._jvm.org.apache.hadoop.fs.Path(folder)
        fs = hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())
        fs.mkdirs(hadoop_path)
        fs.deleteOnExit(hadoop_path)
        _SCRATCH[key] = folder
    return f"{_SCRATCH[key]}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point reliable checkpoints at the shared folder unless already set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
