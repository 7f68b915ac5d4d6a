"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from stationlake.fs import HadoopFS

# Settings the library relies on.  Time zone: partition hours are UTC wall
# clock; ANSI: a bad count in a feed or history file raises instead of
# becoming NULL; partition type inference off: "01" stays "01".
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Floor for AQE coalescing: hour-routed writes of small batches still
    # spread over several tasks; no effect once partitions are large.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "stationlake", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the library's settings.

    On a cluster ``master`` is left to spark-submit and shuffle partitions to
    AQE; tests pass ``local[*]`` and a small partition count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (a bare local session, as in tests) is a
    local folder created and registered; on a cluster the setting is read
    and never replaced.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="stationlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/stationlake/{label}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``stationlake`` importable in Python workers (``addPyFile``).

    Needed where a Python function of the library runs in tasks (pandas
    UDFs).  The zip goes to the shared checkpoint root, once per
    application; with ``--py-files`` set by the submitter this is a cheap
    no-op repeat.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    tmp = tempfile.mkdtemp(prefix="stationlake-zip-")
    archive = shutil.make_archive(os.path.join(tmp, "stationlake"), "zip",
                                  os.path.dirname(pkg), os.path.basename(pkg))
    target = f"{checkpoint_root(spark)}/stationlake/pkg-{uuid.uuid4().hex[:8]}/stationlake.zip"
    fs = HadoopFS(spark, target)
    fs.mkdirs(target.rsplit("/", 1)[0])
    jvm = spark.sparkContext._jvm
    fs._fs.copyFromLocalFile(False, True, jvm.org.apache.hadoop.fs.Path(archive), fs._p(target))
    spark.sparkContext.addPyFile(target)
    shutil.rmtree(tmp)
    _SHIPPED.add(app)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for tests that inspect local folders)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
