"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

from pyspark.sql import SparkSession

_SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "corpuskit", extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[N]`` and a small shuffle-partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_SESSION_DEFAULTS)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.corpuskit.recordPartitions", str(shuffle_partitions or 8))
        conf.setdefault("spark.driver.memory", os.environ.get("CORPUSKIT_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Where it is unset, a folder inside the session's
    warehouse is used. On a cluster a warehouse on local disk is no shared folder, so
    there the setting must be given.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else \
            spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        local = spark.sparkContext.master.startswith("local")
        if not jdir.isDefined() and not local and root.split(":", 1)[0] in ("file", root):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers (once per application).

    It goes as a zip in the shared folder, so no path has to be set on any machine.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(home):  # already run from such a zip
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(home)):
            for name in sorted(names):
                if name.endswith((".py", ".json")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("corpuskit", os.path.relpath(full, home)))
    path = staging_path(spark, "code", unique=True) + "/corpuskit.zip"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(jpath)
    out.write(bytearray(packed.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def staging_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder for staged tables and exports."""
    root = checkpoint_root(spark)
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([root, "corpuskit", *tail])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works for any scheme."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def materialize(df, name: str = "table"):
    """Write ``df`` as parquet below the shared checkpoint folder and read it back.

    Cuts lineage *and* the optimizer's memory of the producing plan (a plain file
    scan), which keeps iterative loops at constant planning cost per round. The
    folder is shared storage, so a lost executor never loses the table.
    """
    path = staging_path(df.sparkSession, "tables", name, unique=True)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_materialized(*frames) -> None:
    """Delete tables written by :func:`materialize` that no frame in use reads any more."""
    for df in frames:
        spark = df.sparkSession
        own = staging_path(spark, "tables")
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if own.split(":", 1)[-1].lstrip("/") in path:
                jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)
