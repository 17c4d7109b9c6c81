"""Session helpers: local session for tests/bench and a cluster-safe checkpoint dir."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tabularis") -> SparkSession:
    """Local session used by tests and bench. On a cluster, build the session outside."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TABULARIS_DRIVER_MEMORY", "16g"))
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tabularis-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application.

    Workers then import the UDF modules wherever the driver was started from.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tabularis_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tabularis-code-"), "tabularis.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._tabularis_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir`` and make it the checkpoint dir.

    A local master without the setting (tests, the driver's smoke check) gets a scratch folder;
    a cluster without it raises, because a machine-local folder would not reach the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="tabularis-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to as many tasks as a shuffle has.

    A table of a few files (or row groups) is read by a few tasks; costly work on its rows would stay in them.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    The plan that made it runs once; a lost executor costs only the tasks that read the files.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
