"""Session helpers: local sessions for tests and benches, and settings read from whatever session is given."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("siltworks")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def session() -> SparkSession:
    """The active session, or that of spark-submit with whatever master it names; a local one only where neither is there."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    return SparkSession.builder.appName("siltworks").getOrCreate() if "PYSPARK_GATEWAY_PORT" in os.environ else local_session()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where none is set (tests on one machine)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="siltworks-")
    sc.setCheckpointDir(folder)
    return folder


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """df over at least as many partitions as there are cores: one small file would otherwise be one task."""
    want = least or max(2, df.sparkSession.sparkContext.defaultParallelism)
    return df if df.rdd.getNumPartitions() * 2 > want else df.repartition(want)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once for each application; they may start without its folder on their path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    home = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="siltworks-"), "siltworks.zip")  # on the driver, which serves it
    with zipfile.ZipFile(target, "w") as z:
        for root, _, names in os.walk(home):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.join("siltworks", os.path.relpath(full, home)))
    sc.addPyFile(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
