"""Session construction and the few runtime helpers every module shares."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on. LAST_WIN makes map_concat an overlay operator.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "taxaloom", **extra: str) -> SparkSession:
    """A local session for tests, benches and the command line."""
    b = SparkSession.builder.master(master).appName(app).config("spark.sql.shuffle.partitions", shuffle_partitions)
    for k, v in {**CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that their Python can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).parent
    target = os.path.join(tempfile.mkdtemp(prefix="taxaloom-"), "taxaloom_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*")):
            if f.is_file() and "__pycache__" not in f.parts:
                z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def ensure(spark: SparkSession) -> SparkSession:
    """Set the runtime-settable options the plans depend on, on a session made elsewhere, and ship the package."""
    ship(spark)
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder of the session.

    The folder is spark.checkpoint.dir as the cluster names it. Only a local session that names none
    (a test) gets a temporary folder of this machine; on a cluster, where such a folder would differ by
    machine, a missing one raises.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "taxaloom-checkpoint"))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Split an input of fewer partitions than the cluster has cores, for work done in Python.

    Inputs that already have enough partitions (any large table) are returned as they are, so
    that nothing is shuffled at scale. Meant for scans and projections of them: counting the
    partitions of a plan with a shuffle would run that shuffle.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want * per_core) if df.rdd.getNumPartitions() < want else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
