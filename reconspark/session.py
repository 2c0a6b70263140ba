"""Session factory and the settings every plan of this library relies on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "reconspark", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests, the bench and the command line; a cluster passes its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python once per application, so that it need not be installed there."""
    sc = spark.sparkContext
    if getattr(sc, "_reconspark_shipped", False):
        return
    package = Path(__file__).resolve().parent
    own = tempfile.mkdtemp(prefix="reconspark-")  # on the driver, which serves the archive until it ends
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(f"{own}/reconspark_package", "zip", package.parent, package.name))
    sc._reconspark_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in spark.checkpoint.dir.

    Only where it is unset (local tests) a temporary folder of this machine is set.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if "RECONSPARK_LOCAL_CHECKPOINTS" not in os.environ:
        os.environ["RECONSPARK_LOCAL_CHECKPOINTS"] = tempfile.mkdtemp(prefix="reconspark-")
        atexit.register(shutil.rmtree, os.environ["RECONSPARK_LOCAL_CHECKPOINTS"], ignore_errors=True)
    return os.environ["RECONSPARK_LOCAL_CHECKPOINTS"]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes a table into the shared folder and reads it again: lineage is cut and lost executors lose nothing.

    It stays until the application ends or discard() removes it.
    """
    place = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(place)
    atexit.register(_remove, df.sparkSession, place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like staged, but one file for each bucket of `key`, so that joins on it leave the table where it is.

    There are as many buckets as the session has shuffle partitions, which a cluster sets for its data.
    """
    spark = df.sparkSession
    named = f"{name}_{uuid.uuid4().hex}"
    place = f"{shared_dir(spark)}/{named}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).option("path", place).saveAsTable(named)
    atexit.register(_remove, spark, place)
    return spark.table(named)


def discard(df: DataFrame) -> None:
    """Removes the files of a staged or bucketed table that nothing will read again."""
    for place in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, place)


def _remove(spark: SparkSession, place: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has ended; the folder's owner clears it
        pass
