"""Tables and files in the folder that the cluster's machines share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_registered = False


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset on one machine, a temporary one (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="orbitframe-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _remove(first: int = 0) -> None:
    gone, _written[first:] = _written[first:], []
    for spark, path in gone:
        try:
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the session is gone; the folder's owner cleans it
            return


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's Python ends."""
    global _registered
    if not _registered:
        atexit.register(_remove)
        _registered = True
    path = f"{shared_dir(spark)}/orbitframe-{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives lost executors."""
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """make()'s rows as a table in the shared folder; the tables that make() wrote on its way are removed."""
    first = len(_written)
    made = written(spark, make(), name)
    kept = _written.pop()
    _remove(first)
    _written.append(kept)
    return made
