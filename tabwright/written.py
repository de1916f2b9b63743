"""Tables written once into the folder that the cluster shares, so that later jobs neither repeat their work nor lose it with an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, as in tests, a new one on a local master; elsewhere an error."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    context = spark.sparkContext
    if not (context.master.startswith("local") and not context.master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _local_dirs.setdefault(context.applicationId, f"file://{tempfile.mkdtemp(prefix='checkpoints-')}")


def own_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one. The driver's JVM deletes it as it ends: results that are to stay have to be written elsewhere."""
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = f"{shared_dir(spark)}/tabwright-{app}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_dirs[app])
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
    return _own_dirs[app]


def cut(df: DataFrame) -> DataFrame:
    """Write a table and read it back."""
    path = f"{own_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
