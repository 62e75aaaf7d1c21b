"""Sessions with the settings that the operators expect, and the shared tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "vellum", **conf: str) -> SparkSession:
    """A session in UTC with adaptive plans. Cluster settings come from outside; ``conf`` adds to them."""
    builder = SparkSession.builder.appName(app)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Where the setting is missing, as in tests, one is made."""
    have = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not have:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        have = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", have)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(have)
    return have.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Paths that the open scopes of ``scratch`` will delete.
_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``written`` wrote meanwhile, except tables that were to be kept. Results must be written out by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The same rows, written to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    if _scopes and not keep:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
