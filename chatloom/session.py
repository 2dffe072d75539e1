"""Session settings and the shared scratch folder."""

from __future__ import annotations

import itertools
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_serial = itertools.count()
# Of stored tables: ids that begin alike are a large part of them, and take half the space.
COMPRESSION = "zstd"
_scopes: list[list[str]] = []


def build_session(app_name: str = "chatloom", **settings: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``settings`` override them."""
    builder = SparkSession.builder.appName(app_name)
    defaults = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, private to this application.

    It lies in the folder that ``spark.checkpoint.dir`` names. A local session
    without that setting gets a temporary folder; a cluster must have it.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/chatloom-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="chatloom-")
    return _local_folders[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and return the written table.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{next(_serial)}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside are deleted at the end, also after an error."""
    written: list[str] = []
    _scopes.append(written)
    try:
        yield
    finally:
        _scopes.remove(written)
        for name in written:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
