"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.sources import paths

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app: str = "tradelake", master: str | None = None, **conf: str) -> SparkSession:
    """Build or get a session; `conf` keys use `__` for dots (`spark__ui__enabled="false"`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local-mode session may fall back to this machine's temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return f"{tempfile.gettempdir()}/tradelake-scratch"


def scratch_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder; it goes when the application ends."""
    path = f"{shared_dir(spark)}/scratch-{spark.sparkContext.applicationId}"
    paths.make_passing_dir(spark, path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the application's scratch folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write `df` once as Parquet in the shared folder and read it back.

    Later uses scan only the columns they need, the planner sees the true size, and the rows
    outlive lost executors. The caller removes the path when it is done with it; what a returned
    DataFrame still reads stays until the application ends.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`stage` for rows that nothing reads after the block."""
    rows, path = stage(df, label)
    try:
        yield rows
    finally:
        paths.remove(df.sparkSession, path)


def observed(seen: Observation) -> dict:
    """What an action observed; nothing where its input was known to be empty and the plan left the observation out."""
    try:
        return seen.get
    except Py4JJavaError as error:
        # The bindings take a row without columns for a mistake.
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, in a form whose size the planner knows."""
    return spark.range(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
