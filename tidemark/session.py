"""Session, table and stage helpers shared by every operator."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Temporary folders of local applications without a shared one.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where it is unset in a local session (tests) a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it has to name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        found = _OWN[app]
    return found.rstrip("/")


def _stages(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"


def drop_stages(spark: SparkSession) -> None:
    """Deletes the application's stages, once all results that rest on them are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_stages(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read and not a re-computation; columnar and
    compressed, hence far smaller than a checkpoint of rows. Stages are in a folder of the application, which
    drop_stages() deletes; a result that is still to be computed may read them.
    """
    spark = df.sparkSession
    path = f"{_stages(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stage_path = path
    return back


def unstage(*staged: DataFrame) -> None:
    """Deletes staged tables that nothing still to be computed reads."""
    for df in staged:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stage_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
