"""Session settings, table access and lineage cuts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ONLY = "local"
_written: list[tuple[SparkSession, str]] = []


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give every Python worker of the session this package, once for each application.

    Functions that run on executors import it there; the workers' search path need not hold the repository.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="paperloom-code-")) / "paperloom.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a directory of parquet tables (a file or a directory of files each)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paperloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor reaches: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local master gets a temporary folder; any other master is refused, since a
    machine-local folder would break the first time another executor reads it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith(_LOCAL_ONLY + "[") and spark.sparkContext.master != _LOCAL_ONLY:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="paperloom-shared-")
    spark.conf.set("spark.checkpoint.dir", f"file://{base}")
    return f"file://{base}"


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, removed by ``cleanup``."""
    path = f"{shared_dir(spark)}/paperloom-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as parquet into the shared folder and read it back.

    The files survive the loss of executors; ``cleanup`` (also run at exit) removes them. The shuffles behind them are let
    go at once.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let the files of finished shuffles go before the next step writes its own: Spark deletes them once the driver has
    collected their plan, which a large heap puts off, so a collection is asked for."""
    spark._jvm.System.gc()


def cleanup() -> None:
    """Remove every table that ``materialize`` wrote."""
    while _written:
        spark, path = _written.pop()
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM is gone already
            return


atexit.register(cleanup)
