"""Sessions, and the folder shared by all executors."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import files

#: Settings of a session of our own; a cluster's session is used as it comes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests, tools and benches."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("paperloom")
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "8g"} | conf
    session = builder.config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def cluster_session(master: str, **conf: str) -> SparkSession:
    """A session on a cluster, whose executors get the package."""
    session = SparkSession.builder.master(master).appName("paperloom").config(map=DEFAULTS | conf).getOrCreate()
    ship(session)
    return session


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as spark.checkpoint.dir names it.

    Where the setting is absent (tests, a local session) a temporary folder is made once per session and set as the
    checkpoint folder. On a cluster the setting is never replaced.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir isn't set; name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="paperloom-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def spread(scan: DataFrame) -> DataFrame:
    """A scan of few row groups over all cores, for a stage that works harder than it reads.

    Only where a scan has fewer partitions than there are cores, thus of small tables; larger ones aren't shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in scan._jdf.queryExecution().executedPlan().toString():  # no mere scan; and to ask for its partitions would run it
        return scan
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


#: Settled tables by application.
_SETTLED: dict[str, list[str]] = {}


def settle(df: DataFrame, name: str = "table", by: list[str] | None = None) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder and reading it back.

    Parquet keeps only the columns and is compressed, so it takes a fraction of what ``checkpoint()`` does, and it
    outlives the loss of any executor. ``by`` partitions the files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _SETTLED.setdefault(spark.sparkContext.applicationId, []).append(path)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a settled table once a later one replaces it."""
    for file in df.inputFiles()[:1]:
        files.remove(os.path.dirname(file))


def clear(spark: SparkSession) -> None:
    """Remove the tables settled so far, once no result that reads them is wanted any more."""
    for path in _SETTLED.pop(spark.sparkContext.applicationId, []):
        files.remove(path)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Versions of a stored state that were written to their end, in order."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    found = [status.getPath() for status in files.listStatus(at) if status.isDirectory()]
    return sorted(str(p) for p in found if files.exists(p.suffix("/_SUCCESS")))


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The last version of a state, or None before the first."""
    versions = _folders(spark, path)
    return spark.read.parquet(versions[-1]) if versions else None


def store(state: DataFrame, path: str) -> DataFrame:
    """Write ``state`` as the next version beside those before it, which it may have been read from; it counts once it is whole."""
    spark = state.sparkSession
    versions = _folders(spark, path)
    number = int(versions[-1].rsplit("/", 1)[-1]) + 1 if versions else 0
    at = f"{path.rstrip('/')}/{number:08d}"
    state.write.mode("overwrite").parquet(at)  # over what a run that broke off may have left
    return spark.read.schema(state.schema).parquet(at)


def ship(spark: SparkSession) -> None:
    """Send the package to all executors by way of the shared folder, so that workers find it wherever they are started."""
    root, data = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.writestr(zipfile.ZipInfo(f"paperloom/{file.relative_to(root)}"), file.read_bytes())
    archive = f"{shared_folder(spark)}/paperloom-{hashlib.sha256(data.getvalue()).hexdigest()[:16]}.zip"
    files.write_bytes(archive, data.getvalue())
    spark.sparkContext.addPyFile(archive)
