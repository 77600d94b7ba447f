"""Session helpers: local session for tests and benches, shared scratch folder, size-checked sides."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only when its row count has been seen to be at most this.
BROADCAST_ROWS = 200_000


def local_session(cpus: int = 8, memory: str = "16g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("terrafold")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the checkpoint folder of the context, which
    ``spark.checkpoint.dir`` names unless somebody has called ``setCheckpointDir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="terrafold-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_HANDED_OUT: list[tuple[str, str]] = []  # (application, path) of what has been written below the shared folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _HANDED_OUT.append((spark.sparkContext.applicationId, path))
    return path


def release(spark: SparkSession) -> int:
    """Delete the tables and checkpoints that this library has written below the shared folder for this application; the
    number of paths.

    Frames that still read them fail afterwards, so call it when results are stored.
    """
    own = [p for a, p in _HANDED_OUT if a == spark.sparkContext.applicationId]
    jvm = spark.sparkContext._jvm
    for path in own:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _HANDED_OUT[:] = [x for x in _HANDED_OUT if x[0] != spark.sparkContext.applicationId]
    return len(own)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    held = df.checkpoint(eager=True)
    place = held._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if place.isDefined():
        _HANDED_OUT.append((df.sparkSession.sparkContext.applicationId, place.get()))
    return held


def lookup_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Ready a narrow lookup frame for a join with a big one.

    The frame is computed once and its rows are counted: few rows are broadcast, more are left to a
    shuffle join, where adaptive execution splits hot keys.
    """
    fixed = cut_lineage(df)
    return F.broadcast(fixed) if fixed.count() <= max_rows else fixed
