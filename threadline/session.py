"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_UNION_RULE = "spark.sql.unionOutputPartitioning"


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "threadline") -> SparkSession:
    """A session for tests, the bench and small jobs; a cluster passes its own."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(_UNION_RULE, "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a folder of its own, since there the
    driver is also the only executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="threadline-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never reused, so a retry cannot mix two runs."""
    return f"{shared_dir(spark)}/threadline/{name}-{uuid.uuid4().hex}"


def prepare(spark: SparkSession) -> None:
    """Settings results depend on, for a session built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(_UNION_RULE, "false")


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of the frames, columns matched by name and absent ones NULL.

    Spark 4.1 lets a union keep the partitioning its inputs share, and an aggregate
    above it then needs no shuffle. When one input becomes a reused exchange, the
    union runs as a plain one after all, equal keys stay in different partitions,
    and the aggregate returns them twice. That planning rule is switched off here.
    """
    frames[0].sparkSession.conf.set(_UNION_RULE, "false")
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint; keeps the output partitioning."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to a new shared folder and read it back: like ``materialize``, and the planner knows the size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    """The file system a path is on, and the path there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path on a file system that tasks can open by themselves, or None."""
    files, at = _place(spark, path)
    return at.toUri().getPath() if files.getUri().getScheme() == "file" else None


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all; for what the driver commits, not for data."""
    files, at = _place(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    out = files.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    files.delete(at, False)
    if not files.rename(draft, at):
        raise OSError(f"could not put {path} in place")


def read_text(spark: SparkSession, path: str) -> str:
    files, at = _place(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    files, at = _place(spark, folder)
    return [entry.getPath().getName() for entry in files.listStatus(at)] if files.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    files, at = _place(spark, path)
    files.delete(at, True)
