"""Session set-up and the shared folder that written tables live in."""

from __future__ import annotations

import json
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the skew splitting and the broadcast choice: a join
# side is broadcast only when its measured size is below the threshold.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("payerscope")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# The JVM never compiles a method of more bytecode than this; Spark's own limit is 65535, so a wide projection that it
# generates as one method would be interpreted row by row.
COMPILED_METHOD = {"spark.sql.codegen.hugeMethodLimit": ("65535", "8000")}


def compiled_methods(spark: SparkSession) -> None:
    """Have projections that are too large for the JVM's compiler generated in smaller methods, unless the session says otherwise."""
    for key, (default, limit) in COMPILED_METHOD.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, limit)


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables: ``spark.checkpoint.dir``.

    A temporary folder is used only for a local master that names none; on a
    cluster a machine-local folder would be lost with its executor, so a missing
    setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="payerscope-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


_owner: ContextVar[str | None] = ContextVar("folder of the run that owns what is written now", default=None)


def new_folder(spark: SparkSession, kind: str = "run") -> str:
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


@contextmanager
def owned_by(folder: str) -> Iterator[None]:
    """Tables that ``write_shared`` writes meanwhile go to this folder, to be removed with it."""
    token = _owner.set(folder)
    try:
        yield
    finally:
        _owner.reset(token)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables of a run; it is removed at the end, whether the run succeeds or fails."""
    folder = new_folder(spark)
    try:
        with owned_by(folder):
            yield folder
    finally:
        remove_path(spark, folder)


SMALL_FILES = "zstd"
# Seconds that a table takes to write before the driver looks for shuffle files that can go.
LONG_WRITE = 5.0


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """After a long write, have the files of shuffles that nothing can read any more removed.

    Spark removes them when the driver collects its garbage, which on a large heap is long after: until then the
    shuffles of every table that was written lie on the executors' disks beside the tables.
    """
    began = time.monotonic()
    yield
    if time.monotonic() - began > LONG_WRITE:
        for _ in range(2):  # what the first one lets go holds the shuffles of the write itself
            spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)


def write_shared(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder, or the folder of the current owner, and read it back.

    This cuts the lineage: whatever runs later starts from files that survive the
    loss of executors, and never re-runs the joins that led here. ``compression`` is for tables as long as
    the claims; others are written as the session says. What a long write has shuffled is let go.
    """
    spark = df.sparkSession
    path = f"{_owner.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with releasing(spark):
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def inline_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small fixed table as literal rows in the plan.

    Its exact size is known to the optimizer, which broadcasts it by the usual
    size check; rows from a Python list would have an unknown size.
    """
    def literal(value) -> str:
        return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else repr(value)

    names = ", ".join(column.split()[0] for column in schema.split(", "))
    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    typed = [f"CAST({c.split()[0]} AS {c.split(maxsplit=1)[1]}) AS {c.split()[0]}" for c in schema.split(", ")]
    return spark.sql(f"SELECT {', '.join(typed)} FROM VALUES {values} AS t({names})")


def _store(spark: SparkSession, path: str):
    """The Hadoop path and the store that it lies in."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, store = _store(spark, path)
    return store.exists(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    hadoop_path, store = _store(spark, path)
    store.delete(hadoop_path, True)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    hadoop_path, store = _store(spark, folder)
    return sorted(f.getPath().getName() for f in store.listStatus(hadoop_path)) if store.exists(hadoop_path) else []


def read_json(spark: SparkSession, path: str):
    """The content of a small JSON file, None if there is none."""
    hadoop_path, store = _store(spark, path)
    if not store.exists(hadoop_path):
        return None
    stream = store.open(hadoop_path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def replace_json(spark: SparkSession, path: str, content) -> None:
    """Put a small JSON file in the place of another in one step: readers see the old one or the new one."""
    jvm = spark.sparkContext._jvm
    staged, store = _store(spark, f"{path}.{uuid.uuid4().hex}")
    stream = store.create(staged, True)
    try:
        stream.write(json.dumps(content).encode())
    finally:
        stream.close()
    overwrite = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = overwrite
    target = store.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(store.makeQualified(staged), target, options)


def path_state(spark: SparkSession, path: str) -> str:
    """Bytes, number of files and time of change of a file or folder; empty if there is none."""
    hadoop_path, store = _store(spark, path)
    if not store.exists(hadoop_path):
        return ""
    held = store.getContentSummary(hadoop_path)
    return f"{held.getLength()}-{held.getFileCount()}-{store.getFileStatus(hadoop_path).getModificationTime()}"
