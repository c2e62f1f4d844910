"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Run-time settings every plan here relies on. Joins carry no size-blind broadcast
# hint: the planner broadcasts a side only when its known or measured size is under
# spark.sql.autoBroadcastJoinThreshold, and otherwise shuffles and splits hot keys.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Shuffles start with one partition per this much input; adaptive execution merges the
# ones that turn out small.
INPUT_BYTES_PER_PARTITION = 256 * 1024 * 1024

# Settings of flows that write every row several times: files take less room, and shuffle files
# go when the statement that wrote them ends, not when the driver next collects garbage.
SPARING_SETTINGS = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_local_dirs: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def local_session(cores: str = "*", app: str = "rowproof", **settings: str) -> SparkSession:
    """Session for one machine (tests, bench). On a cluster, pass your own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.session.timeZone": "UTC",
        **ADAPTIVE_SETTINGS,
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession, input_path: str) -> SparkSession:
    """Set a session up for plans over the files below ``input_path``."""
    return prepare_for(spark, stored_bytes(spark, input_path))


def prepare_for(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Set a session up for plans over so many bytes, which files may hold compressed."""
    partitions = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        input_bytes // INPUT_BYTES_PER_PARTITION,
    )
    settings = {
        **ADAPTIVE_SETTINGS,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
    }
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """Statements inside run with ``SPARING_SETTINGS``; afterwards the session is as it was."""
    before = {key: spark.conf.get(key, None) for key in SPARING_SETTINGS}
    for key, value in SPARING_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    file_system, hadoop_path = _located(spark, path)
    return file_system.exists(hadoop_path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files below a folder."""
    file_system, hadoop_path = _located(spark, path)
    return file_system.getContentSummary(hadoop_path).getLength()


def stored_files(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of all files below a folder."""
    file_system, hadoop_path = _located(spark, path)
    summary = file_system.getContentSummary(hadoop_path)
    return summary.getFileCount(), summary.getLength()


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder; none when it does not exist."""
    file_system, hadoop_path = _located(spark, folder)
    if not file_system.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in file_system.listStatus(hadoop_path))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may leave it unset; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_dirs:
        made = tempfile.mkdtemp(prefix="rowproof-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_dirs[app] = made
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, what was settled inside; frames made inside end with it."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            file_system, hadoop_path = _located(spark, path)
            file_system.delete(hadoop_path, True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder below the shared folder; nothing happens when it is not there."""
    if not path.startswith(shared_dir(spark)):
        raise ValueError(f"{path} is not in the shared folder")
    file_system, hadoop_path = _located(spark, path)
    file_system.delete(hadoop_path, True)


def settle(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    Cuts lineage so that lost executors re-read files instead of recomputing, fixes
    values that depend on row placement, and gives the planner the true size. A ``path`` that
    :func:`scratch_path` gave outside of a scope outlives the scope.
    """
    return settle_measured(df, label, path=path)[0]


def settle_measured(
    df: DataFrame, label: str, path: str | None = None, without: Sequence[str] = (), **metrics: Column
) -> tuple[DataFrame, dict[str, int]]:
    """:func:`settle`, with aggregates taken while writing; ``rows`` is always among them.
    Columns ``without`` are there for the aggregates only and are not written."""
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    measures = {"rows": F.count(F.lit(1)), **metrics}
    observation = Observation()
    observed = df.observe(observation, *[value.alias(name) for name, value in measures.items()]).drop(*without)
    observed.write.parquet(path)
    measured = observation.get
    settled = spark.read.schema(observed.schema).parquet(path)
    return settled, {name: measured.get(name) or 0 for name in measures}
