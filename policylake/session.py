"""Session settings and the shared scratch folder used for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from .operators.sizes import is_scan, source_bytes


# The wide cleaning projections compile to long methods; above 8000 bytes of bytecode the JVM
# interprets a method for good, so Spark is told to split such code instead.
SQL_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Tables are staged query by query: shuffle files go when the query that made them ends, not when
# the driver happens to collect its garbage.
TABLE_SETTINGS = {**SQL_SETTINGS, "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def tune(spark: SparkSession, settings: Mapping[str, str] = SQL_SETTINGS) -> SparkSession:
    """Apply the SQL settings to a session made elsewhere, unless it sets them itself."""
    given = dict(spark.sparkContext.getConf().getAll())
    for key, value in settings.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "policylake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library is tested with; the caller's ones win."""
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **TABLE_SETTINGS,
        **settings,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path below the folder that ``spark.checkpoint.dir`` names.

    Executors must all reach it, so a machine-local folder is only made up where
    the setting is absent and Spark itself runs on this machine alone.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="policylake-")
    return f"{root.rstrip('/')}/policylake/{purpose}-{uuid.uuid4().hex}"


def spread(df: DataFrame, least_bytes: int = 1 << 20) -> DataFrame:
    """Share out a source that has fewer splits than there are cores, else leave it alone.

    Parsing text is heavy work per row; a few large row groups would keep most cores idle.
    A source of cluster size has more splits than cores and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if (source_bytes(df) or 0) < least_bytes or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


T = TypeVar("T")


def concurrently(spark: SparkSession, tasks: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """The results of independent builders, whose jobs run side by side; the first error is raised once all have ended.

    Each has a few jobs in sequence, some of them short, so that one alone leaves most cores waiting.
    """
    if not tasks:
        return {}

    def carried(task: Callable[[], T]) -> Callable[[], T]:
        context = copy_context()
        return inheritable_thread_target(spark)(lambda: context.run(task))

    with ThreadPoolExecutor(len(tasks)) as pool:
        running = {name: pool.submit(carried(task)) for name, task in tasks.items()}
    return {name: future.result() for name, future in running.items()}


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the folders staged inside, which it lists, when the block ends, also by an error; write all results within it."""
    folders: list[str] = []
    token = _STAGED.set(folders)
    try:
        yield folders
    finally:
        _STAGED.reset(token)
        for folder in folders:
            remove_folder(spark, folder)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts the lineage at a Parquet table, so later passes over a few of its columns
    read just those and a lost executor costs a re-read, not a recomputation. Inside ``staging``
    the folder goes when the block ends, else the caller removes it.
    """
    return stage_parts([df], purpose)


def stage_parts(parts: Iterable[DataFrame], purpose: str) -> DataFrame:
    """Stage tables of the same columns as one, one after another, so that the shuffle files of each are gone before the next begins."""
    path = None
    for df in parts:
        if path is None:
            spark, schema, path = df.sparkSession, df.schema, scratch_folder(df.sparkSession, purpose)
            if (folders := _STAGED.get()) is not None:
                folders.append(path)
        df.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def file_slices(staged: DataFrame, most: int = 8, least_bytes: int = 256 << 20) -> list[DataFrame]:
    """A staged table as up to ``most`` tables of whole files, each of about ``least_bytes`` or more; whole where it is not just read from files."""
    count = min(most, (source_bytes(staged) or 0) // least_bytes)
    files = sorted(map(unquote, staged.inputFiles())) if count > 1 and is_scan(staged) else []
    parts = [files[k::count] for k in range(count)] if files else []
    return [staged.sparkSession.read.schema(staged.schema).parquet(*p) for p in parts if p] or [staged]


def stage_built(spark: SparkSession, build: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """Stage what ``build`` returns; what it staged on the way is removed once that is written."""
    outer = _STAGED.get()
    with staging(spark):
        df = build()
        token = _STAGED.set(outer)
        try:
            return stage(df, purpose)
        finally:
            _STAGED.reset(token)
