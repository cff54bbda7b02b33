"""Session-level helpers: the shared folder, lineage cuts, small local tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# The innermost scope that is open owns what is settled.
_SCOPES: ContextVar[tuple] = ContextVar("scopes", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a session on one machine (a laptop, a test) gets a folder of its own without that setting; on a
    cluster each executor would write its part to a disk of its own, so its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortweave-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other job uses."""
    return f"{shared_folder(spark)}/cohortweave/{label}-{uuid.uuid4().hex}"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _shuffles_end(spark: SparkSession):
    """Shuffle files of what runs inside go when it ends, rather than when the driver happens to collect garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def listing_in_few_tasks(spark: SparkSession):
    """Folders that a read inside finds are listed by some tasks per core, not by a task per folder."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    return _setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))


def settle(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write `df` to the shared folder once and read it from there. `codec`: "zstd" makes texts smaller for some more time.

    Several readers then share one computation, reading only the columns they need, the optimizer
    knows the size, and a lost executor costs a re-read instead of a re-run.
    """
    if getattr(df, "_settled", None):
        return df
    path = scratch_path(df.sparkSession, "table")
    with _shuffles_end(df.sparkSession):
        df.write.parquet(path, compression=codec)
    done = df.sparkSession.read.schema(df.schema).parquet(path)
    done._settled = path
    for scope in _SCOPES.get()[-1:]:
        scope.tables.append(done)
    return done


def release(table: DataFrame) -> None:
    """Delete the folder of a settled table; no plan may read it from then on."""
    path = getattr(table, "_settled", None)
    if path:
        jvm = table.sparkSession.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Scope:
    """Owns what is settled while it is the innermost open one: tables are dropped after their last reader, all of them if the work fails.

    A table that was settled before belongs to its caller and is never dropped here. What is left when the work ends well is still
    read by its lazy results and goes to the scope outside; `drop` removes it when they are done with.
    """

    def __init__(self):
        self.tables: list[DataFrame] = []

    def __enter__(self) -> Scope:
        self._token = _SCOPES.set((*_SCOPES.get(), self))
        return self

    def __exit__(self, kind, error, trace) -> None:
        _SCOPES.reset(self._token)
        if kind is not None:
            self.drop()
        for outer in _SCOPES.get()[-1:]:
            outer.tables += self.tables

    def drop(self, *tables: DataFrame) -> None:
        """Drop those of `tables` that are owned here."""
        for table in tables or tuple(self.tables):
            if any(table is t for t in self.tables):
                release(table)
                self.tables = [t for t in self.tables if t is not table]

    def drop_but(self, *kept: DataFrame) -> None:
        """Drop all but `kept`."""
        for table in tuple(self.tables):
            if not any(table is k for k in kept):
                self.drop(table)


def local_table(spark: SparkSession, columns: dict[str, list], types: dict[str, pa.DataType]) -> DataFrame:
    """A table of caller-supplied rules. The optimizer knows its size and decides how it is joined."""
    arrays = {name: pa.array(values, type=types[name]) for name, values in columns.items()}
    return spark.createDataFrame(pa.table(arrays))


def quoted(name: str) -> str:
    """Column name for F.col, safe for names with dots such as `E11.9`."""
    return "`" + name.replace("`", "``") + "`"
