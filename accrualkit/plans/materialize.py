"""Session tables and result sinks.

``temp_table`` is the Spark form of ``CREATE TEMP TABLE … AS SELECT``: the
rows are written once to the shared checkpoint folder (so the lineage is cut
and a lost executor does not force a recompute from the sources) and exposed
under a session view name.  ``write_result`` writes rows to a shared folder
and reads them back.

``run_scope`` gives a run a folder of its own.  What is materialised inside it
without a folder of its own goes there, and when the scope ends, also after a
failure, the folder and the session views that the run has registered are
removed.  Results that outlive the run are written elsewhere before it ends.
Outside a scope, files stay until the shared folder is cleaned, like
checkpoints of a finished application.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Sequence
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from accrualkit.session import checkpoint_dir


@dataclass
class RunScope:
    """The folder and the session views of one run."""

    spark: SparkSession
    path: str
    views: list[str] = field(default_factory=list)

    def remove(self) -> None:
        for view in self.views:
            self.spark.catalog.dropTempView(view)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


_CURRENT: ContextVar[RunScope | None] = ContextVar("run_scope", default=None)


@contextlib.contextmanager
def run_scope(spark: SparkSession) -> Iterator[RunScope]:
    """A run whose intermediates and views are removed at its end.

    DataFrames built inside read these files, so write or collect them before
    the scope ends.  Scopes nest; each removes its own files.
    """
    scope = RunScope(spark, f"{checkpoint_dir(spark).rstrip('/')}/runs/{uuid.uuid4().hex}")
    token = _CURRENT.set(scope)
    try:
        yield scope
    finally:
        _CURRENT.reset(token)
        scope.remove()


def register_view(df: DataFrame, name: str) -> str:
    """``df`` as the session view ``name``, removed with the run that it belongs to."""
    df.createOrReplaceTempView(name)
    if (scope := _CURRENT.get()) is not None:
        scope.views.append(name)
    return name


def reuse(df: DataFrame) -> DataFrame:
    """Materialise an intermediate that a plan reads several times.

    Each use of a shared sub-plan would otherwise be recomputed (column
    pruning gives every use a different projection, so exchange reuse does
    not apply).  The rows are computed once and written as Parquet to the
    shared folder; later readers, and any retry after a lost executor, read
    the columns that they need from the files.
    """
    return write_result(df, "reuse")


def temp_table(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.table(register_view(reuse(df), name))


def write_result(
    df: DataFrame, name: str, root: str | None = None, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` under ``root`` (default: the folder of the run, or the shared checkpoint folder)."""
    spark, scope = df.sparkSession, _CURRENT.get()
    root = (root or (scope.path if scope else checkpoint_dir(spark))).rstrip("/")
    path = f"{root}/results/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").format(fmt).partitionBy(*partition_by).save(path)
    return spark.read.schema(df.schema).format(fmt).load(path)
