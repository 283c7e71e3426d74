"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees: ``spark.checkpoint.dir``.

    Only where that setting is absent and the master is local (tests, a laptop) a folder
    of our own is made.
    """
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None)
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    own = spark.sparkContext.getCheckpointDir()
    if own is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fleetlens-"))
        own = spark.sparkContext.getCheckpointDir()
    return own.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's setting that drops an execution's shuffle files when it has ended.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_open = threading.local()


@contextmanager
def scratch() -> Iterator[None]:
    """Tables materialised inside go at the end, but for those that are to last."""
    made: list[DataFrame] = []
    _open.stack = [*getattr(_open, "stack", []), made]
    try:
        yield
    finally:
        _open.stack.pop()
        for df in made:
            forget(df)


def materialize(df: DataFrame, name: str, *, lasting: bool = False) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    Nothing needs the shuffle files behind the table once it is written; they go at once.
    The table goes with the ``scratch`` around it unless it is ``lasting``.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(_TIDY)
    spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_TIDY, before)
    out = spark.read.schema(df.schema).parquet(path)
    if not lasting and getattr(_open, "stack", None):
        _open.stack[-1].append(out)
    return out


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: it isn't broadcast, however small its file is.

    A table written by ``materialize`` is judged by its packed size; ids of a few bytes each
    there are many times that as a broadcast, which the driver builds.
    """
    return df.hint("merge")


def forget(df: DataFrame) -> None:
    """Delete a table written by ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def named(column: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def passing(*used: str) -> Callable:
    """An operator over documents that passes further columns through, whatever their names.

    It is given the columns of ``used`` by name and the others as one struct, which stands
    apart from any name that the operator uses.
    """
    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def passed(docs: DataFrame, *args, **options) -> DataFrame:
            others = {c: f"c{k}" for k, c in enumerate(docs.columns) if c not in used}
            if not others:
                return operator(docs, *args, **options)
            own = [F.col(c) for c in docs.columns if c in used]
            packed = docs.select(*own, F.struct(*(named(c).alias(k) for c, k in others.items())).alias("passing_columns"))
            out = operator(packed, *args, **options)
            return out.select(*(F.col("passing_columns")[others[c]].alias(c) if c in others else F.col(c) for c in docs.columns))

        return passed

    return wrap
