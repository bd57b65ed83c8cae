"""Tables in the folder that all machines share: written rounds, versions, bucketed outputs."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it gets a folder of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-agroplan-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's setting under which a query's shuffle files go once the query is done.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: And the bytes of a generated method beyond which Spark does without it; Java only interprets what is longer than this, row by row.
_COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}

#: Files that a task of a bucketed table writes at once; within that number rows are not sorted by bucket first.
_UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "2"}


@contextlib.contextmanager
def _no_shuffle_left(spark: SparkSession, **more: str):
    settings = {_CLEANUP: "true", **more}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: its lineage is cut, and a lost executor loses none of it.

    The table stands for what made it, so the shuffle files behind it go at once.
    """
    path = new_path(df.sparkSession, name)
    with _no_shuffle_left(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row(df: DataFrame) -> Row:
    """The row of an aggregate; the shuffle files behind it go at once."""
    with _no_shuffle_left(df.sparkSession, **_COMPILED):
        return df.first()


#: Rows that a join may broadcast; a larger side is shuffled instead.
SMALL_ROWS = 1_000_000


def small(df: DataFrame, name: str) -> DataFrame:
    """``df``, of few short rows, written once and broadcast to its join if its counted rows are few."""
    table = written(df, name)
    return F.broadcast(table) if table.count() <= SMALL_ROWS else table


def write_dealt(df: DataFrame, keys: list[str], buckets: int, name: str = "dealt") -> DataFrame:
    """``df``, whose rows are dealt by ``keys`` over that many partitions, as a bucketed table without a shuffle; see :func:`write_bucketed`."""
    spark = df.sparkSession
    table, path = f"{name}_{uuid.uuid4().hex}", new_path(spark, name)
    with _no_shuffle_left(spark, **_COMPILED, **_UNSORTED):
        df.write.option("compression", "zstd").bucketBy(buckets, *keys).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.written_as = (table, path)
    return out


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`write_dealt` that nothing will read any more."""
    name, path = table.written_as
    table.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    system, inner = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    with contextlib.suppress(FileNotFoundError):
        system.delete_dir(inner)


def write_bucketed(df: DataFrame, keys: list[str], order: list[str], buckets: int, name: str = "bucketed") -> DataFrame:
    """``df`` as a table in ``buckets`` hash buckets of ``keys``, sorted by keys and ``order`` within; read back.

    Rows are dealt by the same hash before the write, so that each bucket is one file. Windows and
    groups by ``keys`` (or by more columns), and joins on exactly ``keys`` with a table of as many
    buckets, then read it without a shuffle; a union with other rows (as-of joins) still shuffles.
    """
    spark = df.sparkSession
    table, path = f"{name}_{uuid.uuid4().hex}", new_path(spark, name)
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys, *order)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", path).saveAsTable(table)
    return spark.table(table)
