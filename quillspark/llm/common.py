"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes of the slices in which Arrow batches are worked on; they keep Python workers small.
BATCH_ROWS = 2048
BATCH_BYTES = 8 << 20
#: Numbers of so many files are sent to all tasks.
MOST_FILES = 200_000
#: A key with more than one in so many rows is hot: fewer than that many keys can be. Its rows go to LANES tasks.
HOT_SHARE, LEAST_HOT, LANES = 1000, 100, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as a long; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only a local session that names none, as in small tests, gets a folder made;
    on a cluster nobody but the driver could read it, so that raises.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if configured:
        if current.isEmpty():
            sc.setCheckpointDir(configured)
        return configured
    if current.isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quillspark-"))
    return sc._jsc.sc().getCheckpointDir().get()


def settle(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later jobs then start from files that outlive any executor, and the work
    behind them is done once.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/quillspark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    settled = df.sparkSession.read.schema(df.schema).parquet(path)
    settled.settled_path = path
    return settled


def local_table(spark: SparkSession, names: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    """A small table of longs from the driver, sent as Arrow: no executor starts Python for it."""
    columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))]
    return spark.createDataFrame(pa.table(columns, names=list(names)))


def discard(*tables: DataFrame) -> None:
    """Delete settled tables from which everything that is needed has been settled in its turn."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.settled_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished work now, not when the driver next collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of BATCH_ROWS rows and, above one row, BATCH_BYTES bytes at most."""
    n = batch.num_rows
    if n > BATCH_ROWS or (n > 1 and batch.nbytes > BATCH_BYTES):
        yield from bounded(batch.slice(0, n // 2))
        yield from bounded(batch.slice(n // 2))
    else:
        yield batch


def give_back() -> None:
    """Return what a worker has freed to the system, where its allocators can be asked to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[None]:
    """Arrow batches of so many rows and bytes at most for jobs that run inside; the session's own bounds come back after."""
    bounds = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {key: spark.conf.get(key, None) for key in bounds}
    try:
        for key, bound in bounds.items():
            spark.conf.set(key, str(bound))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def map_batches(
    df: DataFrame,
    per_batch: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """mapInArrow over slices of bounded rows and bytes; the session's settings are left alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded(batch):
                made = per_batch(part)
                if isinstance(made, pa.RecordBatch):
                    yield made
                else:
                    yield from made

    return df.mapInArrow(run, schema)


def _is_scan(df: DataFrame) -> bool:
    """Whether the rows are those of files, one for one or fewer."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" and bool(df.inputFiles())


def with_row_key(df: DataFrame, name: str = "__row") -> DataFrame:
    """Number the rows, so that repeated or null ids do not run together.

    A row of a file has the file's number, by path, and its place in the file:
    these stay the same however a scan is split, so a table can be read again
    by executors that came later. The files' paths are sent to all tasks where they
    are MOST_FILES at most, and joined beyond.
    Other tables are settled with their numbers first.
    """
    if not _is_scan(df):
        return settle(df.withColumn(name, F.monotonically_increasing_id()))
    path, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    paths = settle(df.select(path.alias("__path")).distinct())
    n_files = paths.count()
    if n_files < 2:
        return df.withColumn(name, at)
    number = F.row_number().over(Window.orderBy("__path")) - 1  # a row a file
    numbers = settle(paths.select("__path", number.cast("long").alias("__file")))
    if n_files <= MOST_FILES:
        numbers = F.broadcast(numbers)
    keyed = df.select("*", path.alias("__of"), at.alias(name)).join(numbers, F.col("__of") == F.col("__path"))
    return keyed.select(*df.columns, F.shiftleft("__file", 40).bitwiseOR(F.col(name)).alias(name))


def join_counted(left: DataFrame, counted: DataFrame, keys: list[str], spread: list[str], wanted: Column | None = None, alike: bool = False) -> DataFrame:
    """Inner join with a settled table of distinct keys, its column n being the rows that ``left`` has of each.

    Rows of a hot key are dealt over LANES tasks by the columns ``spread``, and
    the key's row of ``counted`` goes to each. Hot keys are fewer than HOT_SHARE,
    as each has more than that share of the rows, so they can be sent to all.
    Keys for which ``wanted`` does not hold are left out, hot ones before any row moves.
    ``alike`` joins by merging whatever the sizes.
    """
    wanted = F.lit(True) if wanted is None else wanted
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head().n
    least = max(LEAST_HOT, total // HOT_SHARE)
    hot = counted.where(F.col("n") > least).select(*(F.col(k).alias(f"__hot_{k}") for k in keys), wanted.alias("__wanted"))
    same = reduce(and_, (F.col(k) == F.col(f"__hot_{k}") for k in keys))
    lane = F.when(F.col("__wanted").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.lit(LANES))).cast("int")
    dealt = left.join(F.broadcast(hot), same, "left").where(F.coalesce("__wanted", F.lit(True)))
    lanes = F.when(F.col("n") > least, F.sequence(F.lit(0), F.lit(LANES - 1))).otherwise(F.array(F.lit(0)))
    every = counted.where(wanted).select(*(c for c in counted.columns if c != "n"), F.explode(lanes).alias("__lane"))
    every = every.hint("merge") if alike else every
    return dealt.select(*left.columns, lane.alias("__lane")).join(every, [*keys, "__lane"]).drop("__lane")
