"""Spark session construction and lineage cutting.

Everything in the library takes a ``SparkSession`` (or DataFrames) from the caller; this module
only offers a session with sensible defaults for local runs and tests, and the intermediate tables
that live in the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import gc
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

# Defaults chosen for a cluster: AQE re-plans joins at run time (broadcast when a shuffle
# output proves small, splits skewed partitions), partitions are coalesced after shuffles.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Largest share of a table's files that one task of a ``wide_session`` reads.
SPLIT_BYTES = 32 << 20


def get_spark(app: str = "ontime_spark", master: str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults.

    ``master`` is only applied when given, so on a cluster the launcher's master is kept.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def wide_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings for tables of many columns, whose own settings stay as they are.

    The JVM does not compile a method of more than 8,000 bytes of bytecode, and Spark makes one method
    of a stage: the 39 features with their joins come to 17,000 bytes, which are then interpreted row by row.
    With this limit Spark runs such a stage operator by operator, each with compiled code. Files are read
    in partitions of at most ``SPLIT_BYTES`` unless the caller has set a size: 128 MB of such a table are
    millions of rows, too many for one task's share of the memory."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    own.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if "spark.sql.files.maxPartitionBytes" not in spark.conf.getAll:
        own.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    return own


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the one the caller set with
    ``setCheckpointDir`` if any, else the one named by ``spark.checkpoint.dir``.

    Executors must be able to read what the driver and other executors wrote, so no folder is
    ever made up here and the caller's choice is never replaced; with neither set a
    ``ValueError`` says what to configure."""
    chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
    if chosen.isDefined():
        return chosen.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("no shared folder for intermediate tables: set spark.checkpoint.dir (or "
                         "call sparkContext.setCheckpointDir) to a path every executor can read")
    return path


_written: list[str] = []
_path_of: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"


def materialize(df: DataFrame, name: str = "table", rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back; a file holds at most
    ``rows_per_file`` rows (0: what its task wrote).

    Cuts the lineage like ``checkpoint()`` but stays columnar: later passes prune columns and
    push filters into the files, and a lost executor re-reads files instead of recomputing
    the upstream joins. ``release`` removes what a finished job wrote."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    writer = df.write.mode("overwrite")
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)
    _written.append(path)
    table = spark.read.schema(schema).parquet(path)
    _path_of[table] = path
    return table


def mark() -> int:
    """A position in the list of written intermediates, to be passed to ``release``."""
    return len(_written)


def release(spark: SparkSession, since: int = 0, until: int | None = None) -> int:
    """Remove the intermediate tables written after ``since`` (a ``mark()``) and before ``until``,
    when every result that reads them has been written or collected. Returns how many were removed."""
    paths, _written[since:until] = _written[since:until], []
    _delete(spark, paths)
    return len(paths)


def discard(*tables: DataFrame | None) -> None:
    """Remove tables that ``materialize`` returned and that no later step or result reads (None is
    passed over), and let Spark remove the shuffle files of the steps that are over: it does so
    when the driver has collected the objects that stand for them, which may otherwise be never."""
    gone = [t for t in tables if t is not None and t in _path_of]
    if gone:
        spark = gone[0].sparkSession
        paths = [_path_of.pop(t) for t in gone]
        _written[:] = [p for p in _written if p not in paths]
        _delete(spark, paths)
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
