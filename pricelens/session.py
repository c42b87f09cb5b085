"""Session helpers: a tuned builder for local runs and the shared checkpoint folder."""

from __future__ import annotations

import os
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (broadcast only
# when the materialised side is small), coalesces small shuffle partitions and splits
# skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "pricelens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``; we only set our own when the
    session has none (local tests). Never a machine-local temp dir on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        # Local runs and tests only: one machine, so a local folder is shared by all.
        configured = fallback or os.path.join(os.environ.get("PRICELENS_SCRATCH", "/tmp/pricelens-checkpoints"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for written tables."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/pricelens/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append(path)
    return path


_WRITTEN: list[str] = []


def remove_written(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate folders that this process made after mark ``since`` (see
    ``written_mark``). A job calls it when its results are written; DataFrames that still read
    them must not be used any more. Returns how many folders it deleted."""
    gone = 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _WRITTEN[since:]:
        at = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(at.getFileSystem(conf).delete(at, True))
    del _WRITTEN[since:]
    return gone


def written_mark() -> int:
    """The number of intermediate folders made so far."""
    return len(_WRITTEN)


#: Whether the shuffle files of a query are deleted when it ends. Else they stay until the driver happens to collect its
#: garbage, and the shuffles of one written table after the other add up on disk.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict[int, int] = {}
_LOCK = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Queries that begin in here delete their shuffle files at their end; several threads may be in here at a time."""
    with _LOCK:
        before = spark.conf.get(_FREE, "false") if not _FREEING.get(id(spark)) else None
        _FREEING[id(spark)] = _FREEING.get(id(spark), 0) + 1
        if before is not None:
            _FREEING[-id(spark)] = int(before == "true")
            spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        with _LOCK:
            _FREEING[id(spark)] -= 1
            if not _FREEING[id(spark)]:
                del _FREEING[id(spark)]
                spark.conf.set(_FREE, "true" if _FREEING.pop(-id(spark)) else "false")


def materialize(df, name: str = "table", min_partitions: int | None = None, max_rows: int | None = None):
    """Write ``df`` as parquet to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing joins) and
    lets several later jobs reuse one computation. Columnar parquet is much cheaper to
    write and read than RDD checkpoint files of serialised rows. The shuffle files of the
    write are deleted at its end (``freed_shuffles``).

    ``min_partitions``: when the source has fewer files (e.g. one large row group), spread
    it round-robin first so iterative readers (forest training) get that many files/tasks.
    Sources of more files are untouched. Large sources (``is_large``) are written as they
    come, and only dealt if that has made too few files. ``max_rows``: rows of a file at most.
    """
    late = min_partitions and len(df.inputFiles()) < min_partitions and is_large(df, min_partitions)
    out = _written(spread(df, min_partitions) if min_partitions and not late else df, name, max_rows)
    if late and len(out.inputFiles()) < min_partitions:
        first, out = out, _written(spread(out, min_partitions), name, max_rows)
        discard(first)
    return out


def _written(df, name: str, max_rows: int | None):
    path = shared_path(df.sparkSession, name)
    to = df.write.mode("overwrite")
    with freed_shuffles(df.sparkSession):
        (to.option("maxRecordsPerFile", max_rows) if max_rows else to).parquet(path)
    return df.sparkSession.read.parquet(path)


#: A source is large if its files hold as much for each core.
DEAL_BYTES = 16 << 20


def is_large(df, cores: int) -> bool:
    """Whether the files that ``df`` reads are so large that Spark cuts them, or the shuffle of a join, into a task for
    every core by itself: dealing their rows anew would only move them once more."""
    from pricelens.functions.joins import input_bytes
    return input_bytes(df) >= cores * DEAL_BYTES


def discard(table) -> None:
    """Delete the folder of a table of ``materialize`` that is not read any more, nor by any DataFrame made from it."""
    files = table.inputFiles()
    folder = os.path.dirname(files[0]) if files else ""
    for path in [p for p in _WRITTEN if folder.endswith(p.rsplit("/pricelens/")[-1])]:
        at = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _WRITTEN.remove(path)


def read_finer(table, parts: int):
    """A table of ``materialize``, as it was written, in ``parts`` partitions or more if it has the files for that; nothing
    is moved. How finely files are read is a setting of the session, so it is read in a session of its own."""
    from pricelens.functions.joins import input_bytes
    session = table.sparkSession.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(max(1, input_bytes(table) // parts)))
    return session.read.parquet(os.path.dirname(table.inputFiles()[0]))


def spread(df, min_partitions: int | None = None):
    """Round-robin ``df`` over ``min_partitions`` (default: the cluster's cores) when it reads
    fewer files than that, e.g. one huge row group. The file list is known without running
    anything. A no-op at scale."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) < target:
        return df.repartition(target)
    return df
