"""Session settings and shared scratch space.

The library never builds its own cluster session: callers pass a
``SparkSession``.  ``build_session`` exists for tests, the bench and local
runs only.  ``recommended_conf`` lists the settings the operators are
designed around (AQE with skew-join splitting and runtime broadcast
conversion); on a cluster they belong in the job submission.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings the plans assume.  AQE re-plans joins at runtime: a join side whose
# *materialised* shuffle output is below the adaptive threshold becomes a
# broadcast (a size-checked broadcast), skewed partitions of sort-merge joins are
# split, and small shuffle partitions are coalesced.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even where a side's partitioning would be reused
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the GBK codec of legacy exports
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
}


def recommended_conf() -> dict[str, str]:
    return dict(RECOMMENDED_CONF)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "feedlab", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (the UI stays off)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextlib.contextmanager
def charset_codecs(spark: SparkSession):
    """Legacy charsets for the jobs that run inside; the setting is put back."""
    name = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, size: str = "8m"):
    """Batches of at most ``size`` bytes for the Python workers of jobs that run inside;
    the setting is put back.  Batches are held by Spark and by the worker, on top of the heap."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Where it is unset, a
    single-process local session (tests) gets a fresh private folder; on a
    cluster that is an error, as executors would write to their own disks.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/").rsplit("/", 1)[0] if _is_uuid_leaf(current) else current
    if not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="feedlab-ckpt-")
    sc.setCheckpointDir(local)
    return local


def _is_uuid_leaf(path: str) -> bool:
    # SparkContext.setCheckpointDir appends a random UUID folder.
    leaf = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(leaf)
        return True
    except ValueError:
        return False


_open_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "feedlab-scratch", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}")
    for scope in _open_scopes:
        scope.append(path)
    return path


@contextlib.contextmanager
def stage_outputs_removed(spark: SparkSession):
    """Delete the stage outputs written inside, at the end.  For jobs whose
    results are written elsewhere: DataFrames over stage outputs end with it."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            remove_output(spark, path)


def remove_output(spark: SparkSession, path: str) -> None:
    """Delete a stage output that no later stage reads."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialize(df, name: str):
    """Write ``df`` as Parquet to a fresh folder under the shared checkpoint
    folder and return a DataFrame reading it back.

    Used where one intermediate feeds several branches of a plan (Spark would
    otherwise recompute it per branch) and to cut long lineages: a lost
    executor then re-reads the file instead of recomputing the stage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


# Stored bytes of the inputs for which ``spread`` adds a task.
SPREAD_BYTES = 2 << 20


def input_bytes(df) -> int:
    """Stored bytes of the files that ``df`` reads; 0 for tables without files."""
    spark = df.sparkSession
    conf, total = spark._jsc.hadoopConfiguration(), 0
    for name in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def spread(df, *keys: str, bytes_a_task: int = SPREAD_BYTES):
    """``df`` dealt by ``keys`` to as many tasks as its inputs' bytes ask for.

    Before an aggregate of rows that take many times the room of their inputs
    (terms of texts, terms of users): its memory in a task then depends on
    ``bytes_a_task``, not on the size of the inputs over a fixed number of tasks.
    ``df`` may be a pair of the table and a log whose bytes count where they are more.
    """
    df, *more = df if isinstance(df, tuple) else (df,)
    return df.repartition(_tasks(df, max(map(input_bytes, (df, *more))), bytes_a_task), *keys)


def spread_like(log, df, *keys: str, **bytes_a_task: int):
    """``spread`` where ``df`` reads a reduced copy of ``log``: that is stored in far
    fewer bytes a row, so the bytes of ``log`` count where they are more."""
    return spread((df, log), *keys, **bytes_a_task)


def _tasks(df, size: int, bytes_a_task: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // bytes_a_task))


def join_dealt(log, rows, side, key: str, other: str, bytes_a_task: int = SPREAD_BYTES):
    """``rows`` joined with ``side`` on ``key`` where a row meets many or wide rows of
    ``side``: dealt to as many tasks as the bytes of ``log`` ask for.

    Spark sizes a join's tasks by what they read, which says nothing of what they
    write.  A key with more than a task's share of ``rows`` is cut by ``other``, and
    its rows of ``side`` go with each cut; there are fewer such keys than tasks.
    ``rows`` is counted first, so it is written once.
    """
    tasks = _tasks(rows, max(input_bytes(rows), input_bytes(log)), bytes_a_task)
    rows = materialize(rows, "dealt")
    share = max(1, -(-rows.count() // tasks))
    cuts = F.broadcast(rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("_cuts"))
                           .where("_cuts > 1"))
    n = F.coalesce("_cuts", F.lit(1))
    cut = rows.join(cuts, key, "left").withColumn("_cut", F.pmod(F.xxhash64(other), n).cast("int")).drop("_cuts")
    copies = (side.join(cuts, key, "left").withColumn("_cut", F.explode(F.sequence(F.lit(0), n - 1))).drop("_cuts"))
    # a broadcast of ``rows`` would leave the join to the tasks of ``side``
    return cut.repartition(tasks, key, "_cut").join(copies.hint("merge"), [key, "_cut"]).drop("_cut")


def together(spark: SparkSession, *builds):
    """Run functions that write stage outputs side by side; their results in order.

    For stages that do not read each other: the jobs share the cluster, so the tail
    of one stage does not leave it idle.  The first error is raised once all ended.
    """
    with ThreadPoolExecutor(len(builds)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(b)) for b in builds]
    return [r.result() for r in running]


_shipped: set[str] = set()


def map_arrow(df, function, schema: str):
    """``df.mapInArrow`` with this package on the executors' path."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def ship_package(spark: SparkSession) -> None:
    """Put this package on the executors' path.

    The package is added to the job's Python files once per application, so the
    functions run whatever folder the executors' Python starts in.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        file = Path(tempfile.mkdtemp(prefix="feedlab-py-")) / "feedlab.zip"
        with zipfile.ZipFile(file, "w") as z:
            for p in sorted((root / "feedlab").rglob("*.py")):
                z.write(p, p.relative_to(root).as_posix())
        sc.addPyFile(str(file))
        _shipped.add(sc.applicationId)
