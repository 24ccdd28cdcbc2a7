"""Session helpers: a tuned local session for tests/bench and shared-folder lookups."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
METHOD_LIMIT_CONF = "spark.sql.codegen.hugeMethodLimit"
#: Bytecode of a generated method beyond which the JVM does not compile it: it would run interpreted, row by row.
METHOD_LIMIT = 8_000


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "contrail") -> SparkSession:
    """Local session for tests and the bench.

    On a cluster, build the session with the cluster's own settings instead; only
    the options that change semantics (UTC, ANSI) matter to this package.
    """
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Generated methods above the JVM's 8000-byte JIT limit would run
        # interpreted; fall back to per-operator codegen for such wide stages.
        .config(METHOD_LIMIT_CONF, str(METHOD_LIMIT))
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def session_key(spark: SparkSession) -> str:
    """Identity of a running application (stable for its lifetime, never reused)."""
    return spark.sparkContext.applicationId


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value is
    always used as is. Only a local session without one (a test or a laptop run)
    gets a fresh scratch folder; a cluster session without one is an error.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is not visible to the other executors
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="contrail-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    spark.sparkContext.setCheckpointDir(current)
    return current


#: Folders written by ``materialize`` in this process, deleted when their block or the process ends.
_MADE: list[str] = []
_KEPT: list[str] = []


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialize`` writes inside the block when the block ends.

    What is still needed afterwards has to be written by then (to an output of its own,
    or with ``keep``).
    """
    mark = len(_MADE)
    try:
        yield
    finally:
        done = _MADE[mark:]
        del _MADE[mark:]
        _delete(spark, done)


@atexit.register
def _delete_all() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            _delete(spark, _MADE + _KEPT)


def scratch_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new folder name under the shared checkpoint folder, deleted like the tables of ``materialize``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (_KEPT if keep else _MADE).append(path)
    return path


@contextlib.contextmanager
def compiled_stages(spark: SparkSession) -> Iterator[None]:
    """Inside the block, a stage too wide for one compiled method runs operator by operator."""
    before = spark.conf.get(METHOD_LIMIT_CONF)
    spark.conf.set(METHOD_LIMIT_CONF, str(min(int(before), METHOD_LIMIT)))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT_CONF, before)


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads the files instead of
    recomputing the whole chain) and gives later stages file statistics. The table
    lives until the surrounding ``intermediates`` block ends (with ``keep``, or
    outside such a block, until the process ends).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name, keep)
    with compiled_stages(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
