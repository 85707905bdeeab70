"""Spark session defaults and the shared scratch/checkpoint folder.

Library functions never create sessions; this module is for scripts, tests
and the benchmark.  On a cluster the operator supplies ``spark.checkpoint.dir``
(a shared, reliable folder); we only pick a local folder when it is unset.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Defaults that matter at scale, each applied only where nothing else set it.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast only when its size, measured after its shuffle, is
    # below this bound; file sizes known at planning time decide nothing.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "histdim",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the defaults above for whatever is still unset; values
    from the cluster's configuration, or of a session that runs, stay."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    given = {k for k, _ in spark.sparkContext.getConf().getAll()} | set(extra or {})
    for k, v in SCALE_DEFAULTS.items():
        if k not in given:
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.  Where none is configured, a local run
    gets a local one; on a cluster that is an error, because executors do not
    share a machine's folders."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") \
                or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="histdim-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


#: The folder that holds the scratch data of the work that runs, if it has an owner.
_OWNED: contextvars.ContextVar[str | None] = contextvars.ContextVar("histdim-scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a
    machine-local temp dir on a cluster)."""
    base = _OWNED.get() or f"{ensure_checkpoint_dir(spark).rstrip('/')}/histdim-scratch"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def scratch_owner(spark: SparkSession, name: str = "owned"):
    """Everything frozen inside is removed at the end, also after an error; for work whose results have
    been written elsewhere by then.  An owner inside another one has a folder of its own."""
    path = scratch_path(spark, name)
    token = _OWNED.set(path)
    try:
        yield path
    finally:
        _OWNED.reset(token)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def in_threads(fn, items, most: int = 6) -> list:
    """``fn`` of each item, run side by side as Spark jobs of their own and under the caller's scratch owner."""
    with ThreadPoolExecutor(max_workers=most) as ex:
        return [f.result() for f in [ex.submit(contextvars.copy_context().run, fn, x) for x in items]]


#: How stored rows are compressed: a third smaller than by Parquet's default here.
PACKED = {"compression": "zstd"}


def frozen(df, name: str):
    """``df`` written once to the shared scratch folder and read back: computed
    once whatever uses it, and the same for every use and every retry."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
