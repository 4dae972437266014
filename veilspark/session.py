"""Session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library relies on.
REQUIRED_CONF = {
    # JSON text may repeat a key; the last value wins, as in common JSON readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, app: str = "veilspark", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the settings above.

    On a cluster pass no master: the launcher decides.  Local runs (tests,
    bench) pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # PySpark records the Python call site of every column operation for
        # error messages; that makes building wide policies several times slower
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **REQUIRED_CONF,
        **(conf or {}),
    }
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


# A compiled method above 8000 bytes of bytecode is never JIT-compiled by the
# JVM and runs interpreted.  The JSON record projection can exceed that; with
# this limit Spark falls back to per-operator code for just that stage
# (measured: about a quarter faster on JSON records, no change elsewhere).
HUGE_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
SPARK_DEFAULT_HUGE_METHOD_LIMIT = "65535"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session; the code
    size limit only where the session still has Spark's default."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    k, v = HUGE_METHOD_LIMIT
    if spark.conf.get(k, SPARK_DEFAULT_HUGE_METHOD_LIMIT) == SPARK_DEFAULT_HUGE_METHOD_LIMIT:
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only in local mode (tests, bench), when it is unset, a scratch folder is
    created and set; on a cluster an unset folder is an error, because a
    machine-local folder is not visible to the other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="veilspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return checkpoint_dir(spark).rstrip("/") + "/" + name
