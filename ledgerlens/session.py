"""Spark session defaults used by tests, the bench and the pipeline runner."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every plan in this package assumes.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # keyed writes replace only the as_of_date partitions they touch
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # the staged runner submits independent writes as concurrent jobs; FAIR
    # scheduling lets them share the cores instead of queueing behind the largest
    "spark.scheduler.mode": "FAIR",
}
# settings fixed when the context starts; apply_defaults leaves them alone
_STARTUP_ONLY = ("spark.ui.", "spark.scheduler.mode")


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app_name: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session somebody else built."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith(_STARTUP_ONLY):
            continue
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names, set for the context if need be.

    On a cluster that setting must name a folder all executors share; only a
    session on one machine without it (tests, a laptop) gets a local folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the checkpoint folder and read back: what comes before runs once."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing: dict[int, list] = {}
_counting = threading.Lock()


@contextmanager
def shuffles_released(spark: SparkSession):
    """While this is open, a query's shuffle files go when it ends (from Spark 4.1) and not
    when the driver happens to collect its plan: for writes, whose plans run once."""
    with _counting:
        held = _releasing.setdefault(id(spark), [0, spark.conf.get(_RELEASE, None)])
        held[0] += 1
        spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        with _counting:
            held[0] -= 1
            if not held[0]:
                del _releasing[id(spark)]
                spark.conf.unset(_RELEASE) if held[1] is None else spark.conf.set(_RELEASE, held[1])


def reached(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Nodes reached from ``start(node)`` over ``edges(a, b)``: ``(node, steps)`` with the
    least number of steps, 0 for the start.

    One frontier at a time, without the nodes already seen, until none is new: it ends
    on cycles, has no depth limit, and never enumerates paths. Each frontier is written
    to the checkpoint folder, so the plan does not grow with the depth, and none is sent
    through the driver, which would hold one a step.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    seen = frontier = start.select("node").distinct().withColumn("steps", F.lit(0)).checkpoint()
    steps = 0
    while not frontier.isEmpty():
        steps += 1
        frontier = (edges.join(frontier.select(F.col("node").alias("a")).hint("merge"), "a")
                    .select(F.col("b").alias("node")).distinct()
                    .join(seen.select("node").hint("merge"), "node", "left_anti")
                    .withColumn("steps", F.lit(steps)).checkpoint())
        seen = seen.unionByName(frontier)
    return seen
