"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings that matter for these plans: AQE re-plans joins from real sizes, splits skewed
#: shuffle partitions, and may add a shuffle when that is what a split needs.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """This application's folder inside the one the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent (local mode, tests), the warehouse takes its place: it is shared by
    all executors too.  What the application stored is removed when the driver ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
    folder = f"{shared.rstrip('/')}/cohortloom-{spark.sparkContext.applicationId}"
    if folder not in _MADE:
        _MADE.add(folder)
        atexit.register(_remove, spark.sparkContext, folder)
    return folder


_MADE: set[str] = set()


def _remove(context, folder: str) -> None:
    """Delete a folder through Spark's own file systems; a session that is gone has nothing to do it with."""
    try:
        path = context._gateway.jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._gateway.jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # noqa: BLE001  the driver is ending
        pass


#: Rows that a task of the last stage takes, at least, where it is known that a stored table has few.
ROWS_PER_TASK = 50_000


def tasks_for(spark: SparkSession, at_most: int) -> int:
    """Tasks for up to ``at_most`` narrow rows, no more than a shuffle has."""
    return min(max(-(-at_most // ROWS_PER_TASK), 1), int(spark.conf.get("spark.sql.shuffle.partitions")))


def few_tasks(df: DataFrame, at_most: int | None) -> DataFrame:
    """As few tasks as up to ``at_most`` rows need, if a bound is known."""
    return df if at_most is None else df.coalesce(tasks_for(df.sparkSession, at_most))


def cut_lineage(df: DataFrame, at_most: int | None = None) -> DataFrame:
    """Store a table in the shared folder and read it back.

    The stored copy survives the loss of any executor, is computed once, and, being parquet, gives
    later plans column pruning and true sizes.  ``at_most`` is a bound of its rows, if one is known: a small table
    is then one or a few files instead of one for each shuffle partition.  Its last stage, which has to be light, gets
    as few tasks.
    """
    df = few_tasks(df, at_most)
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_by(df: DataFrame, key: str, tasks: int) -> DataFrame:
    """Store a table dealt by ``key`` into ``tasks`` buckets and read it back.

    Groups and windows whose keys hold ``key`` need no shuffle on it, nor does storing what they return: rows are moved
    only where they are not dealt so yet.  A key's rows lie in one bucket, so look at their number before
    (``common.whole_groups``).
    """
    name = f"t_{uuid.uuid4().hex}"
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.repartition(tasks, key).write.format("parquet").bucketBy(tasks, key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
