"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that a task sorts for a join, about.
ROWS_PER_TASK = 500_000


def local_session(cores: int | str = 8, app: str = "panelspark") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. A machine-local temporary folder is used only
    where that setting is absent and the session itself is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="panelspark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Hint a broadcast when a count shows that ``df`` is small.

    A larger frame comes back unhinted, so that the join shuffles and adaptive execution
    splits its hot keys.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def spread_by_rows(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a large scan by a key, to as many tasks as they need.

    A fixed number of shuffle partitions gives each task, and each sort in it, a share that grows with the table.
    """
    tasks = df.count() // ROWS_PER_TASK + 1
    return df.repartition(tasks, key) if tasks > 1 else df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result that is used several times to a shared folder and read it.

    The table survives lost executors, cuts the lineage and gives the planner true sizes.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
