"""Session helpers: building a session for local runs and managing lineage cuts.

Library operators never create sessions themselves; they take DataFrames and
return DataFrames. The helpers here are for tests, the benchmark and the
iterative operators that have to cut lineage between rounds.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session tuned for the small test scales (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``; that value is always
    respected. Only a local-mode session without one (tests, the benchmark)
    gets a fresh folder of its own. A cluster session without one is an
    error: a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; iterative operators need a shared checkpoint folder"
        )
    folder = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def ship_package(spark: SparkSession) -> None:
    """Give executors this package's code by Spark's own file distribution, once a session.

    Operators whose functions run in Python workers call it; nothing has to be installed there.
    """
    sc = spark.sparkContext
    name = "tessera_package.zip"
    if any(os.path.basename(f) == name for f in sc._python_includes):
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tessera-"), name)
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Compared with ``DataFrame.checkpoint`` the re-read table carries real size
    statistics (file sizes) instead of the estimate of the plan it came from;
    in iterative operators those estimates compound round after round and both
    mislead join planning and make planning itself slow.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)  # given, so that no job reads it from the files
    table._written_to = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of ``cut_lineage`` that nothing reads any more, and let Spark drop the shuffles that made it."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark._jvm.System.gc()  # shuffle files stay until the driver has collected what refers to them
