"""Session helpers: one place for the configuration every job relies on.

The library never creates a session behind the caller's back; operators take
DataFrames.  ``get_session`` is for tests, the bench and the CLI.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings that matter for correctness (time zone, ANSI) or for the plans the
# operators are written for (AQE coalescing / skew handling).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only relations the planner can size; 10 MB is Spark's default and
    # is kept explicit so that nothing grows into a broadcast by accident.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # State tables are partitioned by day_id and bucketed by filename; letting a join on
    # (day_id, filename) use that filename bucketing avoids re-shuffling both sides.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "folio", extra: dict[str, str] | None = None) -> SparkSession:
    master = master or os.environ.get("FOLIO_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app_name)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("FOLIO_DRIVER_MEMORY", "16g"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a folder that driver and executors share; it is
    only read, and a cluster session without it is an error, because a folder of
    one machine cannot be read by the others.  In local mode (tests, the bench),
    where driver and executors are one process, a scratch folder is made instead.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="folio-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per application).

    Needed wherever the workers do not find ``folio`` on their own path, for
    instance when the driver was started from another folder.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="folio-zip-"), "folio.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("folio", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def scale_conf(input_bytes: int, total_cores: int, split_bytes: int = 512 * 1024 * 1024) -> dict[str, str]:
    """Settings sized to the input so tasks stay in memory and the cluster stays busy.

    * file splits of ``split_bytes`` (each scan task reads about that much);
    * shuffle partitions of about ``split_bytes`` too, at least 3 waves of tasks and at
      most 50,000: map tasks x reducers is the number of shuffle blocks the driver and
      the shuffle service keep track of, so reducers are bounded and grow in size instead
      (a sort or aggregation spills; the number of blocks does not shrink);
    * AQE skew-join splitting for partitions 5x the median and above 1 GB.

    For 100 TB on 1000 executors x 8 cores: about 195,000 scan splits of 512 MB and
    50,000 shuffle partitions of about 2 GB of shuffled input at most.
    """
    parts = min(50_000, max(3 * total_cores, -(-input_bytes // split_bytes)))
    mb = f"{split_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * split_bytes // (1024 * 1024)}m",
    }
