"""Session settings, and shipping of this package to the executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_shipped: set[str] = set()


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; other settings as given."""
    builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    return builder.config(map=conf).getOrCreate() if conf else builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package, once for each application; Spark hands the archive to every executor."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = os.path.realpath(tempfile.mkdtemp())
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves the file as long as it runs
    archive = os.path.join(folder, "corvane.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def spread(rows: DataFrame) -> DataFrame:
    """The rows in at least as many tasks as run at once, for work inside rows that costs much more than moving them. A table of
    few files with one row group each is dealt anew; one with tasks enough, as any large one has, stays where it is."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= tasks else rows.repartition(4 * tasks)


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees: spark.checkpoint.dir. Where that is unset, a local session gets one of its own, as
    in tests; a cluster has no such folder to guess, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/corvane-checkpoints"
    return base.rstrip("/")


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there by all that follows. The lineage ends here, so a lost executor
    costs a reread."""
    path = f"{shared_dir(rows.sparkSession)}/kept/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows of a schema. The optimizer knows that there are none and leaves them out of unions; createDataFrame would start Python workers for them."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)]).where(F.lit(False))
