"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on; safe to call repeatedly.

    UTC keeps stored and printed times equal. The group-limit threshold lets Spark cut every
    "first N of a group" window before its shuffle, so a hot player or server sends N rows per
    map task instead of its whole history. Of a key that a JSON object repeats, the last counts.
    The JVM interprets methods of more than 8,000 bytes for good. A stage whose one method would be longer is
    therefore left to projections, which Spark cuts into methods that are compiled.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(2**31 - 1))
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that their Python finds it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    home = Path(__file__).resolve().parent
    packed = Path(tempfile.mkdtemp(prefix="tidewatch-package-")) / "tidewatch.zip"
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(home.rglob("*.py")):
            archive.write(source, Path(home.name) / source.relative_to(home))
    context.addPyFile(str(packed))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for reliable checkpoints: the cluster's own setting, or a fresh one in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tidewatch-checkpoints-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def build(name: str, master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the options that can only be set at its start.

    Plans here are built from many small expressions; recording the Python line of each one costs
    more than the rest of building them.
    """
    builder = SparkSession.builder.appName(name).config(
        "spark.python.sql.dataFrameDebugging.enabled", "false"
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "12g")
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return configure(builder.getOrCreate())
