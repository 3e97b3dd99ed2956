"""Session factory, and shipping of this package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def get_session(app: str = "skyledger", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings every operator assumes: UTC, adaptive execution, joins where tables lie."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false")
    b = b.config("spark.sql.requireAllClusterKeysForCoPartition", "false")  # tables that lie by station are joined by station and time where they lie
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Give executors this package, once for each application, as Python workers import it by name."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        at = Path(tempfile.mkdtemp(prefix="skyledger-")) / "skyledger.zip"
        with zipfile.ZipFile(at, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent).as_posix())
        spark.sparkContext.addPyFile(str(at))
        _shipped.add(app)
    return spark
