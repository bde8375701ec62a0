"""Session helpers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark application.

    Python workers then import it wherever they run, also on machines that
    don't have the repository.
    """
    context = spark.sparkContext
    if getattr(context, "_wakeline_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="wakeline")) / "wakeline.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._wakeline_shipped = True
