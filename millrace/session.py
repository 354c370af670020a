"""Getting a Spark session ready for this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent


def prepare(spark: SparkSession) -> SparkSession:
    """Send the package to the Python workers, once per Spark context.

    Not needed where the package is installed on every node. The Python process
    that plans streaming reads runs beside the driver and gets the search path.
    """
    context = spark.sparkContext
    if not getattr(context, "_millrace_sent", False):
        paths = [context.environment.get("PYTHONPATH"), str(_PACKAGE.parent)]
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, paths))
        if not _PACKAGE.suffix and ".zip" not in str(_PACKAGE):
            archive = Path(tempfile.mkdtemp(prefix="millrace-package-")) / f"{_PACKAGE.name}.zip"
            with zipfile.ZipFile(archive, "w") as out:
                for file in sorted(_PACKAGE.rglob("*.py")):
                    out.write(file, file.relative_to(_PACKAGE.parent))
            context.addPyFile(str(archive))
        context._millrace_sent = True
    return spark
