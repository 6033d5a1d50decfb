"""Send this package to the executors, which import it inside tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application; Spark's file server hands the archive out."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-py-"), "tessera_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "tessera")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(path)
    _SENT.add(app)
