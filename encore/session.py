"""Make a session ready for the jobs."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application (as --py-files would)."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="encore-"), "encore"), "zip",
            root_dir=os.path.dirname(package), base_dir=os.path.basename(package),
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
