"""Sends the library to the executors of a session, for the operators that run Python in tasks.

On a cluster that has it installed (or got it with ``--py-files``) this changes nothing.
"""

from __future__ import annotations

import os
import zipfile

from pyspark import SparkFiles
from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per session; later calls do nothing."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    folder = f"{SparkFiles.getRootDirectory()}/shipped"
    os.makedirs(folder, exist_ok=True)
    archive = f"{folder}/careflow.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for place, _, names in os.walk(PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(place, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    context.addPyFile(archive)
    _sent.add(context.applicationId)
