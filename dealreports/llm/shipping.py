"""Lets Python workers import the package in local mode, where nobody passes ``--py-files``."""

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

import dealreports

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application. On a cluster the package is installed there or comes by ``--py-files``."""
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master) or context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(dealreports.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="dealreports-"), "dealreports_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
