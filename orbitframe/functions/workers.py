"""Makes this package importable in Python workers, wherever the driver has it from."""

from __future__ import annotations

import atexit
import hashlib
import io
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

import orbitframe


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors once per context, through the driver's file server."""
    context = spark.sparkContext
    if getattr(context, "_orbitframe_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(orbitframe.__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.join("orbitframe", os.path.relpath(path, root)))
    name = hashlib.sha256(buffer.getvalue()).hexdigest()[:16]
    folder = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"orbitframe-{name}.zip")
    with open(path, "wb") as file:
        file.write(buffer.getvalue())
    context.addPyFile(path)
    context._orbitframe_shipped = True
