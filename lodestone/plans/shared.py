"""Folders that the driver and all executors see."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder for files that every process opens by its path; it goes when the driver ends.

    It lies in the folder of ``spark.checkpoint.dir``, which a cluster shares, or, where that is unset,
    among the driver's temporary files, which only local mode sees.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        path = tempfile.mkdtemp(prefix="lodestone-")
    else:
        parts = urlsplit(base)
        if parts.scheme not in ("", "file"):
            raise ValueError(f"files that databases open by their path can't lie in {base}")
        path = os.path.join(os.path.abspath(unquote(parts.path) if parts.scheme else base), f"lodestone-{uuid.uuid4().hex}")
        os.makedirs(path)
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path
