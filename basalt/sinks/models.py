"""MLlib models as folders: written beside their place first, then put there by renaming."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def save_model(spark: SparkSession, model: PipelineModel, path: str) -> str:
    """Write a fitted pipeline to ``path``, replacing what is there.

    The old model stays in place until the new one is whole, so a writer that dies leaves a model
    to read; one that dies between the two renames leaves both as ``path`` with a suffix.
    """
    path = path.rstrip("/")
    mark = uuid.uuid4().hex[:8]
    new, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    model.write().save(new)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at = hadoop(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    replaced = fs.exists(at) and fs.rename(at, hadoop(old))
    if not fs.rename(hadoop(new), at):
        raise OSError(f"cannot move the model to {path}")
    if replaced:
        fs.delete(hadoop(old), True)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
