"""Staged batches of vectors as NumPy archives: ids, vectors, error_ids and error_messages in each."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.sources.files import store_file


def save_batch(folder: str, name: str, ids: list[str], vectors: np.ndarray, errors: dict[str, str]) -> int:
    """Write one archive, which appears whole or not at all. For use in tasks."""
    out = io.BytesIO()
    dim = np.asarray(vectors).shape[-1] if len(ids) else 0
    np.savez(out, ids=np.array(ids, str), vectors=np.asarray(vectors, np.float32).reshape(len(ids), dim), error_ids=np.array(list(errors), str), error_messages=np.array(list(errors.values()), str))
    return store_file(folder, name, [out.getvalue()], check=None)


def _rows(frames):
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"], strict=True):
            with np.load(io.BytesIO(content), allow_pickle=False) as z:
                good, bad = z["ids"].tolist(), z["error_ids"].tolist()
                vectors = [*z["vectors"].astype(np.float32).tolist(), *[None] * len(bad)]
                yield pd.DataFrame({"file": path, "photo_id": good + bad, "vector": vectors, "error": [None] * len(good) + z["error_messages"].tolist()})


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """file, photo_id, vector and error of all archives in a folder; a row has a vector or an error."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(folder).select("path", "content")
    return found.mapInPandas(_rows, "file string, photo_id string, vector array<float>, error string").withColumn("file", F.substring_index("file", "/", -1))
