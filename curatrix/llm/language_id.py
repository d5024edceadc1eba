"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed byte n-grams of length 1 to 3, scaled to length 1. Each language has a few
centroids from spherical k-means. A text gets the language of the centroid with the largest cosine, and is rejected when that
cosine is far below what windows of the same length of known texts of that language reach.
The model is fitted on a bounded sample; every text is predicted whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm.common import crc32_of_id, doc_rows, slices

DIM = 4096
CENTROIDS = 4
#: Labelled documents per language that the model is fitted on, at most.
SAMPLE = 300
#: A text is rejected below this share of the cosine that all but one in fifty windows of its length reach.
REJECT_SHARE = 0.5
LENGTH_BINS = 16
UNKNOWN = "und"


#: Bytes of a text whose n-grams are counted at once.
COUNTED = 1 << 20


def _counts(texts: list[bytes]) -> np.ndarray:
    """Counts of hashed n-grams, a row for each text."""
    out = np.zeros((len(texts), DIM), np.float32)
    for i, text in enumerate(texts):
        padded = b" " + text + b" "
        for at in range(0, len(padded), COUNTED):
            # the n-grams that begin in this part of the text
            b = np.frombuffer(padded[at : at + COUNTED + 2], np.uint8).astype(np.uint32)
            two = b[:-1] | (b[1:] << np.uint32(8))
            three = two[:-1] | (b[2:] << np.uint32(16))
            codes = np.concatenate([b[:COUNTED], two[:COUNTED] + np.uint32(1 << 24), three[:COUNTED] + np.uint32(2 << 24)])
            out[i] += np.bincount((codes * np.uint32(2654435761)) >> np.uint32(20), minlength=DIM)
    return out


def _vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    v = np.log1p(_counts(texts)) * idf
    return v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-12)


def _lower(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8", "replace")


def _bin(n: int) -> int:
    return min(LENGTH_BINS - 1, max(n, 1).bit_length())


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their centroids (CENTROIDS rows each), and the least cosine by language and length bin."""

    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray
    floor: np.ndarray

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text the language's number, the cosine of its nearest centroid, and whether it is too far."""
        cosine = (_vectors(texts, self.idf) @ self.centroids.T).reshape(len(texts), len(self.languages), -1).max(axis=2)
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
        return best, score, score < self.floor[best, [_bin(len(t)) for t in texts]]


def _spread(frame: pd.DataFrame) -> pd.DataFrame:
    """How many texts of a language have each n-gram."""
    counts = _counts([_lower(t) for t in frame["text"]])
    return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "n": [len(frame)], "df": [(counts > 0).sum(axis=0).astype(np.float32).tobytes()]})


def _cluster(frame: pd.DataFrame, idf: np.ndarray, centroids: int, seed: int = 3) -> pd.DataFrame:
    """Centroids of a language and the cosines that windows of its texts fall short of but seldom."""
    texts = [_lower(t) for t in frame.sort_values("text")["text"]]
    v = _vectors(texts, idf)
    rng = np.random.default_rng(seed)
    c = v[rng.choice(len(v), centroids, replace=len(v) < centroids)]
    for _ in range(12):
        of = (v @ c.T).argmax(axis=1)
        for k in range(centroids):
            if (of == k).any():
                c[k] = v[of == k].mean(axis=0)
        c /= np.maximum(np.sqrt((c * c).sum(axis=1, keepdims=True)), 1e-12)
    floor = np.zeros(LENGTH_BINS, np.float32)
    for b in range(2, LENGTH_BINS):
        size = (1 << b) - 1
        windows = []
        for t in texts:
            if len(t) >= size:
                at = int(rng.integers(0, len(t) - size + 1))
                windows.append(t[at : at + size])
        if len(windows) >= 20:
            floor[b] = REJECT_SHARE * np.quantile((_vectors(windows, idf) @ c.T).max(axis=1), 0.02)
        else:
            floor[b] = floor[b - 1]
    floor[2:] = np.minimum(floor[2:], np.concatenate([[floor[2]], floor[2:-1]]))  # a bin holds texts down to half its size
    return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "centroids": [c.astype(np.float32).tobytes()], "floor": [floor.tobytes()]})


def fit(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> LanguageModel | None:
    """A model from text and non-null lang of the rows whose crc32(doc_id as text) mod 4 is not 2; None if there are none.

    The sample: the rows are dealt into `sample` cells by a hash of their id, and each cell gives one per language."""
    known = doc_rows(docs, "doc_id", "text", "lang").where("lang is not null and text is not null").where(crc32_of_id() % 4 != 2)
    hashed = F.xxhash64("doc_id")
    picked = known.groupBy("lang", F.pmod(hashed, F.lit(sample)).alias("cell")).agg(F.min(F.struct(hashed.alias("h"), "doc_id")).alias("m")).select("lang", F.col("m.doc_id").alias("doc_id"))
    # at most `sample` ids per language: their size is bounded by the parameter
    texts = known.join(F.broadcast(picked), ["doc_id", "lang"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    texts = texts.where(F.col("text").rlike(r"\p{L}")).drop("doc_id").persist()
    spread = texts.groupBy("lang").applyInPandas(_spread, "lang string, n long, df binary").collect()
    if not spread:
        return None
    df = np.sum([np.frombuffer(r.df, np.float32) for r in spread], axis=0)
    idf = (np.log((1 + sum(r.n for r in spread)) / (1 + df)) + 1).astype(np.float32)
    fitted = sorted(texts.groupBy("lang").applyInPandas(partial(_cluster, idf=idf, centroids=centroids), "lang string, centroids binary, floor binary").collect(), key=lambda r: r.lang)
    texts.unpersist()
    return LanguageModel(tuple(r.lang for r in fitted), idf, np.concatenate([np.frombuffer(r.centroids, np.float32).reshape(centroids, DIM) for r in fitted]), np.stack([np.frombuffer(r.floor, np.float32) for r in fitted]))


def _predict(batches, model):
    model = model.value
    for whole in batches:
        for batch in slices(whole, "text", 1 << 20):
            texts = batch.column("text").to_pylist()
            lang, score, far = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            at = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model else []
            for lo in range(0, len(at), 256):
                part = at[lo : lo + 256]
                best, cosine, rejected = model.predict([_lower(texts[i]) for i in part])
                score[part], far[part] = cosine, rejected
                for i, k in zip(part, best, strict=True):
                    lang[i] = model.languages[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(lang), pa.array(score), pa.array(far)], [*(c for c in batch.schema.names if c != "text"), "lang_pred", "score", "rejected"])


def identify(spark: SparkSession, docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for every row of docs(doc_id, text).

    `und`, score 0 and rejected if the text is null or has no letter, or there is no model. score: cosine, 0 to 1.
    Equal texts get equal results. A null doc_id counts as the empty text in held_out. No rows: no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = doc_rows(docs, "doc_id", "text").withColumn("held_out", crc32_of_id() % 4 == 2)
    shipped = spark.sparkContext.broadcast(model)
    return rows.mapInArrow(partial(_predict, model=shipped), f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(spark: SparkSession, docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The rows of docs, all columns as they are, whose language isn't rejected."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    flat = plain.withColumn("text", F.col(text)).drop(text)
    schema = ", ".join(f"{c} {flat.schema[c].dataType.simpleString()}" for c in flat.columns if c != "text")
    shipped = spark.sparkContext.broadcast(model)
    kept = flat.withColumn("c_text", F.col("text")).mapInArrow(partial(_predict, model=shipped), f"{schema}, c_text string, lang_pred string, score double, rejected boolean").where("not rejected")
    return kept.select(*(F.col("c_text" if c == text else c).alias(o) for c, o in zip(names, docs.columns, strict=True)))
