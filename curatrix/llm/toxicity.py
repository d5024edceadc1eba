"""Toxicity by compression distance.

Texts are dealt to clusters by their byte trigrams, so that texts of one vocabulary are compared with one another; no language is looked at. For each cluster two
zstandard dictionaries are made: one of its ordinary texts, one of the spans of its toxic texts that hold byte n-grams which are significantly more frequent there.
Short windows of a text are compressed with the ordinary dictionary of its cluster, and with that followed by the toxic one; the bytes the
latter saves are the distance. How large they are on average, at most, and in which shares of the windows, against the ordinary texts of the cluster, decides
by thresholds (a logistic curve) calibrated on whole labelled texts that no dictionary saw. All windows of the whole text count; they overlap, so that a word or
short phrase is whole in one of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.llm.common import crc32_of_id, doc_rows, slices
from curatrix.scratch import Scratch

#: Bytes of a window, and from one window to the next; what's no longer than their difference is whole in some window.
WINDOW, STEP = 48, 32
#: Bytes of the n-grams that toxic spans are made of; a longer one counts only where it holds no shorter one that does.
GRAMS = (5, 6, 7, 8, 9, 10)
#: A gram is toxic if it's in LEAST toxic texts, so many times as frequent there as in ordinary ones, and if chance would hardly share out its texts like that:
#: their number times the divergence of the share that is toxic from that of all texts.
LEAST, RATIO, EVIDENCE = 3, 5, 11.0
#: Marked grams of a model, at most, the most significant ones.
MARKED = 200_000
TOXIC_BYTES, ORDINARY_BYTES = 2048, 1024
#: Labelled texts of each label that the model is fitted on, at most; texts whose trigrams clusters are found from, and clusters, at most.
SAMPLE = {1: 2500, 0: 7000}
PROFILES, CLUSTERS, PROFILE_BITS = 2000, 8, 10
#: Texts of each label that a cluster needs to be one.
CLUSTER_LEAST = {1: 4, 0: 50}
#: Share of the sample that the dictionaries are trained on; the thresholds are calibrated on the rest.
TRAIN_SHARE = 0.8
#: Pieces of CHUNK bytes that a cluster's ordinary dictionary is trained on, drawn by hash from all pieces of its whole texts.
CHUNK, CHUNKS = 256, 8_000
#: Bytes of a long text that one step takes at once.
PART = 1 << 20
#: A string without any text's bytes, at the end of both dictionaries and the start of every window: a match that is always there,
#: so that no window is stored uncompressed.
ANCHOR = bytes(np.random.default_rng(0).integers(128, 256, 24, dtype=np.uint8))


def normal(text: str | None) -> bytes:
    return b" " + " ".join((text or "").lower().split()).encode("utf-8", "replace") + b" "


def _grams(text: bytes, size: int) -> np.ndarray:
    """The hash of each run of `size` bytes."""
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    m = max(len(a) - size + 1, 0)
    h = np.zeros(m, np.uint64)
    for k in range(size):
        h = h * np.uint64(257) + a[k : k + m]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64)


def _parts(text: bytes, over: int) -> list[bytes]:
    """A long text in parts that overlap by `over` bytes."""
    return [text[i : i + PART + over] for i in range(0, max(len(text) - over, 1), PART)]


def _spans(text: bytes, marked: dict[int, np.ndarray]) -> set[bytes]:
    """The distinct runs of bytes that toxic grams cover."""
    found = set()
    for part in _parts(text, max(GRAMS) - 1):
        covered, shorter = np.zeros(len(part) + 1, np.int32), []
        for size in GRAMS:
            grams, known = _grams(part, size), marked[size]
            if not len(grams) or not len(known):
                continue
            toxic = known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams
            own = toxic.copy()
            for n, counts in shorter:  # of a shorter toxic gram within
                at = np.arange(len(grams))
                own &= counts[np.minimum(at + size - n + 1, len(counts) - 1)] == counts[at]
            shorter.append((size, np.concatenate([[0], np.cumsum(toxic)])))
            at = np.flatnonzero(own)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + size, -1)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(covered)[:-1] > 0).astype(np.int8), [0]])))
        found |= {part[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)}
    return found


def profile(text: bytes) -> np.ndarray:
    """Roots of the numbers of hashed byte trigrams, as a unit vector."""
    counts = np.zeros(1 << PROFILE_BITS)
    for part in _parts(text, 2):
        a = np.frombuffer(part, np.uint8).astype(np.uint32)
        h = ((a[:-2] * np.uint32(65599) + a[1:-1]) * np.uint32(65599) + a[2:]) * np.uint32(2654435761)
        counts += np.bincount(h >> np.uint32(32 - PROFILE_BITS), minlength=len(counts))
    roots = np.sqrt(counts)
    return roots / max(np.linalg.norm(roots), 1e-12)


def _centroids(profiles: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from profiles that are far apart."""
    centres = profiles[:1]
    for _ in range(k - 1):
        centres = np.vstack([centres, profiles[(profiles @ centres.T).max(axis=1).argmin()]])
    for _ in range(12):
        of = (profiles @ centres.T).argmax(axis=1)
        centres = np.stack([profiles[of == j].mean(axis=0) if (of == j).any() else centres[j] for j in range(len(centres))])
        centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-12
    return centres


def _dictionary(samples: list[bytes], size: int, k: int) -> bytes:
    """Content of a trained dictionary; of too few samples to train on, the samples themselves."""
    samples = [s for s in samples if len(s) >= 8]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples * (1 + 20_000 // len(samples)), k=k, d=6).as_bytes()[-size * 9 // 10 :]
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionParameters(
        compression_level=3, window_log=14, chain_log=14, hash_log=14, search_log=3, min_match=5, strategy=zstandard.STRATEGY_LAZY2,
        write_checksum=False, write_content_size=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    return zstandard.ZstdCompressor(compression_params=own, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


Pair = tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]


@dataclass(frozen=True)
class ToxicityModel:
    """Clusters' centroids, the contents of their dictionaries (toxic, ordinary; equally long), what is usual in their ordinary texts, and the curve."""

    centroids: np.ndarray
    contents: tuple[tuple[bytes, bytes], ...]
    usual: np.ndarray
    spread: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def pairs(self) -> list[Pair]:
        return [(_compressor(ordinary), _compressor(toxic)) for toxic, ordinary in self.contents]

    def scores(self, clusters: np.ndarray, found: np.ndarray) -> np.ndarray:
        unusual = (found - self.usual[clusters]) / self.spread[clusters]
        z = np.c_[(unusual - self.mean) / self.scale, np.ones(len(unusual))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(text: bytes, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> tuple[float, ...]:
    """Saved bytes by window: mean, shares of windows with 3 and 5 at least, and the largest, of which 8 are enough."""
    plain, foul = ordinary.compress, toxic.compress
    saved = np.array([len(plain(w)) - len(foul(w)) for w in (ANCHOR + text[i : i + WINDOW] for i in range(0, max(len(text) - WINDOW + STEP, 1), STEP))], np.float64)
    return saved.mean(), (saved >= 3).mean(), (saved >= 5).mean(), min(saved.max(), 8.0)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(len(w)), z.T @ (y - p) - 0.05 * w)
    return mean, scale, w


def dictionaries(spans: list[bytes], chunks: list[bytes]) -> tuple[bytes, bytes]:
    """Contents of the dictionary of ordinary text followed by toxic spans, the first ones last, and of that of ordinary text alone, equally long."""
    foul = b""
    for span in spans:
        if len(foul) < TOXIC_BYTES and span not in foul:
            foul = span + foul
    foul, plain = foul[-TOXIC_BYTES:], _dictionary(chunks, ORDINARY_BYTES, 64)
    filler = bytes(np.random.default_rng(1).integers(128, 256, len(foul), dtype=np.uint8))
    return plain + foul + ANCHOR, plain + filler + ANCHOR


Batches = Iterator[pa.RecordBatch]


def _each(batches: Batches) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for whole in batches:
        for batch in slices(whole, "text"):
            yield batch, [normal(t) for t in batch.column("text").to_pylist()]


def _profiled(batches: Batches) -> Batches:
    for batch, texts in _each(batches):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([profile(t).tobytes() for t in texts], pa.binary())], ["doc_id", "profile"])


def _clustered(batches: Batches, centroids: np.ndarray) -> Batches:
    for batch, texts in _each(batches):
        clusters = [int((centroids @ profile(t)).argmax()) for t in texts]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "toxic", "train", "text")), pa.array(clusters, pa.int32())], ["doc_id", "toxic", "train", "text", "cluster"])


def _counted(batches: Batches, wanted: Broadcast | None = None) -> Batches:
    """Of each cluster and gram, how many texts of a step hold it; of the wanted grams (sorted), if there are such."""
    for batch, texts in _each(batches):
        kinds: dict[tuple[int, int], list[np.ndarray]] = {}
        for t, cluster in zip(texts, batch.column("cluster").to_pylist(), strict=True):
            for size in GRAMS:
                found = np.unique(np.concatenate([_grams(p, size) for p in _parts(t, size - 1)]))
                if wanted is not None:
                    known = wanted.value[cluster][size]
                    found = found[known[np.minimum(np.searchsorted(known, found), len(known) - 1)] == found] if len(known) else found[:0]
                kinds.setdefault((cluster, size), []).append(found)
        for (cluster, size), each in kinds.items():
            grams, n = np.unique(np.concatenate(each), return_counts=True)
            fixed = [pa.array(np.full(len(grams), x), pa.int32()) for x in (cluster, size)]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(grams), pa.array(n)], ["cluster", "size", "gram", "n"])


def _spanned(batches: Batches, marked: Marked) -> Batches:
    for batch, texts in _each(batches):
        clusters = batch.column("cluster").to_pylist()
        found = [(c, s) for t, c in zip(texts, clusters, strict=True) if c in marked for s in _spans(t, marked[c])]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int32()), pa.array([s for _, s in found], pa.binary())], ["cluster", "span"])


def _chunked(batches: Batches) -> Batches:
    for batch, texts in _each(batches):
        found = [(c, t[i : i + CHUNK]) for t, c in zip(texts, batch.column("cluster").to_pylist(), strict=True) for i in range(0, len(t), CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], ["cluster", "chunk"])


def _measured(batches: Batches, contents: Broadcast) -> Batches:
    by = [(_compressor(ordinary), _compressor(toxic)) for toxic, ordinary in contents.value]
    for batch, texts in _each(batches):
        found = [list(features(t, *by[c])) for t, c in zip(texts, batch.column("cluster").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "toxic", "cluster")), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "toxic", "cluster", "features"])


Marked = dict[int, dict[int, np.ndarray]]


def _by_cluster(grams: DataFrame, clusters: Iterable[int]) -> Marked:
    """By cluster and size the sorted grams of (cluster, size, gram), which come to the driver as columns."""
    rows = grams.select("cluster", "size", "gram").toArrow()
    cluster, size, gram = (rows.column(c).to_numpy() for c in ("cluster", "size", "gram"))
    return {c: {n: np.sort(gram[(cluster == c) & (size == n)]) for n in GRAMS} for c in clusters}


def _toxic_grams(spark: SparkSession, scratch: Scratch, train: DataFrame, texts: dict[int, tuple[int, int]]) -> Marked:
    """The toxic grams of the clusters' texts; texts: of each cluster how many are toxic, and ordinary.

    Only grams of as many toxic texts as the evidence needs at least, if no ordinary text has them, are looked for in ordinary ones."""

    def of(values: dict[int, float]) -> Column:
        return F.element_at(F.create_map(*(F.lit(x) for c, v in values.items() for x in (c, float(v)))), F.col("cluster"))

    def counts(rows: DataFrame, name: str, *wanted: Broadcast) -> DataFrame:
        return _mapped(rows, _counted, "cluster int, size int, gram long, n long", *wanted).groupBy("cluster", "size", "gram").agg(F.sum("n").alias(name))

    least = {c: max(LEAST, EVIDENCE / np.log((bad + good) / bad) if bad and good else np.inf) for c, (bad, good) in texts.items()}
    bad = scratch.keep(counts(train.where("toxic = 1"), "bad").where(F.col("bad") >= of(least)), "bad")
    good = counts(train.where("toxic = 0"), "good", spark.sparkContext.broadcast(_by_cluster(bad, texts)))
    both = bad.join(good, ["cluster", "size", "gram"], "left").fillna(0, ["good"])
    bads, goods = of({c: b for c, (b, _) in texts.items()}), of({c: g for c, (_, g) in texts.items()})
    n, share, usual = F.col("bad") + F.col("good"), F.col("bad") / (F.col("bad") + F.col("good")), bads / (bads + goods)
    rest = F.when(F.col("good") > 0, (1 - share) * F.ln((1 - share) / (1 - usual))).otherwise(0.0)
    told = both.where(share > usual).withColumn("evidence", n * (share * F.ln(share / usual) + rest))
    told = told.where((F.col("evidence") >= EVIDENCE) & (F.col("bad") / bads >= RATIO * F.col("good") / goods))
    return _by_cluster(told.orderBy(F.desc("evidence"), "cluster", "size", "gram").limit(MARKED), texts)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> ToxicityModel | None:
    """A model from the labelled documents whose crc32(doc_id as text) mod 5 is not 0; None unless there are two of each label to
    train on and two to calibrate with.

    The sample: for each label, ids are dealt into as many cells as it may have texts, and each cell gives one, of any length. Of
    several labels of an id the larger counts, of its texts the smallest. Grams and spans are counted by tasks, over whole texts. To the driver come
    PROFILES trigram profiles, hashes of the grams that enough toxic texts of the sample share, TOXIC_BYTES and CHUNKS pieces of a cluster, and four numbers for each calibration text.
    """
    cells = sample or SAMPLE
    known = doc_rows(labels, "doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").where(crc32_of_id() % 5 != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # only labels of documents that there are
    known = known.join(doc_rows(docs, "doc_id", "text").where("text is not null").select("doc_id"), "doc_id", "left_semi")
    h = F.xxhash64("doc_id")
    cell = F.pmod(h, F.when(F.col("toxic") == 1, cells[1]).otherwise(cells[0]))
    picked = known.groupBy("toxic", cell.alias("cell")).agg(F.min(F.struct(h.alias("h"), "doc_id")).alias("m")).select(F.col("m.doc_id").alias("doc_id"), "toxic")
    # sum(sample) ids at most
    ids = sorted(picked.collect(), key=lambda r: (r.toxic, r.doc_id))
    seen, parts = [0, 0], {(label, use): [] for label in (0, 1) for use in (True, False)}
    for r in ids:
        seen[r.toxic] += 1
        parts[r.toxic, int(seen[r.toxic] * TRAIN_SHARE) > int((seen[r.toxic] - 1) * TRAIN_SHARE)].append((r.doc_id, r.toxic))
    if min(map(len, parts.values())) < 2:
        return None

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = spark.createDataFrame([(i, y, use) for (_, use), part in parts.items() for i, y in part], f"doc_id {kind}, toxic int, train boolean")
    scratch = Scratch(spark, "toxicity")
    texts = doc_rows(docs, "doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "train").agg(F.min("text").alias("text"))
    texts = scratch.keep(texts, "texts")
    some = texts.where("train").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(PROFILES).mapInArrow(_profiled, f"doc_id {kind}, profile binary")
    profiles = np.stack([np.frombuffer(r.profile) for r in sorted(some.collect(), key=lambda r: r.doc_id)])
    centroids = _centroids(profiles, max(1, min(CLUSTERS, len(profiles) // 100)))

    def dealt(centroids: np.ndarray, name: str) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
        rows = scratch.keep(_mapped(texts, _clustered, f"doc_id {kind}, toxic int, train boolean, text string, cluster int", centroids), name)
        n = rows.where("train").groupBy("cluster").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).collect()  # CLUSTERS rows
        return rows, {r.cluster: (r.bad, r.good) for r in n}

    rows, sizes = dealt(centroids, "dealt")
    enough = sorted(c for c, (bad, good) in sizes.items() if bad >= CLUSTER_LEAST[1] and good >= CLUSTER_LEAST[0])
    if len(enough) < len(centroids):  # texts of a cluster that is too small go to the nearest of the others
        centroids = centroids[enough] if enough else profiles.mean(axis=0, keepdims=True)
        rows, sizes = dealt(centroids, "dealt again")
    train = rows.where("train")
    marked = _toxic_grams(spark, scratch, train, sizes)
    spans = _mapped(train.where("toxic = 1"), _spanned, "cluster int, span binary", marked).groupBy("cluster", "span").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    first = Window.partitionBy("cluster").orderBy(F.desc("n"), "span")
    spans = spans.withColumn("k", F.row_number().over(first)).where(F.col("k") <= TOXIC_BYTES).orderBy("cluster", "k").collect()
    chunks = _mapped(train.where("toxic = 0"), _chunked, "cluster int, chunk binary").withColumn("k", F.row_number().over(Window.partitionBy("cluster").orderBy(F.xxhash64("chunk"), "chunk")))
    chunks = chunks.where(F.col("k") <= CHUNKS).orderBy("cluster", "k").collect()
    by = lambda rows, name, c: [bytes(r[name]) for r in rows if r.cluster == c]
    contents = tuple(dictionaries(by(spans, "span", c), by(chunks, "chunk", c)) for c in range(len(centroids)))
    measured = _mapped(rows.where("not train"), _measured, f"doc_id {kind}, toxic int, cluster int, features array<double>", spark.sparkContext.broadcast(contents))
    told = sorted(measured.collect(), key=lambda r: r.doc_id)
    x, y, of = np.array([r.features for r in told]), np.array([r.toxic for r in told], float), np.array([r.cluster for r in told])
    plain = [x[(of == c) & (y == 0)] for c in range(len(centroids))]
    plain = [p if len(p) >= 10 else x[y == 0] for p in plain]
    usual, spread = np.stack([p.mean(axis=0) for p in plain]), np.stack([p.std(axis=0) + 1e-3 for p in plain])
    return ToxicityModel(centroids, contents, usual, spread, *_curve((x - usual[of]) / spread[of], y))


def _mapped(df: DataFrame, f: Callable, schema: str, *args: object) -> DataFrame:
    def run(batches: Batches) -> Batches:
        return f(batches, *args)

    return df.mapInArrow(run, schema)


def _score(batches: Batches, model: Broadcast) -> Batches:
    model = model.value
    pairs = model.pairs() if model else None
    for batch, texts in _each(batches):
        scores = np.zeros(len(texts))
        if model and texts:
            clusters = np.array([int((model.centroids @ profile(t)).argmax()) for t in texts])
            scores = model.scores(clusters, np.array([features(t, *pairs[c]) for t, c in zip(texts, clusters, strict=True)]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])


def score(spark: SparkSession, docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs(doc_id, text).

    A null text is scored like an empty one. Without a model every score is 0. Equal texts get equal scores.
    A null doc_id counts as the empty text in held_out. No rows: no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = doc_rows(docs, "doc_id", "text").withColumn("held_out", crc32_of_id() % 5 == 0)
    return _mapped(rows, _score, f"doc_id {kind}, held_out boolean, score double, predicted int", spark.sparkContext.broadcast(model))
