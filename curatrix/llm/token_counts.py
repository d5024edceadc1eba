"""Token counts by scanning flat token files for the end-of-document identifier.

A token file is nothing but little-endian token identifiers, each document's followed by the separator; there is no index.
Files are read in blocks of bounded size. A block's separators are found with one vectorised comparison; a prefix scan over the
blocks of a file then says how many documents ended before each block and how many tokens of an open one it takes over.
"""

from __future__ import annotations

import base64
import re
import uuid
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.llm.common import doc_rows, slices
from curatrix.scratch import Scratch

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits text before merges; that of the public byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEPARATOR = 50256
DTYPE = "<u2"
#: Tokens in a file that the writer makes, and in a block that the scan reads.
FILE_TOKENS, BLOCK_TOKENS = 8 << 20, 1 << 20
#: Bytes of a vocabulary file that is sent to the executors, at most.
VOCABULARY_BYTES = 64 << 20

_encodings: dict = {}


def _open(uri: str):
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else Path(uri).absolute().as_uri())


def _encoding(key: str, ranks: bytes):
    import tiktoken

    if key not in _encodings:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encodings[key] = tiktoken.Encoding("curatrix", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return _encodings[key]


def _tokenize(batches, folder, vocabulary, key, separator):
    """Write flat files; tell which file each document went to and as which document of it."""
    encode = _encoding(key, vocabulary.value).encode_ordinary
    context = TaskContext.get()
    system, root = _open(folder)
    stem = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
    number, length, ordinal, out = 0, 0, 0, None
    for whole in batches:
        for batch in slices(whole, "text"):
            files, places = [], []
            for text in batch.column("text").to_pylist():
                if out is None:
                    name = f"{stem}-{number:05d}.bin"
                    out, length, ordinal = system.open_output_stream(f"{root}/{name}"), 0, 0
                tokens = np.array([*encode(text or ""), separator], DTYPE)
                out.write(tokens.tobytes())
                files.append(name)
                places.append(ordinal)
                length, ordinal = length + len(tokens), ordinal + 1
                if length >= FILE_TOKENS:
                    out.close()
                    out, number = None, number + 1
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(files, pa.string()), pa.array(places, pa.int64())], ["doc_id", "file", "ordinal"])
    if out is not None:
        out.close()


def write_tokens(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, separator: int = SEPARATOR) -> DataFrame:
    """Plan that tokenises docs(doc_id, text) to flat files in `folder` and returns (doc_id, file, ordinal).

    File names hold the task attempt: write the result once and read only the files it names. Null text has no tokens.
    `folder` must be one that executors share and that pyarrow can open."""
    content = Path(tokenizer).read_bytes()
    if len(content) > VOCABULARY_BYTES:
        raise ValueError(f"{tokenizer} has more than {VOCABULARY_BYTES} bytes")
    numbers = {int(line.split()[1]) for line in content.splitlines()}
    if separator in numbers or max(separator, *numbers) > np.iinfo(DTYPE).max:
        raise ValueError(f"separator {separator} is a token of {tokenizer}, or a number is above {np.iinfo(DTYPE).max}")
    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    work = partial(_tokenize, folder=folder, vocabulary=spark.sparkContext.broadcast(content), key=uuid.uuid4().hex, separator=separator)
    return doc_rows(docs, "doc_id", "text").mapInArrow(work, f"doc_id {kind}, file string, ordinal long")


def _scan(batches, separator, dtype, lengths):
    """Of each block its tokens, how many separators it holds and the last one; with `lengths`, a row for each separator instead:
    its number in the file and the tokens since the one before it, of which `open_from` says where the block's first document began."""
    width = np.dtype(dtype).itemsize
    names = ["path", "block", "start", "tokens", *(["done", "open_from", "is_last"] if lengths else [])]
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            path, block, start, tokens = row[:4]
            system, name = _open(path)
            with system.open_input_file(name) as f:
                ids = np.frombuffer(f.read_at(tokens * width, start * width), dtype)
            if len(ids) != tokens:
                raise ValueError(f"{path} ends within block {block}")
            at = np.flatnonzero(ids == separator).astype(np.int64) + start
            if not lengths:
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (path, block, start, tokens, len(at))] + [pa.array([int(at[-1]) if len(at) else None], pa.int64())], ["path", "block", "start", "tokens", "ended", "last"])
                continue
            done, open_from, is_last = row[4:]
            ends = np.append(at, start + tokens) if is_last and (not len(at) or at[-1] < start + tokens - 1) else at
            found = np.diff(ends, prepend=open_from - 1) - 1
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(ends), pa.string()), pa.array(done + np.arange(len(ends), dtype=np.int64)), pa.array(found)], ["path", "ordinal", "n_tokens"])


def count_tokens(spark: SparkSession, folder: str, separator: int = SEPARATOR, dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS, files: DataFrame | None = None) -> DataFrame:
    """path, ordinal and n_tokens (without the separator) of every document in the flat token files of a folder.

    Tokens after the last separator of a file are one more document. Empty files have none. A length that isn't a whole number of
    tokens is an error, and so is a separator that the type of the tokens can't hold. files, if given, has file, the names of the
    files to read; others in the folder, such as those of lost task attempts, are not opened.

    Executors read blocks on their own, so one file of any size spreads over all of them. A first pass tells only how many separators a
    block has and where the last is; the prefix scan goes over these few numbers, of which a file of 1 TB has half a million. A
    second pass reads each block again and, from what the scan says is open before it, tells the lengths.
    """
    width, most = np.dtype(dtype).itemsize, np.iinfo(np.dtype(dtype)).max
    if not 0 <= separator <= most:
        raise ValueError(f"separator {separator} isn't a {np.dtype(dtype).name}")
    found = spark.read.format("binaryFile").load(folder).select("path", "length").where("length > 0")
    if files is not None:
        found = found.withColumn("file", F.substring_index("path", "/", -1)).join(files.select("file").distinct(), "file", "left_semi")
    whole = F.when(F.col("length") % width == 0, F.floor(F.col("length") / width)).otherwise(F.raise_error(F.concat(F.lit("not a whole number of tokens: "), "path")).cast("long"))
    ranges = found.withColumn("n", whole).select("path", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block_tokens))).alias("block"))
    ranges = ranges.select("path", "block", (F.col("block") * block_tokens).alias("start"), F.least(F.lit(block_tokens), F.col("n") - F.col("block") * block_tokens).alias("tokens"))
    blocks = ranges.repartition(F.col("path"), F.col("block")).mapInArrow(partial(_scan, separator=separator, dtype=dtype, lengths=False), "path string, block long, start long, tokens long, ended long, last long")
    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    scanned = (
        blocks.withColumn("done", F.coalesce(F.sum("ended").over(before), F.lit(0)))
        .withColumn("open_from", F.coalesce(F.max(F.col("last") + 1).over(before), F.lit(0)))
        .withColumn("is_last", F.lead("block").over(order).isNull())
    )
    scanned = Scratch(spark, "blocks").keep(scanned.drop("ended", "last"), "scanned")
    return scanned.repartition(F.col("path"), F.col("block")).mapInArrow(partial(_scan, separator=separator, dtype=dtype, lengths=True), "path string, ordinal long, n_tokens long")


def document_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id and n_tokens for every row of docs(doc_id, text), counted in flat files that are written first.

    Null and empty texts have 0 tokens. Repeated rows give repeated results. The separator's text in a document is ordinary text.
    No rows: no rows."""
    scratch = Scratch(spark, "tokens")
    places = scratch.keep(write_tokens(spark, docs, f"{scratch.path}/files", tokenizer), "places")
    counts = count_tokens(spark, f"{scratch.path}/files", files=places).select(F.substring_index("path", "/", -1).alias("file"), "ordinal", "n_tokens")
    return places.join(counts.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")
