"""Files as relations, and sorted, byte-stable outputs."""

from __future__ import annotations

import fnmatch
import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.functions.text import base_name, stem
from curatrix.operators.grouping import numbered
from curatrix.scratch import Scratch


class Folder:
    """A folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path  # each look-up of the class is several calls to the JVM
        self._fs = self._p().getFileSystem(spark._jsc.hadoopConfiguration())

    def _p(self, name: str = ""):
        return self._path(f"{self.path}/{name}".rstrip("/"))

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._p(name))

    def names(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._p(name))) if self.exists(name) else []

    def rename(self, to: str) -> None:
        """Move the whole folder to a place where nothing is."""
        target = self._path(to)
        self._fs.mkdirs(target.getParent())
        if self._fs.exists(target) or not self._fs.rename(self._p(), target):
            raise OSError(f"{self.path} can't be moved to {to}")

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._p(name), True)

    def write_text(self, name: str, text: str) -> None:
        out = self._fs.create(self._p(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, name: str) -> str:
        source = self._fs.open(self._p(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()


class ImageError(ValueError):
    """An image isn't what it should be."""


def whole_jpeg(content: bytes) -> None:
    """A JPEG file begins and ends with its markers; a file that was cut off doesn't. Pixels are not decoded."""
    if not content.startswith(b"\xff\xd8") or not content.rstrip(b"\0").endswith(b"\xff\xd9"):
        raise ImageError("not a whole JPEG file")


def _arrow_store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def store_file(folder: str, name: str, chunks: Iterable[bytes], expected: int | None = None, check: Callable[[bytes], None] | None = whole_jpeg) -> int:
    """Write a file under a temporary name, check its length and content, then rename it; returns its bytes. For use in tasks.

    Nothing is left under the temporary name, whatever happens."""
    system, root = _arrow_store(folder)
    system.create_dir(root, recursive=True)
    part, content = f"{root}/{name}.part", b"".join(chunks)
    try:
        with system.open_output_stream(part) as out:
            out.write(content)
        if expected is not None and len(content) != expected:
            raise ImageError(f"{name}: {len(content)} of {expected} bytes came")
        if check is not None:
            check(content)
        system.move(part, f"{root}/{name}")
        return len(content)
    finally:
        if system.get_file_info(part).type != pa.fs.FileType.NotFound:
            system.delete_file(part)


def delete_files(names: DataFrame, column: str, folder: str) -> int:
    """Delete the named files of a folder by tasks; returns how many names there were. One that is gone already is no error, since a task may run again."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _arrow_store(folder)
        for frame in frames:
            for name in frame[column]:
                for at in (f"{root}/{name}", f"{root}/.{name}.crc"):  # with the checksum that Hadoop's local store may have made
                    try:
                        system.delete_file(at)
                    except FileNotFoundError:
                        continue
            yield pd.DataFrame({"n": [len(frame)]})

    dealt = names.select(column).repartition(names.sparkSession.sparkContext.defaultParallelism)  # few bytes, but a deletion for each
    return dealt.mapInPandas(work, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def images(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """image_file, photo_id and length of the images that are in a folder now; contents aren't read.

    A task lists the folder and its rows are written, so no name comes to the driver, and reading them takes tasks by bytes and not by images.
    Where tasks can't open the store, Spark lists the folder."""
    kind = "image_file string, photo_id string, length long"
    if not Folder(spark, folder).exists():
        return spark.createDataFrame([], kind)
    try:
        _arrow_store(folder)
    except (ValueError, pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        if not Folder(spark, folder).names():
            return spark.createDataFrame([], kind)
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        name = base_name(F.col("path"))
        return files.select(name.alias("image_file"), stem(name).alias("photo_id"), "length")

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _arrow_store(folder)
        for frame in frames:
            found = system.get_file_info(pa.fs.FileSelector(root)) if len(frame) else []
            for at in range(0, len(found), 10_000):
                named = [(f.base_name, f.size) for f in found[at : at + 10_000] if f.type == pa.fs.FileType.File and f.base_name[0] not in "._" and fnmatch.fnmatchcase(f.base_name, pattern)]
                yield pd.DataFrame(named, columns=["image_file", "length"]).astype({"image_file": object, "length": "int64"})

    found = spark.range(1).coalesce(1).mapInPandas(listed, "image_file string, length long")
    return Scratch(spark, "listed").keep(found.select("image_file", stem(F.col("image_file")).alias("photo_id"), "length"), "images")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)


#: Where a Parquet footer has the encodings of a column chunk: row groups, columns, meta_data, encodings.
_ENCODINGS = (4, 1, 3, 2)
#: Bytes of a row group. With 128 MB, Spark's default, a JVM that writes many files at once makes smaller ones of its own accord, so bytes would depend on how many tasks there are.
GROUP_BYTES = 1 << 25


def steady_footer(footer: bytes) -> bytes:
    """A Parquet footer with the encodings of each column chunk in order, of the same length.

    Parquet's writer lists them in the order of a hash set of enum values, which differs from one JVM to the next: without this the same rows written by two executors are
    different bytes. The fields before and after are stepped over (Thrift's compact protocol)."""
    out, at = bytearray(footer), 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = footer[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    def step(kind: int, path: tuple[int, ...]) -> None:
        nonlocal at
        if kind == 12:  # a struct
            field = 0
            while head := footer[at]:
                at += 1
                field = field + (head >> 4) if head >> 4 else number() >> 1
                if head & 15 > 2:  # true and false are in the head
                    step(head & 15, (*path, field))
            at += 1
        elif kind in (9, 10):  # a list or set
            head, at = footer[at], at + 1
            n, first = head >> 4 if head >> 4 < 15 else number(), at
            for _ in range(n):
                step(head & 15, path)
            if path == _ENCODINGS:  # of a byte each
                out[first:at] = bytes(sorted(footer[first:at]))
        elif kind == 11:  # a map
            n = number()
            if n:
                kinds, at = footer[at], at + 1
                for _ in range(n):
                    step(kinds >> 4, (*path, 0))
                    step(kinds & 15, (*path, 0))
        elif kind == 8:  # bytes
            n = number()
            at += n
        elif kind in (1, 2, 3, 7):
            at += 8 if kind == 7 else 1
        else:
            number()

    step(12, ())
    return bytes(out)


def _move_steady(system: pa.fs.FileSystem, source: str, to: str) -> None:
    """Move a Parquet file; if its footer isn't the steady one, it is copied, in blocks, and then deleted. For use in tasks."""
    part = f"{to.rpartition('/')[0]}/_{to.rpartition('/')[2]}.part"
    with system.open_input_file(source) as held:
        size = held.size()
        held.seek(size - 8)
        tail = held.read(8)
        head = size - 8 - int.from_bytes(tail[:4], "little")
        held.seek(head)
        old = held.read(size - 8 - head)
        new = steady_footer(old)
        if new != old:
            held.seek(0)
            with system.open_output_stream(part) as out:
                for at in range(0, head, 1 << 22):
                    out.write(held.read(min(1 << 22, head - at)))
                out.write(new + tail)
    if new == old:
        system.move(source, to)
    else:
        system.move(part, to)
        system.delete_file(source)


def _rename_steady(folder: Folder, source: str, to: str) -> None:
    """The same by the driver, whose buffers the bytes go through, in a store that tasks can't open."""
    held = folder._fs.open(folder._p(source))
    try:
        size = folder._fs.getFileStatus(folder._p(source)).getLen()
        held.seek(size - 8)
        tail = bytes(held.readNBytes(8))
        head = size - 8 - int.from_bytes(tail[:4], "little")
        held.seek(head)
        old = bytes(held.readNBytes(size - 8 - head))
        new = steady_footer(old)
        if new != old:
            held.seek(0)
            out = folder._fs.create(folder._p(f"{source}.part"), True)
            try:
                hadoop = folder.spark._jvm.org.apache.hadoop
                hadoop.io.IOUtils.copyBytes(hadoop.util.LimitInputStream(held, head), out, folder.spark._jsc.hadoopConfiguration(), False)
                out.write(bytearray(new + tail))
            finally:
                out.close()
    finally:
        held.close()
    if not folder._fs.rename(folder._p(source if new == old else f"{source}.part"), folder._p(to)):
        raise OSError(f"{source} can't be moved to {to}")
    if new != old:
        folder.delete(source)


def _single(df: DataFrame, folder: Folder, name: str, kind: str) -> None:
    """One file of this name, with the rows in order; the same rows give the same bytes."""
    staging = f"_{name.replace('/', '_')}.parts"
    writer = df.coalesce(1).write.mode("overwrite")
    (writer.option("parquet.block.size", GROUP_BYTES).parquet if kind == "parquet" else writer.option("header", True).option("escape", '"').csv)(f"{folder.path}/{staging}")
    part = next(n for n in folder.names(staging) if n.startswith("part-"))
    folder.delete(name)
    if kind == "parquet":
        _rename_steady(folder, f"{staging}/{part}", name)
    else:
        folder._fs.rename(folder._p(f"{staging}/{part}"), folder._p(name))
    folder.delete(staging)


def write_sorted(df: DataFrame, folder: Folder, name: str, *order: str) -> None:
    """One sorted file by one task, for small outputs that people read. `write_parts` and `write_ranged` are for tables of any size."""
    _single(df.orderBy(*order), folder, name, name.rpartition(".")[2])


def write_ranged(df: DataFrame, path: str, *order: str) -> None:
    """Sorted files, each a range of the order: no task gets all rows."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


#: Rows of a part of a large sorted output. Which rows a part has depends on it and on the order alone.
PART_ROWS = 1_000_000


def _move_parts(folder: Folder, staging: str, name: str, kind: str, n: int) -> None:
    """The only file of each of n folders _part=0, _part=1 ... to its place; by tasks, since there may be very many, where the store is one that tasks can open."""
    try:
        _arrow_store(folder.path)
    except (ValueError, pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        for part in range(n):
            found = next(x for x in folder.names(f"{staging}/_part={part}") if x.startswith("part-"))
            source, to = f"{staging}/_part={part}/{found}", f"{name}/part-{part:05d}.{kind}"
            if kind == "parquet":
                _rename_steady(folder, source, to)
            else:
                folder._fs.rename(folder._p(source), folder._p(to))
        return
    path = folder.path

    def move(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _arrow_store(path)
        for frame in frames:
            for part in frame["id"]:
                to = f"{root}/{name}/part-{part:05d}.{kind}"
                held = system.get_file_info(pa.fs.FileSelector(f"{root}/{staging}/_part={part}"))
                found = [f.path for f in held if f.base_name.startswith("part-")]
                if found and kind == "parquet":
                    _move_steady(system, found[0], to)
                elif found:
                    system.move(found[0], to)
                elif system.get_file_info(to).type == pa.fs.FileType.NotFound:  # else an attempt before this one has moved it
                    raise FileNotFoundError(f"{staging}/_part={part} has no file")
                for f in held:  # checksums of a local store
                    if f.base_name.endswith(".crc") and found:
                        system.delete_file(f.path)
            yield frame

    if n:
        folder.spark.range(n).mapInPandas(move, "id long").write.format("noop").mode("overwrite").save()


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a sorted Parquet file, or of a folder of `write_parts`, with `place`: each row's place in it, from 0, however many tasks read it."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    part = F.coalesce(F.regexp_extract("_file", r"/part-(\d+)\.parquet$", 1).try_cast("int"), F.lit(0))
    rows = rows.withColumn("_part", part).drop("_file")
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))  # a row for each part
    ahead = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(F.broadcast(sizes.select("_part", ahead.alias("_ahead"))), "_part").withColumn("place", F.col("_ahead") + F.col("_index")).drop("_part", "_index", "_ahead")


def write_parts(df: DataFrame, folder: Folder, name: str, *order: str, kind: str = "parquet", rows: int = PART_ROWS) -> int:
    """Files part-00000, part-00001 ... of `rows` rows each in a folder of this name, sorted; returns how many.

    The order has to tell rows apart. The same rows then give the same files, whatever the number of tasks, and no task sees more than a part.
    No rows: one empty part. CSV parts have no header."""
    staging = f"_{name}.parts"
    placed = numbered(df.withColumn("_order", F.struct(*order)), "_order", "_row").withColumn("_part", F.floor(F.col("_row") / rows).cast("int"))
    writer = placed.repartition("_part").sortWithinPartitions("_part", "_row").select(*df.columns, "_part").write.mode("overwrite").partitionBy("_part")
    (writer.option("parquet.block.size", GROUP_BYTES).parquet if kind == "parquet" else writer.option("header", False).option("escape", '"').csv)(f"{folder.path}/{staging}")
    folder.delete(name)
    folder._fs.mkdirs(folder._p(name))
    n = len([x for x in folder.names(staging) if x.startswith("_part=")])
    _move_parts(folder, staging, name, kind, n)
    if not n and kind == "parquet":
        _single(df, folder, f"{name}/part-00000.parquet", kind)
    elif not n:
        folder.write_text(f"{name}/part-00000.{kind}", "")
    folder.delete(staging)
    return max(n, 1)


def join_parts(folder: Folder, parts: str, name: str, head: str = "") -> None:
    """One file of a head and all parts in order, for people; bytes are copied through a buffer."""
    jvm, conf = folder.spark._jvm, folder.spark._jsc.hadoopConfiguration()
    out = folder._fs.create(folder._p(name), True)
    try:
        out.write(bytearray(head.encode()))
        for part in folder.names(parts):
            source = folder._fs.open(folder._p(f"{parts}/{part}"))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            finally:
                source.close()
    finally:
        out.close()


#: Bytes of a file that Spark may take as one value, of which a task holds several copies; larger ones are streamed.
WHOLE = 1 << 23


def _streamed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = []
        for path in frame["path"]:
            store, at = _arrow_store(path)
            digest = hashlib.sha256()
            with store.open_input_stream(at) as source:
                while chunk := source.read(1 << 22):
                    digest.update(chunk)
            found.append(digest.hexdigest())
        yield frame.assign(sha256=found)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes and SHA-256 of each file of a folder, or of one file, each hashed by one task; of large files a block at a time, where the store is one that tasks can open."""
    try:
        _arrow_store(path)
        most = WHOLE
    except (ValueError, pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        most = (1 << 31) - 1
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    small = files.where(F.col("length") <= most).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > most).select("path", F.col("length").alias("bytes")).mapInPandas(_streamed, "path string, bytes long, sha256 string")
    return small.unionByName(large).select(name.alias("file"), "bytes", "sha256")


def checksum(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file's bytes; of a folder, that of its files' names and checksums in order."""
    rows = checksums(spark, path).orderBy("file")
    if not Folder(spark, path)._fs.getFileStatus(Folder(spark, path)._p()).isDirectory():
        return rows.first().sha256
    lines = rows.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file", "sha256"))), lambda x: F.concat(x["file"], F.lit(":"), x["sha256"])), "\n"), 256))
    return lines.first()[0]  # of a line for each part


def content_hash(df: DataFrame) -> str:
    """A hash of rows that doesn't depend on their order."""
    row = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    total = df.select(F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)").alias("h")).agg(F.sum("h")).first()[0]
    return str(total or 0)


def write_json(folder: Folder, name: str, value: dict) -> None:
    folder.write_text(name, json.dumps(value, indent=2) + "\n")


def read_json(folder: Folder, name: str) -> dict:
    return json.loads(folder.read_text(name))
