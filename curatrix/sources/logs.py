"""The append-only label log: JSON lines whose order decides which record of an id counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from curatrix.operators.grouping import latest
from curatrix.schemas import ENUMS, KEEP_GATE, LABELS, LOG_RECORD, NOT_APPLICABLE


class LabelLogError(ValueError):
    """The log can't be loaded; tables stay as they are."""


_PARSED = StructType([*LOG_RECORD.fields, StructField("_corrupt", StringType())])
_PLACE = "position struct<file: string, block: bigint, line: bigint>"


def parse_lines(lines: DataFrame) -> DataFrame:
    """The record of each line of (position, value), with position and _corrupt; blank lines are dropped."""
    full = lines.where(F.trim("value") != "")
    record = F.from_json("value", _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return full.select("position", record.alias("r")).select("position", "r.*")


def _files(spark: SparkSession, path: str) -> list[str]:
    """The file, or what a folder holds: files, and finished appends in their order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    if not system.getFileStatus(at).isDirectory():
        return [path]
    found = []
    for s in system.listStatus(at):
        name = s.getPath().getName()
        if name[0] not in "._" and (not s.isDirectory() or system.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))):
            found.append(s.getPath().toString())
    return sorted(found)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Records of a log, a file or a folder of appends, with their `position`, which orders them as they were written.

    The physical last line of a file may be malformed (a write that was cut off) and is then left out; any other malformed line is
    an error. Files of any size are read in blocks: a line's position is its file, where its block begins, and its place in the
    block's task. No file: no records.
    """
    files = _files(spark, path)
    if not files:
        return spark.createDataFrame([], StructType([*LOG_RECORD.fields, *StructType.fromDDL(_PLACE).fields]))
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(files)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = text.select(place.alias("position"), "value")
    parsed = parse_lines(lines)
    bad = parsed.where("_corrupt is not null").groupBy("position.file").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("file").limit(2).collect()
    for row in bad:
        here = lines.where(F.col("position.file") == row.file)
        at = F.struct(F.lit(row.first.file).alias("file"), F.lit(row.first.block).alias("block"), F.lit(row.first.line).alias("line"))
        before, after = here.agg(F.count_if(F.col("position") < at), F.count_if(F.col("position") > at)).first()
        if after:
            raise LabelLogError(f"line {before + 1} of {row.file} is not JSON")
    return parsed.where("_corrupt is null").drop("_corrupt")


def append(records: DataFrame, folder: str) -> None:
    """Add records as one further part of the log, after all that it has; a part that isn't finished isn't read.

    Within the part the rows' order is that of the DataFrame's partitions."""
    spark = records.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
    number = max((int(n[1:]) for n in names if n.startswith("b") and n[1:].isdigit()), default=0) + 1
    # whoever makes the claim writes the part
    while not system.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(at, f"_claim-{number:08d}")):
        number += 1
    records.drop("position").write.mode("error").json(f"{folder}/b{number:08d}")


def problems() -> Column:
    """What is wrong with a record, as an array: fields outside their vocabulary, no id, a kept gate without subject or modality."""
    told = [F.when(~F.coalesce(F.col(c).isin(*values), F.lit(False)), F.concat(F.lit(f"{c}="), F.coalesce(F.concat(F.lit("'"), c, F.lit("'")), F.lit("None")))) for c, values in ENUMS.items()]
    told.append(F.when(F.coalesce(F.col("photo_id"), F.lit("")) == "", F.lit("no photo_id")))
    idle = (F.col("subject") == NOT_APPLICABLE) | (F.col("modality") == NOT_APPLICABLE)
    told.append(F.when((F.col("gate_category") == KEEP_GATE) & idle, F.lit("kept with not_applicable")))
    return F.filter(F.array(*told), lambda x: x.isNotNull())


def project(records: DataFrame, position: str = "position") -> DataFrame:
    """The labels table from the log: the last record of each id. Any invalid one is an error that shows ten."""
    if not records.where("photo_id is null").isEmpty():
        raise LabelLogError("a record has no photo_id")
    last = latest(records, "photo_id", position).withColumn("problems", problems())
    wrong = last.where(F.size("problems") > 0).select("photo_id", "problems").orderBy("photo_id").limit(10).collect()
    if wrong:
        raise LabelLogError("; ".join(f"{r.photo_id}: {', '.join(r.problems)}" for r in wrong))
    return last.select(*LABELS.names)
