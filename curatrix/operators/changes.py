"""Keyed tables that change without being rewritten: bases in buckets, change files, merged on read and compacted by bucket.

A commit writes only the rows that change, and a new state that names them. A reader takes unchanged buckets as they are and, in the others, the newest change
of each key instead of its row in the base. Compaction rewrites the buckets whose changes have grown; all others share their files with the versions before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from curatrix.operators.grouping import latest
from curatrix.operators.state import Tables

BUCKETS = 32
#: Changes of a bucket, as a share of its base, from which it is worth rewriting.
SHARE = 0.25


class ChangeTable:
    """One table under Tables, with a unique key that isn't null. Its entry in the state says

    buckets: into how many the key is hashed; base: for each bucket that has rows the number of the folder that has them, and how many;
    changes: folders of change files in commit order, each with the rows that it has for each bucket whose base doesn't hold them yet."""

    def __init__(self, tables: Tables, name: str, schema: StructType, key: str, buckets: int = BUCKETS) -> None:
        self.tables, self.name, self.schema, self.key, self._buckets = tables, name, schema, key, buckets
        extra = [StructField("_bucket", IntegerType()), StructField("_gone", BooleanType()), StructField("_order", LongType())]
        self._changes = StructType([*schema.fields, *extra])

    @property
    def spark(self):
        return self.tables.spark

    def parts(self) -> dict:
        """What the state says of the table."""
        return self.tables.state().get(self.name) or {"buckets": self._buckets, "last": 0, "base": {}, "changes": []}

    def _bucketed(self, df: DataFrame, parts: dict) -> DataFrame:
        return df.withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(parts["buckets"])).cast("int"))

    def _base(self, parts: dict, buckets: set[int]) -> DataFrame:
        found = [f"{self.tables.root}/{self.name}/base{parts['base'][str(b)][0]:06d}/_bucket={b}" for b in sorted(buckets) if str(b) in parts["base"]]
        return self.spark.read.schema(self.schema).parquet(*found) if found else self.spark.createDataFrame([], self.schema)

    def _newest(self, parts: dict, buckets: set[int]) -> DataFrame:
        """The newest change of each key in these buckets. A folder may have changes of other buckets, and some that a base holds."""
        found = self.spark.createDataFrame([], self._changes)
        for folder, rows in parts["changes"]:
            wanted = sorted(int(b) for b in rows if int(b) in buckets)
            if wanted:
                found = found.unionByName(self.spark.read.schema(self._changes).parquet(f"{self.tables.root}/{self.name}/change{folder:06d}").where(F.col("_bucket").isin(wanted)))
        return latest(found, self.key, "_order")

    def _merged(self, parts: dict, buckets: set[int]) -> DataFrame:
        changed = {int(b) for _, rows in parts["changes"] for b in rows} & buckets
        out = self._base(parts, buckets - changed)
        if not changed:
            return out
        new = self._newest(parts, changed)
        kept = self._base(parts, changed).join(new.select(self.key), self.key, "left_anti").select(*self.schema.names)
        return out.unionByName(kept).unionByName(new.where(~F.col("_gone")).select(*self.schema.names))

    def read(self) -> DataFrame:
        """The table as the newest state has it. What was read stays as it is when the table changes, until vacuum."""
        parts = self.parts()
        return self._merged(parts, set(range(parts["buckets"])))

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The rows of these keys. Buckets that have none of them aren't read."""
        parts = self.parts()
        wanted = self._bucketed(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct(), parts)
        buckets = {r._bucket for r in wanted.select("_bucket").distinct().collect()}  # one row a bucket at most
        return self._merged(parts, buckets).join(wanted.select(self.key), self.key, "left_semi").select(*self.schema.names)

    def write(self, rows: DataFrame | None = None, gone: DataFrame | None = None) -> int:
        """Commit these rows in place of those of the same keys, and take away the rows of the keys in `gone`; returns how many changes were written.

        Of a key in both the row stays. Rows with a null key are refused."""
        with self.tables.writing():
            parts, state = self.parts(), self.tables.state()
            number = parts["last"] + 1
            empty = self.spark.createDataFrame([], self.schema)
            new = (empty if rows is None else rows.select(*self.schema.names)).withColumn("_gone", F.lit(False))
            if gone is not None:
                lost = gone.select(self.key).distinct().join(new.select(self.key), self.key, "left_anti").withColumn("_gone", F.lit(True))
                new = new.unionByName(lost, allowMissingColumns=True)
            key = F.when(F.col(self.key).isNull(), F.raise_error(F.lit(f"{self.name}: a null key"))).otherwise(F.col(self.key))
            new = self._bucketed(new.withColumn(self.key, key), parts).withColumn("_order", F.lit(number).cast("long"))
            folder = f"{self.tables.root}/{self.name}/change{number:06d}"
            new.select(*self._changes.names).write.mode("overwrite").parquet(self._draft(folder))
            written = self.spark.read.schema(self._changes).parquet(self._draft(folder))
            told = written.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(self.key).alias("keys")).collect()  # one row a bucket
            if any(r.n != r.keys for r in told):
                raise ValueError(f"{self.name}: a key has two rows")
            if not told:
                return 0
            self._move(folder)
            parts["last"], parts["changes"] = number, [*parts["changes"], [number, {str(r._bucket): r.n for r in told}]]
            self.tables.publish(state | {self.name: parts})
            return sum(r.n for r in told)

    def change(self, incoming: DataFrame, f: Callable[[DataFrame], DataFrame]) -> int:
        """Commit what f makes of the rows of the incoming keys, with nobody writing in between. f gets these rows only, so what it returns are changes."""
        with self.tables.writing():
            return self.write(f(self.rows_of(incoming)))

    def compact(self, share: float = SHARE) -> list[int]:
        """Rewrite the buckets whose changes are at least this share of their base; returns them."""
        with self.tables.writing():
            parts, state = self.parts(), self.tables.state()
            grown: dict[int, int] = {}
            for _, rows in parts["changes"]:
                for b, n in rows.items():
                    grown[int(b)] = grown.get(int(b), 0) + n
            due = {b for b, n in grown.items() if n >= share * parts["base"].get(str(b), [0, 0])[1]}
            if not due:
                return []
            number = parts["last"] + 1
            folder = f"{self.tables.root}/{self.name}/base{number:06d}"
            merged = self._bucketed(self._merged(parts, due), parts).repartition("_bucket").sortWithinPartitions("_bucket", self.key)
            merged.write.mode("overwrite").partitionBy("_bucket").parquet(self._draft(folder))
            kept = {r._bucket: r.n for r in self.spark.read.schema(self._changes).parquet(self._draft(folder)).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
            self._move(folder)
            base = {b: v for b, v in parts["base"].items() if int(b) not in due} | {str(b): [number, n] for b, n in kept.items()}
            changes = [[c, {b: n for b, n in rows.items() if int(b) not in due}] for c, rows in parts["changes"]]
            self.tables.publish(state | {self.name: parts | {"last": number, "base": base, "changes": [c for c in changes if c[1]]}})
            return sorted(due)

    def vacuum(self) -> int:
        """Delete the folders that the newest state doesn't name; returns how many. Older reads can't go on after it."""
        with self.tables.writing():
            parts = self.parts()
            named = {f"base{n:06d}" for n, _ in parts["base"].values()} | {f"change{n:06d}" for n, _ in parts["changes"]}
            old = [n for n in self.tables._names(self.name) if n not in named]
            for n in old:
                self.tables._fs.delete(self.tables._path(self.name, n), True)
            return len(old)

    def _draft(self, folder: str) -> str:
        head, _, last = folder.rpartition("/")
        return f"{head}/.{last}-{self.tables._lease:08d}"

    def _move(self, folder: str) -> None:
        """From the draft, which is this writer's own, to where the state will say; only while the lease is held."""
        self.tables.fence()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        self.tables._fs.delete(path(folder), True)  # of a commit that failed after this step
        if not self.tables._fs.rename(path(self._draft(folder)), path(folder)):
            raise OSError(f"{folder} can't be written")
