"""Keyed tables that a running query changes in place of rewriting them: merge on read.

A table is a base in buckets of the key's hash, and one folder of net changes per micro-batch, so a batch writes what it changes and no more.
Reading takes the newest change of a key, or its row in the base. Every ``every`` batches the changes are merged into the buckets they
touch: those buckets get a new folder, all others keep theirs; then merged changes and replaced buckets are dropped.

Nothing of a batch depends on when it runs: its folder of changes is overwritten by a replay, and a merge that finished is not
done again. What a replay may still read is dropped one merge later.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.sources.files import child_names, drop, exists
from tablewright.streaming.feeds import run_available

_BATCH, _UPTO, _BUCKET = "batch=", "upto=", "bucket="


class KeyedTable:
    """A table of unique, non-NULL ``key`` under the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType, buckets: int = 64, every: int = 8):
        self.spark, self.path, self.key, self.schema, self.buckets, self.every = spark, path, key, schema, buckets, every

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write_base(self, rows: DataFrame, upto: int, others: dict[int, int]) -> None:
        """Write buckets, then the manifest (bucket, upto) of all buckets: a merge is done when that is there.

        A large bucket is several files, each written by a task of its own, so that no task sorts a whole bucket.
        """
        folder = f"{self.path}/base/{_UPTO}{upto}"
        placed = rows.select(*self.schema.names).withColumn("bucket", self._bucket()).hint("rebalance", F.col("bucket"))
        placed.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        mine = {int(n.removeprefix(_BUCKET)): upto for n in child_names(self.spark, folder) if n.startswith(_BUCKET)}
        manifest = self.spark.createDataFrame(list((others | mine).items()), "bucket int, upto int")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{_UPTO}{upto}")

    def create(self, rows: DataFrame) -> KeyedTable:
        """Write the first base, unless it is there already."""
        if not self._numbers("manifest", _UPTO):
            self._write_base(rows, -1, {})
        return self

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        names = [n for n in child_names(self.spark, f"{self.path}/{folder}") if n.startswith(prefix)]
        return sorted(int(n.removeprefix(prefix)) for n in names if exists(self.spark, f"{self.path}/{folder}/{n}/_SUCCESS"))

    def _manifest(self, upto: int) -> dict[int, int]:
        """bucket to the merge that wrote it, at most ``buckets`` rows."""
        rows = self.spark.read.schema("bucket int, upto int").parquet(f"{self.path}/manifest/{_UPTO}{upto}").collect()
        return {r["bucket"]: r["upto"] for r in rows}

    def _base(self, manifest: dict[int, int]) -> DataFrame:
        folders = [f"{self.path}/base/{_UPTO}{n}/{_BUCKET}{bucket}" for bucket, n in sorted(manifest.items())]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _changes(self, after: int, upto: int) -> DataFrame | None:
        """(key, row) of the newest change of each key in the batches after ``after`` up to ``upto``."""
        found = [n for n in self._numbers("changes", _BATCH) if after < n <= upto]
        if not found:
            return None
        each = self.spark.read.schema(self.change_schema()).option("basePath", f"{self.path}/changes").parquet(
            *[f"{self.path}/changes/{_BATCH}{n}" for n in found]
        )
        return each.groupBy(self.key).agg(F.max_by(F.struct("row"), "batch").alias("last")).select(self.key, "last.row")

    def change_schema(self) -> StructType:
        return StructType([self.schema[self.key]]).add("row", self.schema).add("batch", "integer")

    def apply(self, net: DataFrame, batch_id: int) -> DataFrame:
        """Write a batch's net changes (key, row), as `operators.changes.net_changes` gives them; returns them as written."""
        row = F.when(F.col("row").isNotNull(), F.struct(*[F.col(f"row.{f.name}").cast(f.dataType).alias(f.name) for f in self.schema.fields]))
        folder = f"{self.path}/changes/{_BATCH}{batch_id}"
        net.select(self.key, row.alias("row")).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(StructType(self.change_schema().fields[:2])).parquet(folder)

    def read(self, upto: int | None = None) -> DataFrame:
        """The table after batch ``upto``, by default after the last one."""
        upto = 2**31 - 1 if upto is None else upto
        merged = [n for n in self._numbers("manifest", _UPTO) if n <= upto]
        if not merged:
            raise FileNotFoundError(f"no table in {self.path}")
        return self._overlaid(self._base(self._manifest(merged[-1])), self._changes(merged[-1], upto))

    def _overlaid(self, base: DataFrame, changes: DataFrame | None) -> DataFrame:
        if changes is None:
            return base
        kept = base.join(changes.select(self.key), self.key, "left_anti").select(*self.schema.names)
        return kept.unionByName(changes.where(F.col("row").isNotNull()).select("row.*").select(*self.schema.names))

    def merge(self, batch_id: int) -> None:
        """Merge all changes up to this batch into the buckets they touch, if it is due."""
        merged = self._numbers("manifest", _UPTO)
        if (batch_id + 1) % self.every or batch_id in merged:
            return
        last = max(n for n in merged if n < batch_id)
        before, changes = self._manifest(last), self._changes(last, batch_id)
        if changes is None:
            return
        touched = {r["b"] for r in changes.select(self._bucket().alias("b")).distinct().collect()}  # at most ``buckets``
        base = self._base({bucket: n for bucket, n in before.items() if bucket in touched})
        self._write_base(self._overlaid(base, changes), batch_id, {bucket: n for bucket, n in before.items() if bucket not in touched})
        self._drop_old(last, before, self._manifest(batch_id))

    def _drop_old(self, last: int, *manifests: dict[int, int]) -> None:
        """Drop what neither of the manifests needs: the newest one, and the one before it, made by merge ``last``."""
        for n in self._numbers("changes", _BATCH):
            if n <= last:
                drop(self.spark, f"{self.path}/changes/{_BATCH}{n}")
        for n in self._numbers("manifest", _UPTO):
            if n < last:
                drop(self.spark, f"{self.path}/manifest/{_UPTO}{n}")
        needed = {(n, bucket) for manifest in manifests for bucket, n in manifest.items()}
        for n in self._numbers("base", _UPTO):
            buckets = [int(name.removeprefix(_BUCKET)) for name in child_names(self.spark, f"{self.path}/base/{_UPTO}{n}") if name.startswith(_BUCKET)]
            for bucket in buckets:
                if (n, bucket) not in needed:
                    drop(self.spark, f"{self.path}/base/{_UPTO}{n}/{_BUCKET}{bucket}")


def keep_tables(feed: DataFrame, tables: Sequence[KeyedTable], step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Take all changes the stream ``feed`` has; ``step(batch, batch_id)`` applies a batch to the tables."""

    def run(batch: DataFrame, batch_id: int) -> None:
        # a batch is read by several tables of a step, its source files once
        batch = batch.persist()
        try:
            step(batch, batch_id)
            for table in tables:
                table.merge(batch_id)
        finally:
            batch.unpersist()

    run_available(feed.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint))


def keep_copy(
    facts: KeyedTable, people: KeyedTable, copy: KeyedTable, person: str, readable: Callable[[DataFrame, DataFrame], DataFrame], batch_id: int,
    fact_changes: DataFrame, people_changes: DataFrame,
) -> None:
    """One batch of a readable copy: net changes of facts and people, and the copy's rows they touch.

    ``readable(facts, people)`` joins names into fact rows. Facts of people that changed or went away are looked up among the stored facts; facts that
    changed are at hand. Only these rows of the copy are written.
    """
    fact_changes, people_changes = facts.apply(fact_changes, batch_id), people.apply(people_changes, batch_id)
    after, key = facts.read(batch_id), facts.key
    changed = fact_changes.where(F.col("row").isNotNull()).select("row.*").select(*after.columns)
    touched = fact_changes.select(key)
    if not people_changes.isEmpty():
        affected = after.join(people_changes.select(person), person, "left_semi").join(touched, key, "left_anti").select(*after.columns)
        changed, touched = changed.unionByName(affected), touched.unionByName(affected.select(key))
    rows = readable(changed, people.read(batch_id)).select(F.col(key).alias("_k"), F.struct(*copy.schema.names).alias("row"))
    copy.apply(touched.join(rows, touched[key] == rows["_k"], "left").select(key, "row"), batch_id)
