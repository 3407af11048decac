"""Exact deduplication against a persistent index of digests.

The index is a table bucketed and sorted by digest. New rows are reduced to one row per digest, the digests that
the index holds already are taken away by a sort-merge anti-join that reads the index in its buckets, and the
rest is appended. Everything is DataFrame functions; texts are read once and only their digests are shuffled.

A table is admitted in batches by falling id, so that the row that stays of each text is in the first batch that has it
and later batches find its digest in the index.

A null text counts as empty. Texts are equal when they are identical after lower-casing A-Z. Of equal texts the
one with the largest id stays, but a text that the index already held stays with the id it had then. Rows with a
null id are never preferred to others. Rows that repeat the same id and text count as one document, and
``keep_rows`` tells how many of them there are. An empty table gives an empty result and leaves the index as it
is. Columns other than id and text are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.columns import ascii_lower, join_groups
from starmart.session import check_warehouse_place, scratch_path
from starmart.sources.tables import buckets_of


def digest_of(text: Column) -> Column:
    """SHA-256 of the text with A-Z in lower case, in UTF-8."""
    return F.unhex(F.sha2(ascii_lower(text).cast("binary"), 256))


def digests(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest) of every row, written to the shared folder and read again."""
    spark = docs.sparkSession
    path = scratch_path(spark, "digests")
    docs.select(F.col(id).alias("id"), digest_of(F.col(text)).alias("digest")).write.parquet(path)
    return spark.read.parquet(path)


class DigestIndex:
    """A table of digests: (digest, keep_id, keep_rows, group_size), bucketed and sorted by digest."""

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None, path: str | None = None):
        """An index that is there, with the buckets it has, or a new one, at ``path`` or in the session's warehouse."""
        self._spark, self.name, self._path = spark, name, path
        self._buckets = buckets_of(spark, name)[0] if self.exists() else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    @classmethod
    def temporary(cls, spark: SparkSession) -> DigestIndex:
        """An index under a name and in a shared folder of its own."""
        return cls(spark, f"digest_index_{uuid.uuid4().hex}", path=scratch_path(spark, "digest-index"))

    def _write(self, groups: DataFrame, name: str) -> None:
        dealt = groups.repartition(self._buckets, "digest").write.mode("append").format("parquet")
        if self._path and name == self.name:
            dealt = dealt.option("path", self._path)
        elif not self.exists() or name != self.name:
            check_warehouse_place(self._spark, None)
        dealt.bucketBy(self._buckets, "digest").sortBy("digest").saveAsTable(name)

    def exists(self) -> bool:
        return self._spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self._spark.table(self.name)

    def admit(self, rows: DataFrame) -> None:
        """Append the digests of (id, digest) rows that the index doesn't hold yet.

        A batch that is admitted again, after a failure, adds nothing that is there.
        """
        same = rows.groupBy("digest", "id").agg(F.count("*").alias("rows"))
        groups = same.groupBy("digest").agg(
            F.max("id").alias("keep_id"),
            F.max_by("rows", F.struct(F.col("id").isNotNull(), "id")).alias("keep_rows"),
            F.sum("rows").alias("group_size"),
        )
        if self.exists():
            groups = groups.join(self.read().hint("merge"), "digest", "left_anti")
        self._write(groups, self.name)

    def compact(self) -> DigestIndex:
        """The same index with one sorted file for each bucket, under a new name."""
        place = self._path and f"{self._path}-{uuid.uuid4().hex[:8]}"
        other = DigestIndex(self._spark, f"{self.name}_{uuid.uuid4().hex[:8]}", self._buckets, place)
        other._write(self.read(), other.name)
        return other

    def look_up(self, rows: DataFrame) -> DataFrame:
        """(id, digest) rows with the index's columns; every row has its digest in the index.

        ``group_size`` counts the text's rows among these rows, whichever batches they came in.
        """
        path = scratch_path(self._spark, "groups")
        sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
        sizes.join(self.read().drop("group_size").hint("merge"), "digest").write.parquet(path)
        return join_groups(rows, self._spark.read.parquet(path), ["digest"], "group_size", rows.count())


#: Batches in which a table is admitted.
BATCHES = 2


def falling_batches(rows: DataFrame, batches: int) -> list[DataFrame]:
    """The rows in batches of falling ids, over equal ranges of ids; null ids are in the last one."""
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    if not isinstance(low, int) or high - low < batches:
        return [rows]
    marks = [low + (high - low) * k // batches for k in range(batches - 1, 0, -1)]
    parts, above = [], F.lit(False)
    for mark in marks:
        here = F.coalesce(F.col("id") >= mark, F.lit(False))
        parts.append(rows.filter(here & ~above))
        above = here
    return [*parts, rows.filter(~above)]


def deduplicate(docs: DataFrame, index: DigestIndex, *, id: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """One row per row of ``docs``: id, digest, keep_id, keep_rows, group_size, kept.

    The documents are admitted to the index first. ``group_size`` counts the rows of ``docs`` with the text.
    """
    rows = digests(docs, id=id, text=text)
    for batch in falling_batches(rows, batches):
        index.admit(batch)
    return index.look_up(rows).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
