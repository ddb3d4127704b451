"""Exact deduplication against a persistent digest index (operator 11).

The index is a Parquet table bucketed and sorted by digest, kept in a folder of its own;
it outlives the session (``DigestIndex.open``).  A delivery of documents is reduced to one
entry per digest (partial aggregation before the exchange, so a text with a third of the rows
costs one row a task), deduplicated against the index by a sort-merge anti-join, and
appended.  The index side of that join is read bucket by bucket and never exchanged.

Entries of digests that the index already has are appended too, marked ``first = false``:
they carry the tally and the best row of later deliveries, so that ``report`` over any
number of deliveries equals the report over one.  ``compact`` folds them together.

Texts are equal when they are identical without the characters of ``[\\x20\\x09-\\x0D]``
(null: empty), held by the SHA-256 of what is left.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import written
from hearth.llm.skew import join_groups
from hearth.session import scratch_path

#: The characters that do not count when texts are compared.
BLANKS = " \t\n\x0b\x0c\r"


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text without its blanks, in UTF-8 (null: of the empty text)."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANKS, ""), 256))


def _rank(chars: Column, key: Column, row: Column) -> Column:
    """Sorts first for the row that stays: most code points, then smallest id (null last), then first row."""
    return F.struct((-chars).alias("less_chars"), key.isNull().alias("no_id"), key.alias("id"), row.alias("row"))


@dataclass
class DigestIndex:
    """A persistent set of digests; make one with ``create`` or ``open``."""

    spark: SparkSession
    path: str
    buckets: int
    id_type: str

    @classmethod
    def create(cls, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int | None = None) -> DigestIndex:
        """An empty index under ``path``.

        ``buckets`` should grow with the texts expected (about 128 MB a bucket).  The default is the session's number
        of shuffle partitions: then the exchange of a delivery meets the buckets, one task a bucket.
        """
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        meta = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(id_type).alias("id_type"))
        meta.coalesce(1).write.parquet(f"{path}/meta")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DigestIndex:
        m = spark.read.schema("buckets int, id_type string").parquet(f"{path}/meta").first()
        index = cls(spark, path, m["buckets"], m["id_type"])
        index._register("entries")
        return index

    def _register(self, part: str) -> str:
        name = f"digest_index_{part}_" + md5(f"{self.path}/{part}".encode()).hexdigest()[:16]
        self.spark.sql(f"""
            CREATE TABLE IF NOT EXISTS {name} (
              digest BINARY, delivery STRING, first BOOLEAN, n_rows BIGINT,
              best STRUCT<less_chars: BIGINT, no_id: BOOLEAN, id: {self.id_type}, row: BIGINT>)
            USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS
            LOCATION '{self.path}/{part}'""")
        return name

    def _entries(self) -> DataFrame:
        return self.spark.table(self._register("entries"))

    def groups(self) -> DataFrame:
        """digest, group_size, best: one row per distinct text, aggregated inside the buckets (no exchange)."""
        return self._entries().groupBy("digest").agg(F.sum("n_rows").alias("group_size"), F.min("best").alias("best"))

    def ingest(self, rows: DataFrame, delivery: str) -> None:
        """Add the rows of ``keyed`` documents under the name of their delivery.

        A delivery that the index already holds adds nothing, so a job that is run again does no harm.
        """
        entries = self._entries()
        if not entries.filter(F.col("delivery") == delivery).isEmpty():
            return
        # written, for the planner would put the joins below the aggregate and move every row of a hot text
        batch = written(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n_rows"),
                                                   F.min(_rank(F.col("chars"), F.col("id"), F.col("row"))).alias("best")),
                        "digest-batch")
        known = entries.select("digest").hint("merge")
        new = batch.join(known, "digest", "left_anti").withColumn("first", F.lit(True))
        again = batch.join(known, "digest", "left_semi").withColumn("first", F.lit(False))
        add = new.unionByName(again).withColumn("delivery", F.lit(delivery))
        self._append("entries", written(add, "digest-delivery"))

    def _append(self, part: str, add: DataFrame) -> None:
        """One file a bucket and delivery, sorted by digest."""
        name = self._register(part)
        add.repartition(self.buckets, "digest").select(*self.spark.table(name).columns).write.insertInto(name)

    def new_digests(self, delivery: str) -> DataFrame:
        """The digests that came into the index with this delivery, and the best row of each."""
        return self._entries().filter((F.col("delivery") == delivery) & F.col("first")).select("digest", "best", "n_rows")

    def compact(self, path: str) -> DigestIndex:
        """A new index with one entry per digest, in one sorted file a bucket; later joins need no sort of many files."""
        out = DigestIndex.create(self.spark, path, self.id_type, self.buckets)
        folded = self.groups().select("digest", F.lit("compacted").alias("delivery"), F.lit(True).alias("first"),
                                      F.col("group_size").alias("n_rows"), "best")
        out._append("entries", folded)
        return out


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False,
          first_row: int = 0) -> DataFrame:
    """Written table of (row, id, digest, chars) for every row of ``docs``; with ``carry`` also the row itself as ``doc``.

    ``row`` is unique in the table and starts at ``first_row``; it tells repeated rows apart.
    Columns of ``docs`` live inside ``doc``, so none of their names can clash.
    """
    text = F.col(text_col)
    doc = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if carry else []
    return written(docs.select((F.monotonically_increasing_id() + F.lit(first_row)).alias("row"), F.col(id_col).alias("id"),
                               digest(text).alias("digest"),
                               F.char_length(F.coalesce(text.cast("string"), F.lit(""))).cast("long").alias("chars"), *doc),
                   "digest-rows")


def new_documents(index: DigestIndex, docs: DataFrame, delivery: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of a delivery to pass on: one per text that the index did not have; the index has them from then on.

    Of equal texts in the delivery, the one with the most code points in its original stays, then
    the smallest id (a null id last), then the first row.  Null texts are empty texts.  An empty
    delivery gives no rows; the columns are those of ``docs``.  A delivery name that was used
    before gives the documents that it brought then.
    """
    rows = keyed(docs, id_col, text_col, carry=True)
    index.ingest(rows, delivery)
    new = index.new_digests(delivery).select("digest", F.col("best.row").alias("row"))
    return rows.join(new, ["digest", "row"], "left_semi").select("doc.*")


def report(index: DigestIndex, rows: DataFrame) -> DataFrame:
    """id, keep_id, group_size, kept, sha256 of every row of ``keyed`` documents, over all deliveries so far.

    Exactly one row of each group is kept, also where an id is repeated.
    """
    groups = written(index.groups(), "digest-groups")
    j = join_groups(rows, groups, "digest", "group_size")
    return j.select("id", F.col("best.id").alias("keep_id"), "group_size", (F.col("best.row") == F.col("row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("sha256"))


#: Rows of later deliveries are numbered from here on, so that row numbers never meet.
DELIVERY_ROWS = 1 << 60


def audit(docs: DataFrame, deliveries: int = 2, buckets: int | None = None) -> DataFrame:
    """Every row of ``docs`` with the row that stays of its group: doc_id, keep_id, group_size, kept, text_sha256.

    The table comes to a fresh index in ``deliveries`` parts (at most 7) by a hash of the row's id, as new data
    does; the anti-join finds the copies of earlier parts, and the result does not depend on the number of parts.
    Null texts count as empty and null ids sort last; of wholly equal rows one is kept.  An empty
    table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    index = DigestIndex.create(spark, scratch_path(spark, "digest-index"), docs.schema["doc_id"].dataType.simpleString(), buckets)
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(deliveries))
    parts = []
    for k in range(deliveries):
        parts.append(keyed(docs.filter(part == k).select("doc_id", "text"), first_row=k * DELIVERY_ROWS))
        index.ingest(parts[-1], f"part-{k}")
    return report(index, reduce(DataFrame.unionByName, parts)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))
