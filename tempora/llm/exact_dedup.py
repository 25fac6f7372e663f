"""Exact deduplication against a persistent digest index (DataFrame operations only).

The index is a Parquet table, bucketed and sorted by the SHA-256 of the text, one row per distinct
text.  A batch of documents is grouped by digest (partial sums first, so a text that fills a third
of the batch costs one row per task), the groups go through a sort-merge anti-join against the
index, and what is new is appended in the index's own buckets with the name of its batch.  A batch that runs again after
a failure finds its own rows by that name: they are still its own.  A small file beside the table keeps where it is and
how many buckets it has; ``compact`` writes it anew with as many as its size asks for, one sorted file each.

Defined results: a null text counts as empty; of equal texts in one batch the row with the largest
id stays (nulls last); rows that repeat an id together with the text are ties, of which exactly one
stays; a text that the index already held is kept by nobody in the batch, and ``keep_id`` names the
document that brought it; an empty batch gives no rows and leaves the index as it is.  Columns of
the input never clash with the operator's, which works on its own projection.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import documents, fresh_name, scratch, written
from tempora.session import delete_path, hadoop_fs, list_dirs, read_text, scratch_path, write_text

#: Rows that a bucket of a compacted index has at most, and appends after which it is compacted.
BUCKET_ROWS, APPENDS = 4_000_000, 16
BUCKETS = 64
_COLUMNS = "text_sha256 string, keep_id long, group_size long, batch string"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 text; null as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class DigestIndex:
    """Table ``text_sha256, keep_id, group_size, batch``, bucketed and sorted by ``text_sha256``, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, folder: str, buckets: int):
        self.spark, self.path, self.folder, self.buckets = spark, path, folder, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} ({_COLUMNS}) USING parquet CLUSTERED BY (text_sha256) "
                  f"SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{path}/{folder}'")

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None, buckets: int | None = None) -> DigestIndex:
        """A new empty index below the shared folder; by default with as many buckets as a shuffle has
        partitions, ``BUCKETS`` at least: then a task writes one bucket."""
        buckets = buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        index = cls(spark, path or scratch_path(spark, "digest_index"), uuid.uuid4().hex, buckets)
        index._point()
        return index

    @classmethod
    def attach(cls, spark: SparkSession, path: str, buckets: int | None = None) -> DigestIndex:
        """An index that an earlier application wrote to ``path``.  The number of buckets is kept with it; a
        different one would read other digests than were written there, so it is refused."""
        kept = read_text(spark, f"{path}/_index")
        if kept is None:
            raise ValueError(f"there is no digest index in {path}")
        where = json.loads(kept)
        if buckets is not None and buckets != where["buckets"]:
            raise ValueError(f"the index in {path} has {where['buckets']} buckets, not {buckets}")
        return cls(spark, path, where["folder"], where["buckets"])

    def _point(self) -> None:
        write_text(self.spark, f"{self.path}/_index", json.dumps({"folder": self.folder, "buckets": self.buckets}))

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forget the table and delete its files; what was computed from it must have been written before."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.path)

    def _save(self, rows: DataFrame) -> None:
        (rows.select("text_sha256", "keep_id", "group_size", "batch").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "text_sha256").sortBy("text_sha256").saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)

    def _files(self) -> int:
        fs, p = hadoop_fs(self.spark, f"{self.path}/{self.folder}")
        return sum(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(p)) if fs.exists(p) else 0

    def append(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               name: str | None = None) -> DataFrame:
        """Add the batch's new texts; returns the table of its groups: ``text_sha256, keep_id, group_size, fresh``.

        ``name``: of the batch, the same when it runs again (by default no batch ever runs again)."""
        name = name or uuid.uuid4().hex
        groups = written(batch.select(F.col(id_col).cast("long").alias("id"), digest(F.col(text_col)).alias("text_sha256"))
                         .groupBy("text_sha256").agg(F.max("id").alias("own"), F.count("*").alias("group_size")),
                         "digest_groups")
        self.add(groups.select("text_sha256", F.col("own").alias("keep_id"), "group_size"), name)
        return (groups.drop("own").join(self.table().drop("group_size"), "text_sha256")
                .select("text_sha256", "keep_id", "group_size", (F.col("batch") == name).alias("fresh")))

    def add(self, groups: DataFrame, name: str) -> None:
        """Append those of ``groups(text_sha256, keep_id, group_size)``, one per digest, that the index lacks."""
        # one row per digest: dealt to the index's buckets, no key is hot
        fresh = (groups.repartition(self.buckets, "text_sha256")
                 .join(self.table().hint("merge"), "text_sha256", "left_anti"))
        self._save(fresh.withColumn("batch", F.lit(name)))
        if self._files() > APPENDS * self.buckets:
            self.compact()

    def compact(self, rows_per_bucket: int = BUCKET_ROWS) -> None:
        """Write the index anew: a sorted file per bucket, and twice as many buckets as long as one has too many rows.
        Readers go by the file that names the folder, which is written last."""
        buckets = self.buckets
        rows = self.table().count()
        while rows > buckets * rows_per_bucket:
            buckets *= 2
        old, old_name = self.folder, self.name
        fresh = DigestIndex(self.spark, self.path, uuid.uuid4().hex, buckets)
        fresh._save(self.table().repartition(buckets, "text_sha256"))
        self.name, self.folder, self.buckets = fresh.name, fresh.folder, buckets
        self._point()
        self.spark.sql(f"DROP TABLE IF EXISTS {old_name}")
        for folder in list_dirs(self.spark, self.path):  # and what a crashed compaction left
            if folder == old or folder != self.folder:
                delete_path(self.spark, f"{self.path}/{folder}")


def mark(batch: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
         name: str | None = None) -> DataFrame:
    """One row per row of the batch: ``<id_col>, keep_id, group_size, kept, text_sha256``."""
    return mark_batches(batch, F.lit(0), [name or uuid.uuid4().hex], index, id_col, text_col)


def mark_batches(rows: DataFrame, nth: Column, names: list[str], index: DigestIndex, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``mark`` of rows that arrive in batches, ``nth`` telling the batch of a row by its place in ``names``;
    ``group_size`` counts the rows of all of them.

    The digests are taken and grouped once for all batches, which then go to the index one after the other."""
    spark = rows.sparkSession
    with scratch(spark):
        # numbered as they are written: of rows that repeat an id and a text the lowest number stays
        rows = written(rows.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("text_sha256"),
                                   nth.cast("int").alias("nth"), F.monotonically_increasing_id().alias("row")),
                       "digest_rows")
        who = F.struct(F.col("id").cast("long").alias("id"), (-F.col("row")).alias("row"))
        of = [F.col("nth") == k for k in range(len(names))]
        groups = written(rows.groupBy("text_sha256").agg(
            F.count("*").alias("group_size"), *[F.max(F.when(b, who)).alias(f"own{k}") for k, b in enumerate(of)],
            *[F.count(F.when(b, 1)).alias(f"n{k}") for k, b in enumerate(of)]), "digest_groups")
        for k, name in enumerate(names):
            index.add(groups.filter(f"n{k} > 0").select("text_sha256", F.col(f"own{k}.id").alias("keep_id"),
                                                        F.col(f"n{k}").alias("group_size")), name)
        # the row that stays: of the batch that brought the text, its own one
        stays = F.coalesce(*[F.when(F.col("batch") == name, -F.col(f"own{k}.row")) for k, name in enumerate(names)],
                           F.lit(-1).cast("long"))
        keys = groups.select("text_sha256", F.col("group_size").alias("size"),
                             *[f"own{k}" for k in range(len(names))])
        keys = written(keys.join(index.table().drop("group_size"), "text_sha256").select(
            "text_sha256", "keep_id", F.col("size").alias("group_size"), stays.alias("stays")), "digest_marks")
        # a hot digest is split by the engine's skew join: the keys have one row per digest
        return written(rows.join(keys, "text_sha256").select(
            F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("stays")).alias("kept"),
            "text_sha256"), "digest_marks", outer=True)


def deduplicated(batch: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
                 name: str | None = None) -> DataFrame:
    """The rows of the batch that stay, with all their columns.

    Joined on (digest, id), which no group of copies makes hot."""
    with scratch(batch.sparkSession):
        keys = written(index.append(batch, id_col, text_col, name).filter("fresh"), "digest_marks", outer=True)
    sha, keep = fresh_name(batch, "llm_sha"), fresh_name(batch, "llm_keep")
    keys = keys.select(F.col("text_sha256").alias(sha + "k"), F.col("keep_id").alias(keep))
    named = batch.withColumn(sha, digest(F.col(text_col)))
    hit = named.join(keys, (F.col(sha) == F.col(sha + "k"))
                     & F.col(id_col).cast("long").eqNullSafe(F.col(keep)), "left_semi")
    return hit.dropDuplicates([sha, id_col]).drop(sha)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table in two batches, the larger ids first, so that of equal texts the largest id is in the index when the
    others come: what the second batch repeats of the first the anti-join removes."""
    docs = documents(spark, sf_dir)
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    index = DigestIndex.create(spark)
    try:
        lower = F.when(F.col("doc_id") > F.lit(middle), 0).otherwise(1)
        return mark_batches(docs, lower, ["upper", "lower"], index)
    finally:
        index.drop()


OP3_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size,
       doc_id IS NOT DISTINCT FROM keep_id
         AND row_number() OVER (PARTITION BY text_sha256, doc_id) = 1 AS kept,
       text_sha256
FROM d JOIN g USING (text_sha256)
"""
