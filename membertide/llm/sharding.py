"""Sharding by a two-pass external shuffle, with DataFrame functions alone.

Pass one scatters every row to a bucket of its shard by seeded hashes; the number of buckets
follows the measured size, so a bucket fits in memory. Pass two takes a bucket as one array,
shuffles it (Spark's ``shuffle`` is a Fisher-Yates shuffle) and writes it. A row's slot is its place
in its bucket plus the rows of the shard's buckets before it.

The shard follows the law ``key``: of all shards the one with the highest hash of id and shard
number, so the id and the shard count decide, and one more shard takes rows only into itself.

Null text: size 8, checksum of the empty text. A null id hashes like a value of its own. Rows that
repeat stay as they are, spread over the buckets. A very long text is one row of one bucket, which is then larger.
Empty table: no rows. Other columns may be carried; the operator's own names are refused among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BYTES = 8 << 20
#: Bytes an entry takes in memory besides its text.
ROW_BYTES = 200
LAW = "key"
#: Columns of the operator's own.
NAMES = ("shard", "bucket", "size", "place", "slot")


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """The shard with the highest hash for this key."""
    ranked = [F.struct(F.xxhash64(key, F.lit(s), F.lit(seed)).alias("h"), F.lit(s).alias("s")) for s in range(shards)]
    return (F.greatest(*ranked) if shards > 1 else ranked[0])["s"]


def text_size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint") + 8


def scatter(docs: DataFrame, shards: int, seed: int, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """The rows with shard and bucket, and the number of buckets of each shard."""
    size = text_size(F.col(text)).alias("size")
    total = docs.select(size).agg(F.sum(F.col("size") + ROW_BYTES)).first()[0] or 0
    buckets = max(1, -(-total // (shards * BUCKET_BYTES)))
    place = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), F.col(doc_id)), F.lit(buckets)).cast("int")
    return docs.withColumns({"shard": shard_of(F.col(doc_id), shards, seed), "bucket": place, "size": size}), buckets


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> None:
    """Shuffled rows of all shards at ``path``/rows by shard and bucket, bucket sizes at ``path``/buckets.

    There are as many tasks as buckets, so a task has few of them on its heap whatever the size.
    """
    if taken := [c for c in docs.columns if c.lower() in NAMES]:
        raise ValueError(f"rename {taken}, which are the operator's own names")
    rows, buckets = scatter(docs, shards, seed, doc_id, text)
    columns = [c for c in rows.columns if c not in ("shard", "bucket")]
    boxed = rows.select("shard", "bucket", F.struct(*[f"`{c}`" for c in columns]).alias("row"))
    dealt = boxed.repartition(shards * buckets, "shard", "bucket")
    shuffled = dealt.groupBy("shard", "bucket").agg(F.shuffle(F.collect_list("row"), F.lit(seed)).alias("rows"))
    placed = shuffled.select("shard", "bucket", F.posexplode("rows").alias("place", "row"))
    placed.select("shard", "bucket", "place", "row.*").write.parquet(f"{path}/rows")
    written = docs.sparkSession.read.parquet(f"{path}/rows").groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    written.write.parquet(f"{path}/buckets")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The written rows with their slot; a shard's slots run from 0 without gaps."""
    # one row per bucket: thousands of documents each
    before = spark.read.parquet(f"{path}/buckets").selectExpr(
        "shard AS of_shard", "bucket AS of_bucket", "sum(n) OVER (PARTITION BY shard ORDER BY bucket) - n AS before"
    )
    rows = spark.read.parquet(f"{path}/rows")
    joined = rows.join(before, (F.col("shard") == F.col("of_shard")) & (F.col("bucket") == F.col("of_bucket")))
    return joined.withColumn("slot", F.col("before") + F.col("place")).drop("of_shard", "of_bucket", "before", "place", "bucket")
