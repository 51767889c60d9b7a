"""Adapters from the driver's parquet tables to the library's data model.

* ``keyword_facts``  — the keyword fact table ``kw`` (events ⋈ customer).
* ``modal_texts``    — texts of any modality (documents, conversations, benchmark).
* ``video_payloads`` — raw video metadata records derived from ``documents``.

Only the columns a query needs are selected, so parquet scans prune columns;
``nation`` is replaced by a fixed 25-row code table (broadcast: proven bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kwpulse.functions import dims

BASE_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC, base of derived createTime values


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, c_nationkey, c_mktsegment). The customer side grows with the
    data, so it is *not* hinted; AQE broadcasts it only when its runtime size is
    under the broadcast threshold and otherwise keeps a (skew-split) sort-merge
    join. Kept a plain scan so the planner's size estimate is the scan's."""
    return read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")


def with_nation_code(df: DataFrame, key: str = "c_nationkey") -> DataFrame:
    """Add ``code`` (ISO-2 of the nation): a 25-row fixed table, broadcast (proven bound).

    Applied after the fact-customer join: joining it to customer first would make
    the planner's size estimate of that side the product of both inputs."""
    codes = F.broadcast(dims.nation_codes_df(df.sparkSession))
    return df.join(codes, F.col(key) == codes.nationkey, "inner").drop("nationkey")


def keyword_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword fact table ``kw`` (schema ``schemas.KW``), derived per FIXTURES B1.

    NULLs, dirty region spellings, invalid/empty JSON and text-valued counts are
    planted by fixed rules on ``event_id`` so every quirk of the reference meets data.
    """
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    cust = customer_dim(spark, sf_dir)
    e = F.col("event_id")
    play = F.when(e % 19 == 0, F.lit(0)).otherwise((e * 13) % 9000 + 1000).cast("string")
    play_json = F.when(e % 59 == 0, F.concat(F.lit('"'), play, F.lit('"'))).otherwise(play)
    stats_json = F.concat(
        F.lit('{"diggCount":'), ((e * 7) % 1000).cast("string"),
        F.lit(',"commentCount":'), ((e * 3) % 100).cast("string"),
        F.lit(',"shareCount":'), (e % 50).cast("string"),
        F.lit(',"collectCount":'), (e % 70).cast("string"),
        F.lit(',"playCount":'), play_json, F.lit("}"))
    stats = (F.when(e % 41 == 0, F.lit(None).cast("string"))
             .when(e % 43 == 0, F.lit("not json"))
             .when(e % 47 == 0, F.lit("{}"))
             .otherwise(stats_json))
    region = (F.when(e % 31 == 0, F.lit(None).cast("string"))
              .when(e % 53 == 0, F.concat(F.lit(" "), F.lower("code"), F.lit(" ")))
              .otherwise(F.col("code")))
    return (with_nation_code(ev.join(cust, ev.user_id == cust.c_custkey, "inner"))
              .select(
                  F.col("user_id").cast("string").alias("video_id"),
                  F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("keyword"),
                  F.col("event_type").alias("modality"),
                  F.lit(1.0).alias("confidence"),
                  F.col("ts").alias("detected_at"),
                  F.when(e % 29 == 0, F.lit(None)).otherwise(F.col("ts")).alias("posted_at"),
                  region.alias("region"),
                  F.when(e % 37 == 0, F.lit(None).cast("string"))
                   .otherwise(F.col("c_mktsegment")).alias("category"),
                  stats.alias("stats")))


def modal_texts(spark: SparkSession, sf_dir: str,
                sources=("documents", "conversations", "benchmark")) -> DataFrame:
    """(video_id, modality, frame, text): the X4 input table, a bag union of sources."""
    parts = []
    if "documents" in sources:
        d = read_table(spark, sf_dir, "documents", "doc_id", "text")
        parts.append(d.select(F.col("doc_id").cast("string").alias("video_id"),
                              F.lit("caption").alias("modality"),
                              F.lit(None).cast("bigint").alias("frame"), "text"))
    if "conversations" in sources:
        c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
        parts.append(c.select(F.col("conv_id").cast("string").alias("video_id"),
                              F.col("role").alias("modality"),
                              F.col("turn").cast("bigint").alias("frame"), "text"))
    if "benchmark" in sources:
        b = read_table(spark, sf_dir, "benchmark", "item_id", "text")
        parts.append(b.select(F.col("item_id").cast("string").alias("video_id"),
                              F.lit("ocr").alias("modality"),
                              F.lit(None).cast("bigint").alias("frame"), "text"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def video_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw video metadata records (schema ``schemas.VIDEO`` + ``entry_id``).

    One record per document; fallbacks of the reference (empty ids, ``desc`` vs
    ``caption``, ``authorName`` vs ``author``, bad ``createTime``, missing stats)
    are planted by fixed rules on ``doc_id``.
    """
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    k = F.col("doc_id")
    null_s = F.lit(None).cast("string")
    sid = k.cast("string")
    created = (F.lit(BASE_EPOCH) + k * 3600).cast("string")
    region_of_lang = (F.when(F.col("lang") == "en", "US").when(F.col("lang") == "de", "DE")
                      .when(F.col("lang") == "fr", "FR").when(F.col("lang") == "es", "ES")
                      .otherwise(F.upper("lang")))
    categories = F.array(*[F.lit(c) for c in dims.COLLECTOR_CATEGORIES])
    music = F.when(k % 17 == 0, F.lit(None)).otherwise(F.struct(
        F.col("source").alias("title"),
        F.when(k % 5 == 0, F.upper("lang")).otherwise(null_s).alias("author"),
        F.when(k % 5 == 0, null_s).otherwise(F.col("lang")).alias("authorName")))
    stats = F.when(k % 10 == 0, F.lit(None)).otherwise(F.struct(
        (k % 70).alias("collectCount"), ((k * 3) % 100).alias("commentCount"),
        ((k * 7) % 1000).alias("diggCount"), ((k * 13) % 9000).alias("playCount"),
        (k % 50).alias("shareCount")))
    return d.select(
        k.alias("entry_id"),
        (F.when(k % 23 == 0, null_s).when(k % 11 == 0, F.lit("")).otherwise(sid)).alias("id"),
        null_s.alias("url"),
        F.when((k % 7 == 0) | (k % 13 == 0), F.col("text")).otherwise(null_s).alias("caption"),
        (F.when(k % 13 == 0, F.lit("")).when(k % 7 == 0, null_s)
          .otherwise(F.col("text"))).alias("desc"),
        null_s.alias("username"),
        F.when(k % 9 == 0, null_s).otherwise(region_of_lang).alias("region"),
        F.when(k % 8 == 0, F.lit("")).otherwise(
            F.element_at(categories, (k % len(dims.COLLECTOR_CATEGORIES) + 1).cast("int"))
        ).alias("category"),
        (F.when(k % 3 == 0, null_s).when(k % 19 == 0, F.lit("0"))
          .when(k % 29 == 0, F.lit("abc")).otherwise(created)).alias("createTime"),
        null_s.alias("playAddr"),
        music.alias("music"),
        stats.alias("stats"),
        F.struct(F.when(k % 23 == 0, null_s).otherwise(F.concat(F.lit("v"), sid)).alias("id"),
                 F.concat(F.lit("https://video.invalid/"), sid).alias("playAddr"),
                 (F.lit(BASE_EPOCH) + k * 60).cast("string").alias("createTime")).alias("video"),
        F.struct(F.concat(F.lit("user"), (k % 97).cast("string")).alias("uniqueId")).alias("author"),
    )
