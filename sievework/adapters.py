"""The tables of the test data in the shapes of the store.

``orders`` become notices, ``documents`` their texts, ``benchmark`` the code dictionary and
``labels`` the labels and scores. Everything is lazy; only the authority map (ten names) is read.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.text import text_measures
from sievework.operators.containment import CodeDetector, code_detector
from sievework.operators.lexicon import Lexicon
from sievework.operators.scoring import doc_features
from sievework.session import allow_repeated_fields, spread_scan

URL_BASE = "https://example.org/notice?id="
AS_OF = "2001-08-01 00:00:00"        # last day of the notices
EVENTS_AS_OF = "2024-01-30 23:59:59"  # last day of the events

# Word lists for the invented vocabulary of the test texts.
TEST_LEXICON = Lexicon(
    key_terms={
        "the": 2.5, "and": 2.0, "that": 1.0, "for": 1.8, "was": 1.3,
        "with": 1.2, "this": 1.0, "are": 1.0, "from": 1.0, "than": 1.5,
    },
    terms=("ing", "ble", "tion", "ther", "thon"),
    heavy_terms=("ing", "ble"),
    phrases=("of the", "and the"),
)
N_AUTHORITIES = 10


# Declared, so that opening a table reads no file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """Lazy frames over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        allow_repeated_fields(spark)

    def raw(self, name: str) -> DataFrame:
        return spread_scan(self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet"))

    @cached_property
    def notices(self) -> DataFrame:
        key = F.col("o_orderkey")
        # The remainder by the number of parts reaches the whole table, each part about equally often.
        parts = self.raw("part").select("p_partkey", "p_name")
        n_parts = parts.agg(F.count(F.lit(1)).alias("n")).scalar()
        labels = self.raw("labels").select("doc_id", "toxic")
        customers = self.raw("customer").select("c_custkey", "c_nationkey", "c_name", "c_mktsegment")
        nations = self.raw("nation").select("n_nationkey", "n_name")
        joined = (
            self.raw("orders").withColumn("_part", key % n_parts)
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(parts, F.col("_part") == F.col("p_partkey"), "left")
            .join(labels, key == F.col("doc_id"), "left")
        )
        return joined.select(
            key.alias("resource_id"),
            F.concat_ws(" ", "o_orderpriority", "c_mktsegment", "c_name", F.year("o_orderdate").cast("string")).alias("title"),
            F.col("n_name").alias("ca"),
            F.when(key % 5 == 0, "").otherwise(F.col("p_name")).alias("info"),
            F.col("o_orderdate").alias("published"),
            (F.col("o_orderdate") + F.make_dt_interval((key % 60).cast("int"))).alias("deadline"),
            F.col("o_orderdate").alias("created_at"),
            F.when(F.col("o_orderstatus") == "O", "Open").when(F.col("o_orderstatus") == "F", "Closed")
            .otherwise("Awarded").alias("status"),
            F.col("c_mktsegment").alias("procedure"),
            F.when(key % 4 == 0, "").otherwise(F.concat(F.lit(URL_BASE), key.cast("string"))).alias("pdf_url"),
            F.when(key % 5 < 2, None).otherwise(F.col("o_totalprice").cast("decimal(15,2)")).alias("value"),
            F.lit("").alias("cycle"),
            F.col("toxic").alias("bid"),
        )

    @cached_property
    def doc_content(self) -> DataFrame:
        minutes = F.make_dt_interval(mins=(F.col("n_chars") % 4000).cast("int"))
        return self.raw("documents").select(
            F.col("doc_id").alias("resource_id"),
            F.col("text").alias("pdf_text"),
            F.when(F.col("doc_id") % 10 == 0, "failed").otherwise("COMPLETED").alias("processing_status"),
            (F.lit(AS_OF).cast("timestamp_ntz") - minutes).alias("extraction_timestamp"),
        )

    @cached_property
    def dictionary(self) -> DataFrame:
        return self.raw("benchmark").select(F.col("text").alias("code"), F.col("item_id").alias("code_pos"))

    @cached_property
    def detector(self) -> CodeDetector:
        return code_detector(self.dictionary)

    @cached_property
    def coded(self) -> DataFrame:
        """Document texts with their detected codes."""
        return self.detector(self.doc_content)

    @cached_property
    def counted(self) -> DataFrame:
        """Codes and text counts of each document, without its text."""
        return self.detector(self.doc_content, keep=partial(doc_features, lexicon=TEST_LEXICON))

    @cached_property
    def measured(self) -> DataFrame:
        """Notices with the measures of their text."""
        return self.notices.join(self.detector(self.doc_content, keep=text_measures), "resource_id", "left")

    @cached_property
    def screened(self) -> DataFrame:
        """Notices with the counts of their document, ready to be scored."""
        return self.notices.join(self.counted, "resource_id", "left")

    @cached_property
    def authorities(self) -> dict[str, int]:
        names = self.raw("nation").where(F.col("n_nationkey") < N_AUTHORITIES).select("n_name", "n_nationkey")
        return {r["n_name"]: r["n_nationkey"] + 1 for r in names.collect()}

    @cached_property
    def scored(self) -> DataFrame:
        """A score with ties and a 0/1 label per labelled document."""
        labels = self.raw("labels").select("doc_id", F.col("toxic").alias("y"))
        return self.raw("documents").select("doc_id", "n_chars").join(labels, "doc_id").select(
            "doc_id", ((F.col("n_chars") % 997) / F.lit(997.0)).alias("score"), "y"
        )

    @cached_property
    def raw_notices(self) -> DataFrame:
        """Notices as scraped: every field text, some empty or broken."""
        key = F.col("resource_id")
        hurt = lambda c: F.when(key % 11 == 0, "").when(key % 13 == 0, "bad").otherwise(c)
        stamp = "dd/MM/yyyy HH:mm:ss"
        # Thousands commas on the whole euros, two digits of cents.
        euros = F.floor(F.col("value")).cast("bigint").cast("string")
        grouped = F.regexp_replace(euros, r"(?<=\d)(?=(\d{3})+$)", ",")
        cents = F.lpad(((F.col("value") * 100) % 100).cast("int").cast("string"), 2, "0")
        return self.notices.select(
            "title", key.cast("string").alias("resource_id"), "ca", "info",
            hurt(F.date_format("published", stamp)).alias("published"),
            hurt(F.date_format("deadline", stamp)).alias("deadline"),
            "procedure", "status", "pdf_url",
            hurt(F.date_format("published", "dd/MM/yyyy")).alias("awarddate"),
            hurt(F.coalesce(F.concat(F.lit("€"), grouped, F.lit("."), cents), F.lit(""))).alias("value"),
            "cycle",
        )
