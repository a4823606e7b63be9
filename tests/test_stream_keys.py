"""Texts of a batch are picked where they are read."""

from pyspark.sql import functions as F

from sievework.streaming import chain


def test_wanted_texts_are_kept_without_a_shuffle(spark):
    docs = spark.range(20_000).select((F.col("id") * 7).cast("int").alias("resource_id"), F.concat(F.lit("text "), "id").alias("pdf_text"))
    docs = docs.union(docs.where("resource_id = 70")).union(spark.createDataFrame([(None, "no key")], "resource_id int, pdf_text string"))
    wanted = spark.range(0, 70_000, 5).select(F.col("id").alias("resource_id"), F.lit("other").alias("title"))
    near = chain.only_keys(docs, wanted)
    assert near.columns == docs.columns
    exact = lambda df: sorted(tuple(r) for r in df.join(wanted, "resource_id", "left_semi").collect())
    assert exact(near) == exact(docs) and len(exact(docs)) == 2001
    assert near.count() < 2100
    assert chain.only_keys(docs, wanted.limit(0)).count() == 0
    # Only keys of the batch are dealt out, as bits; the texts pass no exchange.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = chain.only_keys(docs, wanted)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
