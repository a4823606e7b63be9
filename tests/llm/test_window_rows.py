"""Windows that met an item leave the join without the text around them."""

import re

from sievework.llm import decontaminate

ITEM = "the quick river carries seven heavy stones down to the quiet harbour of Lund every spring morning"


def test_rows_of_the_join_hold_a_window_not_the_text(spark):
    docs = spark.createDataFrame([(1, f"Some words before. {ITEM} and more words behind it."), (2, "Nothing of the kind is here.")], "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    found = decontaminate.contaminated(docs, items)
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    joins = [int(k) for k in re.findall(r"^\((\d+)\) BroadcastHashJoin", plan, re.M)]
    assert joins
    for k in joins:
        above = re.search(rf"^\({k + 1}\) Project.*?\nOutput \[\d+\]: \[(.*)\]$", plan, re.M | re.S).group(1).split("\n")[0]
        # A function with a lambda is no part of the join's code, so whole texts would be copied for it.
        assert "lambdafunction" not in above and "slice(words" in above
    assert [(r.doc_id, r.item_id, r.exact) for r in found.collect()] == [(1, 7, True)]


def test_many_passages_in_a_long_text(spark):
    items = [(k, " ".join(f"w{k}x{j}" for j in "abcdefghijkl")) for k in range(40)]
    text = " . ".join(f"{t} plain filler goes between these passages" for _, t in items)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {r.item_id: (r.windows, r.exact) for r in found.collect()} == {k: (5, True) for k, _ in items}
