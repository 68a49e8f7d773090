"""Stage tables in buckets."""
from pyspark.sql import functions as F

from leadrank.session import bucketed_table


def test_groupings_and_joins_on_buckets_need_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(2000).selectExpr("concat('f', id % 50) AS k", "id % 7 AS r", "id AS x")
        many = bucketed_table(rows, "k", "many")
        one = bucketed_table(rows.groupBy("k").agg(F.max("x").alias("most")), "k", "one")
        nested = (many.groupBy("k", "r").agg(F.collect_list("x").alias("xs")).groupBy("k").agg(F.collect_list("xs").alias("all")).join(one, "k"))
        got = {r.k: (sorted(x for xs in r.all for x in xs), r.most) for r in nested.collect()}
        plan = nested._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
        want = {}
        for r in rows.collect():
            want.setdefault(r.k, []).append(r.x)
        assert got == {k: (sorted(v), max(v)) for k, v in want.items()}
        assert bucketed_table(rows.limit(0), "k", "none").groupBy("k").count().collect() == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
