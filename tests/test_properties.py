"""Property checks on the driver's small tables."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_group_split_disjoint(spark):
    import __spark_entry__ as E
    df = E.queries()["g1_group_split"](spark, SF_SMALL)
    per = df.groupBy("o_custkey").agg(F.count_distinct("split").alias("k"))
    assert per.filter("k > 1").count() == 0
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()


def test_tp_fn_is_support(spark):
    import __spark_entry__ as E
    counts = {r.type: r for r in E.queries()["e4_score_entities"](spark, SF_SMALL).collect()}
    rep = {r.label: r for r in E.queries()["e7_prf_report"](spark, SF_SMALL).collect()}
    for t, c in counts.items():
        assert rep[t].support == c.tp + c.fn


def test_global_rank_is_permutation(spark):
    from tessera.operators.splits import global_rank
    df = spark.range(5000).withColumn("k", (F.col("id") * 7919) % 5003)
    r = global_rank(df, [F.col("k"), F.col("id")])
    got = [x[0] for x in r.orderBy("k", "id").select("rank").collect()]
    assert got == list(range(5000))


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "error_id" in df.columns
