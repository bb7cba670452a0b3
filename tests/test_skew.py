from pyspark.sql import functions as F

from provlake.operators.skew import first_k, join_facts


def test_facts_reach_every_row_of_a_hot_key(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    facts = rows.select("k").distinct().where("k <> '5'").withColumn("fact", F.upper("k"))
    got = join_facts(rows, facts, ["k"], "id")
    assert got.columns == ["k", "id", "fact"] and got.count() == 2999 and got.where("fact <> upper(k)").count() == 0
    assert join_facts(rows, facts, ["k"], "id", "left").where("fact is null").count() == 1


def test_first_k_is_exact(spark):
    rows = spark.range(5000).select((F.col("id") % 2).alias("k"), F.lpad(F.col("id").cast("string"), 5, "0").alias("v"))
    got = {(r["k"], r["v"], r["rank"]) for r in first_k(rows, ["k"], "v", 3).collect()}
    assert got == {(0, "00000", 1), (0, "00002", 2), (0, "00004", 3), (1, "00001", 1), (1, "00003", 2), (1, "00005", 3)}
