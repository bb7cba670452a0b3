from provlake.plans import adapter as A


def test_staged_parts_of_the_listing_are_distinct_before_their_paths(spark, tmp_path):
    """The listing asks which parts a session stages; pairs of order and part were made distinct and looked up before."""
    for name, rows in {"region": "0L as r_regionkey, 'R' as r_name", "nation": "0L as n_nationkey, 'N' as n_name, 0L as n_regionkey",
                       "customer": "0L as c_custkey, 'M' as c_mktsegment, 0L as c_nationkey",
                       "orders": "id as o_orderkey, 0L as o_custkey, 'P' as o_orderstatus, '5-LOW' as o_orderpriority",
                       "part": "id as p_partkey, cast(id as int) as p_size",
                       "lineitem": "id % 3 as l_orderkey, id % 2 as l_partkey"}.items():
        spark.range(6 if name in ("orders", "part", "lineitem") else 1).selectExpr(*rows.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    files = A.files(A.Tables(spark, str(tmp_path)))
    found = {(r["session_id"], r["path"], r["length"]) for r in files.collect() if r["path"].startswith("work/part/")}
    assert found == {("region-0", "work/part/0.csv", 0), ("region-0", "work/part/1.tsv", 1)}
    assert "keys=[l_orderkey" not in files._jdf.queryExecution().executedPlan().toString()
