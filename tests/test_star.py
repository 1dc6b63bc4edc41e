"""The roles as Spark reads them: the same rows as their text in the common SQL."""

import datetime as dt

from conftest import rows

from parcelworks.plans import star


def test_lines_keep_their_rows_in_another_join_order(spark, tmp_path):
    day = dt.datetime(1997, 5, 2)
    tables = {
        "lineitem": (
            [(o, p, 1, n, 5.0, 10.0, "R", "F", day) for o, p, n in [(1, 1, 1), (1, 1, 1), (1, 2, 2), (2, None, 1), (None, 1, 1), (3, 9, 1), (4, 1, 1)]],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
        "orders": (
            [(o, c, "F", 99.0, day, "2-HIGH") for o, c in [(1, 1), (1, 2), (2, 1), (4, None), (None, 1)]],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "customer": ([(1, "a", 1, "BUILDING"), (2, "b", 1, None), (2, "b", 1, None)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "nation": ([(1, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "part": ([(1, "Brand#2", "PROMO", 50), (1, None, "SMALL", 7), (2, "Brand#1", "LARGE", 3)], "p_partkey long, p_brand string, p_type string, p_size int"),
    }
    for name, (values, kinds) in tables.items():
        spark.createDataFrame(values, kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    s = star.Star(spark, str(tmp_path))
    want = spark.sql(star.ROLES["lines"], **{name: s.table(name) for name in tables})
    lines = s.role("lines")
    assert lines.columns == want.columns
    assert rows(lines) == rows(want) and len(rows(want)) == 15

    # Customers meet the orders, not the lines: no join has lines on one side and customers on the other.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = s.role("lines")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert "[l_orderkey" in joins[0] and len(joins) == 5


def test_export_keeps_its_rows_with_cells_made_below_the_join(spark, tmp_path):
    day = dt.datetime(1997, 5, 2)
    spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "l_orderkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, "F", 1234.5, day, "2-HIGH"), (1, "P", 99.0, day, None), (2, "O", None, None, "5-LOW"), (None, "F", 1.0, day, "5-LOW")]
    kinds = "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, kinds).write.parquet(f"{tmp_path}/orders.parquet")
    s = star.Star(spark, str(tmp_path))
    want = spark.sql(star.ROLES["export_a"], lineitem=s.table("lineitem"), orders=s.table("orders"))
    got = s.role("export_a")
    assert got.schema == want.schema and rows(got) == rows(want) and len(rows(want)) == 5
    # Nothing is computed above the join.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE" not in plan[: plan.index("Join")]
