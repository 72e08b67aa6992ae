"""Relational queries on small tables with rows that the given tables hardly have."""

from atrium.plans.registry import ORACLE_SQL, QUERIES
from tests import oracle


def test_an_order_of_any_number_counts(spark, tmp_path):
    tables = {
        "customer": spark.createDataFrame([(i,) for i in range(1, 5)], "c_custkey long"),
        "orders": spark.createDataFrame([(1, 1), (8, 2), (13, 3), (16, 3), (21, None)], "o_orderkey long, o_custkey long"),
    }
    for name, rows in tables.items():
        rows.coalesce(1).toPandas().to_parquet(f"{tmp_path}/{name}.parquet")
    q = "rel_customers_without_orders"
    assert [tuple(r) for r in QUERIES[q](spark, str(tmp_path)).collect()] == [(4,)]
    assert oracle.difference(spark, oracle.connect(str(tmp_path)), QUERIES[q], ORACLE_SQL[q], str(tmp_path)) == ""
