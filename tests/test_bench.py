import bench
import __spark_entry__


def test_the_bench_times_registered_queries_and_all_text_operators():
    market = {n for n in bench.HEADLINE if n != "pipeline" and not n.startswith("op")}
    assert market <= set(__spark_entry__.queries()) and "l4_block_tops" in market
    assert {n for n in __spark_entry__.queries() if n == "pipeline" or n.startswith("op") and n[2].isdigit()} <= set(bench.HEADLINE)


def test_every_query_is_registered_with_its_sql():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries)
    assert all(n in sql for n in queries if n != "pipeline" and not n.startswith("op") or n.startswith("ofi"))
