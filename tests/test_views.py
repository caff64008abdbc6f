"""What the queries build as input."""

import re
from pathlib import Path

from queries import views
from queries.spark_queries import QUERIES
from queries.views import write_each


def test_several_tasks_write_one_file_per_value(spark, tmp_path):
    rows = spark.range(40).selectExpr("concat('text ', id) AS value", "id AS file")
    write_each(rows, "file", str(tmp_path / "out"))
    files = sorted(Path(tmp_path / "out").glob("file=*/*.txt"))
    assert {f.parent.name: f.read_text() for f in files} == {f"file={i}": f"text {i}\n" for i in range(40)}
    assert len(files) == 40 and len({re.match(r"part-(\d+)", f.name)[1] for f in files}) > 1


def test_songs_and_actions_pass_no_table_through_the_driver(spark, tmp_path):
    spark.sql("SELECT 1L AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, 3 AS p_size, 2D AS p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT 7L AS o_orderkey, 5L AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        "SELECT 7L AS l_orderkey, 1L AS l_partkey, 20D AS l_quantity, 0.1D AS l_discount, 0.2D AS l_tax, 30D AS l_extendedprice, "
        "'N' AS l_returnflag, TIMESTAMP_NTZ '2020-01-01 00:00:00' AS l_shipdate"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    for table in (views.songs(spark, str(tmp_path)), views.actions(spark, str(tmp_path))):
        assert table.count() == 1
        assert "Broadcast" not in table._jdf.queryExecution().executedPlan().toString()


def test_user_index_join_puts_actions_and_songs_together_once(spark, tmp_path):
    spark.sql("SELECT id AS p_partkey, concat('n', id) AS p_name, 'b' AS p_brand, 't' AS p_type, 3 AS p_size, 2D AS p_retailprice FROM range(1, 4)").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT id AS o_orderkey, 5 + id % 2 AS o_custkey FROM range(6)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        "SELECT id % 6 AS l_orderkey, 1 + id % 2 AS l_partkey, CAST(20 + id AS DOUBLE) AS l_quantity, 0.1D AS l_discount, 0.2D AS l_tax, "
        "30D AS l_extendedprice, 'N' AS l_returnflag, TIMESTAMP_NTZ '2020-01-01 00:00:00' AS l_shipdate FROM range(18)"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["user_index_join"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == [(0, 0, "5", "1", "n1", 3.5), (1, 1, "6", "2", "n2", 3.5)]
    # The given tables are not joined once more for the last joins, which read what is written.
    assert not any("lineitem" in f for f in found.inputFiles())
