"""Stored tables: key registry, published views, bucketed join, VARIANT."""

import os

import pytest
from cases import SF_SMALL
from pyspark.sql import functions as F

from strata.operators import model
from strata.plans import queries_tables
from strata.sinks import keys, published, swap, versions, write_bucketed
from strata.sources import lake
from strata.sources.driver_tables import read_table


def _keys(spark, path):
    return {r.name: r.surrogate_key for r in keys.registered_keys(spark, path).collect()}


def test_keys_are_dense_stable_and_without_gaps(spark, scratch):
    path = f"{scratch}/keys"
    given = {}
    for names in (["b", None, "a", "a"], ["a", "c"], [], ["", None, "d"], [f"n{i}" for i in range(500)]):
        rows = spark.createDataFrame([(n,) for n in names], "name string").repartition(3)
        top = keys.register_keys(spark, path, rows, "name")
        now = _keys(spark, path)
        assert given.items() <= now.items()
        assert sorted(now.values()) == list(range(1, top + 1)) and len(now) == top
        given = now
    named = keys.with_keys(spark, path, spark.createDataFrame([("a",), ("zz",), (None,)], "name string"), "name")
    assert {r.name: r.surrogate_key for r in named.collect()} == {"a": given["a"], "zz": None, None: given[None]}


def test_keys_of_several_columns(spark, scratch):
    path = f"{scratch}/keys"
    rows = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), (None, None), ("a", None)], "x string, y string")
    assert keys.register_keys(spark, path, rows, ["x", "y"]) == 4
    assert keys.with_keys(spark, path, rows, ["x", "y"], "k").select("k").distinct().count() == 4
    assert keys.with_keys(spark, f"{scratch}/none", rows, ["x", "y"]).where("surrogate_key IS NULL").count() == 5


def test_two_key_loads_at_once(spark, scratch, monkeypatch):
    path = f"{scratch}/keys"
    keys.register_keys(spark, path, spark.createDataFrame([("a",)], "name string"), "name")
    base, state = versions.latest(spark, path)
    monkeypatch.setattr(keys, "latest", lambda *a: (base - 1, {}))  # read before the other load had committed
    with pytest.raises(swap.ConcurrentChange):
        keys.register_keys(spark, f"{path}", spark.createDataFrame([("b",)], "name string"), "name")


def test_published_table_is_never_missing(spark, scratch):
    root = f"{scratch}/t"
    published.publish(spark, spark.range(3), "t_published", root)
    reader = spark.table("t_published")  # on the first version
    seen = []

    class Watched:
        """A frame whose write is watched: the view must show the old version until it is replaced."""

        def __init__(self, df):
            self.df = df

        @property
        def write(self):
            seen.append(spark.table("t_published").count())
            return self.df.write

    again = spark.table("t_published").select("id", F.lit("x").alias("part")).unionByName(spark.range(9).select("id", F.lit("y").alias("part")))
    published.publish(spark, Watched(again), "t_published", root, partition_by="part")
    assert seen == [3] and reader.count() == 3
    assert spark.table("t_published").columns == ["id", "part"] and spark.table("t_published").count() == 12
    assert sorted(d for d in os.listdir(f"{root}/v2") if "=" in d) == ["part=x", "part=y"]
    published.publish(spark, spark.range(1), "t_published", root)
    assert published.forget_published(spark, root, keep=2) == ["v1"]
    assert spark.table("t_published").count() == 1 and not os.path.exists(f"{root}/v1")
    spark.sql("DROP VIEW t_published")
    published.point(spark, "t_published", root)  # the pointer follows from the versions
    assert spark.table("t_published").count() == 1


def test_two_publishers_of_one_version(spark, scratch):
    root = f"{scratch}/t"
    published.publish(spark, spark.range(3), "t_published_2", root)

    class Beaten:
        @property
        def write(self):
            published.publish(spark, spark.range(7), "t_published_2", root)
            return spark.range(5).write

    with pytest.raises(swap.ConcurrentChange):
        published.publish(spark, Beaten(), "t_published_2", root)


def test_bucketed_join_has_no_exchange(spark, scratch):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [
            write_bucketed(read_table(spark, SF_SMALL, n), f"b_{n}", 4, k, sort_by=k, path=f"{scratch}/{n}")
            for n, k in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"))
        ]
        joined = model.order_lines(tables[1], tables[0])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = model.order_lines(read_table(spark, SF_SMALL, "lineitem"), read_table(spark, SF_SMALL, "orders"))
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        assert joined.exceptAll(plain).count() == 0 and joined.count() == plain.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_stored_variant_is_not_parsed_again(spark, scratch):
    for query in (queries_tables.q_stored_variant_fields, queries_tables.q_stored_variant_flattened):
        plan = query(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "parse_json" not in plan.lower()
    rows = [(1, '{"k": 5, "s": "x"}'), (2, "not json"), (3, None), (4, '{"k": "text"}'), (5, "[1, 2]")]
    lake.store_variant(spark.createDataFrame(rows, "id int, props string"), f"{scratch}/v", "props")
    stored = spark.read.parquet(f"{scratch}/v")
    assert stored.schema["props"].dataType.simpleString() == "variant"
    got = {r.id: (r.k, r.s) for r in stored.select("id", lake.variant_field("props", "$.k", "int").alias("k"), lake.variant_field("props", "$.s", "string").alias("s")).collect()}
    assert got == {1: (5, "x"), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None)}
