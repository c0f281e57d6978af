"""The forms in which Spark works out catalogue relations, against their text."""

import pytest
from pyspark.sql import functions as F

from lodestead.sources import bindings

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """The smallest tables with parts that occur twice, and with nulls."""
    folder = str(tmp_path_factory.mktemp("odd"))
    for t in bindings.TABLES:
        df = spark.read.parquet(f"{DATA}/{t}.parquet")
        if t == "part":
            df = df.union(df.where("p_partkey % 10 = 3")).withColumn("p_name", F.expr("if(p_partkey % 17 = 4, null, p_name)"))
        if t == "lineitem":
            df = df.withColumns({"l_partkey": F.expr("if(l_orderkey % 50 = 1, null, l_partkey)"), "l_shipdate": F.expr("if(l_orderkey % 50 = 2, null, l_shipdate)"), "l_returnflag": F.expr("if(l_orderkey % 50 = 3, null, l_returnflag)")})
        df.write.parquet(f"{folder}/{t}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(bindings.FORMS))
def test_form_has_the_rows_of_its_text(spark, odd, name):
    tables = ", ".join(f"{t} AS (SELECT * FROM parquet.`{odd}/{t}.parquet`)" for t in bindings.TABLES)
    text = spark.sql(f"WITH {tables}, {bindings.RELATIONS} SELECT * FROM {name}")
    form = bindings.relation(spark, odd, name)
    assert form.dtypes == text.dtypes
    assert sorted(map(tuple, form.collect()), key=repr) == sorted(map(tuple, text.collect()), key=repr)


def test_names_are_not_compared_in_pairs(spark):
    plan = bindings.relation(spark, DATA, "all_tab_columns")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_parts_are_spread(spark, monkeypatch):
    monkeypatch.setattr(bindings, "PART_BYTES", 1_000)
    assert "REPARTITION_BY_NUM" in bindings.relation(spark, DATA, "record_catalog")._jdf.queryExecution().executedPlan().toString()
