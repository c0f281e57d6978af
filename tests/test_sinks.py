"""Sinks and sources: idempotence, alignment, validation."""

import pytest
from pyspark.sql import types as T

from lodestead.operators import classify
from lodestead.sources import sinks, versions
from lodestead.sources.shared import file_stamp

SCHEMA = T.StructType([T.StructField("run_id", T.IntegerType()), T.StructField("recname", T.StringType()), T.StructField("field", T.StringType()), T.StructField("extra", T.LongType())])


def test_align(spark):
    got = sinks.align(spark.createDataFrame([("R", 9, "F")], "` RecName ` string, run_id int, Field string"), SCHEMA, 3)
    assert got.columns == [f.name for f in SCHEMA] and got.first() == (3, "R", "F", None)


def test_replace_slices_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1, "a"), (2, "b")], [(2, "c")], [(2, "c")]):
        sinks.replace_slices(spark.createDataFrame(rows, "run_id int, v string"), path)
    assert sorted((r["run_id"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]
    loaded = spark.read.parquet(path)
    assert [r[0] for r in sinks.pending_slices(spark.createDataFrame([(1,), (5,)], "run_id int"), loaded, "run_id").collect()] == [5]


def test_upsert(spark):
    old, new = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert sorted(map(tuple, sinks.upsert(old, new, "k").collect())) == [("a", 1), ("b", 3), ("c", 4)]


def test_decisions(spark, tmp_path):
    good = spark.createDataFrame([(1, "APPROVED")], "asset_id int, decision string")
    for _ in range(2):
        sinks.append_decisions(good, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    with pytest.raises(Exception, match="decision not allowed"):
        sinks.valid_decisions(spark.createDataFrame([(1, "PURGED")], "asset_id int, decision string")).collect()


def test_optional_table_and_csv(spark, tmp_path):
    assert sinks.optional_table(spark, str(tmp_path / "absent"), SCHEMA).count() == 0
    (tmp_path / "x.csv").write_text("a;b,c;d\n1;2;3\n", encoding="utf-8")
    assert sinks.read_csv_auto(spark, str(tmp_path / "x.csv")).columns == ["a", "b,c", "d"]


def test_keyword_domain(spark):
    texts = ["JOURNAL_ID | BUDGET | VAT", "journal budget vendor", "EMPLID payroll salary absence campaign", "campaign audience", "QX1 | QX2", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: (r["domain"], r["domain_alt"], r["confidence"]) for r in classify.keyword_domain(df, df["t"]).collect()}
    assert got[texts[0]] == ("Finance & Contrôle", None, 0.81) and got[texts[2]] == ("RH", "Ventes & Clients", 0.78) and got[texts[3]] == ("Ventes & Clients", None, 0.78)
    assert got[texts[1]] == got[texts[4]] == got[None] == (None, None, None)


def test_term_base_from_a_table(spark):
    rows = [("b", "beta", 1), ("a", "alpha", 2), ("b", "bet", 3)]
    assert classify.terms_from(spark.createDataFrame(rows, "domain string, term string, place int")) == {"b": ("bet", "beta"), "a": ("alpha",)}
    flat = [t for own in classify.TERMS.values() for t in own]
    assert len(flat) == len(set(flat)) and set(classify.TERMS) == set(classify.TERM_LABELS)


def test_row_hash(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string")
    h = [r[0] for r in df.select(classify.row_hash(df)).collect()]
    assert h[0] == h[2] != h[1]


def test_align_refuses_equal_names_and_unknown_tables(spark):
    with pytest.raises(ValueError, match="equal name"):
        sinks.align(spark.createDataFrame([(1, 2)], "a int, ` A` int"), SCHEMA, 1)
    with pytest.raises(ValueError, match="no such table"):
        sinks.known_table("x", {"y": SCHEMA})
    with pytest.raises(Exception, match="repeat a key"):
        sinks.upsert(spark.createDataFrame([("a", 1)], "k string, v int"), spark.createDataFrame([("b", 3), ("b", 4)], "k string, v int"), "k").collect()


def test_slices_go_on_after_a_failure(spark, tmp_path):
    def build(k):
        return spark.createDataFrame([(k, "v")], "run_id int, v string") if k != 2 else 1 / 0

    assert sinks.load_slices([1, 2, 3], build, str(tmp_path / "t")) == [(2, "division by zero")]
    assert sorted(r["run_id"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 3]


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    for run, status, message in ((1, "running", None), (1, "failed", "x" * 5000), (2, "running", None)):
        sinks.run_event(spark, path, run, status, message)
    got = {r["run_id"]: (r["status"], len(r["message"] or "")) for r in sinks.run_status(spark.read.parquet(path)).collect()}
    assert got == {1: ("failed", 4000), 2: ("running", 0)}


def test_publish_and_export(spark, tmp_path):
    builds = [("base", lambda done: spark.range(5)), ("twice", lambda done: done["base"].union(done["base"]))]
    for _ in range(2):
        assert {r["result"]: r["rows"] for r in sinks.publish(builds, str(tmp_path / "p")).collect()} == {"base": 5, "twice": 10}
    sinks.export_pack({"a": spark.range(3), "b": spark.range(0)}, str(tmp_path / "pack"))
    assert {tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "pack/metadata")).collect()} == {("a", "3"), ("b", "0")}
    sinks.write_report(spark.createDataFrame([(1, None)], "x int, y string"), str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r")).first()[0] == '{"x":1,"y":null}'


def test_a_failed_publication_leaves_the_one_before(spark, tmp_path):
    folder = str(tmp_path / "p")
    with pytest.raises(ValueError, match="no result"):
        versions.read(spark, folder, "base")
    builds = [("base", lambda done: spark.range(5)), ("twice", lambda done: done["base"].union(done["base"]))]
    assert {tuple(r) for r in versions.publish(spark, builds, folder).collect()} == {("base", 5), ("twice", 10)}
    begun = versions.read(spark, folder, "base")

    def fails(done):
        assert done["base"].count() == 7  # the first result is written already
        return done["base"].select((1 / (done["base"]["id"] - 3)).alias("x"))

    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        versions.publish(spark, [("base", lambda done: spark.range(7)), ("twice", fails)], folder)
    assert versions.read(spark, folder, "base").count() == 5 and versions.read(spark, folder, "twice").count() == 10
    versions.publish(spark, [("base", lambda done: spark.range(8)), ("none", lambda done: spark.range(0))], folder)
    assert versions.read(spark, folder, "base").count() == 8 and versions.read(spark, folder, "twice").count() == 10 and versions.read(spark, folder, "none").count() == 0
    assert begun.count() == 5  # a reader that began before
    assert len(versions.remove_unused(spark, folder)) == 1 and versions.read(spark, folder, "twice").count() == 10
    number, content = versions.manifest(spark, folder)
    with pytest.raises(RuntimeError, match="came first"):
        versions._put(spark, folder, number - 1, content)


def test_slices_are_swapped_at_once(spark, tmp_path):
    folder = str(tmp_path / "s")
    for rows in ([(1, "a"), (2, "b"), (None, "n")], [(2, "c"), (2, "d")], [(2, "c"), (2, "d")]):
        versions.replace_slices(spark.createDataFrame(rows, "run_id int, v string"), folder, "t")
    assert sorted(map(tuple, versions.read(spark, folder, "t").collect()), key=str) == [(1, "a"), (2, "c"), (2, "d"), (None, "n")]
    with pytest.raises(Exception, match="not allowed"):
        versions.replace_slices(sinks.valid_decisions(spark.createDataFrame([(1, "APPROVED"), (1, "x")], "run_id int, decision string")), folder, "t")
    assert versions.read(spark, folder, "t").count() == 4 and versions.manifest(spark, folder)[0] == 3


def test_separators_inside_quotes(spark, tmp_path):
    assert sinks.sniffed_csv(['"a;b;c;d",x', '"1;2",3', "4,5"]) == (",", False)
    assert sinks.sniffed_csv(["a|b,c|d", '1|"x|y"|3', "1|2|3"]) == ("|", False)
    assert sinks.sniffed_csv(["﻿a\tb", '"first', 'second"\t2', "3\t4"]) == ("\t", True)
    assert sinks.sniffed_csv(["only", "one"]) == (";", False) and sinks.sniffed_csv([]) == (";", False)
    (tmp_path / "x.csv").write_text('﻿"a;1";b,c\n"x; ""y""\nz";2\n3;4\n', encoding="utf-8")
    got = sinks.read_csv_auto(spark, str(tmp_path / "x.csv"))
    assert got.columns == ["a;1", "b,c"] and sorted(map(tuple, got.collect())) == [("3", "4"), ('x; "y"\nz', "2")]


def test_stamps_see_files_in_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).selectExpr("id", "id % 2 as k").write.partitionBy("k").parquet(path)
    before = file_stamp(spark, path)
    spark.range(1).selectExpr("id", "1L as k").write.mode("append").partitionBy("k").parquet(path)
    assert before and file_stamp(spark, path) != before
    with pytest.raises(Exception, match="not exist"):
        file_stamp(spark, str(tmp_path / "absent"))
