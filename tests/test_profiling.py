"""Value patterns, semantics, masking, prices, features and the helpers of text."""

import pytest
from pyspark.sql import functions as F

from lodestead.functions.text import SPARK, composed, folded, module_prefix, normalized, safe_number
from lodestead.operators import features, profiling


def patterns_of(spark, name, kind, values):
    rows = [(name, kind, v) for v in values]
    return profiling.observed_patterns(spark.createDataFrame(rows, "column_name string, data_type string, value string")).first()["pattern"]


@pytest.mark.parametrize(
    ("name", "kind", "values", "pattern"),
    [
        ("X", "", ["me@site.org", "you@site.fr", "nobody"], "email_like"), ("X", "", ["www.site.org", "HTTPS://b.c/d"], "url_like"), ("X", "", ["+33 1 23 45 67 89"], "phone_like"),
        ("X", "", ["0a1b2c3d-0000-1111-2222-abcdefabcdef"], "uuid_like"), ("X", "", ["2020-02-03 04:05", "2021/12/31 23:59:59"], "timestamp_like"), ("X", "", ["2020-02-03", "31/12/2021"], "date_like"),
        ("X", "", ["Y", "N", "y"], "binary_flag_like"), ("X", "", ["Y", "N", "T"], "name_like"), ("X", "", ["12", "-7", "300", "4"], "integer_like"), ("X", "", ["1.5", "2,5", "3", "1 000"], "decimal_like"),
        ("X", "", ["OPEN_A", "CLOSED"], "short_code_like"), ("X", "", ["item-a17", "b2c3d4e5"], "alphanumeric_identifier_like"), ("X", "", ["Jean Dupont", "Anna Maria Roy"], "name_like"),
        ("X", "", ["some words in a row", "and some more of it"], "free_text_like"), ("X", "", ["Lyon", "Paris"], "name_like"), ("EFFDT", "", ["soon", "later"], "date_like"), ("QX", "NUMBER", ["few", "many"], "decimal_like"),
        ("QX", "", ["few", "many"], "free_text_like"),
    ],
)
def test_observed_patterns(spark, name, kind, values, pattern):
    assert patterns_of(spark, name, kind, values) == pattern


def test_merged_semantics(spark):
    rows = [
        ("HOME_LATITUDE", "NUMBER", "decimal_like", None, "geo_latitude"), ("STATE", "CHAR", "short_code_like", None, "other"), ("STATE_CITY", "CHAR", "short_code_like", None, "location_text"),
        ("ORDER_YEAR", "NUMBER", "integer_like", None, "date_part"), ("C", "CHAR", "email_like", "status", "email_address"), ("LOAD_DT", "DATE", "date_like", None, "technical_timestamp"),
        ("NET_AMT", "NUMBER", "decimal_like", None, "financial_amount"), ("PAY_STATUS", "CHAR", "name_like", None, "status"), ("CUST_ID", "CHAR", "free_text_like", None, "identifier"),
        ("VALID", "CHAR", "free_text_like", None, "label"), ("Q", "CHAR", "short_code_like", None, "classification"), ("Q", "BLOB", None, "status", "status"), ("Q", "BLOB", None, None, "other"),
        ("EMPLID", "CHAR", None, "label", "person_identifier"), (None, None, None, None, "other"), ("IS_OPEN", "CHAR", None, None, "flag"),
    ]
    df = spark.createDataFrame(rows, "column_name string, data_type string, pattern string, stored string, want string")
    wrong = profiling.merged_semantics(df).where("semantics <> want").collect()
    assert not wrong, wrong


def test_samples_and_masking(spark):
    rows = [("a", f"v{k % 6}|x\n y", float(k)) for k in range(30)] + [("a", " ", None), ("b", "z" * 80, 1.0)]
    got = profiling.sample_column_values(spark.createDataFrame(rows, "g string, t string, n double"), ("g",), k=2).collect()
    assert sorted((r["g"], r["column_name"], r["data_type"], r["value"]) for r in got) == [("a", "n", "double", "0.0"), ("a", "n", "double", "1.0"), ("a", "t", "string", "v0/x y"), ("a", "t", "string", "v1/x y"), ("b", "n", "double", "1.0"), ("b", "t", "string", "z" * 61 + "...")]
    df = spark.createDataFrame([(["a", "b"], "label"), (["a"], "email_address")], "v array<string>, s string")
    assert [r[0] for r in df.select(profiling.masked_samples(F.col("v"), F.col("s"))).collect()] == ["[a | b]", profiling.MASK]


def test_prices(spark):
    pages = spark.createDataFrame([("<p>only <b>$0.02</b> / GB, $99/TB",), ("$10.24 /TB",), ("nothing",), (None,)], "html string")
    assert profiling.unit_prices(pages).first().asDict() == pytest.approx({"low": 0.12, "high": 0.24, "sources": 2})
    with pytest.raises(Exception, match="no page names a price"):
        profiling.unit_prices(pages.where("html = 'nothing'"), required=True).collect()


def test_text_helpers(spark):
    df = spark.createDataFrame([("AP-VCHR{LINE}.X",), ("  É_é  9 ",), ("***",), (None,)], "x string")
    assert [r[0] for r in df.select(F.expr(normalized("x", SPARK))).collect()] == ["ap vchr line x", "9", "", ""]
    assert [r[0] for r in df.select(F.expr(composed(("x", "x"), SPARK))).collect()] == ["ap vchr line x ap vchr line x", "9 9", "no_text", "no_text"]
    names = spark.createDataFrame([("PS_JOB_DATA",), ("OWNER.PS_PO_HDR",), ("ABCDEFGHIJ",), ("ps9_x",), (None,)], "x string")
    assert [r[0] for r in names.select(F.expr(module_prefix("x", SPARK))).collect()] == ["JOB", "PO", "ABCDEF", "9", ""]
    assert spark.createDataFrame([("Été_de-la / R&D",)], "x string").select(F.expr(folded("x", SPARK))).first()[0] == "ete de la r and d"
    odd = spark.createDataFrame([("7.5",), ("NaN",), ("-3",), ("Infinity",), ("x",), (None,)], "x string")
    assert [r[0] for r in odd.select(F.expr(safe_number("x"))).collect()] == [7.5, 0, 0, 0, 0, 0]


def test_numeric_features(spark):
    empty = {"run_id": 1, "asset_id": "a", **dict.fromkeys(features.RAW), **dict.fromkeys((*features.TEXTS, "column_value_semantics_text"))}
    full = {**empty, "asset_id": "b", "field_count": 4.0, "numeric_field_count": 1.0, "row_count": -5.0, "size_mb": 2.0, "technical_name": "GL_LEDGER_DT", "source_ref": "PS_GL_LEDGER", "column_names_text": "TAX | VENDOR", "column_value_semantics_text": "A:status | B:status | C:Location_Text | bad"}
    schema = "run_id int, asset_id string, " + ", ".join(f"{c} double" for c in features.RAW) + ", " + ", ".join(f"{c} string" for c in (*features.TEXTS, "column_value_semantics_text"))
    got = {r["asset_id"]: r.asDict() for r in features.with_numeric_features(spark.createDataFrame([tuple(x.values()) for x in (empty, full)], schema)).collect()}
    assert len(features.FEATURE_NAMES) == len(set(features.FEATURE_NAMES)) == 129 and len(got["a"]) == 131
    assert all(v == 0 for k, v in got["a"].items() if k not in ("run_id", "asset_id"))
    b = got["b"]
    assert (b["ratio_numeric"], b["row_count"], b["size_bytes"], b["avg_size_per_field"]) == (0.25, 0, 2 * 1048576, 2 * 1048576 / 4)
    assert (b["finance_keyword_count"], b["has_procurement_keyword"], b["technical_name_token_count"], b["technical_name_underscore_count"], b["technical_name_upper_ratio"], b["technical_name_has_dt"]) == (5, 1, 3, 0, 0, 1)
    assert (b["sem_status"], b["ratio_status"]) == (2, pytest.approx(2 / 3)) and sum(b[f"sem_{s}"] for s in features.SEMANTICS) == 2
