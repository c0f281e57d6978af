"""The dataset's summary of fields against the rows of fields that it does without."""

from lodestead.operators import catalog
from lodestead.plans.catalogue import Run


def test_summary_is_that_of_the_rows(spark):
    columns = spark.createDataFrame(
        [
            (1, "Rec_A", "T1", "EMPLID", "VARCHAR2", 11, "N"), (1, "REC_A", "t1", "EMPLID", "VARCHAR2", 11, "N"), (1, "REC_A", "T1", "EMPLID", "VARCHAR2", 11, None), (1, "REC_A", "T1", "NOTES", "CLOB", None, "Y"),
            (1, "REC_B", "B.T1", "BIG", "CHAR", 2000, "x"), (1, "REC_B", None, "QTY", None, 3, "Y"), (1, None, "T1", "EFFDT", "DATE", 7, "N"), (1, "REC_C", "T3", None, "DATE", 7, "N"),
            (2, "REC_A", "T1", "AMOUNT", "NUMBER", 26, "n"), (2, "REC_D", "T4", "X", "LONG", None, "Y"),
        ],
        "run_id int, recname string, physical_table_name string, column_name string, data_type string, data_length int, nullable_flag string",
    )
    # A.B.T1 is a table of A.B and one of A; T1 of owner O stands there twice.
    tables = spark.createDataFrame([(1, "A.B", "T1"), (1, "A", "B.T1"), (1, "O", "T1"), (1, "o", "T1"), (2, "O", "T1"), (2, "O", "T4"), (2, "O", "T9")], "run_id int, owner string, table_name string")
    assets = spark.createDataFrame(
        [
            (1, "ps_record", "rec_a", "1a"), (1, "ps_record", "REC_A", "1A"), (1, "ps_record", "REC_A", "1A"), (1, "ps_record", "REC_B", "1B"), (1, "ps_record", "REC_C", "1C"), (2, "ps_record", "REC_D", "2D"),
            (1, "oracle_table", "A.B.T1", "1t"), (1, "oracle_table", "O.T1", "1o"), (2, "oracle_table", "O.T1", "2o"), (2, "oracle_table", "O.T4", "24"), (2, "oracle_table", "O.T9", "29"),
        ],
        "run_id int, asset_type string, technical_name string, asset_id string",
    )
    fields = catalog.dim_field(assets, tables, columns)
    plain = catalog.field_counts(fields).join(catalog.field_texts(fields), ["run_id", "asset_id"])
    own = catalog.field_summary(assets, tables, columns)
    assert own.dtypes == plain.dtypes
    rows = sorted(map(tuple, own.collect()), key=repr)
    assert rows == sorted(map(tuple, plain.collect()), key=repr) and len(rows) == 8


def test_dataset_does_not_write_fields(spark, monkeypatch):
    monkeypatch.setattr(Run, "_stored", {})
    Run(spark, "/root/testdata/sf0.001").dataset
    assert "dataset" in {k[2] for k in Run._stored} and "dim_field" not in {k[2] for k in Run._stored}
