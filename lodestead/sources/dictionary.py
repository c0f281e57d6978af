"""Source catalogues from the dictionary tables of a database and of the application on it.

``owner`` is the schema whose physical tables count.  Blank text is no text, and the
application's placeholder record is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The placeholder record, the prefix of a table that no name is given for, and the names of the two mappings.
PLACEHOLDER, PREFIX = "PSDUMMY", "PS_"
GIVEN, FALLBACK = "SQLTABLENAME", "FALLBACK_PS_PREFIX"
DESCRIPTION_CHARS = 4000


def _text(c: str) -> Column:
    """The trimmed text, null where it is blank."""
    return F.nullif(F.trim(c), F.lit(""))


def _mapped(records: DataFrame) -> DataFrame:
    """Records with the physical table each one names, or is named after."""
    return records.where(F.col("recname") != PLACEHOLDER).withColumn("physical_table_name", F.coalesce(_text("sqltablename"), F.concat(F.lit(PREFIX), "recname")))


def record_catalog(records: DataFrame, tables: DataFrame, owner: str) -> DataFrame:
    """Logical records with their physical table and whether the owner has it."""
    own = tables.where(F.col("owner") == owner).select(F.col("owner").alias("oracle_owner"), F.col("table_name").alias("oracle_table_name"))
    named = _mapped(records).join(own, F.col("physical_table_name") == F.col("oracle_table_name"), "left")
    return named.select(
        "recname", "recdescr", "rectype", _text("sqltablename").alias("sqltablename_raw"), "physical_table_name",
        F.when(_text("sqltablename").isNull(), FALLBACK).otherwise(GIVEN).alias("mapping_source"), "oracle_owner", "oracle_table_name",
        F.col("oracle_table_name").isNotNull().cast("int").alias("table_exists_flag"), _text("parentrecname").alias("parentrecname"),
    )


def table_catalog(tables: DataFrame, modifications: DataFrame, dependencies: DataFrame, owner: str) -> DataFrame:
    """The owner's physical tables with their last modification and the number of objects that refer to them."""
    changed = modifications.where(F.col("table_owner") == owner).groupBy("table_name").agg(F.max("modified_at").alias("last_modified"))
    used = dependencies.where((F.col("referenced_owner") == owner) & (F.col("referenced_type") == "TABLE"))
    used = used.groupBy(F.col("referenced_name").alias("table_name")).agg(F.countDistinct("owner", "name", "type").alias("referenced_by_count"))
    joined = tables.where(F.col("owner") == owner).join(changed, "table_name", "left").join(used, "table_name", "left")
    return joined.select(
        "owner", "table_name", "tablespace_name", "num_rows", "blocks", "avg_row_len", "last_modified", F.coalesce("referenced_by_count", F.lit(0)).alias("referenced_by_count"),
        F.col("temporary").alias("temporary_flag"), F.col("partitioned").alias("partitioned_flag"),
    )


def column_catalog(records: DataFrame, columns: DataFrame, record_fields: DataFrame, fields: DataFrame, owner: str, prefix: str = "") -> DataFrame:
    """Columns of the owner's tables by record, with the application's view of each; only records that begin with ``prefix``."""
    own = columns.where(F.col("owner") == owner).withColumnRenamed("table_name", "physical_table_name").drop("owner")
    used = record_fields.select("recname", F.col("fieldname").alias("column_name"), "fieldnum", _text("recname_parent").alias("recname_parent"))
    known = fields.select(F.col("fieldname").alias("column_name"), "fieldtype", F.col("length").alias("ps_field_length"), F.substring("descrlong", 1, DESCRIPTION_CHARS).alias("field_descrlong"))
    mapped = _mapped(records).where(F.col("recname").startswith(prefix)).select("recname", "physical_table_name")
    joined = mapped.join(own, "physical_table_name").join(used, ["recname", "column_name"], "left").join(known, "column_name", "left")
    return joined.select(
        "recname", "physical_table_name", "column_id", "column_name", "data_type", "data_length", F.col("nullable").alias("nullable_flag"), "fieldnum", "recname_parent",
        "fieldtype", F.coalesce("ps_field_length", "data_length").alias("field_length"), "field_descrlong",
    )


def index_catalog(indexes: DataFrame, keys: DataFrame) -> DataFrame:
    """Key fields of every index; an index without any has one row."""
    return indexes.join(keys, ["recname", "indexid"], "left").select("recname", "indexid", F.col("uniqueflag").alias("uniqueness_flag"), F.col("keyposn").alias("field_position"), "fieldname", "ascdesc")
