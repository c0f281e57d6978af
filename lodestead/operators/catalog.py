"""Processed layer: assets, fields, profiles, lineage, features and the ML dataset.

Every function takes and returns DataFrames keyed by ``run_id``, so one job builds all
runs; ids are digests of their natural key, so a rebuild keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.semantics import column_semantics
from lodestead.sources.shared import written

MB = 1024.0 * 1024.0


def asset_key(run_id: Column, system: Column, name: Column) -> Column:
    return F.md5(F.concat_ws("|", run_id.cast("string"), system, name))


def dim_asset(table_catalog: DataFrame, record_catalog: DataFrame) -> DataFrame:
    """Physical tables and logical records as one dimension, each side without repeats."""
    nothing = F.lit(None).cast("string")
    tables = table_catalog.select(
        "run_id",
        F.lit("oracle").alias("source_system"),
        F.lit("oracle_table").alias("asset_type"),
        F.concat("owner", F.lit("."), "table_name").alias("technical_name"),
        nothing.alias("business_name"),
        F.col("owner").alias("owner_name"),
        nothing.alias("description"),
        F.col("table_name").alias("source_ref"),
    ).distinct()
    records = record_catalog.select(
        "run_id",
        F.lit("peoplesoft").alias("source_system"),
        F.lit("ps_record").alias("asset_type"),
        F.col("recname").alias("technical_name"),
        F.col("recdescr").alias("business_name"),
        F.col("oracle_owner").alias("owner_name"),
        F.col("recdescr").alias("description"),
        F.col("physical_table_name").alias("source_ref"),
    ).distinct()
    both = tables.unionByName(records)
    return both.withColumn("asset_id", asset_key(F.col("run_id"), F.col("source_system"), F.col("technical_name")))


def nullable_flag(flag: Column) -> Column:
    """Y or nothing: true; N: false; anything else: unknown."""
    up = F.upper(F.coalesce(flag, F.lit("Y")))
    return F.when(up == "Y", True).when(up == "N", False)


def record_fields(assets: DataFrame, column_catalog: DataFrame) -> DataFrame:
    """Columns of the logical records; names meet without regard to case."""
    records = assets.where("asset_type = 'ps_record'").select("run_id", "asset_id", F.upper("technical_name").alias("key"))
    columns = column_catalog.where("recname is not null and column_name is not null").withColumn("key", F.upper("recname"))
    return columns.join(records, ["run_id", "key"]).select(
        "run_id", "asset_id", F.col("column_name").alias("technical_name"), "data_type", "data_length",
        nullable_flag(F.col("nullable_flag")).alias("nullable"), F.concat("recname", F.lit("."), "column_name").alias("source_ref"),
    )


def table_fields(assets: DataFrame, table_catalog: DataFrame, column_catalog: DataFrame) -> DataFrame:
    """Columns of the physical tables; repeats by record are merged before the join."""
    columns = (
        column_catalog.where("physical_table_name is not null and column_name is not null")
        .select("run_id", F.upper("physical_table_name").alias("key"), "column_name", "data_type", "data_length", "nullable_flag")
        .distinct()
    )
    owned = table_catalog.select("run_id", "owner", "table_name", F.upper("table_name").alias("key"), F.upper(F.concat("owner", F.lit("."), "table_name")).alias("full"))
    tables = assets.where("asset_type = 'oracle_table'").select("run_id", "asset_id", F.upper("technical_name").alias("full"))
    return tables.join(owned, ["run_id", "full"]).join(columns, ["run_id", "key"]).select(
        "run_id", "asset_id", F.col("column_name").alias("technical_name"), "data_type", "data_length",
        nullable_flag(F.col("nullable_flag")).alias("nullable"), F.concat("owner", F.lit("."), "table_name", F.lit("."), "column_name").alias("source_ref"),
    )


def dim_field(assets: DataFrame, table_catalog: DataFrame, column_catalog: DataFrame) -> DataFrame:
    return record_fields(assets, column_catalog).unionByName(table_fields(assets, table_catalog, column_catalog))


def size_mb(rows: Column, length: Column) -> Column:
    return rows.cast("double") * length.cast("double") / F.lit(MB)


def asset_profile(assets: DataFrame, table_catalog: DataFrame, record_catalog: DataFrame, column_catalog: DataFrame, index_catalog: DataFrame) -> DataFrame:
    """Table statistics of each asset, by full name first and by table name for the rest."""
    columns = column_catalog.groupBy("run_id", F.upper("physical_table_name").alias("key")).agg(F.count("*").alias("column_count"))
    indexes = (
        record_catalog.select("run_id", "recname", F.upper(F.coalesce("oracle_table_name", "physical_table_name")).alias("key"))
        .join(index_catalog, ["run_id", "recname"])
        .groupBy("run_id", "key").agg(F.countDistinct("indexid").alias("index_count"))
    )
    tables = (
        table_catalog.select(
            "run_id", F.upper("table_name").alias("key"), F.upper(F.concat("owner", F.lit("."), "table_name")).alias("full"),
            F.col("num_rows").alias("row_count"), size_mb(F.col("num_rows"), F.col("avg_row_len")).alias("size_mb"), "last_analyzed",
        )
        .join(columns, ["run_id", "key"], "left")
        .join(indexes, ["run_id", "key"], "left")
    )
    return _matched(assets, tables, "row_count", "size_mb", "column_count", "index_count", "last_analyzed")


def asset_sizes(assets: DataFrame, table_catalog: DataFrame) -> DataFrame:
    """``(run_id, asset_id, size_mb)`` of every asset: the greatest size of its profiles, null where it has none."""
    tables = table_catalog.select(
        "run_id", F.upper("table_name").alias("key"), F.upper(F.concat("owner", F.lit("."), "table_name")).alias("full"), size_mb(F.col("num_rows"), F.col("avg_row_len")).alias("size_mb")
    )
    key = ["run_id", "asset_id"]
    return assets.select(key).join(_matched(assets, tables, "size_mb").groupBy(key).agg(F.max("size_mb").alias("size_mb")), key, "left")


def _matched(assets: DataFrame, tables: DataFrame, *values: str) -> DataFrame:
    """Values of ``tables(run_id, key, full, ...)`` of each asset, by full name first and by table name for the rest."""
    named = assets.select("run_id", "asset_id", F.upper("technical_name").alias("full"), F.upper(F.nullif(F.trim("source_ref"), F.lit(""))).alias("key"))
    first = named.drop("key").join(tables, ["run_id", "full"]).select("run_id", "asset_id", F.lit("technical_name").alias("match_type"), *values)
    rest = named.drop("full").join(first.select("run_id", "asset_id"), ["run_id", "asset_id"], "left_anti")
    second = rest.join(tables, ["run_id", "key"]).select("run_id", "asset_id", F.lit("source_ref").alias("match_type"), *values)
    return first.unionByName(second)


def lineage_edges(assets: DataFrame, record_catalog: DataFrame) -> DataFrame:
    """Parent record to child record; the dimension plays both roles."""
    records = assets.where("asset_type = 'ps_record'").select("run_id", "asset_id", F.upper("technical_name").alias("name"))
    pairs = record_catalog.where("trim(parentrecname) <> ''").select("run_id", F.upper("recname").alias("child"), F.upper("parentrecname").alias("parent"))
    return (
        pairs.join(records.select("run_id", F.col("name").alias("parent"), F.col("asset_id").alias("source_asset_id")), ["run_id", "parent"])
        .join(records.select("run_id", F.col("name").alias("child"), F.col("asset_id").alias("target_asset_id")), ["run_id", "child"])
        .select("run_id", "source_asset_id", "target_asset_id", F.lit("ps_parent_record").alias("lineage_type"))
    )


def archival_score(size: Column, purges: Column, out: Column, terms: Column) -> Column:
    return F.least(size / 100, F.lit(30)) + F.least(purges * 5, F.lit(25)) + F.greatest(20 - 2 * out, F.lit(0)) + F.greatest(25 - 3 * terms, F.lit(0))


def roi_score(size: Column, purged_rows: Column, out: Column) -> Column:
    return F.least(size / 100, F.lit(40)) + F.least(purged_rows / 100000, F.lit(30)) + F.greatest(30 - 2 * out, F.lit(0))


def features_asset(assets: DataFrame, profile: DataFrame, edges: DataFrame, terms: DataFrame | None = None, purges: DataFrame | None = None) -> DataFrame:
    """Most complete profile, degrees and scores of each asset; absent counts are 0.

    ``terms(run_id, asset_id)`` and ``purges(run_id, asset_id, rows_affected)`` are optional.
    """
    key = ["run_id", "asset_id"]
    best = profile.groupBy(key).agg(*[F.max(c).alias(c) for c in ("row_count", "size_mb", "column_count", "index_count")])
    into = edges.groupBy("run_id", F.col("target_asset_id").alias("asset_id")).agg(F.count("*").alias("lineage_in_count"))
    out = edges.groupBy("run_id", F.col("source_asset_id").alias("asset_id")).agg(F.count("*").alias("lineage_out_count"))
    df = assets.select(key).join(best, key, "left").join(into, key, "left").join(out, key, "left")
    zero = F.lit(0).cast("long")
    if terms is None:
        df = df.withColumn("term_count", zero)
    else:
        df = df.join(terms.groupBy(key).agg(F.count("*").alias("term_count")), key, "left")
    if purges is None:
        df = df.withColumns({"purge_event_count": zero, "total_purged_rows": zero})
    else:
        df = df.join(purges.groupBy(key).agg(F.count("*").alias("purge_event_count"), F.sum("rows_affected").alias("total_purged_rows")), key, "left")
    counts = ("lineage_in_count", "lineage_out_count", "term_count", "purge_event_count", "total_purged_rows")
    df = df.withColumns({c: F.coalesce(c, zero) for c in counts})
    size = F.coalesce("size_mb", F.lit(0.0))
    return df.withColumns({
        "archival_candidate_score": archival_score(size, F.col("purge_event_count"), F.col("lineage_out_count"), F.col("term_count")),
        "roi_score": roi_score(size, F.col("total_purged_rows"), F.col("lineage_out_count")),
    })


def latest_profile(profile: DataFrame, *order: Column) -> DataFrame:
    """One profile per asset: the first in the given order."""
    w = Window.partitionBy("run_id", "asset_id").orderBy(*order)
    return profile.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def _field_kinds() -> dict[str, Column]:
    """What is counted of an asset's fields."""
    kind = F.lower(F.coalesce("data_type", F.lit("")))
    text = kind.rlike("char|varchar|text")
    return {
        "field_count": F.lit(True),
        "nullable_field_count": F.col("nullable"),
        "non_nullable_field_count": ~F.col("nullable"),
        "numeric_field_count": kind.rlike("number|integer|int|decimal|numeric|float|double"),
        "date_field_count": kind.rlike("date|timestamp|datetime"),
        "text_field_count": kind.rlike("char|varchar|text|clob"),
        "large_text_field_count": kind.contains("clob") | (text & (F.coalesce("data_length", F.lit(0)) >= 1000)),
    }


def field_counts(fields: DataFrame) -> DataFrame:
    """Counts of each asset's fields by nullability and data-type family."""
    return fields.groupBy("run_id", "asset_id").agg(
        *[F.count_if(fits).alias(n) for n, fits in _field_kinds().items()],
        F.avg("data_length").alias("avg_data_length"),
        F.max("data_length").cast("long").alias("max_data_length"),
    )


def field_texts(fields: DataFrame) -> DataFrame:
    """Packed name, type and semantic lists of each asset, ordered by name then entry."""
    name, kind = F.col("technical_name"), F.coalesce("data_type", F.lit("unknown"))
    packs = {
        "column_names_text": name,
        "column_type_signature_text": F.concat(name, F.lit(":"), kind),
        "column_value_semantics_text": F.concat(name, F.lit(":"), column_semantics(name, F.col("data_type"))),
    }

    def pack(entry: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(name.alias("n"), entry.alias("e")))), lambda s: s["e"]), " | ")

    return fields.groupBy("run_id", "asset_id").agg(*[pack(e).alias(n) for n, e in packs.items()])


def _summed(columns: DataFrame, *keys: str) -> DataFrame:
    """Counts, lengths and sorted ``(name, type, semantic)`` of the fields of each key; rows of a key lie in one partition already."""
    name, kind = F.col("technical_name"), F.col("data_type")
    packed = F.struct(name.alias("n"), F.coalesce(kind, F.lit("unknown")).alias("k"), F.col("semantic").alias("s"))
    return columns.withColumn("packed", packed).groupBy(*keys).agg(
        *[F.count_if(fits).alias(n) for n, fits in _field_kinds().items()], F.sum(F.col("data_length").cast("double")).alias("lengths"), F.count("data_length").alias("with_length"),
        F.max("data_length").cast("long").alias("max_data_length"), F.sort_array(F.collect_list("packed")).alias("packed"),
    )


def field_summary(assets: DataFrame, table_catalog: DataFrame, column_catalog: DataFrame) -> DataFrame:
    """`field_counts` and `field_texts` of what `dim_field` gives, without its rows: columns are summed up by the name
    that they are joined by, before assets are joined.

    Rows are moved as they are, once for each name, and brought into lists where they arrive: a list for each
    row would be moved otherwise, since rows of one name come from all tasks.  Semantics are told once for each
    distinct name and type, in a table whose size Spark knows when it chooses how to join it.
    """
    what = ["technical_name", "data_type", "data_length", "nullable_flag"]
    columns = column_catalog.where("column_name is not null").withColumnRenamed("column_name", "technical_name")
    pairs = columns.select("technical_name", F.coalesce("data_type", F.lit("")).alias("kind")).distinct()
    semantics = written(pairs.withColumn("semantic", column_semantics(F.col("technical_name"), F.col("kind"))), "semantics")

    def told(rows: DataFrame) -> DataFrame:
        known = rows.withColumns({"kind": F.coalesce("data_type", F.lit("")), "nullable": nullable_flag(F.col("nullable_flag"))})
        return known.join(semantics, ["technical_name", "kind"]).drop("kind")

    of_record = _summed(told(columns.where("recname is not null").select("run_id", F.upper("recname").alias("key"), *what)).repartition("run_id", "key"), "run_id", "key")
    records = assets.where("asset_type = 'ps_record'").select("run_id", "asset_id", F.upper("technical_name").alias("key"))
    sets = columns.where("physical_table_name is not null").select("run_id", F.upper("physical_table_name").alias("key"), *what).repartition("run_id", "key").distinct()
    of_table = _summed(told(sets), "run_id", "key")
    owned = table_catalog.select("run_id", F.upper("table_name").alias("key"), F.upper(F.concat("owner", F.lit("."), "table_name")).alias("full"))
    tables = assets.where("asset_type = 'oracle_table'").select("run_id", "asset_id", F.upper("technical_name").alias("full")).join(owned, ["run_id", "full"])
    found = records.join(of_record, ["run_id", "key"]).unionByName(tables.drop("full").join(of_table, ["run_id", "key"])).drop("key")
    # An asset that stands there twice, or has several names, has all of their fields.
    counts = list(_field_kinds())
    own = found.repartition("run_id", "asset_id").groupBy("run_id", "asset_id").agg(
        *[F.sum(c).alias(c) for c in counts], F.sum("lengths").alias("lengths"), F.sum("with_length").alias("with_length"), F.max("max_data_length").alias("max_data_length"), F.sort_array(F.flatten(F.collect_list("packed"))).alias("packed")
    )
    # In order of name, type and semantic, so the first two texts have no order of their own.
    by_semantic = F.sort_array(F.transform("packed", lambda f: F.struct(f["n"].alias("n"), f["s"].alias("s"))))
    return own.select(
        "run_id", "asset_id", *counts, F.try_divide("lengths", "with_length").alias("avg_data_length"), "max_data_length",
        F.array_join("packed.n", " | ").alias("column_names_text"),
        F.array_join(F.transform("packed", lambda f: F.concat(f["n"], F.lit(":"), f["k"])), " | ").alias("column_type_signature_text"),
        F.array_join(F.transform(by_semantic, lambda f: F.concat(f["n"], F.lit(":"), f["s"])), " | ").alias("column_value_semantics_text"),
    )


def dataset_asset_ml(assets: DataFrame, fields: DataFrame, profile: DataFrame) -> DataFrame:
    """Inputs of the domain classifier: counts, profile and packed texts of each asset."""
    return dataset_of_summary(assets, field_counts(fields).join(field_texts(fields), ["run_id", "asset_id"]), profile)


def dataset_texts(assets: DataFrame, summary: DataFrame) -> DataFrame:
    """The assets, names and texts of `dataset_of_summary`, which no profile is needed for: it has a row for each asset at most."""
    texts = ["column_names_text", "column_type_signature_text", "column_value_semantics_text"]
    df = assets.select("run_id", "asset_id", "source_system", "asset_type", "technical_name", "source_ref").join(summary.select("run_id", "asset_id", *texts), ["run_id", "asset_id"], "left")
    return df.withColumns({c: F.coalesce(c, F.lit("")) for c in texts})


def dataset_of_summary(assets: DataFrame, summary: DataFrame, profile: DataFrame) -> DataFrame:
    """The same from a `field_summary`."""
    key = ["run_id", "asset_id"]
    one = latest_profile(profile, F.desc_nulls_last("row_count"), F.desc_nulls_last("size_mb")).select(*key, "row_count", "size_mb", F.lit(True).alias("has_profile_data"))
    counts = list(_field_kinds())
    texts = ["column_names_text", "column_type_signature_text", "column_value_semantics_text"]
    df = assets.select(*key, "source_system", "asset_type", "technical_name", "source_ref").join(summary, key, "left").join(one, key, "left")
    return df.withColumns({
        **{c: F.coalesce(c, F.lit(0).cast("long")) for c in counts},
        **{c: F.coalesce(c, F.lit("")) for c in texts},
        "has_profile_data": F.coalesce("has_profile_data", F.lit(False)),
        "size_bytes": F.round(F.col("size_mb") * MB).cast("long"),
    })
