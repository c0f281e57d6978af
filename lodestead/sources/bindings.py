"""Catalogue relations derived from the test tables.

The text is plain SQL that Spark and DuckDB both run, so a query and its twin read the
same inputs: parts are tables, orders their key fields, events their access statistics,
and shipping years the runs of a catalogue load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestead.sources.shared import file_bytes

#: The day on which ages are measured.
AS_OF = "2002-01-01"

RELATIONS = """
runs AS (SELECT DISTINCT year(l_shipdate) - 1994 AS run_id FROM lineitem),
vocab AS (SELECT * FROM (VALUES
  (0,'EMPLID','VARCHAR2',11),(1,'ACCOUNT','VARCHAR2',10),(2,'DESCR','VARCHAR2',30),(3,'EMAIL_ADDR','VARCHAR2',70),
  (4,'MONETARY_AMOUNT','NUMBER',26),(5,'LAST_UPDATED','TIMESTAMP(6)',11),(6,'COMMENTS_LONG','CLOB',4000),(7,'VENDOR_ID','VARCHAR2',10),
  (8,'QTY_SHIPPED','NUMBER',15),(9,'SETID','VARCHAR2',5),(10,'INV_ITEM_ID','VARCHAR2',18),(11,'EFFDT','DATE',7)
) AS v(k, column_name, data_type, data_length)),
src_part AS (
  SELECT p_partkey, p_brand, p_type, p_size, p_name, p_retailprice,
         'T' || CAST(p_partkey AS STRING) AS table_name,
         upper(replace(p_name, ' ', '_')) || '_' || CAST(p_partkey AS STRING) AS recname
  FROM part),
table_catalog AS (
  SELECT year(l.l_shipdate) - 1994 AS run_id, p.p_brand AS owner, p.table_name,
         CAST(SUM(l.l_quantity) AS BIGINT) * 1000 AS num_rows, COUNT(*) AS blocks,
         CAST(p.p_size AS BIGINT) * 10 AS avg_row_len,
         CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE MAX(l.l_shipdate) END AS last_analyzed,
         CASE WHEN p.p_partkey % 5 = 0 THEN NULL ELSE MIN(l.l_shipdate) END AS last_modified,
         (COUNT(DISTINCT l.l_suppkey) - 1) * 3 AS referenced_by_count
  FROM lineitem l JOIN src_part p ON p.p_partkey = l.l_partkey
  GROUP BY year(l.l_shipdate) - 1994, p.p_brand, p.table_name, p.p_size, p.p_partkey),
record_catalog AS (
  SELECT r.run_id, c.recname, CASE WHEN c.p_partkey % 5 = 0 THEN NULL ELSE c.p_name END AS recdescr,
         CAST(c.p_partkey % 4 AS STRING) AS rectype, c.table_name AS physical_table_name, c.p_brand AS oracle_owner,
         CASE WHEN c.p_partkey % 3 = 0 THEN NULL ELSE c.table_name END AS oracle_table_name,
         CASE WHEN c.p_partkey % 3 = 0 THEN 0 ELSE 1 END AS table_exists_flag, p.recname AS parentrecname
  FROM src_part c CROSS JOIN runs r
  LEFT JOIN src_part p ON p.p_partkey = CAST(floor(c.p_partkey / 13) AS BIGINT) AND c.p_partkey >= 13),
column_catalog AS (
  SELECT DISTINCT year(l.l_shipdate) - 1994 AS run_id, p.recname, p.table_name AS physical_table_name,
         v.k AS column_id, v.column_name, v.data_type, v.data_length,
         CASE l.l_returnflag WHEN 'A' THEN 'N' WHEN 'N' THEN 'Y' ELSE NULL END AS nullable_flag
  FROM lineitem l JOIN src_part p ON p.p_partkey = l.l_partkey
  JOIN vocab v ON v.k = (l.l_orderkey + l.l_linenumber) % 12),
index_catalog AS (
  SELECT DISTINCT year(o.o_orderdate) - 1994 AS run_id, p.recname,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'A' ELSE '0' END AS indexid,
         CAST(v.k AS BIGINT) AS field_position, v.column_name AS fieldname
  FROM orders o JOIN src_part p ON p.p_partkey = o.o_custkey
  JOIN vocab v ON v.k = o.o_orderkey % 12),
segment_statistics AS (
  SELECT 7 AS run_id, p.p_brand AS owner, p.table_name AS object_name, 'TABLE' AS object_type,
         CASE WHEN e.event_type IN ('view','click') THEN 'logical reads' WHEN e.event_type = 'purchase' THEN 'physical reads' ELSE 'other' END AS statistic_name,
         CAST(floor(e.value) AS BIGINT) AS value
  FROM events e JOIN src_part p ON p.p_partkey = e.user_id),
prediction AS (
  SELECT r.run_id, p.recname, p.table_name, p.p_brand AS owner,
         CASE p.p_type WHEN 'ECONOMY' THEN 'Finance' WHEN 'STANDARD' THEN 'HR' WHEN 'PROMO' THEN 'Sales' WHEN 'LARGE' THEN 'IT' WHEN 'MEDIUM' THEN 'Procurement' ELSE 'Supply' END AS domain,
         CASE p.p_type WHEN 'ECONOMY' THEN 'IT' ELSE 'Finance' END AS domain_alt,
         CAST(((p.p_partkey * 37 + r.run_id * 11) % 100) AS DOUBLE) / 100 AS confidence,
         (p.p_partkey + r.run_id) % 9 = 0 AS review_required,
         CASE WHEN p.p_partkey % 4 = 0 THEN 'keyword_rule/v1' ELSE 'v1' END AS model_version
  FROM src_part p CROSS JOIN runs r),
gold AS (
  SELECT run_id, recname, domain AS predicted, confidence,
         CASE WHEN (length(recname) + run_id) % 4 = 0 THEN domain_alt WHEN length(recname) % 11 = 0 THEN '' ELSE domain END AS human_label
  FROM prediction),
votes AS (
  SELECT l_orderkey AS asset_id, l_linenumber AS vote_no, CASE WHEN l_tax > 0.06 THEN 'semantic_first' ELSE 'salient_first' END AS variant,
         CASE l_returnflag WHEN 'A' THEN 'Finance' WHEN 'N' THEN 'IT' ELSE (CASE WHEN l_linestatus = 'F' THEN 'Other' ELSE '' END) END AS label
  FROM lineitem),
psrecdefn AS (
  SELECT recname, p_name AS recdescr, CAST(p_partkey % 4 AS STRING) AS rectype, CASE WHEN p_partkey % 3 = 0 THEN '  ' ELSE table_name END AS sqltablename,
         CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE upper(replace(p_name, ' ', '_')) END AS parentrecname
  FROM src_part UNION ALL SELECT 'PSDUMMY', 'dummy', '0', ' ', ' '),
all_tables AS (
  SELECT p_brand AS owner, CASE WHEN p_partkey % 6 = 0 THEN 'PS_' || recname ELSE table_name END AS table_name, 'TS' || CAST(p_size AS STRING) AS tablespace_name,
         CAST(p_partkey * 7 AS BIGINT) AS num_rows, CAST(p_size AS BIGINT) AS blocks, CAST(p_size AS BIGINT) * 10 AS avg_row_len, 'N' AS temporary, CASE WHEN p_size > 25 THEN 'YES' ELSE 'NO' END AS partitioned
  FROM src_part),
all_tab_modifications AS (
  SELECT p.p_brand AS table_owner, p.table_name, l.l_shipdate AS modified_at FROM lineitem l JOIN src_part p ON p.p_partkey = l.l_partkey WHERE l.l_linenumber > 2),
all_dependencies AS (
  SELECT 'APP' AS owner, 'S' || CAST(l.l_suppkey AS STRING) AS name, CASE WHEN l.l_linestatus = 'F' THEN 'VIEW' ELSE 'PACKAGE' END AS type,
         p.p_brand AS referenced_owner, p.table_name AS referenced_name, CASE WHEN l.l_linenumber = 7 THEN 'SYNONYM' ELSE 'TABLE' END AS referenced_type
  FROM lineitem l JOIN src_part p ON p.p_partkey = l.l_partkey),
all_tab_columns AS (
  SELECT DISTINCT t.owner, t.table_name, v.k AS column_id, v.column_name, v.data_type, v.data_length, CASE WHEN v.k % 2 = 0 THEN 'N' ELSE 'Y' END AS nullable
  FROM all_tables t JOIN src_part p ON t.table_name IN (p.table_name, 'PS_' || p.recname) JOIN lineitem l ON l.l_partkey = p.p_partkey JOIN vocab v ON v.k = (l.l_orderkey + l.l_linenumber) % 12),
psrecfielddb AS (
  SELECT recname, v.column_name AS fieldname, v.k + 1 AS fieldnum, CASE WHEN v.k = 3 THEN ' ' ELSE 'R' || CAST(v.k AS STRING) END AS recname_parent FROM src_part CROSS JOIN vocab v WHERE (p_partkey + v.k) % 3 > 0),
psdbfield AS (SELECT column_name AS fieldname, k % 5 AS fieldtype, data_length AS length, concat(column_name, ' holds ', repeat('x', k * 500)) AS descrlong FROM vocab WHERE k <> 7),
psindexdefn AS (
  SELECT DISTINCT p.recname, CASE WHEN o.o_orderkey % 3 = 0 THEN 'A' ELSE '0' END AS indexid, CASE WHEN o.o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS uniqueflag FROM orders o JOIN src_part p ON p.p_partkey = o.o_custkey),
pskeydefn AS (
  SELECT DISTINCT p.recname, '0' AS indexid, CAST(v.k AS BIGINT) AS keyposn, v.column_name AS fieldname, 1 AS ascdesc
  FROM orders o JOIN src_part p ON p.p_partkey = o.o_custkey JOIN vocab v ON v.k = o.o_orderkey % 12 WHERE o.o_orderkey % 2 = 0)
"""

#: The relations whose text joins or compares more than it has to, as Spark works them out: the same rows, but rows of the
#: long tables become few by their numbers before names are joined, and no names are compared with each other in pairs.
FORMS = {
    "table_catalog": """
  SELECT l.run_id, p.p_brand AS owner, p.table_name, CAST(l.quantity * p.copies AS BIGINT) * 1000 AS num_rows, l.rows * p.copies AS blocks, CAST(p.p_size AS BIGINT) * 10 AS avg_row_len,
         CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE l.last END AS last_analyzed, CASE WHEN p.p_partkey % 5 = 0 THEN NULL ELSE l.first END AS last_modified, (l.suppliers - 1) * 3 AS referenced_by_count
  FROM (SELECT run_id, l_partkey, SUM(quantity) AS quantity, SUM(rows) AS rows, MAX(last) AS last, MIN(first) AS first, COUNT(l_suppkey) AS suppliers
        FROM (SELECT run_id, l_partkey, l_suppkey, SUM(l_quantity) AS quantity, COUNT(*) AS rows, MAX(l_shipdate) AS last, MIN(l_shipdate) AS first
              FROM (SELECT /*+ REPARTITION(run_id, l_partkey) */ year(l_shipdate) - 1994 AS run_id, l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem WHERE l_partkey IS NOT NULL) GROUP BY run_id, l_partkey, l_suppkey)
        GROUP BY run_id, l_partkey) l
  JOIN (SELECT p_partkey, p_brand, table_name, p_size, COUNT(*) AS copies FROM src_part GROUP BY p_partkey, p_brand, table_name, p_size) p ON p.p_partkey = l.l_partkey""",
    "column_catalog": """
  SELECT l.run_id, p.recname, p.table_name AS physical_table_name, v.k AS column_id, v.column_name, v.data_type, v.data_length, l.nullable_flag
  FROM (SELECT DISTINCT year(l_shipdate) - 1994 AS run_id, l_partkey, (l_orderkey + l_linenumber) % 12 AS k, CASE l_returnflag WHEN 'A' THEN 'N' WHEN 'N' THEN 'Y' ELSE NULL END AS nullable_flag FROM lineitem) l
  JOIN (SELECT DISTINCT p_partkey, recname, table_name FROM src_part) p ON p.p_partkey = l.l_partkey
  JOIN vocab v ON v.k = l.k""",
    "all_tab_columns": """
  SELECT n.owner, n.table_name, v.k AS column_id, v.column_name, v.data_type, v.data_length, CASE WHEN v.k % 2 = 0 THEN 'N' ELSE 'Y' END AS nullable
  FROM (SELECT DISTINCT t.owner, t.table_name, l.k
        FROM all_tables t JOIN (SELECT table_name AS name, p_partkey FROM src_part UNION SELECT 'PS_' || recname, p_partkey FROM src_part) p ON p.name = t.table_name
        JOIN (SELECT DISTINCT l_partkey, (l_orderkey + l_linenumber) % 12 AS k FROM lineitem) l ON l.l_partkey = p.p_partkey) n
  JOIN vocab v ON v.k = n.k""",
}
#: Relations that have a run.
BY_RUN = ("table_catalog", "record_catalog", "column_catalog", "index_catalog", "segment_statistics", "prediction", "gold")
TABLES = ("part", "lineitem", "orders", "events")


#: Bytes of parts that one task turns into names; a compressed file of them is small, what is made of it for all runs is not.
PART_BYTES = 100_000


def relation(spark: SparkSession, sf_dir: str, name: str, run: int | None = None) -> DataFrame:
    """One catalogue relation over the tables in ``sf_dir``, of one run where it is given."""
    tasks = -(-file_bytes(spark, f"{sf_dir}/part.parquet") // PART_BYTES)
    spread = {"part": f"/*+ REPARTITION({tasks}) */ "} if tasks > 1 else {}
    tables = ", ".join(f"{t} AS (SELECT {spread.get(t, '')}* FROM parquet.`{sf_dir}/{t}.parquet`)" for t in TABLES)
    found = spark.sql(f"WITH {tables}, {RELATIONS} {FORMS.get(name, f'SELECT * FROM {name}')}")
    return found if run is None else found.where(f"run_id = {run}")


def latest_run_id(spark: SparkSession, sf_dir: str) -> int | None:
    """The greatest run that any record has."""
    return spark.sql(f"SELECT max(year(l_shipdate)) - 1994 AS run_id FROM parquet.`{sf_dir}/lineitem.parquet`").first()[0]
