"""Input views derived from the given tables; the same SQL text runs in Spark and DuckDB.

``{name}`` stands for a given table: Spark gets a DataFrame there, DuckDB the view's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


TABLES = ("lineitem", "orders", "customer", "nation", "part", "supplier")

_JOIN_SQL = """
WITH j AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS ln, CAST(l.l_shipdate AS TIMESTAMP) AS ship,
         l.l_partkey AS pk, l.l_suppkey AS sk, l.l_extendedprice AS px, l.l_returnflag AS rf,
         CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS od,
         CAST(CAST(l.l_shipdate AS DATE) AS STRING) AS sd,
         o.o_orderpriority AS issue0, p.p_brand AS brand, p.p_type AS ptype, p.p_name AS pname,
         s.s_name AS sname, n.n_name AS nname, c.c_mktsegment AS seg, c.c_custkey AS ck
  FROM {lineitem} l
  JOIN {orders} o ON l.l_orderkey = o.o_orderkey
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey
  JOIN {part} p ON l.l_partkey = p.p_partkey
  JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
)
"""

_RAW_ROWS_SQL = """SELECT
  CASE WHEN k % 101 = 0 THEN NULL
       WHEN k % 103 = 0 THEN 'ID-' || CAST(k AS STRING)
       WHEN k % 107 = 0 THEN '   '
       WHEN k % 5 = 0 THEN ' ' || CAST(k AS STRING) || ' '
       ELSE CAST(k AS STRING) END AS complaint_id,
  CASE WHEN k % 97 = 0 THEN 'not a date'
       WHEN k % 89 = 0 THEN '  '
       WHEN k % 4 = 0 THEN substr(od, 6, 2) || '/' || substr(od, 9, 2) || '/' || substr(od, 1, 4)
       WHEN k % 4 = 1 THEN CAST(CAST(substr(od, 6, 2) AS INT) AS STRING) || '/'
            || CAST(CAST(substr(od, 9, 2) AS INT) AS STRING) || '/' || substr(od, 1, 4)
       WHEN k % 4 = 2 THEN od
       ELSE od || ' 00:00:00' END AS date_received,
  CASE WHEN (k + ln) % 53 = 0 THEN NULL ELSE sd END AS date_sent_to_company,
  CASE WHEN pk % 7 = 0 THEN ptype || '  ' ELSE ptype END AS product,
  CASE WHEN pk % 11 = 0 THEN NULL WHEN pk % 13 = 0 THEN '' ELSE pname END AS sub_product,
  issue0 AS issue,
  CASE WHEN pk % 3 = 0 THEN NULL ELSE brand END AS sub_issue,
  CASE WHEN sk % 19 = 0 THEN NULL ELSE sname END AS company,
  CASE WHEN ck % 23 = 0 THEN NULL WHEN ck % 29 = 0 THEN ' '
       WHEN ck % 2 = 0 THEN lower(nname) ELSE nname END AS state,
  CASE WHEN ck % 31 = 0 THEN NULL WHEN ck % 37 = 0 THEN '12A' WHEN ck % 41 = 0 THEN '90210-1234'
       ELSE substr(CAST(10000 + ck AS STRING), 1, 5) END AS zip_code,
  CASE WHEN k % 6 = 0 THEN 'Older American' ELSE NULL END AS tags,
  CASE WHEN ck % 2 = 0 THEN lower(seg) ELSE seg END AS submitted_via,
  CASE WHEN rf = 'R' THEN 'Closed with relief' WHEN rf = 'A' THEN 'Closed with explanation'
       ELSE '' END AS company_response_to_consumer,
  CASE WHEN (pk * 7 + sk * 3) % 20 = 0 THEN 'No' WHEN (pk + sk) % 45 = 0 THEN ' n '
       WHEN (pk + sk) % 47 = 0 THEN NULL WHEN (pk + sk) % 59 = 0 THEN 'maybe'
       WHEN k % 3 = 0 THEN 'Y' ELSE 'Yes' END AS timely_response,
  CASE WHEN k % 2 = 0 THEN 'narrative ' || CAST(ln AS STRING) ELSE NULL END
       AS consumer_complaint_narrative,
  CAST(ship AS DATE) AS _ingestion_date, ship AS _ingested_at,
  CAST('landing/records.zip' AS STRING) AS _source_zip_path,
  CAST(ln AS STRING) || '.csv' AS _source_csv_name,
  ln AS _ln, pk AS _pk, sk AS _sk, px AS _px
FROM j
"""

RAW_SQL = _JOIN_SQL + _RAW_ROWS_SQL

#: The join of ``RAW_SQL`` in another order: the parts go to narrow lines, the customers to the orders, and lines meet orders last.
_DEALT_JOIN_SQL = """
WITH parts AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS ln, CAST(l.l_shipdate AS TIMESTAMP) AS ship,
         l.l_partkey AS pk, l.l_suppkey AS sk, l.l_extendedprice AS px, l.l_returnflag AS rf,
         p.p_brand AS brand, p.p_type AS ptype, p.p_name AS pname, s.s_name AS sname
  FROM {lineitem} l
  JOIN {part} p ON l.l_partkey = p.p_partkey
  JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
),
lines AS (SELECT /*+ REPARTITION(k) */ * FROM parts),
heads AS (
  SELECT o.o_orderkey AS ok, CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS od,
         o.o_orderpriority AS issue0, n.n_name AS nname, c.c_mktsegment AS seg, c.c_custkey AS ck
  FROM {orders} o
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey
),
j AS (
  SELECT lines.*, CAST(CAST(ship AS DATE) AS STRING) AS sd, heads.*
  FROM lines JOIN heads ON k = ok
)
"""

SCORED_SQL = """
SELECT l_orderkey * 10 + l_linenumber AS id,
  CASE WHEN l_linenumber % 2 = 0 THEN 'm1' ELSE 'm2' END AS model_name,
  CASE WHEN l_suppkey % 2 = 0 THEN 'VALIDATION' ELSE 'TEST' END AS dataset_split,
  CAST((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 7) % 1000 AS DOUBLE) / 1000 AS probability,
  CASE WHEN (l_partkey * 13 + l_orderkey * 101) % 1000
            < ((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 7) % 1000) / 5
       THEN 1 ELSE 0 END AS label
FROM {lineitem}
"""

#: Scored rows of which no two have the same score: an odd factor permutes the numbers below 2^32.
SCORED_FINE_SQL = """
WITH numbered AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_linenumber AS ln, l_suppkey AS sk, l_partkey AS pk,
    ((l_orderkey * 10 + l_linenumber) * 2654435761) % 4294967296 AS place FROM {lineitem})
SELECT id,
  CASE WHEN ln % 2 = 0 THEN 'm1' ELSE 'm2' END AS model_name,
  CASE WHEN sk % 2 = 0 THEN 'VALIDATION' ELSE 'TEST' END AS dataset_split,
  CAST(place AS DOUBLE) / 4294967296 AS probability,
  CASE WHEN ((pk * 13 + id * 101) % 1000) * 14316557 < place THEN 1 ELSE 0 END AS label
FROM numbered
"""

RAW_COLUMNS = (
    "complaint_id",
    "date_received",
    "date_sent_to_company",
    "product",
    "sub_product",
    "issue",
    "sub_issue",
    "company",
    "state",
    "zip_code",
    "tags",
    "submitted_via",
    "company_response_to_consumer",
    "timely_response",
    "consumer_complaint_narrative",
)
TIE_BREAKS = ("_ln", "_pk", "_sk", "_px")


def _given(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def complaints_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer: dirty all-text business columns plus lineage.

    The given files hold one row group each, which is one task of work; so the lines are dealt out by the order's key before the text columns
    are made, over partitions that follow from their size. Only narrow rows meet the other tables before that. All rows of an id, which is the order's key, come to lie
    in one file, where ``dedupe_latest`` leaves one of them before its shuffle.
    """
    return spark.sql(_DEALT_JOIN_SQL + _RAW_ROWS_SQL, **_given(spark, sf_dir, *TABLES))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows of two models on two splits."""
    return spark.sql(SCORED_SQL, **_given(spark, sf_dir, "lineitem"))


def scored_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows with as many scores as rows."""
    return spark.sql(SCORED_FINE_SQL, **_given(spark, sf_dir, "lineitem"))


def duckdb_sql(template: str) -> str:
    """The DuckDB text of a view: table names in place of the placeholders."""
    return template.format(**{n: n for n in TABLES})


def write_csv(df: DataFrame, path: str) -> None:
    """Write rows as the delimited source has them: header, doubled quotes, spaces kept."""
    (
        df.write.options(header="true", quote='"', escape='"', encoding="UTF-8")
        .options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .csv(path)
    )


def pack_archives(spark: SparkSession, csv_path: str, target: str) -> DataFrame:
    """One ZIP per delimited file under ``csv_path``, streamed file by file; ``(archive)`` rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(csv_path).select("path")

    def pack(batches):
        import posixpath
        import shutil
        import zipfile

        import pandas as pd

        from lakeops.sources.archives import CHUNK_BYTES, _open

        for batch in batches:
            out = []
            for path in batch["path"]:
                name = posixpath.basename(path)
                archive = f"{target}/{name}.zip"
                with _open(path, "r") as data, _open(archive, "w") as sink:
                    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as packed:
                        packed.writestr("readme.txt", "no data")
                        with packed.open(name, "w") as member:
                            shutil.copyfileobj(data, member, length=CHUNK_BYTES)
                out.append(archive)
            yield pd.DataFrame({"archive": out})

    return files.mapInPandas(pack, "archive string")
