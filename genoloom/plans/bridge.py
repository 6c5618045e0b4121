"""Domain tables derived from the driver's tables: the same projections as SQL text and as DataFrames.

Each entry of ``VIEWS`` is SQL that Spark and DuckDB both run; ``frame`` runs it in Spark over the tables it names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

VIEWS = {
    "vep": """
        SELECT 'chr1' AS chrom, CAST(floor(l_orderkey / 32) AS BIGINT) AS start_, CAST(floor(l_orderkey / 32) AS BIGINT) + 1 AS end_,
          'A' AS ref, 'C' AS alt, concat('G', CAST(l_partkey % 4 AS VARCHAR(10))) AS gene,
          concat('T', CAST(l_partkey AS VARCHAR(10))) AS transcript, l_returnflag = 'R' AS stop_gained,
          CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_returnflag = 'A' END AS lof_hc, l_tax AS cadd_raw,
          nullif(l_discount, 0) AS sift
        FROM lineitem""",
    "iso": """
        SELECT concat('G', CAST(p_partkey % 4 AS VARCHAR(10))) AS gene, concat('T', CAST(p_partkey AS VARCHAR(10))) AS transcript,
          n_name AS tissue, CAST((p_partkey * 7 + n_nationkey * 3) % 100 AS DOUBLE) / 100 AS prop
        FROM part CROSS JOIN nation WHERE (p_partkey + n_nationkey) % 3 <> 0""",
    "ids": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = 7 THEN concat('bad:', CAST(l_orderkey AS VARCHAR(20))) ELSE
          concat('chr', CAST(l_linenumber AS VARCHAR(10)), ':', CAST(l_orderkey AS VARCHAR(20)), ':', CAST(l_orderkey + 1 + l_linenumber AS VARCHAR(20)),
          ':', CASE l_returnflag WHEN 'R' THEN '-' WHEN 'A' THEN 'AC' ELSE 'G' END, '>', CASE l_linestatus WHEN 'F' THEN '-' ELSE 'T>C' END) END AS id
        FROM lineitem""",
    "labelled": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 'tolerated' WHEN l_returnflag = 'A' THEN NULL
          ELSE concat('deleterious(', CAST(l_linenumber AS VARCHAR(10)), '.5)') END AS cell
        FROM lineitem""",
    "aliases": "SELECT n_name AS alias, concat('N', CAST(n_nationkey AS VARCHAR(10))) AS name FROM nation WHERE n_nationkey < 10",
    "scores": """
        SELECT concat('chr', CAST(l_suppkey % 5 AS VARCHAR(10))) AS chrom, l_orderkey AS start_, l_orderkey + 1 AS end_, 'A' AS ref, 'C' AS alt,
          CASE WHEN l_linenumber = 6 THEN NULL ELSE concat('G', CAST(l_suppkey % 5 AS VARCHAR(10))) END AS gene, l_returnflag AS tissue,
          CASE WHEN l_quantity < 5 THEN NULL ELSE l_extendedprice END AS score, l_linenumber
        FROM lineitem""",
    "alleles": """
        SELECT o_orderkey, o_custkey AS pos, CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'acG' ELSE 'N' END AS ref,
          CASE o_orderkey % 4 WHEN 0 THEN 'T,G' WHEN 1 THEN '<DEL>,C,TT' WHEN 2 THEN 'C' ELSE '*' END AS alt
        FROM orders""",
}


def sql(text: str) -> str:
    """``text`` with the views that it names as common table expressions, for DuckDB."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", text)]
    body = text.strip()
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in used)
    if not ctes:
        return body
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"


def frame(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A view, or the result of SQL text, over the driver's tables."""
    text = VIEWS.get(view, view)
    used = [t for t in TABLES if re.search(rf"\b{t}\b", text)]
    frames = {f"t_{t}": spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN)(\s+){t}\b", rf"\1\2{{t_{t}}}", text)
    return spark.sql(text, **frames)
