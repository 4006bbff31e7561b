"""Genetic stand-in tables as views over the star-schema tables.

Each text runs unchanged in Spark SQL and in the SQL checker, reads whole base
tables, and may use the views defined before it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# The columns of the base tables that the views use, so that no read has to look for a schema first.
BASE_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_size INT",
    "customer": "c_custkey BIGINT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING",
    "lineitem": "l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
                "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING",
}

VIEWS: dict[str, str] = {
    "vi": """
SELECT 'rs' || CAST(p_partkey AS STRING) AS ID,
       'chr' || CASE WHEN p_partkey % 23 = 22 THEN 'X' ELSE CAST(p_partkey % 23 + 1 AS STRING) END || ':' ||
         CAST((p_partkey * 104729) % 5000000 + 1 AS STRING) AS Marker,
       substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1) AS OA,
       substr('ACGT', CAST((p_partkey + 1 + p_size % 3) % 4 AS INT) + 1, 1) AS EA,
       CAST(p_size AS DOUBLE) / 100e0 AS EAF,
       (80e0 + CAST(p_size % 20 AS DOUBLE)) / 100e0 AS Info
FROM part""",
    "loci": """
SELECT ID, OA, EA, EAF, Info,
       CAST(replace(replace(split_part(Marker, ':', 1), 'chr', ''), 'X', '23') AS INT) AS chromosome,
       CAST(split_part(Marker, ':', 2) AS BIGINT) AS position
FROM vi""",
    "vlist": """
SELECT ID, split_part(Marker, ':', 1) AS Chrom, CAST(split_part(Marker, ':', 2) AS BIGINT) AS Pos, OA, EA FROM vi""",
    "gwas": """
SELECT 'rs' || CAST(l_partkey AS STRING) AS ID, 'trait_' || CAST(l_suppkey % 8 AS STRING) AS phenotype,
       max(l_discount) - max(l_tax) AS beta,
       greatest(0.001e0, (max(l_extendedprice) - 70000e0) / 1000e0) AS chi2
FROM lineitem GROUP BY l_partkey, l_suppkey % 8""",
    "alias_map": """
SELECT 'trait_' || CAST(r_regionkey AS STRING) AS phenotype, 'Lineage ' || r_name AS alias FROM region""",
    "genes": """
SELECT s_name AS gene_name, CAST(s_suppkey % 23 + 1 AS INT) AS chromosome,
       (s_suppkey * 102953) % 5000000 + 1 AS gene_start,
       (s_suppkey * 102953) % 5000000 + 1001 + s_nationkey * 2000 AS gene_end
FROM supplier""",
    "peaks": """
SELECT CAST(o_custkey % 23 + 1 AS INT) AS chromosome,
       (o_orderkey * 15485863) % 5000000 AS peak_start,
       (o_orderkey * 15485863) % 5000000 + 2000 + (o_orderkey % 3000) * 10 AS peak_end,
       'ST' || CAST(o_orderkey AS STRING) || '.TF' || CAST(o_custkey % 50 AS STRING) || '.' || o_orderpriority AS name,
       (o_orderkey * 15485863) % 5000000 + o_custkey % 100 AS thick_start,
       (o_orderkey * 15485863) % 5000000 + 1900 + (o_orderkey % 3000) * 10 AS thick_end
FROM orders""",
    "effects": """
SELECT DISTINCT Chrom || ':' || CAST(Pos AS STRING) || OA || '>' || EA || '.1' AS variant,
       'TF' || CAST(l_suppkey % 50 AS STRING) AS tf, 'M' || CAST(l_linenumber AS STRING) AS model_id,
       CASE WHEN k > 0 THEN 'gain' WHEN k < 0 THEN 'loss' ELSE 'NA' END AS prediction,
       CASE WHEN k < 0 THEN '-' ELSE '' END || '0.' || CAST(abs(k) AS STRING) || '000' ||
         CASE WHEN l_linenumber % 5 = 0 THEN '*' ELSE '' END AS score
FROM (SELECT l_partkey, l_suppkey, l_linenumber, CAST(round(l_discount * 100e0) AS INT) - 5 AS k FROM lineitem) x
JOIN vlist v ON v.ID = 'rs' || CAST(x.l_partkey AS STRING)""",
    "motif_matrix": """
SELECT tf AS TF,
       max(CASE WHEN model_id = 'M1' THEN score END) AS M1, max(CASE WHEN model_id = 'M2' THEN score END) AS M2,
       max(CASE WHEN model_id = 'M3' THEN score END) AS M3, max(CASE WHEN model_id = 'M4' THEN score END) AS M4,
       max(CASE WHEN model_id = 'M5' THEN score END) AS M5, max(CASE WHEN model_id = 'M6' THEN score END) AS M6,
       max(CASE WHEN model_id = 'M7' THEN score END) AS M7
FROM effects GROUP BY tf""",
    "matrix_cells": """
SELECT tf AS TF, variant, min(score) AS score FROM effects GROUP BY tf, variant""",
    "eqtl_a": """
SELECT v.ID AS rsid, v.chromosome, v.position, v.OA, v.EA, 'GA' || CAST(l_suppkey % 5 AS STRING) AS gene,
       l_returnflag AS cell_type, min(l_extendedprice) / 1e7 AS pval, max(l_discount) AS slope
FROM lineitem x JOIN loci v ON v.ID = 'rs' || CAST(x.l_partkey AS STRING)
GROUP BY v.ID, v.chromosome, v.position, v.OA, v.EA, l_suppkey % 5, l_returnflag""",
    "eqtl_b": """
SELECT DISTINCT v.chromosome, v.position,
       CASE WHEN v.position % 5 = 0 THEN v.EA ELSE v.OA END AS ref,
       CASE WHEN v.position % 5 = 0 THEN v.OA ELSE v.EA END AS alt,
       'GB' || CAST(l_suppkey % 4 AS STRING) AS gene, 'tissue_' || l_linestatus AS source
FROM lineitem x JOIN loci v ON v.ID = 'rs' || CAST(x.l_partkey AS STRING)""",
    "raw_vi": """
SELECT ID, OA, EA, EAF, Info,
       CASE WHEN EAF > 0.4e0 THEN replace(Marker, ':', '-') WHEN EAF > 0.35e0 THEN NULL
            WHEN EAF > 0.2e0 THEN replace(Marker, 'chr', '') ELSE Marker END AS Marker
FROM vi""",
    "good_vi": """
SELECT CASE WHEN Info >= 0.85e0 THEN ID ELSE 'old_' || ID END AS ID, Marker, OA, EA, EAF, Info FROM vi""",
    "odd_vi": """
SELECT ID, replace(replace(replace(Marker, 'chr2:', 'chrY:'), 'chr4:', 'chrMT:'), 'chrX:', 'X:') AS Marker, OA, EA, EAF, Info FROM vi""",
    "odd_gwas": """
SELECT ID, replace(replace(phenotype, 'trait_', 'trait, no. '), '3', '3 %2C') AS phenotype, beta, chi2 FROM gwas""",
    "result_files": """
SELECT 'batch_1_run_2_' || phenotype || '_all_chr_v1.res' AS file_name, ID, beta, chi2 FROM gwas""",
    "attributes": """
SELECT 'gene_id "ENSG' || CAST(s_suppkey AS STRING) || '"; gene_type "protein_coding"; gene_name "' || s_name ||
         '"; level 2;' AS attributes, s_suppkey AS line
FROM supplier""",
    "genotyped": """
SELECT c_custkey * 2 AS sample_id FROM customer""",
    "cohort": """
SELECT s_suppkey AS sample_id FROM supplier""",
    "pheno": """
SELECT s_suppkey AS sample_id, sqrt(abs(s_acctbal) + 1e0) AS y1,
       CASE WHEN s_suppkey % 11 = 0 THEN NULL
            ELSE sqrt(abs(s_acctbal) * 0.5e0 + CAST(s_nationkey * s_nationkey AS DOUBLE) * 10e0) END AS y2
FROM supplier""",
    "cov": """
SELECT s_suppkey AS sample_id, CAST(s_suppkey % 2 AS INT) AS sex, CAST(s_nationkey AS DOUBLE) AS pc1 FROM supplier""",
    "geno": """
SELECT 'rs' || CAST(k AS STRING) AS ID, s AS sample_id,
       CASE WHEN (s + k) % 37 = 0 THEN NULL WHEN k % 8 = 0 THEN 2 * a1 ELSE a1 + a2 END AS n_alt
FROM (SELECT k, s,
             CASE WHEN (s * s * 31 + k * 7919 + s * 13) % 101 < cut THEN 1 ELSE 0 END AS a1,
             CASE WHEN (s * s * 17 + k * 104729 + s * 57) % 103 < cut THEN 1 ELSE 0 END AS a2
      FROM (SELECT DISTINCT l_partkey AS k, l_suppkey AS s,
                   CASE WHEN l_partkey % 5 = 1 THEN 2 ELSE 10 + p_size END AS cut
            FROM lineitem JOIN part ON l_partkey = p_partkey) pairs) x""",
}


def uses(name: str) -> list[str]:
    """Views that ``name`` needs, itself last, in definition order."""
    needed: set[str] = set()

    def visit(view: str) -> None:
        if view in needed:
            return
        needed.add(view)
        for other in VIEWS:
            if other != view and re.search(rf"\b(FROM|JOIN) {other}\b", VIEWS[view]):
                visit(other)

    visit(name)
    return [v for v in VIEWS if v in needed]


class Tables:
    """Fixture views of one data directory as DataFrames, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self._spark.read.schema(BASE_TABLES[name]).parquet(f"{self._dir}/{name}.parquet")
        text = VIEWS[name]
        sources = {
            t: getattr(self, t) for t in [*BASE_TABLES, *VIEWS] if re.search(rf"\b(FROM|JOIN) {t}\b", text)
        }
        for source in sources:
            text = re.sub(rf"\b(FROM|JOIN) {source}\b", rf"\1 {{{source}}}", text)
        return self._spark.sql(text, **sources)


def with_clause(*names: str) -> str:
    """``WITH`` prefix that defines the named views and what they need, for the SQL checker."""
    wanted = [v for v in VIEWS if any(v in uses(n) for n in names)]
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in wanted)
