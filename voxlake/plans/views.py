"""The domain's tables as views of the test tables, for Spark and, equally, for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Every voxel is of one of two campaigns, whose subjects overlap; one sulcus is named S1 in A and S63 in B.
_IN_A = "l_suppkey % 5 <> 0 AND (l_suppkey % 7 = 0 OR l_returnflag = 'A')"

#: name -> (test table, columns as expressions both engines read alike, condition)
_SIMPLE = {
    "campaign_voxels": (
        "lineitem",
        [
            f"CASE WHEN {_IN_A} THEN 'A' ELSE 'B' END AS campaign", "CAST(l_suppkey AS STRING) AS subject_id", "CASE WHEN l_linestatus = 'F' THEN 'L' ELSE 'R' END AS side", f"concat('S', CAST(CASE WHEN l_partkey % 63 <> 1 OR {_IN_A} THEN l_partkey % 63 ELSE 63 END AS STRING)) AS sulcus",
            "CASE WHEN l_tax < 0.03 THEN 'aims_bottom' WHEN l_tax < 0.06 THEN 'aims_ss' ELSE 'aims_other' END AS bucket", "CAST(l_quantity AS INT) - 1 AS x", "CAST(l_linenumber AS INT) AS y", "CAST(round(l_discount * 100) AS INT) AS z",
        ],
        None,
    ),
    "region_sulci": ("customer", ["c_mktsegment AS region", "CASE WHEN c_nationkey % 2 = 0 THEN 'L' ELSE 'R' END AS side", "concat('S', CAST(c_nationkey * 2 + c_custkey % 7 AS STRING)) AS sulcus"], None),
    "vectors": ("embeddings", ["concat('R', CAST(label AS STRING)) AS region", "CASE WHEN CAST(floor(vec_id / 7) AS BIGINT) % 2 = 0 THEN 'left' ELSE 'right' END AS hemi", "CAST(vec_id AS STRING) AS subject_id", "vec_id", "label", "embedding AS vec"], None),
    "qc": ("labels", ["CAST(doc_id AS STRING) AS participant_id", "CASE WHEN doc_id % 11 = 3 THEN NULL ELSE quality END AS qc"], None),
    "subjects": ("documents", ["CAST(doc_id AS STRING) AS subject_id"], None),
    "files": (
        "part",
        [
            "concat('/data/derivatives/crops/', CASE WHEN p_partkey % 3 = 0 THEN 'v1/' ELSE '' END, '2mm/', p_brand, '/mask/', CASE WHEN p_partkey % 2 = 0 THEN 'L' ELSE 'R' END, 'crops/sub-', CAST(p_partkey AS STRING), "
            "CASE p_size % 4 WHEN 0 THEN '.nii.gz' WHEN 1 THEN '.nii' WHEN 2 THEN '_cropped_skeleton.nii.gz.minf' ELSE '.nii.gz.minf' END) AS path",
            "p_brand AS region", "CASE WHEN p_partkey % 2 = 0 THEN 'L' ELSE 'R' END AS side", "CASE p_size % 4 WHEN 0 THEN 'crop' WHEN 1 THEN 'volume' WHEN 2 THEN 'skeleton' ELSE 'header' END AS kind", "concat('sub-', CAST(p_partkey AS STRING)) AS subject_id",
            "CAST(p_size AS BIGINT) * 100 AS length",
        ],
        None,
    ),
    "graph_paths": (
        "orders",
        [
            "concat('/db/sub-', CAST(o_custkey AS STRING), '/t1mri/acq', CAST(o_orderkey % 3 AS STRING), CASE WHEN o_orderkey % 2 = 0 THEN '/default_analysis/' ELSE '/default_acquisition/0/' END, "
            "CASE WHEN o_orderkey % 5 = 0 THEN concat('segmentation/mesh/sub-', CAST(o_custkey AS STRING), CASE WHEN o_orderkey % 4 < 2 THEN '_Lwhite.gii' ELSE '_Rwhite.gii' END) "
            "ELSE concat(CASE WHEN o_orderkey % 7 = 0 THEN 'other/' ELSE 'folds/3.1/' END, CASE WHEN o_orderkey % 4 < 2 THEN 'L' ELSE 'R' END, 'sub-', CAST(o_custkey AS STRING), CASE WHEN o_orderkey % 11 = 0 THEN '.minf' ELSE '.arg' END) END) AS path"
        ],
        None,
    ),
    "table_names": (
        "supplier",
        [
            "CASE s_suppkey % 4 WHEN 0 THEN concat('FColl-R', CAST(s_nationkey AS STRING), '_left_name05-06-07--', CAST(s_suppkey AS STRING), '_embeddings.csv') WHEN 1 THEN concat('_S.T--a', CAST(s_nationkey AS STRING), '--right--name01-02-03--', CAST(s_suppkey AS STRING), '_embeddings.csv') "
            "WHEN 2 THEN concat('R', CAST(s_nationkey AS STRING), '_both_name05-06-07--', CAST(s_suppkey AS STRING), '_embeddings.csv') ELSE concat('R', CAST(s_nationkey AS STRING), '_left_', CAST(s_suppkey AS STRING), '.csv') END AS name",
            "s_suppkey",
        ],
        None,
    ),
    "folders": ("supplier", ["concat('R.', CAST(s_nationkey AS STRING), CASE s_suppkey % 3 WHEN 0 THEN '_left' WHEN 1 THEN '_right' ELSE '_both' END) AS folder", "s_suppkey"], None),
    "statuses": ("orders", ["CASE o_orderkey % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'skipped' WHEN 2 THEN 'invalid_foldlabel' WHEN 3 THEN 'failed: no space' ELSE 'ok' END AS status", "CAST(o_orderkey AS STRING) AS subject_id"], None),
}

SQL = {
    name: f"SELECT {', '.join(columns)} FROM {table}".replace(" AS STRING)", " AS VARCHAR)") + (f" WHERE {where}" if where else "") for name, (table, columns, where) in _SIMPLE.items()
}
SQL["region_sulci"] = SQL["region_sulci"].replace("SELECT", "SELECT DISTINCT", 1)
SQL |= {
    "counts": "SELECT campaign, side, subject_id, sulcus, count(*) AS n FROM campaign_voxels GROUP BY ALL",
    "merged": "SELECT campaign, subject_id, sulcus, arg_max(n, side) AS n FROM counts GROUP BY ALL",
    "mask_voxels": "SELECT campaign AS mask_set, side, sulcus, x, y, z, CAST(count(DISTINCT subject_id) AS INTEGER) AS n FROM campaign_voxels WHERE x BETWEEN 0 AND 49 AND y BETWEEN 0 AND 7 AND z BETWEEN 0 AND 10 GROUP BY ALL",
    "all_masks": "SELECT side, sulcus, x, y, z, CAST(count(DISTINCT subject_id) AS INTEGER) AS n FROM campaign_voxels WHERE x BETWEEN 0 AND 49 AND y BETWEEN 0 AND 7 AND z BETWEEN 0 AND 10 GROUP BY ALL",
    "region_mask": "SELECT region, side, x, y, z, CAST(sum(n) AS INTEGER) AS n FROM all_masks JOIN region_sulci USING (side, sulcus) GROUP BY ALL HAVING sum(n) > 1",
    "box": "SELECT region, side, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z, max(x) - min(x) + 1 AS size_x, max(y) - min(y) + 1 AS size_y, max(z) - min(z) + 1 AS size_z FROM region_mask GROUP BY ALL",
    "new_vectors": "SELECT * FROM vectors WHERE vec_id % 20 = 0",
    "reference": "SELECT * FROM vectors WHERE vec_id % 20 <> 0",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns, where = _SIMPLE[name]
    df = table(spark, sf_dir, source)
    df = (df.where(where) if where else df).selectExpr(*columns)
    return df.distinct() if name == "region_sulci" else df


def oracle(body: str) -> str:
    """`body` with the views it uses, and those that they use, before it."""
    need, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name, sql in SQL.items():
            if name not in need and f" {name}" in f" {text}".replace("(", " ").replace(",", " ").replace("\n", " "):
                need.add(name)
                todo.append(sql)
    views = ", ".join(f"{n} AS ({SQL[n]})" for n in SQL if n in need)
    if not views:
        return body
    head = "WITH RECURSIVE " if body.startswith("WITH RECURSIVE ") else "WITH "
    return f"{head}{views}, {body.removeprefix(head)}" if body.startswith(head) else f"{head}{views} {body}"


def dims() -> tuple[int, int, int]:
    return 50, 8, 11


def halves(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two embedding sets of the same subjects: the first and the last 32 numbers of each vector."""
    return tuple(vectors.withColumn("vec", F.slice("vec", F.lit(a), F.lit(32))) for a in (1, 33))
