"""Pose tables derived from the benchmark tables: frames from orders, instances from lineitem, classes from part.

One portable SQL text for each, which Spark runs here (but for fx_masks) and DuckDB runs as a CTE of the oracles. Every row of the
tables takes part; the pixel grid of a frame is region x region, 5 x 5 pixels of 128 x 96 image points.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FRAMES = """
SELECT o_orderkey AS frame_id, lpad(CAST(o_custkey % 15 + 1 AS STRING), 6, '0') AS subset,
  CAST(floor(o_orderkey / 100) AS BIGINT) AS shard_id, 640 AS img_w, 480 AS img_h,
  CAST(o_orderkey % 8 AS DOUBLE) * 0.125e0 AS cam_x, CAST(o_orderkey % 5 AS DOUBLE) * 0.25e0 AS cam_y, 0.5e0 + CAST(o_orderkey % 4 AS DOUBLE) * 0.125e0 AS cam_z,
  CASE o_custkey % 4 WHEN 0 THEN 0.0e0 WHEN 1 THEN 0.5e0 WHEN 2 THEN 0.6e0 ELSE 0.0e0 END AS cam_qx,
  CASE o_custkey % 4 WHEN 0 THEN 0.0e0 WHEN 1 THEN 0.5e0 WHEN 2 THEN 0.0e0 ELSE 0.6e0 END AS cam_qy,
  CASE o_custkey % 4 WHEN 0 THEN 0.0e0 WHEN 1 THEN 0.5e0 WHEN 2 THEN 0.0e0 ELSE 0.8e0 END AS cam_qz,
  CASE o_custkey % 4 WHEN 0 THEN 1.0e0 WHEN 1 THEN 0.5e0 WHEN 2 THEN 0.8e0 ELSE 0.0e0 END AS cam_qw,
  500.0e0 + CAST(o_custkey % 5 AS DOUBLE) * 10.0e0 AS fx, 500.0e0 + CAST(o_custkey % 5 AS DOUBLE) * 10.0e0 + CASE WHEN o_custkey % 7 = 0 THEN 2.0e0 ELSE 0.0e0 END AS fy,
  320.0e0 + CAST(o_custkey % 3 AS DOUBLE) AS cx, 240.0e0 AS cy, CASE WHEN o_custkey % 3 = 0 THEN 0.1e0 ELSE 1.0e0 END AS depth_scale
FROM orders"""

ANNOTATIONS = """
SELECT l_orderkey AS frame_id, CAST(ii AS INT) AS instance_index, CAST(ii + 1 AS INT) AS obj_id, l_partkey AS class_id, p_brand AS cls,
  (l_quantity - 25.0e0) / 64.0e0 AS pos_x, CAST(l_suppkey % 32 - 16 AS DOUBLE) / 32.0e0 AS pos_y, CAST(l_partkey % 16 AS DOUBLE) / 16.0e0 AS pos_z,
  CASE WHEN vis THEN CAST(bx AS INT) ELSE 0 END AS x1, CASE WHEN vis THEN CAST(b_y AS INT) ELSE 0 END AS y1,
  CASE WHEN vis THEN CAST(least(bx + 1 + l_linenumber * 20, 639) AS INT) ELSE 0 END AS x2,
  CASE WHEN vis THEN CAST(least(b_y + 1 + (l_partkey % 37) * 5, 479) AS INT) ELSE 0 END AS y2,
  ii % 5 = 4 AS hidden, l_partkey % 2 = 0 AS has_semantics
FROM (SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS ii,
    CAST(l_quantity AS BIGINT) % 10 <> 0 AS vis, (l_partkey * 7) % 600 AS bx, (l_suppkey * 13) % 440 AS b_y FROM lineitem l) a
JOIN part ON l_partkey = p_partkey"""

#: Joins of fx_masks as Spark makes them: objects meet their frame before its pixels are made, so that no pixel is shuffled or sorted on its own.
SPARK_MASKS = """
SELECT frame_id, instance_index, y, x, CASE WHEN (x + y * 2 + frame_id) % 7 = 0 THEN 0 ELSE CAST(200 + (x * 131 + y * 117 + frame_id) % 1200 AS INT) END AS depth_raw
FROM (SELECT f.frame_id, a.instance_index, CAST(r.r_regionkey AS INT) AS y, CAST(s.r_regionkey AS INT) AS x
  FROM fx_frames f JOIN fx_annotations a ON a.frame_id = f.frame_id AND a.x2 > 0
  JOIN region r ON r.r_regionkey BETWEEN floor(a.y1 / 96.0e0) AND floor(a.y2 / 96.0e0) JOIN region s ON s.r_regionkey BETWEEN floor(a.x1 / 128.0e0) AND floor(a.x2 / 128.0e0)) m"""

PIXELS = """
SELECT f.frame_id, CAST(r.r_regionkey AS INT) AS y, CAST(s.r_regionkey AS INT) AS x, f.depth_scale,
  CASE WHEN (s.r_regionkey + r.r_regionkey * 2 + f.frame_id) % 7 = 0 THEN 0 ELSE CAST(200 + (s.r_regionkey * 131 + r.r_regionkey * 117 + f.frame_id) % 1200 AS INT) END AS depth_raw
FROM fx_frames f CROSS JOIN region r CROSS JOIN region s"""

MASKS = """
SELECT p.frame_id, a.instance_index, p.y, p.x, p.depth_raw
FROM fx_pixels p JOIN fx_annotations a ON a.frame_id = p.frame_id AND a.x2 > 0
 AND p.x BETWEEN floor(a.x1 / 128.0e0) AND floor(a.x2 / 128.0e0) AND p.y BETWEEN floor(a.y1 / 96.0e0) AND floor(a.y2 / 96.0e0)"""

ASSETS = """
SELECT p_partkey AS asset_id, CASE p_partkey % 3 WHEN 0 THEN 'SYNTHDET' WHEN 1 THEN 'OMNI3D' ELSE 'YCB' END AS source,
  concat('models/', replace(p_name, ' ', '_'), CASE p_partkey % 11 WHEN 0 THEN '_vhacd.obj' WHEN 1 THEN '_collision.obj' ELSE '.obj' END) AS path,
  replace(p_name, ' ', '_') AS name, CAST(p_size AS DOUBLE) / 100.0e0 AS diameter, p_retailprice AS price
FROM part"""

QUATS = """
SELECT vec_id, q0 / n AS qx, q1 / n AS qy, q2 / n AS qz, q3 / n AS qw, v0 AS vx, v1 AS vy, v2 AS vz
FROM (SELECT *, sqrt(q0 * q0 + q1 * q1 + q2 * q2 + q3 * q3) AS n FROM
 (SELECT vec_id, CAST(embedding[{0}] AS DOUBLE) AS q0, CAST(embedding[{1}] AS DOUBLE) AS q1, CAST(embedding[{2}] AS DOUBLE) AS q2, CAST(embedding[{3}] AS DOUBLE) AS q3,
   CAST(embedding[{4}] AS DOUBLE) AS v0, CAST(embedding[{5}] AS DOUBLE) AS v1, CAST(embedding[{6}] AS DOUBLE) AS v2 FROM embeddings) e) s"""

#: name -> (SQL, the tables that it reads)
TABLES = {
    "fx_frames": (FRAMES, ["orders"]),
    "fx_annotations": (ANNOTATIONS, ["lineitem", "part"]),
    "fx_pixels": (PIXELS, ["fx_frames", "region"]),
    "fx_masks": (MASKS, ["fx_pixels", "fx_annotations"]),
    "fx_assets": (ASSETS, ["part"]),
    "fx_quats": (QUATS, ["embeddings"]),
}

#: Tables that Spark derives by another text with the same rows.
SPARK_TABLES = {"fx_masks": (SPARK_MASKS, ["fx_frames", "fx_annotations", "region"])}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the directory, or one derived from it."""
    if name not in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql, needs = SPARK_TABLES.get(name, TABLES[name])
    sql = sql.format(*range(7))  # Spark counts from 0, DuckDB from 1
    inputs = {n: read(spark, sf_dir, n) for n in needs}
    if name == "fx_pixels":  # pixels come dealt out by frame, as frames are before their pixels are made
        inputs["fx_frames"] = inputs["fx_frames"].repartition("frame_id")
    for n in needs:
        sql = re.sub(rf"(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", sql)
    return spark.sql(sql, **inputs)


def with_tables(sql: str) -> str:
    """DuckDB SQL with the derived tables that it names as CTEs."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name in text and name not in need:
                visit(TABLES[name][0])
                need.append(name)

    visit(sql)
    ctes = ", ".join(f"{n} AS MATERIALIZED ({TABLES[n][0].format(*range(1, 8)).strip()})" for n in need)
    body = sql.strip()
    if not need:
        return body
    return f"WITH {ctes}, {body[5:]}" if body.startswith("WITH ") else f"WITH {ctes} {body}"
