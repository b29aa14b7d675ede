"""Business records derived from the `part` table, for queries and tests on tables that have none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text

# The view in SQL that Spark and DuckDB both read; `string` stands for the engine's own name of the type.
VIEW = """
WITH b AS (SELECT CAST(p_partkey AS BIGINT) AS k, CAST(round((p_partkey - p_partkey % 3) / 3.0) AS BIGINT) AS ent,
    p_partkey % 3 AS src, p_name, p_brand, p_type, p_size FROM {part}),
h AS (SELECT ent, max(CASE WHEN src=0 THEN p_name END) AS n0, max(CASE WHEN src=0 THEN p_brand END) AS br,
    max(CASE WHEN src=0 THEN p_type END) AS ty, max(CASE WHEN src=0 THEN p_size END) AS sz FROM b GROUP BY ent)
SELECT concat('S', CAST(b.src+1 AS {string}), '-', lpad(CAST(b.k AS {string}), 8, '0')) AS entity_id, CAST(b.src + 1 AS INT) AS src, b.k AS k,
 CASE WHEN b.src=0 THEN concat(h.n0, ' ', substr(h.br,7), ' Pvt Ltd')
      WHEN b.k % 7 = 0 THEN concat(b.p_name, ' L.L.C.')
      WHEN b.src=1 THEN concat(upper(h.n0), ' ', substr(h.br,7), ' Private Limited')
      ELSE concat('The ', h.n0, ' & Co.') END AS business_name,
 CASE WHEN b.src=2 AND b.k % 11 = 0 THEN ''
      ELSE concat(CAST(h.sz AS {string}), CASE WHEN b.src=1 THEN ' ' ELSE ' No ' END, lower(h.ty),
        CASE WHEN b.src=0 THEN ' Rd, ' ELSE ' road, ' END, CAST(560000 + h.ent % 97 AS {string})) END AS business_address,
 CASE WHEN h.ent % 3 = 0 THEN CASE WHEN b.src=0 THEN 'India' ELSE 'IND' END
      WHEN h.ent % 3 = 1 THEN CASE WHEN b.src=0 THEN 'US' ELSE 'United States' END
      ELSE 'France' END AS country,
 h.ent AS ent, (b.k % 7 <> 0 AND b.src > 0) AS is_true_link
FROM b JOIN h ON b.ent = h.ent
"""


def raw_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql(VIEW.format(part="{part}", string="STRING"), part=part)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, src, ord, business_*, country, norm_*, ent, is_true_link)."""
    return raw_entities(spark, sf_dir).select(
        "entity_id",
        "src",
        (F.shiftleft(F.col("src").cast("bigint"), 56) + F.col("k")).alias("ord"),
        "business_name",
        "business_address",
        "country",
        text.business_name(F.col("business_name")).alias("norm_name"),
        text.address(F.col("business_address")).alias("norm_address"),
        text.country(F.col("country")).alias("norm_country"),
        "ent",
        "is_true_link",
    )


def truth(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(s1_id) of all entities of source 1, and (s1_id, target_id) of the true links."""
    s1 = known.where("src = 1").select(F.col("entity_id").alias("s1_id"), "ent")
    targets = known.where("is_true_link").select(F.col("entity_id").alias("target_id"), "ent")
    return s1.select("s1_id"), s1.join(targets, "ent").select("s1_id", "target_id")
