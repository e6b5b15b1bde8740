"""Gold marts as persistent SQL views (K2, the ``as_view`` option).

A persistent Spark view stores SQL text: that of the mart (``plans/gold.py``),
with the silver table's name for its input.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from reelhouse.plans import catalog, gold


def gold_view_sql(name: str, silver: str = "silver") -> str:
    mart = gold.MARTS[name]
    return mart.sql(f"`{silver}`.silver_{mart.source}")


def create_gold_view(spark: SparkSession, name: str, silver: str = "silver",
                     gold_layer: str = "gold") -> str:
    """K2: ``CREATE OR REPLACE VIEW gold.<name>`` over the silver tables. A mart
    that was a table until now becomes a view."""
    catalog.ensure_layers(spark, (gold_layer,))
    full = f"{gold_layer}.{name}"
    if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW":
        spark.sql(f"DROP TABLE `{gold_layer}`.`{name}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{gold_layer}`.`{name}` AS {gold_view_sql(name, silver)}")
    return f"{gold_layer}.{name}"
