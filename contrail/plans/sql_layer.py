"""SQL access to the feature table.

Analysts query the cleaned table by name with SQL that sums the delay flags
(``SUM(IS_DELAYED_ARRIVAL) / COUNT(*)``); Spark does not sum booleans, so the
query layer exposes every boolean flag as int 0/1 and registers the table under
a name. Everything after that is plain ``spark.sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VIEW = "flights_features"


def query_layer(features: DataFrame) -> DataFrame:
    """The feature table with boolean columns as int 0/1 (null stays null)."""
    flags = [f.name for f in features.schema.fields if f.dataType.typeName() == "boolean"]
    return features.withColumns({c: F.col(c).cast("int") for c in flags})


def register_table(features: DataFrame, name: str = DEFAULT_VIEW, persist: bool = False) -> str:
    """Publish the query layer under ``name``: a temp view, or with ``persist`` a
    catalog table."""
    layer = query_layer(features)
    if persist:
        layer.write.mode("overwrite").saveAsTable(name)
    else:
        layer.createOrReplaceTempView(name)
    return name


def overview_sql(name: str) -> str:
    """SQL over a registered table: per scheduled hour and season, flights, late arrivals and the worst delay."""
    return f"""
        SELECT SEASON, DEPARTURE_HOUR, count(*) AS flights,
               sum(IS_DELAYED_ARRIVAL) AS late, max(ARRIVAL_DELAY) AS worst_delay
        FROM {name} WHERE SEASON IS NOT NULL GROUP BY ALL"""
