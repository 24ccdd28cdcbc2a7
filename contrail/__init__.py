"""contrail: flight-operations analytics as Spark DataFrame jobs.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column`` for the scalar helpers in :mod:`contrail.functions`), so steps chain
with ``df.transform`` and Catalyst sees one logical plan end to end.
"""

__version__ = "0.1.0"
