"""basketry: Spark-native retail customer analytics.

Every operator is a DataFrame -> DataFrame function built on Spark SQL
expressions, aggregations, windows and MLlib.  Sub-packages:

* ``functions``  column expressions (bins, text normalisation, exact rounding)
* ``sources``    readers, the driver-table fixture mapping, writers
* ``operators``  cleaning, quality, ranking, features, reports, BI, ML
* ``plans``      composed jobs and the query registry used by the driver
* ``streaming``  incremental refresh of the BI exports
"""

from basketry.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
