"""tessera: DataFrame-native analytics operators on Spark.

Families: text scoring, ridge and sparse logistic regression, graph analytics,
matrix factorization and collaborative filtering.  Every operator takes and
returns DataFrames and is built from Spark's own expressions, joins, windows and
aggregations.
"""

from tessera.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
