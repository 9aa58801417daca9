"""tessera: DataFrame -> DataFrame analytics operators on Spark.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column``) and never triggers an action unless its docstring says so.
"""

from tessera.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
