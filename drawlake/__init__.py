"""drawlake: Spark DataFrame operators for time-ordered tables of small number sets.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and is
expressed with built-in DataFrame/SQL functions so Catalyst plans it.
"""

from drawlake.schemas import DEFAULT_POOLS, MAIN, STAR, Pool

__all__ = ["Pool", "MAIN", "STAR", "DEFAULT_POOLS"]
__version__ = "0.1.0"
