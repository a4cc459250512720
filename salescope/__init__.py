"""salescope — sales, net-sales and forecast-accuracy analytics on Spark.

Every operator is a plain Python function that takes a :class:`SalesTables`
bundle of lazy DataFrames plus keyword parameters and returns a lazy
DataFrame built only from Spark SQL / DataFrame primitives, so Catalyst and
adaptive query execution plan the whole query.
"""

from salescope.sources.tables import SalesTables, load_tables
from salescope.session import get_session

__all__ = ["SalesTables", "load_tables", "get_session"]
