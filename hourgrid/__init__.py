"""hourgrid: hourly sensor-series analytics expressed as Spark DataFrame operators.

Every operator takes DataFrames and column names and returns a lazy DataFrame.
Series are identified by one or more key columns; nothing loops over keys on
the driver and nothing reads the wall clock (``as_of`` is always an argument).
"""

__version__ = "0.1.0"
