"""chronogrid: gridded time-series analytics on Spark.

A grid is a table with one row per (time, y, x) cell-step and one column per
variable; constants live in a cell table, the time axis in an axis table and
variable attributes in a catalog table.  Every operator takes and returns
DataFrames; nothing is collected to the driver in the core.
"""

__version__ = "0.1.0"
