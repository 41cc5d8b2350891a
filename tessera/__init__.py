"""tessera — clustering of located, dated records on Spark DataFrames.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects (or column
expressions) so Catalyst can prune, push down and fuse the work; nothing
passes whole tables through the driver.
"""

__version__ = "0.1.0"
