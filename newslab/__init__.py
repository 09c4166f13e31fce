"""newslab: labelled news text analytics and configuration search on Spark.

Everything is expressed with the DataFrame / SQL API so that Catalyst can
prune columns, push filters into the Parquet scan and plan partial
aggregations.  Python runs inside tasks only where a vectorised pandas
step is the natural form (candidate scoring, HTML-free helpers).
"""

__all__ = ["schema", "session"]
