"""adlumen: audience analytics (ETL, funnel reports, tags, identity graph) on Spark DataFrames."""

__version__ = "0.1.0"
