"""reelhouse: Spark jobs for video-platform metadata.

Raw nested documents are parsed once into DataFrames, flattened into the
video / channel / caption / thumbnail tables, landed as date-partitioned
JSON, loaded into append-only tables under a strict schema, filtered for
media eligibility, exported to CSV parts of an exact size and gated on the
value of a SQL query. Every job is a DataFrame -> DataFrame function; the
SparkSession always comes from the caller.
"""

__all__ = ["schemas"]
