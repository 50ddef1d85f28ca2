"""tidemark: a Spark-native change-data lakehouse toolkit.

Change feeds -> cleansed tables -> type 2 / type 1 dimensions, calendar and an
order-line fact -> business queries, a quality gate, partitioned event files,
profiles, health metrics and role-restricted views.  Every operator is a
function from DataFrames to DataFrames planned by Catalyst.
"""

__version__ = "0.1.0"
