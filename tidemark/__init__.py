"""tidemark: daily-observation analytics as lazy Spark DataFrame transforms.

Every operator takes a DataFrame plus column names and returns a DataFrame, so
operators chain with ``df.transform``.  See README.md for the operator list.
"""

__version__ = "0.1.0"
