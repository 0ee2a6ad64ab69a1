"""rillstone: a Spark-native engine for registries built from many dirty sources.

Every public operator is a function over DataFrames or Columns; nothing runs
until the caller acts on the result.
"""

__version__ = "0.1.0"
