"""burstline: trending-topic detection over timestamped short posts, on PySpark.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns; nothing runs until the caller asks for an action, except in ``jobs``.
"""
