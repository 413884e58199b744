"""socialog: the message log of a social network as Spark DataFrames.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing here reads the clock, so the caller passes ``now``.
"""
