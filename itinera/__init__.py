"""Journey analytics on Spark: booking rows in, legs, trips, eligibility and delay outcomes out.

Every operator takes and returns DataFrames (or Columns) and stays lazy unless its docstring says otherwise.
"""

__version__ = "0.1.0"
