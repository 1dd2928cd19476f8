"""Spark-native analytics for Dutch residential-mortgage portfolios.

Every operator takes and returns a DataFrame (or a Column) and is lazy; nothing
runs until the caller asks for an action.
"""

__version__ = "0.1.0"
