"""barlake: Spark-native operators for keyed bar/time-series tables.

Bronze (landed raw bars) -> silver (clean, forward-filled, moving averages,
quality gate) -> gold (date/ticker dimensions, price fact, feature view),
written as DataFrame operators that take key, time and value column names
as parameters.
"""

__version__ = "0.1.0"
