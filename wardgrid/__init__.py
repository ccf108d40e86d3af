"""wardgrid: a PySpark-native analytics engine for longitudinal event data.

Every operator is a lazy function of DataFrames; Catalyst plans the work.
"""

__version__ = "0.1.0"
