"""eventide: Spark-native event analytics and keyed-sequence operators.

Every operator is a function DataFrame -> DataFrame built from the
DataFrame / SQL API so that Catalyst plans it and Spark scales it over
keys and partitions.  See README.md for the operator map.
"""

__version__ = "0.1.0"
