"""Daily market-series analytics on Spark DataFrames.

Layers: ``sources`` (payload parsing, Bronze read/write), ``operators`` (dedup, joins, grain and
gap checks, data quality), ``functions`` (Column helpers), ``plans`` (Silver, Gold, serving and
whole runs), ``streaming`` (trade ticks).  Everything is lazy DataFrame code; there are no Python
UDFs in the data path.
"""
