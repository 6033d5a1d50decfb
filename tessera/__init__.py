"""tessera: a Spark-native medallion pipeline for retail order analytics.

Layers: raw (landed files) -> bronze (typed) -> silver (deduplicated)
-> gold (joined) -> marts (aggregated), with data-quality operators that
return violating rows.  Everything is DataFrame / SQL; no Python UDFs.
"""

__version__ = "0.1.0"
