"""barforge: a Spark-first daily-price lakehouse.

Layers: landing files -> bronze (upserted on symbol, date) -> staging view
-> weekly / monthly OHLCV bars -> weekly technical indicators, with data
checks on every layer. Every operator is a ``DataFrame -> DataFrame``
function built from the DataFrame API, so Catalyst plans the whole flow.
"""

__version__ = "0.1.0"
