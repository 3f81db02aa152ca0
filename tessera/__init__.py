"""tessera: medallion-style lakehouse data work written on Spark DataFrames.

Layers: ``sources`` (scans), ``functions`` (column expressions),
``operators`` (DataFrame -> DataFrame steps), ``plans`` (datasets built from
them), ``streaming`` (Structured Streaming jobs), ``sinks`` (writes and
file-level maintenance).
"""

from tessera.session import get_spark

__all__ = ["get_spark"]
