"""cordon - a Spark-native trip warehouse and policy-impact analytics library.

Layers: ``sources`` (raw reads, the test-table adapter, ingest), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame building blocks),
``plans`` (warehouse build, gate, publish and the named query catalog) and
``streaming`` (incremental ingest as a Structured Streaming job).
"""

from cordon.config import TAXI, TPCH_TRIPS, PipelineConfig

__all__ = ["PipelineConfig", "TAXI", "TPCH_TRIPS"]
