"""fareflow: ride-hailing analytics as Spark DataFrame operators.

Layers (each a plain function DataFrame -> DataFrame):

* ``fareflow.sources``   raw table contracts, the test-data adapter, sinks
* ``fareflow.functions`` Column expressions (cleaning, bands, dates, keys, rates)
* ``fareflow.operators`` DataFrame operators (dedup, fraud, sessions, ranking,
  joins, incremental merge, SCD2, data quality)
* ``fareflow.plans``     staging -> intermediate -> mart pipelines
* ``fareflow.streaming`` Structured Streaming variants of the status feed
"""

from fareflow.session import PipelineConfig, get_session

__all__ = ["PipelineConfig", "get_session"]
