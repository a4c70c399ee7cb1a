"""orderlake: web-shop behaviour events to a star schema, as Spark DataFrame jobs.

Layers:
  functions/  pure Column expressions (prices, currency symbols, keys, text, JSON shape)
  operators/  DataFrame -> DataFrame building blocks (dedup, lookup and range joins,
              default members, data-quality checks, report measures, page resolution)
  sources/    readers, sinks, the exchange-rate seed, adapters from the driver tables
  plans/      the staging, intermediate and warehouse models composed from the above
  streaming/  exactly-once file ingestion with a load ledger
"""

__version__ = "0.1.0"
