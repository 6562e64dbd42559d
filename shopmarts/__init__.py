"""PySpark-native order-data warehouse: contract-checked CSV sources, per-table cleaning, integrity
gates, an idempotent Parquet publish, and twelve analytical marts.

Packages: ``sources`` (contracts, CSV scan, Parquet sink), ``functions`` (column expressions),
``operators`` (cleaning, integrity checks, range-parallel ranking), ``plans`` (marts, pipeline,
test-table mapping, SQL oracles), ``streaming`` (none needed).
"""
