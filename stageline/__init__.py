"""Table loads on Spark: convert, refresh, plan changes, keep load metadata.

Sub-packages:

* ``sources``   - scans: CSV, Parquet, partitions, listings, control tables
* ``sinks``     - writers: converted tables, stage tables, touched partitions
* ``functions`` - column functions: table lists, templates, job parameters
* ``operators`` - lookups, keyed updates, aggregates and checks on frames
* ``plans``     - change plan between two snapshots, run requests
* ``streaming`` - ready-messages, staged loads, run states
"""
