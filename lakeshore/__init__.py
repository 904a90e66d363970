"""lakeshore: batch and incremental warehouse operators on Spark DataFrames.

Sub-packages:
  sources    - table scans, landed payloads, landed CSV, driver stand-ins
  functions  - scalar column helpers (cleaning, dates, labels)
  operators  - dedup, upsert, quality gates, star-schema model, audit,
               incremental windows, marts
  plans      - storage (snapshots, publish), export, size-checked joins,
               views, the people/events build, the model refresh and the
               end-to-end daily flow
  streaming  - exactly-once file loads and streaming upserts

Top-level modules: session (settings, scratch folders), schemas (declared
table schemas), fixed (values that must equal the reference's), registry
and oracle (the registered queries and their DuckDB SQL).
"""

__all__ = ["fixed", "schemas", "session"]
