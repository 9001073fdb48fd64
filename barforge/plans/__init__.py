"""End-to-end jobs: lake setup, incremental load (entry A), transform
(entry B, full build or incremental refresh) and the daily job that runs
both. Operators never write; these jobs decide when the storage helpers in
``barforge.sources`` do."""
