"""DuckDB SQL for each registered query (the correctness oracle).

Each string runs on the pre-registered parquet views; the shared leading
CTEs rebuild the engine's input tables from ``events`` / ``part`` with the
same rule as ``tvpulse.sources.testdata``.
"""
