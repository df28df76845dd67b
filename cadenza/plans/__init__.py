"""Query plans over the driver tables: each is (spark, sf_dir) -> DataFrame,
registered with its DuckDB oracle SQL in :mod:`cadenza.plans.registry`."""
