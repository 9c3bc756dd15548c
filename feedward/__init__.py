"""Data-feed quality engine: raw -> clean -> KPI -> audit layers as Spark jobs."""
