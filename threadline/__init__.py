"""Lineage graphs over notebooks, built and queried as Spark jobs."""
