"""Bulk Spark jobs over a catalog of version-tracked public geodata."""
