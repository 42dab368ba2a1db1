"""Warehouse layout, pipeline, dashboard slices and the query registry."""
