"""Readers and writers: array files, rasters, GeoJSON, scene items, lists."""
