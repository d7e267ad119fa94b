"""Readers and writers: footers, GeoParquet, GeoJSON lines, element text, manifests."""
