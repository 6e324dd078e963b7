"""Spark-native analytics for media ingest: identity, deduplication, segments, detections, reports."""
