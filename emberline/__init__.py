"""Hotspot analytics on Spark: detections in, daily features, forecasts and monitoring out."""
