"""Models (staging, marts, semantic), the metric catalog and the daily run."""
