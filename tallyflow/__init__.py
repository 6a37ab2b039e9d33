"""Real-time retail analytics as PySpark DataFrame and Structured Streaming jobs."""
