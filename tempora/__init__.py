"""tempora: composable PySpark operators for measurements over time.

Batch: land historical CSV, profile and clean it without failing on bad
input, compute rounded means, seasonal/period/decade trends, top-k rankings
and outliers. Streaming: watermarked tumbling-window measures over CSV, Parquet
or Kafka record streams. A unified table combines batch and streaming results.
"""

__version__ = "0.1.0"
