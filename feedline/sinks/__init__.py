"""Writers: JSON lines, Parquet, Kafka value frames, metrics."""

from feedline.sinks.writers import (
    append_metrics,
    kafka_values,
    write_jsonl,
    write_kafka,
    write_kafka_stream,
    write_records,
)

__all__ = ["append_metrics", "kafka_values", "write_jsonl", "write_kafka", "write_kafka_stream", "write_records"]
