from .readers import (kafka_options, load_model, read_demographic_csv,
                      read_partitioned, read_sensor_csv, read_stream,
                      read_stream_dir, read_typed_csv)

__all__ = ["kafka_options", "load_model", "read_demographic_csv", "read_partitioned",
           "read_sensor_csv", "read_stream", "read_stream_dir", "read_typed_csv"]
