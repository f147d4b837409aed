from .commits import CommitLog, append_once, publish_once, stream_path
from .writers import (append_metrics, append_metrics_once, append_parquet, save_model,
                      write_batch_csv, write_partitioned, write_sized)

__all__ = ["CommitLog", "append_metrics", "append_metrics_once", "append_once", "append_parquet", "publish_once", "save_model",
           "stream_path", "write_batch_csv", "write_partitioned", "write_sized"]
