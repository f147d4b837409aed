from .jobs import decode, encode, kafka_sink_options, publish, score, trigger_kwargs
from .state import Chain, compact, features_stream, read_rows, score_stream

__all__ = ["Chain", "compact", "decode", "encode", "features_stream", "kafka_sink_options", "publish", "read_rows", "score", "score_stream",
           "trigger_kwargs"]
