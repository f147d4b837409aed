from .columns import (chunk_of, clip, is_missing, json_decode, json_encode,
                      round6, strip_and_cast)

__all__ = ["chunk_of", "clip", "is_missing", "json_decode", "json_encode",
           "round6", "strip_and_cast"]
