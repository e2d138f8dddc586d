from tidemark.functions.codecs import bytes_to_long, long_to_bytes, to_utf8, from_utf8, long_to_hex
from tidemark.functions.keys import (counter_key, day_of, random_code, salt_prefix, salted_key, unsalt,
                                     region_of, SPLIT_KEYS, ALPHABETS)
from tidemark.functions.offsets import encode_offsets, decode_offsets

__all__ = ["bytes_to_long", "long_to_bytes", "to_utf8", "from_utf8", "long_to_hex",
           "counter_key", "day_of", "random_code", "salt_prefix", "salted_key", "unsalt", "region_of",
           "SPLIT_KEYS", "ALPHABETS", "encode_offsets", "decode_offsets"]
