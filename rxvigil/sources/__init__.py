from rxvigil.sources.feeds import (
    decode,
    decode_failures,
    decoded_good,
    read_feed,
    split_decoded,
    stream_feed,
)

__all__ = [
    "decode", "decode_failures", "decoded_good", "read_feed", "split_decoded", "stream_feed",
]
