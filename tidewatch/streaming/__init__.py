from tidewatch.streaming.dedup import dedup_stream
from tidewatch.streaming.identity import attach_identity_stream
from tidewatch.streaming.shaped import shape_stream
from tidewatch.streaming.shaping import coalesce_repeats_stream, rate_limit_stream

__all__ = ["attach_identity_stream", "coalesce_repeats_stream", "dedup_stream", "rate_limit_stream",
           "shape_stream"]
