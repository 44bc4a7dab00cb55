from siltstone.streaming.feed import apply_feed

__all__ = ["apply_feed"]
