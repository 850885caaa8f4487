from tidemark.sources.layers import register_views
from tidemark.sources.raw import preview, read_raw, spread

__all__ = ["preview", "read_raw", "register_views", "spread"]
