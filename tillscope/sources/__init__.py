from tillscope.sources.transactions import read_processed, read_raw, register

__all__ = ["read_processed", "read_raw", "register"]
