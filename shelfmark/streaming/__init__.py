from shelfmark.streaming.catchup import catch_up

__all__ = ["catch_up"]
