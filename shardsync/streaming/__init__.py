from shardsync.streaming.sink import read_stream_sink, stream_commits, write_stream_sharded

__all__ = ["read_stream_sink", "stream_commits", "write_stream_sharded"]
