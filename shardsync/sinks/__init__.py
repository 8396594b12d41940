from shardsync.operators.commits import CommitConflict
from shardsync.operators.digest import ContentMismatch, Digest, WriteDigest, content_digest
from shardsync.sinks.publish import publish_sharded, remove_replaced, verify_published
from shardsync.sinks.shards import jdbc_write_options, write_sharded
from shardsync.sinks.sync import sync_table

__all__ = [
    "CommitConflict",
    "ContentMismatch",
    "Digest",
    "WriteDigest",
    "content_digest",
    "jdbc_write_options",
    "publish_sharded",
    "remove_replaced",
    "sync_table",
    "verify_published",
    "write_sharded",
]
