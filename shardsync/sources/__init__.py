from shardsync.sources.named_query import is_named_query, query_text, read_named_query
from shardsync.sources.replicas import Choice, NoReplica, choose_replicas
from shardsync.sources.shards import (
    ShardSpec,
    common_root,
    file_cluster,
    jdbc_options,
    jdbc_predicates,
    parse_shards,
    read_sharded,
)

__all__ = [
    "Choice",
    "NoReplica",
    "choose_replicas",
    "ShardSpec",
    "common_root",
    "file_cluster",
    "is_named_query",
    "jdbc_options",
    "jdbc_predicates",
    "parse_shards",
    "query_text",
    "read_named_query",
    "read_sharded",
]
