"""The replica of a shard that answers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from shardsync.operators.commits import list_names

#: Tells why a replica can't be read; None if it can.
Probe = Callable[[str], str | None]


class NoReplica(RuntimeError):
    """No replica of a shard can be read."""


@dataclass(frozen=True)
class Choice:
    """The replica a shard is read from, and what was wrong with those before it."""

    shard: int
    replica: str
    passed: tuple[tuple[str, str], ...] = ()


def folder_probe(spark: SparkSession, folder_of: Callable[[str], str]) -> Probe:
    """A folder answers if it can be listed and holds anything."""

    def probe(replica: str) -> str | None:
        folder = folder_of(replica)
        try:
            names = list_names(spark, folder)
        except Py4JJavaError as e:  # a store that is down or refuses
            return str(e.java_exception.toString())
        if names is None:
            return f"{folder} doesn't exist"
        return None if names else f"{folder} is empty"

    return probe


def choose_replicas(shards: Sequence, probe: Probe) -> list[Choice]:
    """The first replica of every shard that ``probe`` finds readable. Later replicas
    are asked only when earlier ones fail; a shard without one that answers raises
    ``NoReplica`` and tells why for each of them."""
    chosen = []
    for i, shard in enumerate(shards):
        passed = []
        for replica in shard.replicas:
            reason = probe(replica)
            if reason is None:
                chosen.append(Choice(i, replica, tuple(passed)))
                break
            passed.append((replica, reason))
        else:
            told = "; ".join(f"{r}: {why}" for r, why in passed)
            raise NoReplica(f"no replica of shard {i} can be read ({told})")
    return chosen
