"""Sharded tables as one DataFrame.

A shard is a directory (or object-store prefix) or a JDBC URL, with replicas.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.functions.types import as_schema
from shardsync.operators.commits import HIDDEN, Commit, current, list_names, read_facts, read_log
from shardsync.operators.fragments import assign_fragment, keep_fragments
from shardsync.operators.routing import SHARD
from shardsync.operators.schema import align_schema, column
from shardsync.operators.tables import decode_row
from shardsync.plans.dialects import dialect_for
from shardsync.plans.domains import Domain, prune_fragments
from shardsync.plans.fragments import FragmentSpec
from shardsync.plans.lattice import common_schema
from shardsync.sources.replicas import Probe, choose_replicas, folder_probe

DEFAULT_FETCH = 100_000
#: Tasks of one JDBC shard; a finer plan is an error.
MOST_TASKS = 100_000
FORMATS = ("parquet", "orc", "lines")

_TABLE = "{table}"
#: Folder columns of a logged table's parts.
PART_COLUMNS = ("stream", "batch")


@dataclass(frozen=True)
class ShardSpec:
    """Replicas of one shard; the first one takes writes, and reads while it answers."""

    replicas: tuple[str, ...]

    def __post_init__(self):
        if not self.replicas or not all(r.strip() for r in self.replicas):
            raise ValueError("a shard needs at least one replica, none of them blank")

    @property
    def primary(self) -> str:
        return self.replicas[0]

    @property
    def is_jdbc(self) -> bool:
        return self.primary.startswith("jdbc:")

    def location(self, table: str) -> str:
        """Directory of a table on this shard."""
        return table_folder(self.primary, table)


def table_folder(replica: str, table: str) -> str:
    if _TABLE in replica:
        return replica.replace(_TABLE, table)
    return f"{replica.rstrip('/')}/{table}"


def parse_shards(text: str) -> list[ShardSpec]:
    """Read ``shard;shard;...`` where a shard lists its replicas with commas: hosts
    inside a JDBC URL (``jdbc:x://a:1,b:2/db``) or whole directories."""
    if not text.strip():
        raise ValueError("no shard given")
    return [ShardSpec(tuple(_replicas(part.strip()))) for part in text.split(";")]


def _replicas(text: str) -> list[str]:
    if not text.startswith("jdbc:"):
        return [r.strip() for r in text.split(",")]
    scheme, mark, rest = text.partition("://")
    hosts, slash, tail = rest.partition("/")
    return [f"{scheme}{mark}{h.strip()}{slash}{tail}" for h in hosts.split(",")]


def file_cluster(root: str, n_shards: int) -> list[ShardSpec]:
    """Shards kept side by side as ``<root>/<table>/_shard=<i>``, which are written
    in one pass and read in one scan."""
    root = root.rstrip("/")
    return [ShardSpec((f"{root}/{_TABLE}/{SHARD}={i}",)) for i in range(n_shards)]


def common_root(shards: Sequence[ShardSpec], table: str) -> str | None:
    """The directory whose ``_shard=<i>`` folders are exactly these shards."""
    first = shards[0].location(table)
    root, mark, _ = first.rpartition(f"/{SHARD}=")
    if shards[0].is_jdbc or not mark:
        return None
    same = all(s.location(table) == f"{root}{mark}{i}" for i, s in enumerate(shards))
    return root if same else None


def table_folders(shards: Sequence[ShardSpec], table: str) -> tuple[list[str], list[ShardSpec]]:
    """The folders of a table on directory shards (one, if they lie below a common root;
    the first one holds the commit log), and shards whose tables are parts of it."""
    root = common_root(shards, table)
    if root is not None:
        return [root], file_cluster(root, len(shards))
    folders = [s.location(table) for s in shards]
    return folders, [ShardSpec((f,)) for f in folders]


def all_jdbc(shards: Sequence[ShardSpec]) -> bool:
    """Whether these shards are databases; they must all be of one sort."""
    kinds = {s.is_jdbc for s in shards}
    if not kinds:
        raise ValueError("there must be at least one shard")
    if len(kinds) > 1:
        raise ValueError("shards are either all JDBC URLs or all directories")
    return kinds.pop()


def jdbc_options(options: dict | None = None) -> dict[str, str]:
    """JDBC read options; timestamps come back without a zone, as declared."""
    merged = {"fetchsize": DEFAULT_FETCH, "preferTimestampNTZ": "true", **(options or {})}
    for name in ("fetchsize", "queryTimeout"):
        if int(merged.get(name, 0)) < 0:
            raise ValueError(f"{name} must be a non-negative integer")
    return {k: str(v) for k, v in merged.items()}


def jdbc_predicates(
    spec: FragmentSpec | None,
    numbers: Iterable[int] | None = None,
    dialect: str = "ansi",
    quote: bool = True,
) -> list[str] | None:
    """One predicate, hence one Spark partition, per fragment."""
    if spec is None:
        return None
    chosen = range(len(spec)) if numbers is None else sorted(set(numbers))
    if len(chosen) > MOST_TASKS:
        raise ValueError(f"a shard is read by at most {MOST_TASKS} tasks, not {len(chosen)}")
    return [spec.fragment(n).to_predicate(dialect, quote) for n in chosen]


def read_sharded(
    spark: SparkSession,
    shards: Sequence[ShardSpec],
    table: str,
    *,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    plan: FragmentSpec | None = None,
    fragments: Iterable[int] | None = None,
    within: Domain | None = None,
    fragment_column: str | None = None,
    shard_column: str | None = None,
    fmt: str = "parquet",
    options: dict | None = None,
    dialect: str | None = None,
    quote: bool = True,
    replica_column: str | None = None,
    probe: Probe | None = None,
) -> DataFrame:
    """All shards of a table, columns matched by name. Without a declared ``schema``, types
    are widened until they hold the values of all shards (``common_type``).

    A table with a commit log is read by it: parts that are being written, or were
    replaced, don't show. The log is read once, here.

    A shard with several replicas is read from the first one that answers: a folder that
    can be listed and isn't empty, or whatever ``probe`` takes (it gets a replica's URL and
    tells what is wrong with it; JDBC replicas are asked only by a ``probe``). If none
    does, ``NoReplica`` is raised. ``replica_column`` adds where each row was read.

    With a ``plan``, a JDBC shard is read by one task per fragment; files are cut
    by Spark itself. ``fragments`` keeps some fragments only (pushed to the scan),
    ``within`` keeps the rows of a domain of the plan's column and plans only the
    fragments that can hold any. ``fragment_column`` and ``shard_column`` add where a row
    came from. The
    ``dialect`` of JDBC predicates follows from the URL unless it is given.
    """
    jdbc = all_jdbc(shards)
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, not {fmt!r}")
    if plan is None and (fragments is not None or fragment_column or within is not None):
        raise ValueError("fragments need a plan")
    schema = as_schema(schema) if schema is not None else None
    chosen = None if fragments is None else list(fragments)
    if within is not None:
        reached = prune_fragments(plan, within)
        chosen = reached if chosen is None else [n for n in reached if n in set(chosen)]
    shards = _answering(spark, shards, table, jdbc, probe)
    if jdbc:
        # jdbc:<database>:..., the host name must not count
        dialect = dialect or dialect_for(shards[0].primary.split(":")[1])
        predicates = jdbc_predicates(plan, chosen, dialect, quote)
        if predicates == []:
            predicates = ["1 = 0"]  # no fragment is left, the columns are
        frames = [
            spark.read.jdbc(
                s.primary,
                table,
                predicates=predicates,
                properties=jdbc_options(options),
            )
            for s in shards
        ]
        df = _union(frames, schema, shard_column or (replica_column and SHARD))
    else:
        at = shard_column or (replica_column and SHARD)
        df = _read_files(spark, shards, table, schema, fmt, options or {}, at)
        if chosen is not None:
            df = keep_fragments(df, plan, chosen)
    if within is not None:
        df = df.where(within.to_column(plan.column))
    if replica_column:
        names = F.array(*(F.lit(s.primary) for s in shards))
        df = df.withColumn(replica_column, F.get(names, column(shard_column or SHARD)))
        df = df if shard_column else df.drop(SHARD)
    if fragment_column:
        df = assign_fragment(df, plan, fragment_column)
    if columns is not None:
        extra = [c for c in (shard_column, replica_column, fragment_column) if c]
        df = df.select(*map(column, [*columns, *extra]))
    return df


def _answering(spark, shards, table, jdbc, probe) -> list[ShardSpec]:
    """The shards with the replica alone that is read."""
    if probe is None and not jdbc:
        probe = folder_probe(spark, lambda r: table_folder(r, table))
    several = [i for i, s in enumerate(shards) if len(s.replicas) > 1]
    out = list(shards)
    if probe is not None:
        for i, choice in zip(several, choose_replicas([shards[i] for i in several], probe), strict=True):
            out[i] = ShardSpec((choice.replica,))
    return out


def _read_files(spark, shards, table, schema, fmt, options, shard_column) -> DataFrame:
    root = common_root(shards, table)
    folders = [s.location(table) for s in shards] if root is None else [root]
    log = read_log(spark, folders[0])
    parts = None if log is None else [c.folder for c in current(log)]
    if log:
        _same_cluster(spark, folders[0], max(log), len(shards))
    elif root is not None:
        _no_other_shards(spark, root, len(shards))

    def scan(folder: str) -> DataFrame:
        return _scan(spark, folder, parts, schema, fmt, options)

    if root is None:
        return _union([scan(f) for f in folders], schema, shard_column)
    try:
        df = scan(root)
    except (PySparkException, Py4JJavaError) as e:
        if schema is not None or "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
        # shards of different types: each is read by itself, and their types widened
        below = [root] if parts is None else [f"{root}/{p}" for p in parts]
        found = [f"{f}/{SHARD}={i}" for f in below for i in range(len(shards))]
        found = [f for f in found if list_names(spark, f)]
        frames = [_scan(spark, f, None, None, fmt, options, root).drop(*HIDDEN) for f in found]
        df = _union([f.drop(SHARD) for f in frames], None, None)
        return df if shard_column is None else _numbered(frames, df.schema, shard_column)
    if SHARD not in df.columns:
        df = df.withColumn(SHARD, F.lit(0))
    declared = schema or T.StructType([f for f in df.schema if f.name != SHARD])
    if shard_column is None:
        return align_schema(df, declared)
    if shard_column != SHARD:
        df = df.withColumnRenamed(SHARD, shard_column)
    return align_schema(df, T.StructType([*declared, df.schema[shard_column]]))


def _numbered(frames: Sequence[DataFrame], schema: T.StructType, shard_column: str) -> DataFrame:
    aligned = (
        align_schema(f, T.StructType([*schema, f.schema[SHARD]])).withColumnRenamed(SHARD, shard_column)
        for f in frames
    )
    return reduce(DataFrame.unionByName, aligned)


def _scan(spark, folder, parts, schema, fmt, options, base=None) -> DataFrame:
    """A folder, or the ``parts`` of it that are committed."""
    paths = [folder] if parts is None else [f"{folder}/{p}" for p in parts]
    if parts is not None or base is not None:
        options = {"basePath": base or folder, **options}
    if fmt == "lines":
        if schema is None:
            raise ValueError("lines are read with a declared schema")
        if not paths:
            return spark.createDataFrame([], schema)
        text = spark.read.options(lineSep="\n", **options).text(paths)
        keep = tuple(c for c in (*PART_COLUMNS, SHARD) if c in text.columns and c not in schema.names)
        return decode_row(text, schema, keep=keep)
    merged = {"mergeSchema": "true", **options} if schema is None else options
    try:
        if paths:
            return spark.read.format(fmt).options(**merged).load(paths).drop(*HIDDEN if parts is not None else ())
    except AnalysisException as e:
        # a partitioned write of no rows leaves no file to learn from
        if schema is None or e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    if schema is None:
        raise ValueError(f"nothing is committed in {folder}; declare a schema")
    return spark.createDataFrame([], schema)


def read_logged(
    spark: SparkSession, folders: Sequence[str], fmt: str, schema: T.StructType | str | None, keep: Sequence[str]
) -> DataFrame:
    """The committed parts of a table, with the folder columns ``keep``; the log is in the
    first folder. Several folders are the table's shards, in order."""
    schema = as_schema(schema) if schema is not None else None
    log = read_log(spark, folders[0])
    if log is None:
        raise ValueError(f"no commit log in {folders[0]}")
    parts = [c.folder for c in current(log)]
    frames = [_scan(spark, f, parts, schema, fmt, {}) for f in folders]
    if len(frames) > 1:
        frames = [f.withColumn(SHARD, F.lit(i)) for i, f in enumerate(frames)]
    data = [c for c in frames[0].columns if c not in keep]
    kinds = common_schema([f.select(*map(column, data)).schema for f in frames]) if schema is None else schema
    own = T.StructType([*kinds, *(frames[0].schema[c] for c in keep if c in frames[0].columns and c not in kinds.names)])
    return reduce(DataFrame.unionByName, (align_schema(f, own) for f in frames))


def _same_cluster(spark: SparkSession, base: str, last: Commit, n: int) -> None:
    """A table that was written to another number of shards would be read in part."""
    written = read_facts(spark, base, last).get("n_shards", n)
    if written != n:
        raise ValueError(f"{base} was written to {written} shards, {n} are listed")


def _no_other_shards(spark: SparkSession, root: str, n: int) -> None:
    """A folder of a shard that isn't listed holds rows that would go missing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in found]
    numbers = [x.removeprefix(f"{SHARD}=") for x in names if x.startswith(f"{SHARD}=")]
    others = [x for x in numbers if not x.isdigit() or int(x) >= n]
    if others:
        raise ValueError(f"{root} has shards that are not listed: {', '.join(sorted(others))}")


def _union(
    frames: Sequence[DataFrame], schema: T.StructType | None, shard_column: str | None
) -> DataFrame:
    """Union by name in the declared schema. Without one, all shards must have the same
    columns, so that none goes missing, in the first shard's order; types are widened."""
    declared = schema if schema is not None else common_schema([f.schema for f in frames])
    aligned = (align_schema(f, declared) for f in frames)
    if shard_column:
        aligned = (f.withColumn(shard_column, F.lit(i)) for i, f in enumerate(aligned))
    return reduce(DataFrame.unionByName, aligned)
