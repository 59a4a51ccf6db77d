"""What the corpus operators share: scratch tables, row ids, word splitting, connected components."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread as spread

#: Used only where a local master's session names no spark.checkpoint.dir, as in tests on one machine.
DEFAULT_SCRATCH = "file:/tmp/checkpoints/curaspark"

_written: list[str] = []


def on_one_machine(spark: SparkSession) -> bool:
    """Whether driver and tasks are one process (local, local[n]), whose number of cores doesn't change."""
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the one that driver and executors share; an error where a cluster's session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not on_one_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = base or DEFAULT_SCRATCH
    return f"{base.rstrip('/')}/curaspark-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared scratch folder and read it again.

    Cuts lineage in a way that survives lost executors, and gives later passes column pruning.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that go to Python at once: texts can be long, and both sides hold a batch or two outside the heap.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Settings for an application of these operators, to be called by the application (as the queries and the pipeline do);
    operators themselves change no session. Rows go to Python in batches of BATCH_ROWS, and files are split alike however many
    cores there happen to be: by default their number sets the least number of splits, and it changes when executors are lost or
    come. Results are the same without it; memory, and copies that repeatable() then makes, are not."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
    if spark.conf.get(SPLITS, None) is None:
        spark.conf.set(SPLITS, spark.sparkContext.defaultParallelism)
    return spark


def written() -> list[str]:
    """The scratch tables of this process so far."""
    return list(_written)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables; only for callers who have written all that depends on them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
        _written.remove(p)


SPLITS = "spark.sql.files.minPartitionNum"
#: Plan nodes that deal rows alike in each run: files of Spark's own readers, and row-wise steps above them.
_ALIKE = re.compile(r"^(Project|Filter|SubqueryAlias|View|Union|(Logical)?Relation( \S+)? ?\[.*\] (parquet|orc|json|csv|text|avro)$)")
_LOCAL = re.compile(r"^LocalRelation")


def repeatable(df: DataFrame) -> DataFrame:
    """df itself where each run deals its rows alike, so that row ids of several passes agree: files under projections and filters,
    with pinned splits (see prepare()) or on one machine. Else a written copy: whatever is not known to be alike is copied."""
    spark = df.sparkSession
    fixed = on_one_machine(spark)
    lines = df._jdf.queryExecution().optimizedPlan().toString().strip().splitlines()
    nodes = [x for x in (re.sub(r"^[\s:+\-|!]*", "", x) for x in lines) if x]
    random = re.search(r"\b(rand|randn|uuid|shuffle|monotonically_increasing_id)\(", "\n".join(lines))
    alike = all(_ALIKE.match(x) or (fixed and _LOCAL.match(x)) for x in nodes)
    if alike and not random and (fixed or spark.conf.get(SPLITS, None) is not None):
        return df
    return materialize(df)


def with_rid(df: DataFrame, name: str = "__rid") -> DataFrame:
    """Add a row id that is the same in every pass over df (see repeatable)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def few(df: DataFrame, limit: int) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows by count, else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df without columns that an operator is about to add."""
    clash = {x.lower() for x in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])


# --- words -----------------------------------------------------------------------------------

#: A-Z become a-z; what is neither a digit, a letter nor beyond ASCII becomes a space.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: The same words as a regular expression over text whose A-Z have been lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: bytes) -> list[bytes]:
    """The lower-cased words of UTF-8 bytes."""
    return text.translate(WORD_TABLE).split()


def ascii_lower(text: Column) -> Column:
    """Lower case of which every ASCII word equals the one of lower-casing A-Z alone (KELVIN SIGN would become k)."""
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\ufffd")))


class WordHash(dict):
    """Cache of 64-bit word hashes; emptied when full, which changes no value."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of the runs of `width` words, in order; one run of all words where there are fewer."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        out = mix(out ^ hashes[i : n - width + 1 + i]) + np.uint64(0x9E3779B97F4A7C15)
    return out


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


# --- connected components --------------------------------------------------------------------

#: Links that one task takes at once (some 16 bytes each, several times over).
AT_ONCE = 1 << 18


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all links (a, b) given, by union-find."""
    parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if not parts:
        return
    a, b = (np.concatenate(x) for x in zip(*parts))
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)
    roots = np.fromiter(map(find, range(len(nodes))), np.int64, len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[roots])], names=["node", "root"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links (long ids): (node, root), root the smallest node, for every node with a link.

    Up to AT_ONCE different links go to one task, since each round below takes several exchanges, however few the links. More of them
    alternate large-star and small-star steps, until nothing changes or so few are left; each round is written to scratch, so lineage stays
    short, and the number of rounds grows with the logarithm of the longest path. A node of very many links is only ever aggregated or joined.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")).where("a <> b").distinct()
    e, before = materialize(e), None
    while True:
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now[0] <= AT_ONCE:
            return materialize(e.coalesce(1).mapInArrow(_united, "node long, root long"))
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
        before = now
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialize(rest.union(small.select("a", "m")).distinct())


def partitions_for(n: float, each: float) -> int:
    return max(1, math.ceil(n / each))
