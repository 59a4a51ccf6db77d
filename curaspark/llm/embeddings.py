"""Near-duplicate embeddings: cells by spherical k-means, blocked cosine products within cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialize, without

#: Cosine from which two vectors are linked.
THRESHOLD = 0.9
#: Vectors on which the cells are fitted, at most; every vector is indexed and compared.
SAMPLE = 20_000
#: Vectors of a cell on average, and cells at most (the centres are sent to every task).
CELL_ROWS, MOST_CELLS = 2_000, 4_096
#: A vector also visits the cells whose centres it is nearly as close to as to its own, by this much in cosine.
MARGIN = 0.2
#: Added to margins, for the rounding of distances between centres.
ROUNDING = 1e-7
#: Vectors in a block of residents, on average, and how many times more in one of visitors: residents are sent once for each.
BLOCK, VISITORS = 2_048, 4


def unit(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_cells(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Centres of k cells of unit vectors by spherical k-means; an empty cell keeps its centre."""
    rng = np.random.default_rng(seed)
    centres = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds if len(centres) > 1 else 0):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norms = np.sqrt((sums * sums).sum(axis=1))
        ok = norms > 1e-12
        centres[ok] = sums[ok] / norms[ok, None]
    return centres


def _visits(x: np.ndarray, centres: np.ndarray, margin: float, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of each unit vector, and which cells it visits, its own among them.

    Two vectors are at most sqrt(2 - 2 * threshold) apart if they are linked. If they have different homes, the plane between the two
    centres is between them, so one of them is within half of that from the plane, which as a difference of cosines is that half times
    the distance of the centres. Wherever this is less than the margin, no link is lost.
    """
    dots = x @ centres.T
    home = dots.argmax(axis=1)
    homes, row = np.unique(home, return_inverse=True)
    apart = np.sqrt(np.maximum(2 - 2 * (centres[homes] @ centres.T), 0))
    enough = np.minimum(margin, math.sqrt(max(2 - 2 * threshold, 0)) / 2 * apart + ROUNDING)
    return home, dots >= dots[np.arange(len(x)), home][:, None] - enough[row]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), dim)


def _dealer(centres: np.ndarray, margin: float, threshold: float):
    """(id, copies, cell, home, vector as given) for each cell that a vector visits."""
    dim = centres.shape[1]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                home, visited = _visits(unit(_matrix(part.column("vector"), dim)), centres, margin, threshold)
                row, cell = np.nonzero(visited)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(take),
                        part.column("copies").take(take),
                        pa.array(cell.astype(np.int32)),
                        pa.array(home[row].astype(np.int32)),
                        part.column("vector").take(take),
                    ],
                    names=["id", "copies", "cell", "home", "vector"],
                )

    return deal


def _least(linked: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The smallest label of the columns linked with each row, some rows at a time."""
    big = np.iinfo(np.int64).max
    return np.concatenate([np.where(linked[s : s + 256], labels, big).min(axis=1, initial=big) for s in range(0, len(linked), 256)])


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep linked vectors connected, at most one for each row and each column: everything's smallest id."""
    label_l, label_r = left.copy(), right.copy()
    while True:
        new_l = np.minimum(label_l, _least(linked, label_r))
        new_r = np.minimum(label_r, _least(linked.T, new_l))
        if (new_l == label_l).all() and (new_r == label_r).all():
            return np.concatenate((left, right)), np.concatenate((label_l, label_r))
        label_l, label_r = new_l, new_r


def _comparer(centres: np.ndarray, margin: float, threshold: float):
    """Counts and links of one pair of blocks of a cell: (id, links, to); links: rows linked, counted by copies."""
    dim = centres.shape[1]

    def compare(key, table):
        table = table.combine_chunks()
        cell = key[0].as_py()
        x = unit(_matrix(table.column("vector").combine_chunks(), dim))
        ids, copies, home = (table.column(c).to_numpy() for c in ("id", "copies", "home"))
        left, right = (table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("is_left", "is_right"))
        i, j = np.flatnonzero(left), np.flatnonzero(right)
        visitors = (home[i] != cell).any()
        seen = _visits(x[j], centres, margin, threshold)[1] if visitors else None
        linked, n_left, n_right = np.zeros((len(i), len(j)), bool), np.zeros(len(i), np.int64), np.zeros(len(j), np.int64)
        for s in range(0, len(i), 1024):
            k = i[s : s + 1024]
            part = x[k] @ x[j].T >= threshold
            part &= ids[k][:, None] != ids[j][None, :]
            # A pair of residents belongs to the block pair once; a visitor's pair to the smaller of the two cells that show it.
            if key[1].as_py() == key[2].as_py():
                part &= ids[k][:, None] <= ids[j][None, :]
            if visitors:
                part &= (home[k] >= cell)[:, None] | ~seen[:, home[k]].T
            linked[s : s + 1024] = part
            n_left[s : s + 1024] = part @ copies[j]
            n_right += copies[k] @ part
        some_l, some_r = n_left > 0, n_right > 0
        if not some_l.any():
            return pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "to": pa.array([], pa.int64())})
        i, j, n_left, n_right = i[some_l], j[some_r], n_left[some_l], n_right[some_r]
        nodes, to = _forest(linked[some_l][:, some_r], ids[i], ids[j])
        return pa.table({"id": pa.array(nodes, pa.int64()), "links": pa.array(np.concatenate((n_left, n_right)), pa.int64()), "to": pa.array(to, pa.int64())})

    return compare


def _links(vectors: DataFrame, dim: int, *, threshold: float, margin: float, sample: int, cell_rows: int) -> DataFrame:
    """(id, links, to) partial counts and links of the distinct vectors (id, vector, copies) of one dimension."""
    n = vectors.count()
    part = vectors.select("vector") if n <= sample else vectors.orderBy(F.xxhash64("vector"), "id").select("vector").limit(sample)
    rows = part.toArrow().column("vector").combine_chunks()
    cells = min(MOST_CELLS, math.ceil(n / cell_rows))
    centres = fit_cells(unit(_matrix(rows, dim)), cells)
    kind = vectors.schema["vector"].dataType.simpleString()
    dealt = vectors.select("id", "copies", "vector").mapInArrow(_dealer(centres, margin, threshold), f"id long, copies long, cell int, home int, vector {kind}")
    dealt = materialize(dealt).withColumn("own", F.col("home") == F.col("cell"))
    counts = dealt.groupBy("cell").agg(F.count_if("own").alias("o"), F.count_if(~F.col("own")).alias("v"))
    # Residents and visitors of a cell are dealt into blocks; a task has one block of either beside one of residents.
    counts = counts.select("cell", F.ceil(F.col("o") / BLOCK).cast("int").alias("o"), F.ceil(F.col("v") / (VISITORS * BLOCK)).cast("int").alias("v"))
    dealt = dealt.join(F.broadcast(counts), "cell")  # at most MOST_CELLS rows
    block = F.pmod(F.xxhash64("id", F.lit(7)), F.when(F.col("own"), F.col("o")).otherwise(F.col("v"))).cast("int")
    dealt = dealt.withColumn("block", F.when(F.col("own"), block).otherwise(F.col("o") + block))
    # (left block, right block): left <= right among residents; visitors (left) with each block of residents.
    role = "struct<l:int,r:int,is_left:boolean,is_right:boolean>"

    def pairs(low, high, make):
        return F.when(high >= low, F.transform(F.sequence(low, high), make)).otherwise(F.array().cast(f"array<{role}>"))

    def task(a, b, left: bool, right: bool):
        return F.struct(a.alias("l"), b.alias("r"), F.lit(left).alias("is_left"), F.lit(right).alias("is_right"))

    me, last, end = F.col("block"), F.col("o") - 1, F.col("o") + F.col("v") - 1
    resident = F.concat(
        pairs(me + 1, last, lambda q: task(me, q, True, False)),
        F.array(task(me, me, True, True)),
        pairs(F.lit(0), me - 1, lambda q: task(q, me, False, True)),
        pairs(F.col("o"), end, lambda q: task(q, me, False, True)),
    )
    visitor = pairs(F.lit(0), last, lambda q: task(me, q, True, False))
    tasks = dealt.select("id", "copies", "home", "vector", "cell", F.explode(F.when(F.col("own"), resident).otherwise(visitor)).alias("t"))
    tasks = tasks.select("id", "copies", "home", "vector", "cell", "t.l", "t.r", "t.is_left", "t.is_right")
    return tasks.groupBy("cell", "l", "r").applyInArrow(_comparer(centres, margin, threshold), "id long, links long, to long")


def near_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = THRESHOLD,
    margin: float = MARGIN,
    sample: int = SAMPLE,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Every column of vectors (vec_id, embedding, ...), and n_links, component_id, kept.

    n_links: other rows whose cosine with this one, in double precision, is at least `threshold`; component_id: the smallest
    vec_id that links reach, its own included; kept: vec_id = component_id (false for a null vec_id).

    Equal vectors are compared once and counted by their copies. Cells are fitted on at most `sample` vectors (those of the
    smallest hashes); every vector is a resident of its nearest cell and a visitor of those nearly as near (by `margin`, or by less
    where less loses nothing), and is compared with all residents there, block by block. Counts are exact for the pairs found; a block pair sends on links that
    keep its vectors connected, not all pairs. No pair below the threshold is linked. With random differences a pair at the
    threshold itself is missed well below once in a hundred; with a margin of 2 none is.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do vectors of different lengths.
    Null vec_ids are no component ids unless all are null. Rows that repeat link with each other. Columns named like
    those added are replaced; an empty table gives no rows.
    """
    vectors = without(vectors, ["n_links", "component_id", "kept"])
    # Components of single precision stay so until they are compared: half the bytes to shuffle, and exact as doubles.
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    v = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    good = F.exists(v, lambda c: c != 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.withColumn("__vector", F.when(good, v))
    distinct = rows.where("__vector IS NOT NULL").groupBy(F.col("__vector").alias("vector")).agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    distinct = materialize(distinct.withColumn("id", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")))
    found = None
    for dim in sorted(r[0] for r in distinct.select("dim").distinct().collect()):
        part = _links(distinct.where(F.col("dim") == dim), dim, threshold=threshold, margin=margin, sample=sample, cell_rows=cell_rows)
        found = part if found is None else found.union(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "id long, links long, to long")
    found = materialize(found)
    roots = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    marked = distinct.join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    marked = materialize(marked.select("vector", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("root")))
    least = marked.groupBy("root").agg(F.min("least").alias("component_id"))
    marked = marked.join(least, "root").select(F.col("vector").alias("__vector"), (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(marked, "__vector", "left")
    own = F.when(F.col("__vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        *[F.col(f"`{c}`") for c in vectors.columns],
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"),
    )


def deduplicate(vectors: DataFrame, **options) -> DataFrame:
    """The vectors that stay: one representative of each group."""
    return near_duplicates(vectors, **options).where("kept").select(*[F.col(f"`{c}`") for c in vectors.columns])
