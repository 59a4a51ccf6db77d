"""Near-duplicates by DartMinHash signatures, banded joins and exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHash, components, few, materialize, mix, repeatable, shingles, spread, utf8, with_rid, without, words

#: Words of a shingle, and the weighted Jaccard similarity from which two documents are linked.
WIDTH, THRESHOLD = 5, 0.8
#: BANDS bands of ROWS coordinates: at similarity 0.8 a pair is missed with probability (1 - 0.8**5)**30, 7e-6.
BANDS, ROWS = 30, 5
#: Rounds in which a bucket's members are compared with one of them, another one in each round.
ROUNDS = 3
#: Words of the documents that are signed at once, but for a longer last one.
SIGNED = 1 << 12
#: Shingles after which a task sends a batch on.
SENT = 1 << 18
#: Shingles of the documents in a block, on average, where members of a bucket are compared with all others. Beyond SIDES blocks they
#: grow instead, up to LARGEST shingles, so that a document is sent at most twice SIDES times until then.
BLOCK, SIDES, LARGEST = 100_000, 16, 1_000_000
#: Tables of row ids are broadcast up to so many rows; beyond that the texts are shuffled.
FEW_ROWS = 1_000_000
#: Shingles told as frequent are those of more than FREQUENT documents, and so many at most.
FREQUENT, MOST_FREQUENT = 8, 50_000

#: Poisson(1) distribution function, to draw the number of darts in a cell of unit area.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _counted(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each of n[i] copies of i, and its number among them."""
    index = np.repeat(np.arange(len(n)), n)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(n) - n, n)


def dart_minhash(sets: list[tuple[np.ndarray, np.ndarray]], k: int, seed: int = 0) -> np.ndarray:
    """k weighted min-hashes of each set of 64-bit elements with weights above 0, a row for each: two sets agree at a coordinate with
    the probability of their weighted Jaccard similarity.

    Hashed darts lie in the plane of weight and rank that belongs to each element, one per unit of area on average (a Poisson
    process that is drawn cell by cell, so that all sets see the same darts). A set gets the darts below its elements'
    weights whose rank is below a limit, chosen so that k ln k + 2 k are expected; each dart belongs to a random
    coordinate, which keeps the earliest. Where a coordinate of a set has none, that set's limit is doubled.
    """
    out = np.empty((len(sets), k), np.uint64)
    todo = np.arange(len(sets))
    limits = np.array([(k * math.log(k) + 2 * k) / float(w.sum()) for _, w in sets])
    while len(todo):
        of, _ = _counted(np.array([len(sets[i][0]) for i in todo]))
        weight = np.concatenate([sets[i][1] for i in todo])
        limit = limits[todo]
        # Cells of weight [a, a+1) and rank [b, b+1).
        at, a = _counted(np.ceil(weight).astype(np.int64))
        of, top = of[at], weight[at]
        cell = mix(np.concatenate([sets[i][0] for i in todo])[at] ^ mix(a.astype(np.uint64) * _GOLDEN + np.uint64(seed + 1)))
        at, b = _counted(np.ceil(limit).astype(np.int64)[of])
        of, top, a = of[at], top[at], a[at]
        cell = mix(cell[at] + b.astype(np.uint64) * _GOLDEN)
        at, nth = _counted(np.searchsorted(_POISSON, _unit(cell), "right"))
        d = mix(cell[at] + (nth.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
        rank = b[at] + _unit(d)
        keep = np.flatnonzero(rank < limit[of[at]])
        at, d, rank = at[keep], d[keep], rank[keep]
        own = mix(d + _GOLDEN)
        keep = np.flatnonzero(a[at] + _unit(own) < top[at])
        at, d, rank, own = at[keep], d[keep], rank[keep], own[keep]
        place = of[at] * k + (mix(own + _GOLDEN) % np.uint64(k)).astype(np.int64)
        earliest = np.full(len(todo) * k, np.inf)
        np.minimum.at(earliest, place, rank)
        first = np.flatnonzero(rank == earliest[place])
        found = np.empty(len(todo) * k, np.uint64)
        found[place[first]] = d[first]
        whole = np.isfinite(earliest).reshape(len(todo), k).all(axis=1)
        out[todo[whole]] = found.reshape(len(todo), k)[whole]
        todo = todo[~whole]
        limits[todo] *= 2
    return out


def weighted(hashes: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a text and how often each occurs."""
    return np.unique(shingles(hashes, width), return_counts=True)


def tokens_of(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A text's shingles as a plain set: the nth occurrence of a shingle is an element of its own, so that the Jaccard similarity of two
    such sets is the weighted one of the texts."""
    at, nth = _counted((found := weighted(hashes, width))[1])
    element = found[0][at]
    return np.where(nth > 0, mix(element + nth.astype(np.uint64) * _GOLDEN), element)


def _hashed(cache: WordHash, w: list[bytes]) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, w), np.uint64, len(w))


def _signer(width: int, bands: int, rows: int):
    """(rid, content, n, bands): the hash of a text's words, how many shingles they make, and the keys of its bands; nulls without words."""

    def keys(sets: list) -> list[np.ndarray]:
        signature = dart_minhash([(e, n.astype(np.float64)) for e, n in sets], bands * rows).reshape(len(sets), bands, rows)
        key = np.tile(np.arange(bands, dtype=np.uint64) * _GOLDEN, (len(sets), 1))
        for i in range(rows):
            key = mix(key ^ signature[:, :, i]) + _GOLDEN
        return list(key.view(np.int64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHash()
        for batch in batches:
            contents, sizes, found, held, size = [], [], [], [], 0
            for text in utf8(batch.column("text")):
                w = words(text or b"")
                contents.append(xxhash.xxh3_128_hexdigest(b" ".join(w)) if w else None)
                sizes.append(max(1, len(w) - width + 1) if w else None)
                if w:
                    held.append(weighted(_hashed(cache, w), width))
                    size += len(w)
                if size >= SIGNED:
                    found += keys(held)
                    held, size = [], 0
            own = iter(found + (keys(held) if held else []))
            bands_of = pa.array([None if c is None else next(own) for c in contents], pa.list_(pa.int64()))
            columns = [batch.column("__rid"), pa.array(contents, pa.string()), pa.array(sizes, pa.int32()), bands_of]
            yield pa.RecordBatch.from_arrays(columns, names=["rid", "content", "n", "bands"])

    return sign


def _tokeniser(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHash()
        for batch in batches:
            rids, sets, size = [], [], 0
            for rid, text in zip(batch.column("__rid").to_pylist(), utf8(batch.column("text"))):
                rids.append(rid)
                sets.append(tokens_of(_hashed(cache, words(text)), width).view(np.int64))
                size += len(sets[-1])
                if size >= SENT:
                    yield _token_batch(rids, sets)
                    rids, sets, size = [], [], 0
            if rids:
                yield _token_batch(rids, sets)

    return run


def _token_batch(rids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))], names=["rid", "tokens"])


def _alike(n: Column, m: Column, threshold: float) -> Column:
    """Whether sets of so many elements can be similar enough at all."""
    return F.least(n, m) >= F.lit(threshold) * F.greatest(n, m)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs (a, b) of row ids, from the shingles of their whole texts, with the pairs' other columns."""
    a = sets.select(F.col("rid").alias("a"), F.col("tokens").alias("left"))
    b = sets.select(F.col("rid").alias("b"), F.col("tokens").alias("right"))
    both = pairs.join(a, "a").join(b, "b")
    both = both.select(*pairs.columns, F.size(F.array_intersect("left", "right")).alias("same"), (F.size("left") + F.size("right")).alias("all"))
    return both.select(*pairs.columns, (F.col("same") / (F.col("all") - F.col("same"))).alias("similarity"))


def _block_comparer(threshold: float):
    def compare(table: pa.Table) -> pa.Table:
        """Links between the left documents of a block pair and right ones of other components, one for each such component.

        Overlaps come from an index of the right documents' tokens, a left document at a time; no pair is sent on but links.
        """
        table = table.combine_chunks()
        left = table.column("is_left").to_numpy(zero_copy_only=False).astype(bool)
        rids, roots = table.column("rid").to_numpy(), table.column("root").to_numpy()
        sets = table.column("tokens").combine_chunks()
        ends, values = sets.offsets.to_numpy(), sets.values.to_numpy()
        size = np.diff(ends)
        i, j = np.flatnonzero(left), np.flatnonzero(~left)
        owner = np.repeat(np.arange(len(j)), size[j])
        token = np.concatenate([values[ends[k] : ends[k + 1]] for k in j]) if len(j) else values[:0]
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        out: tuple[list, list] = ([], [])
        for k in i:
            mine = values[ends[k] : ends[k + 1]]
            low, high = np.searchsorted(token, mine, "left"), np.searchsorted(token, mine, "right")
            at, nth = _counted(high - low)
            both = np.bincount(owner[low[at] + nth], minlength=len(j))
            near = np.flatnonzero((both / np.maximum(size[k] + size[j] - both, 1) >= threshold) & (roots[j] != roots[k]))
            _, first = np.unique(roots[j][near], return_index=True)
            out[0].extend([rids[k]] * len(first))
            out[1].extend(rids[j][near[first]])
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    return compare


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, rows): in how many documents each token occurs, in parts."""

    def counted() -> pa.RecordBatch:
        token, rows = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(rows)], names=["token", "rows"])

    held, size = [], 0
    for batch in batches:
        held.append(batch.column("tokens").flatten().to_numpy())
        size += len(held[-1])
        if size >= SENT:
            yield counted()
            held, size = [], 0
    if size:
        yield counted()


def _prefixes(token: np.ndarray, rows: np.ndarray, threshold: float):
    """(rid, tokens): the first n - ceil(threshold * n) + 1 tokens of each set of n, in an order that all sets share: those not among the
    frequent ones (token, sorted, in so many rows) by value, then these from the least frequent on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch.column("tokens")
            ends, values = sets.offsets.to_numpy(), sets.values.to_numpy()
            out = []
            for low, high in zip(ends[:-1], ends[1:]):
                mine = values[low:high]
                often = np.zeros(len(mine), np.int64)
                if len(token):
                    at = np.minimum(np.searchsorted(token, mine), len(token) - 1)
                    often = np.where(token[at] == mine, rows[at], 0)
                prefix = len(mine) - math.ceil(threshold * len(mine) - 1e-9) + 1
                out.append(mine[np.lexsort((mine, often))[:prefix]])
            if out:
                yield _token_batch(batch.column("rid").to_pylist(), out)

    return run


def _parted(members: DataFrame, by: list[str]) -> DataFrame:
    """(by, big, lefts, rights, sent): the largest component of each group of members, the numbers of blocks of all others and of all, and
    how many shingles comparing these sends."""
    parts = members.groupBy(*by, "root").agg(F.sum("n").alias("tokens"))
    groups = parts.groupBy(*by).agg(F.max(F.struct("tokens", "root")).alias("big"), F.sum("tokens").alias("tokens"))
    block, others = F.greatest(F.lit(BLOCK), F.least(F.lit(LARGEST), F.col("tokens") / SIDES)), F.col("tokens") - F.col("big.tokens")
    groups = groups.withColumn("lefts", F.ceil(others / block).cast("int")).withColumn("rights", F.ceil(F.col("tokens") / block).cast("int"))
    sent = F.col("lefts") * F.col("tokens") + F.col("rights") * others
    return groups.select(*by, F.col("big.root").alias("big"), "lefts", "rights", sent.alias("sent"))


def _merged(members: DataFrame) -> DataFrame:
    """members (bucket, rid, n, root) with one bucket instead of several that hang together, where comparing all in it sends no more.

    Similar documents share most of their buckets, so each of them would be taken, and each pair compared, once for each. What shares a
    bucket is still together. Buckets that hang together by chains of other documents stay as they are if they are smaller.
    """
    members = members.select("bucket", "rid", "n", "root")
    first = members.groupBy("bucket").agg(F.min("rid").alias("first"))
    chained = components(members.join(first, "bucket"), "rid", "first").select(F.col("node").alias("rid"), F.col("root").alias("cluster"))
    members = materialize(members.join(chained, "rid", "left").withColumn("cluster", F.coalesce("cluster", "rid")))
    whole = members.select("cluster", "rid", "n", "root").distinct()
    apart = _parted(members, ["cluster", "bucket"]).groupBy("cluster").agg(F.sum("sent").alias("apart"))
    cheap = _parted(whole, ["cluster"]).join(apart, "cluster").where("sent <= apart").select("cluster")
    cheap = few(materialize(cheap), FEW_ROWS)
    whole = whole.join(cheap, "cluster", "left_semi").withColumnRenamed("cluster", "bucket")
    return materialize(whole.union(members.join(cheap, "cluster", "left_anti").select("bucket", "rid", "n", "root")))


def _rest(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between components that share a bucket (members: bucket, rid, n, root).

    Two sets that are similar enough share one of the rarest tokens of each (prefix filter): a set of n tokens is told by its
    n - ceil(threshold * n) + 1 rarest. Only documents with such a token that another component in their bucket has, too, go on:
    none of a bucket of dissimilar documents, however large. Of those, the ones outside a bucket's largest component are
    compared with all others there, block by block.
    """
    members = members.select("bucket", "rid", "n", "root")
    there = sets.join(few(members.select("rid").distinct(), FEW_ROWS), "rid", "left_semi")
    # Any order of all tokens will do; that of the frequent ones is what keeps common passages out of the prefixes.
    least = max(FREQUENT, (there.agg(F.sum(F.size("tokens"))).first()[0] or 0) // MOST_FREQUENT)
    rows = there.select("tokens").mapInArrow(_counter, "token long, rows long").groupBy("token").agg(F.sum("rows").alias("rows"))
    often = sorted(tuple(r) for r in rows.where(F.col("rows") > least).collect())
    token, rows = (np.array([x[k] for x in often], np.int64) for k in (0, 1))
    rare = there.select("rid", "tokens").mapInArrow(_prefixes(token, rows, threshold), "rid long, tokens array<long>")
    placed = materialize(members.join(rare, "rid").select("bucket", "rid", "n", "root", F.explode("tokens").alias("token")))
    several = placed.groupBy("bucket", "token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("bucket", "token")
    members = materialize(placed.join(several, ["bucket", "token"], "left_semi").select("bucket", "rid", "n", "root").distinct())
    dealt = members.join(few(materialize(_parted(members, ["bucket"]).where("lefts > 0").drop("sent")), FEW_ROWS), "bucket")

    def tasks(side: DataFrame, own: str, other: str, left: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("rid", F.lit(3 if left else 5)), F.col(own)).cast("int").alias("i" if left else "j")
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("j" if left else "i")
        return side.select("bucket", block, each, F.lit(left).alias("is_left"), "rid", "root").select("bucket", "i", "j", "is_left", "rid", "root")

    both = tasks(dealt.where("root <> big"), "lefts", "rights", True).union(tasks(dealt, "rights", "lefts", False))
    return both.join(sets, "rid").groupBy("bucket", "i", "j").applyInArrow(_block_comparer(threshold), "a long, b long")


def links(docs: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(members, links): members (rid, representative) has every row of docs (with __rid and text), links (a, b) pairs of
    representatives that are at least `threshold` similar, enough to tell the components of all such pairs that share a bucket.

    Rows of the same words are one class and go on as one representative. In each bucket of the banded signatures, members are
    compared with one of them, which is then done with there, and by rounds with another one, unless they are in its component
    already: as many pairs as members, never all. A bucket of at most ROUNDS + 1 members is wholly compared so. What then is
    still in several components and shares rare shingles is compared block by block, buckets that hang together as one where that is
    less (see _merged() and _rest()), so that no link which a shared bucket shows is lost; a large group of copies is mostly one component by then, as the likely original is compared first. All comparisons are of hashed shingles, which are made once for the documents
    that share a bucket.
    """
    texts = docs.select("__rid", "text")
    signed = materialize(spread(texts).mapInArrow(_signer(width, bands, rows), "rid long, content string, n int, bands array<long>"))
    classes = signed.where("content IS NOT NULL").groupBy("content").agg(F.min("rid").alias("representative"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = materialize(classes)
    members = signed.select("rid", "content").join(classes.select("content", "representative"), "content", "left")
    members = members.select("rid", F.coalesce("representative", "rid").alias("representative"))

    placed = classes.select(F.col("representative").alias("rid"), "n", F.explode("bands").alias("bucket"))
    several = placed.groupBy("bucket").agg(F.count("*").alias("rows")).where("rows > 1")
    placed = materialize(placed.join(several, "bucket").withColumn("root", F.col("rid")))
    # A document that shares its buckets with many is likely what they were made from: it comes first in each of them.
    central = placed.groupBy("rid").agg(F.sum("rows").alias("central"))
    placed = materialize(placed.drop("rows").join(central, "rid"))
    needed = materialize(placed.select(F.col("rid").alias("__rid")).distinct())
    sets = materialize(texts.join(few(needed, FEW_ROWS), "__rid", "left_semi").mapInArrow(_tokeniser(width), "rid long, tokens array<long>"))

    tested, found = None, None
    for k in range(ROUNDS):
        first = placed.groupBy("bucket").agg(F.max_by(F.struct("rid", "root", "n"), F.struct("central", F.xxhash64("rid", F.lit(k)))).alias("first"))
        # The first of a bucket has been compared with all others there, and is done with.
        placed = materialize(placed.join(first, "bucket").where(F.col("rid") != F.col("first.rid")))
        pairs = placed.where((F.col("root") != F.col("first.root")) & _alike(F.col("n"), F.col("first.n"), threshold))
        ends, roots = (F.array_sort(F.array(x, f"first.{x}")) for x in ("rid", "root"))
        pairs = pairs.select(ends[0].alias("a"), ends[1].alias("b"), roots[0].alias("x"), roots[1].alias("y")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        compared = materialize(_compared(pairs, sets))
        tested = compared.select("a", "b") if tested is None else tested.union(compared.select("a", "b"))
        near = compared.where(F.col("similarity") >= threshold)
        found = near.select("a", "b") if found is None else found.union(near.select("a", "b"))
        placed = _rooted(placed.drop("first"), near.select("x", "y"))
    return members, found.union(_rest(_merged(placed), sets, threshold))


def _rooted(placed: DataFrame, joined: DataFrame) -> DataFrame:
    """(bucket, rid, n, central, root) of the buckets that still hold several components, after roots x and y were linked. Only new links
    are taken: those of earlier rounds are in the roots."""
    united = components(joined, "x", "y").select(F.col("node").alias("root"), F.col("root").alias("to"))
    placed = materialize(placed.join(united, "root", "left").withColumn("root", F.coalesce("to", "root")).drop("to"))
    several = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("bucket")
    return materialize(placed.join(several, "bucket", "left_semi").select("bucket", "rid", "n", "central", "root"))


def classes(docs: DataFrame, *, keep_text: bool = True, **options) -> DataFrame:
    """docs (without text, if keep_text is false) with class_id (smallest doc_id of its group), class_size, and kept (true for the one that stays: the smallest doc_id,
    of equal ones the first row). Groups are the components of links (see links()).

    Words are lower-cased; a shingle is five consecutive words, or all words where there are fewer, weighted by how often it
    occurs. A text that is null or has no words is alone in its class. A null doc_id is largest, and its class_id null if all
    are. Rows that repeat are members of one class. Columns named like those added are replaced. Empty table: no rows.
    """
    docs = with_rid(without(repeatable(docs), ["class_id", "class_size", "kept"]))
    members, found = links(docs, **options)
    found = materialize(found)
    roots = components(found)
    whole = members.join(roots.withColumnRenamed("node", "representative"), "representative", "left").select("rid", F.coalesce("root", "representative").alias("root"))
    ids = docs.select(F.col("__rid").alias("rid"), "doc_id").join(whole, "rid")
    ids = materialize(ids)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
    groups = ids.groupBy("root").agg(first, F.count("*").alias("class_size"))
    marks = ids.join(groups, "root").select(
        F.col("rid").alias("__rid"), F.col("first.doc_id").alias("class_id"), "class_size", (F.col("rid") == F.col("first.rid")).alias("kept")
    )
    return (docs if keep_text else docs.drop("text")).join(marks, "__rid").drop("__rid")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay: one of each group."""
    return classes(docs, **options).where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])
