"""Line dedup over the corpus by a deletion-neighbourhood join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHash, materialize, mix, repeatable, spread, utf8, with_rid, without, words

#: Words of a line per edit: a line is a near-copy within one edit if that is at most a fifth of the longer line's words.
WORDS_PER_EDIT = 5
#: Words in the runs by which lines within more than one edit are found.
RUN = 3
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_OWN = np.uint64(0xD6E8FEB86659FD93)
_ORDER = ["doc_id", "rid", "line"]
#: Rows that a task takes up at once, and keys after which it sends a batch on.
SLICE_ROWS, BATCH_KEYS = 256, 100_000


def halves(w: list[bytes]) -> list[int]:
    """Keys of which two lines within one edit share one: the first and last words, as many as half of the shorter line."""
    n, out = len(w), []
    if n >= WORDS_PER_EDIT - 1:
        for j in {n // 2, (n - 1) // 2}:
            out.append(xxhash.xxh3_64_intdigest(b" ".join(w[:j]), seed=1))
            out.append(xxhash.xxh3_64_intdigest(b" ".join(w[n - j :]), seed=2))
    return out


def variants(h: np.ndarray) -> tuple[np.ndarray, int]:
    """Hashes of a line's words (hashed) without each one of them, and of all of them."""
    n = len(h)
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, _BASE, np.uint64))))
    upto = np.cumsum(h * powers)
    before = upto - h * powers
    return mix(before + (upto[-1] - upto) * _INVERSE), int(mix(upto[-1:])[0])


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether the edit distance of two word lists is at most 1, and at most a fifth of the longer."""
    if len(a) > len(b):
        a, b = b, a
    if a == b:
        return True
    if len(b) - len(a) > 1 or len(b) < WORDS_PER_EDIT:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def bound(n: int, edits: int | None) -> int:
    """Edits that a line may be away from one of n words, n the longer: a fifth of them, and no more than `edits`."""
    return n // WORDS_PER_EDIT if edits is None else min(edits, n // WORDS_PER_EDIT)


def within(a: list[bytes], b: list[bytes], edits: int | None = None) -> bool:
    """Whether the edit distance of two word lists is within the bound()."""
    if len(a) > len(b):
        a, b = b, a
    most = bound(len(b), edits)
    if len(b) - len(a) > most:
        return False
    row = {j: j for j in range(min(most, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        last, row = row, {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            put, out = row.get(j - 1, most) + 1, last.get(j, most) + 1
            row[j] = min(put, out, last[j - 1] + (x != b[j - 1])) if j else i
        if min(row.values()) > most:
            return False
    return row[len(b)] <= most


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows a few at a time, to hold little of them as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def _lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line with words: where it is, the 128-bit hash of its words, how many, and the keys of its halves."""
    for batch in _sliced(batches):
        rids, ids = batch.column("__rid").to_pylist(), batch.column("doc_id").to_pylist()
        out: tuple[list, ...] = tuple([] for _ in range(7))
        for rid, doc_id, text in zip(rids, ids, utf8(batch.column("text"))):
            for i, line in enumerate((text or b"").split(b"\n")):
                w = words(line)
                if w:
                    h = xxhash.xxh3_128_intdigest(b" ".join(w))
                    row = (doc_id, rid, i, _signed(h >> 64), _signed(h & (1 << 64) - 1), len(w), [_signed(k) for k in halves(w)])
                    for c, v in zip(out, row):
                        c.append(v)
        types = (batch.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=[*_ORDER, "h1", "h2", "n", "halves"])


def _fetcher(squeezed: bool):
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of the lines asked for, from their documents."""
        expand = zstandard.ZstdDecompressor()
        for batch in _sliced(batches):
            out: tuple[list, ...] = tuple([] for _ in range(4))
            for doc_id, rid, at, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "rid", "lines", "text"))):
                lines = (expand.decompress(text) if squeezed else text).split(b"\n")
                for i in at:
                    for c, v in zip(out, (doc_id, rid, i, b" ".join(words(lines[i])))):
                        c.append(v)
            types = (batch.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=[*_ORDER, "words"])

    return fetch


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The deletion neighbourhood of each line, as hashed keys with the line's place.

    Lines that differ in one word share the rest with that word's position (key of both); a line with a word more shares the rest
    with the whole of the other (key marked own there). So all lines with a key of the first sort are within one edit of one
    another, and of the second sort each with the one whose own key it is.
    """
    cache = WordHash()

    def out(batch: pa.RecordBatch, keys: list, owns: list, rows: list) -> pa.RecordBatch:
        take = pa.array(np.concatenate(rows))
        columns = [*(batch.column(c).take(take) for c in _ORDER), pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owns))]
        return pa.RecordBatch.from_arrays(columns, names=[*_ORDER, "key", "own"])

    for batch in _sliced(batches):
        keys, owns, rows, size = [], [], [], 0
        for r, line in enumerate(batch.column("words").to_pylist()):
            w = line.split()
            h = mix(np.fromiter(map(cache.__getitem__, w), np.uint64, len(w)))
            without_one, own = variants(h)
            at = mix(np.arange(1, len(w) + 1, dtype=np.uint64))
            shorter = np.unique(without_one)
            keys += [mix(without_one ^ at), mix(shorter ^ _OWN), mix(np.array([own], np.uint64) ^ _OWN)]
            mark = np.zeros(len(w) + len(shorter) + 1, bool)
            mark[-1] = True
            owns.append(mark)
            rows.append(np.full(len(mark), r))
            size += len(mark)
            if size >= BATCH_KEYS:
                yield out(batch, keys, owns, rows)
                keys, owns, rows, size = [], [], [], 0
        if rows:
            yield out(batch, keys, owns, rows)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashed runs of each line, with where they begin and the line's number of words."""
    for batch in _sliced(batches):
        rows, ns, ats, runs = [], [], [], []
        for r, line in enumerate(batch.column("words").to_pylist()):
            w = line.split()
            for at in range(len(w) - RUN + 1):
                rows.append(r)
                ns.append(len(w))
                ats.append(at)
                runs.append(_signed(xxhash.xxh3_64_intdigest(b" ".join(w[at : at + RUN]))))
        take = pa.array(rows, pa.int64())
        columns = [*(batch.column(c).take(take) for c in _ORDER), pa.array(ns, pa.int32()), pa.array(ats, pa.int32()), pa.array(runs, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*_ORDER, "n", "at", "run"])


def _verifier(edits: int | None):
    def near(a: list[bytes], b: list[bytes]) -> bool:
        return within_one(a, b) if edits == 1 else within(a, b, edits)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("words", "other"))
            ok = pa.array([near(x.split(), y.split()) for x, y in zip(a, b)], pa.bool_())
            yield batch.select(_ORDER).filter(ok)

    return verify


#: Tables of line numbers are broadcast up to so many lines; beyond that the texts are shuffled, compressed.
FEW_LINES = 1_000_000


def _packer(columns: list[str]):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for b in _sliced(batches):
            data = [squeeze.compress(x) if x else x for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(data, pa.binary())], names=[*columns, "text"])

    return pack


def _with_lines(docs: DataFrame, columns: list[str], lines: DataFrame, how: str) -> tuple[DataFrame, bool]:
    """columns of docs, text as bytes, and lines (__rid, lines), joined by row; whether the texts are compressed."""
    data = docs.select(*columns, F.encode("text", "UTF-8").alias("text"))
    few = (lines.agg(F.sum(F.size("lines") + 1)).first()[0] or 0) <= FEW_LINES
    if few:
        return data.join(F.broadcast(lines), "__rid", how), False
    return data.mapInArrow(_packer(columns), data.schema).join(lines, "__rid", how), True


def _met_by_runs(near: DataFrame, id_type: str, edits: int | None) -> DataFrame:
    """Places of lines and of earlier ones that may be within the bound: all pairs that are, where the longer has two edits or more.

    An edit changes at most RUN runs of a line, so lines within k edits share one of the k * RUN + 1 rarest runs of both, in
    places at most k apart. A line of n words is within a fifth only of lines of at most n / 0.8 words, so k is at most n / 4.
    """
    limit = F.lit(1 << 30 if edits is None else edits)
    place = F.struct(*_ORDER)
    runs = materialize(near.mapInArrow(_runs, f"doc_id {id_type}, rid long, line int, n int, at int, run long"))
    counts = runs.groupBy("run").agg(F.count("*").alias("rows"))
    ranked = runs.join(counts, "run").withColumn("rank", F.row_number().over(Window.partitionBy(*_ORDER).orderBy("rows", "run", "at")))
    rare = ranked.where((F.col("rank") <= RUN * F.least(limit, F.floor(F.col("n") / (WORDS_PER_EDIT - 1))) + 1) & (F.col("rows") > 1))
    rare = materialize(rare.select(place.alias("me"), "n", "at", "run"))
    earlier = rare.select(F.col("me").alias("other"), F.col("n").alias("m"), F.col("at").alias("there"), "run")
    most = F.least(limit, F.floor(F.greatest("n", "m") / WORDS_PER_EDIT))
    close = (F.col("other") < F.col("me")) & (most > 1) & (F.abs(F.col("n") - F.col("m")) <= most) & (F.abs(F.col("at") - F.col("there")) <= most)
    return rare.join(earlier, "run").where(close).select("me.*", "other").distinct()


def repeated_lines(docs: DataFrame, *, edits: int | None = 1) -> DataFrame:
    """(__rid, lines): the numbers of the lines to be removed from each row of docs (with __rid, doc_id, text) that has any."""
    place = F.struct(*_ORDER)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lines = materialize(
        spread(docs.select("__rid", "doc_id", "text")).mapInArrow(_lister, f"doc_id {id_type}, rid long, line int, h1 long, h2 long, n int, halves array<long>")
    )
    # Equal lines are one class, told by the earliest: reduced before anything is joined, so the places of a frequent line never meet.
    first = F.min(F.struct(*_ORDER, "n", "halves")).alias("first")
    classes = materialize(lines.groupBy("h1", "h2").agg(first, F.count("*").alias("copies")).select("h1", "h2", "copies", "first.*"))
    # Which distinct lines share a half with another one: only these can be within one edit of anything.
    placed = classes.select("h1", F.explode("halves").alias("half"))
    shared = placed.groupBy("half").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x <> y").select("half")
    wanted = placed.join(materialize(shared), "half", "left_semi").select("h1").distinct()
    if edits != 1:
        # A line of fewer words is not within two edits of one that is long enough for them.
        wanted = wanted.union(classes.where(F.col("n") >= 2 * (WORDS_PER_EDIT - 1)).select("h1")).distinct()
    wanted = classes.join(wanted, "h1", "left_semi")
    wanted = materialize(wanted.groupBy(F.col("rid").alias("__rid"), "doc_id").agg(F.collect_list("line").alias("lines")).drop("doc_id"))
    texts, squeezed = _with_lines(docs, ["__rid", "doc_id"], wanted, "inner")
    near = materialize(texts.select("doc_id", F.col("__rid").alias("rid"), "lines", "text").mapInArrow(_fetcher(squeezed), f"doc_id {id_type}, rid long, line int, words binary"))
    keys = materialize(near.mapInArrow(_neighbours, f"doc_id {id_type}, rid long, line int, key long, own boolean"))
    # The earliest of each key, of either sort of rows; keys of one line alone say nothing.
    several = keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key")
    keys = materialize(keys.join(several, "key", "left_semi"))
    groups = keys.groupBy("key").agg(F.min(F.when(~F.col("own"), place)).alias("least"), F.min(F.when(F.col("own"), place)).alias("whole"))
    other = F.when(F.col("own"), F.col("least")).otherwise(F.coalesce("whole", "least"))
    met = keys.join(groups, "key").select(*_ORDER, other.alias("other")).where(F.col("other") < place).distinct()
    others = near.select(place.alias("other"), F.col("words").alias("other_words"))
    if edits != 1:
        met = met.union(_met_by_runs(near, id_type, edits)).distinct()
    pairs = met.join(near.withColumn("me", place).select("me", "words"), place == F.col("me")).join(others, "other")
    verify = _verifier(edits)
    later = pairs.select(*_ORDER, "words", F.col("other_words").alias("other")).mapInArrow(verify, f"doc_id {id_type}, rid long, line int")
    later = later.distinct().select(place.alias("first"), F.lit(True).alias("near"))
    # Equal lines go but for the first; all of them go if an earlier line is near.
    classes = classes.select("h1", "h2", "copies", place.alias("first")).join(later, "first", "left")
    affected = materialize(classes.where("copies > 1 OR near").select("h1", "h2", "first", "near"))
    # Both sides come straight from files, so that the places of a line that very many documents have can be split.
    gone = lines.select("h1", "h2", *_ORDER).join(affected, ["h1", "h2"]).where(F.col("near") | (place != F.col("first")))
    return materialize(gone.groupBy(F.col("rid").alias("__rid")).agg(F.array_sort(F.collect_list("line")).alias("lines")))


def find(docs: DataFrame, *, edits: int | None = 1) -> DataFrame:
    """docs with n_lines (lines of the text, null: 0) and removed, the numbers (from 0) of the lines that go: those that an earlier
    line of the corpus equals or is within one edit of.

    Lines end with a line feed and are compared by their lower-cased words; lines without words stay and match nothing. An edit
    puts in, takes out or replaces a word. The bound is `edits` of them, but at most a fifth of the longer line's words, rounded down
    (None: just that fifth). One edit, as in the query's SQL, is found by keys of deletion variants alone, of which lines that share
    one are near each other, so a key that very many lines share costs no pairs; near-copies of long lines with two or more changed
    words stay then. Further edits are found by rare runs of words; no pair is missed, but runs that very many lines share make
    work that grows with the square of their number.

    Earlier is by doc_id (null first), then row, then line. A line goes even if the earlier one goes itself. Rows that repeat are
    later copies. An empty table gives no rows; columns named like those added are replaced.
    """
    docs = with_rid(without(repeatable(docs), ["n_lines", "removed"]))
    gone = repeated_lines(docs, edits=edits)
    n = F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit("\n")) + 1)
    none = F.array().cast("array<int>")
    return docs.withColumn("n_lines", n).join(gone, "__rid", "left").withColumn("removed", F.coalesce("lines", none)).drop("__rid", "lines")


def _cutter(squeezed: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for b in _sliced(batches):
            texts, stay = [], []
            for text, gone in zip(b.column("text").to_pylist(), b.column("lines").to_pylist()):
                text = expand.decompress(text) if squeezed and text else text
                if gone:
                    drop = set(gone)
                    text = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in drop)
                stay.append(not gone or bool(words(text)))
                texts.append(text)
            names = [n for n in b.schema.names if n not in ("text", "lines")]
            out = pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(texts, pa.binary()).cast(pa.string())], names=[*names, "text"])
            yield out.filter(pa.array(stay, pa.bool_()))

    return cut


def deduplicate(docs: DataFrame, *, edits: int | None = 1) -> DataFrame:
    """docs without the lines that find() names (edits as there), and n_chars counted anew if docs has it; a document that loses lines and has no
    words left goes."""
    docs = with_rid(without(repeatable(docs), ["lines"]))
    gone = repeated_lines(docs, edits=edits)
    names = [c for c in docs.columns if c not in ("__rid", "text")]
    data, squeezed = _with_lines(docs, ["__rid", *names], gone, "left")
    out = data.select(*names, "text", "lines").mapInArrow(_cutter(squeezed), docs.select(*names, "text").schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c != "__rid"])
