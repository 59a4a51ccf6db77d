"""Benchmark decontamination: an FM-index of each training shard, searched for the windows of the benchmark."""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, WORD_TABLE, materialize, repeatable, spread, with_rid, without, words
from .fmindex import FMIndex

#: Words of a window.
WINDOW = 10
#: Benchmark text that one pass holds in each task; a larger benchmark is searched in several passes. Longer items are dealt in
#: pieces, so that none passes this.
BLOCK_BYTES = 16 << 20
#: A shard ends with the batch in which it has so many symbols, or so many bytes of text.
SHARD_SYMBOLS, SHARD_BYTES = 1 << 20, 8 << 20
#: Text that is split into words at once.
SPLIT_BYTES = 1 << 20

HITS = "array<struct<item:string,start:int,stop:int>>"
SPANS = "array<struct<start:int,stop:int>>"


def windows_of(items: list[tuple[str | None, bytes]], width: int = WINDOW) -> dict[tuple[bytes, ...], set[str | None]]:
    """Every window of the items' words, with the items that have it."""
    out: dict[tuple[bytes, ...], set[str | None]] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            out.setdefault(tuple(w[i : i + width]), set()).add(item)
    return out


class _Searcher:
    """The windows of a block of items, and the search for them in shards."""

    def __init__(self, items: list[tuple[str | None, bytes]]):
        found = sorted((k, sorted(v, key=_item_order)) for k, v in windows_of(items).items())
        self.items = [v for _, v in found]
        self.ids = _Ids({w: i + 2 for i, w in enumerate(sorted({w for k, _ in found for w in k}))})
        self.lengths = np.array([len(k) for k, _ in found], np.int64)
        self.phrases = np.ones((len(found), max(self.lengths, default=1)), np.int64)
        for row, (k, _) in zip(self.phrases, found):
            row[: len(k)] = [self.ids[w] for w in k]
        self.least = int(self.lengths.min(initial=WINDOW))

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words of all texts, 0 for words that no window has, and the number of words of each text."""
        parts, counts, held, size = [], [], [], 0

        def split() -> None:
            # \0 stands between texts; no word has it.
            ids = np.fromiter(map(self.ids.__getitem__, b" \0 ".join(held).split()), np.int32)
            ends = np.flatnonzero(ids == -1)
            counts.append(np.diff(np.concatenate(([-1], ends, [len(ids)]))) - 1)
            parts.append(ids[ids != -1])

        for t in texts:
            held.append(t.translate(WORD_TABLE))
            size += len(t)
            if size >= SPLIT_BYTES:
                split()
                held, size = [], 0
        if held:
            split()
        return (np.concatenate(parts), np.concatenate(counts)) if parts else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def reduced(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Positions of the words that could be part of a window: in runs of known words as long as the shortest window."""
        known = ids > 0
        begins = known.copy()
        begins[1:] &= ~known[:-1]
        begins[starts[starts < len(ids)]] |= known[starts[starts < len(ids)]]
        at = np.flatnonzero(known)
        if not len(at):
            return at
        run = np.cumsum(begins)[at]
        return at[np.bincount(run)[run] >= self.least]

    def search(self, ids: np.ndarray, at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence; at: what reduced() gave."""
        none = np.zeros(0, np.int64)
        if not len(at) or not len(self.lengths):
            return none, none
        # A separator (1) wherever two neighbours in the reduced shard are not neighbours in one text.
        begins = np.zeros(len(ids) + 1, bool)
        begins[starts] = True
        cut = np.concatenate(([True], (np.diff(at) > 1) | begins[at[1:]]))
        place = np.arange(len(at)) + np.cumsum(cut)
        seq = np.ones(place[-1] + 2, np.int64)
        seq[place] = ids[at]
        where = np.full(len(seq), -1, np.int64)
        where[place] = at
        index = FMIndex(seq)
        low, high = index.search(self.phrases, self.lengths)
        n = high - low
        window = np.repeat(np.arange(len(n)), n)
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return window, where[index.locate(rows)]


class _Ids(dict):
    """Word to symbol; 0 for other words, -1 for the mark between texts."""

    def __missing__(self, word: bytes) -> int:
        return -1 if word == b"\0" else 0


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= SHARD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches of at most SHARD_BYTES of text, but for a longer single text."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < b.num_rows:
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + SHARD_BYTES, "right")))
            yield b.slice(start, stop - start)
            start = stop


def _item_order(item: str | None) -> tuple[bool, str]:
    return item is not None, item or ""


def _finder(items: list[tuple[str | None, bytes]], keep: list[str], only_hits: bool):
    """The columns `keep` of each batch, n_words, hits and spans of what a block of items has in each text; only rows with hits, if
    only_hits."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _Searcher(items)
        for shard in _shards(_pieces(batches, "text")):
            texts = [x or b"" for b in shard for x in b.column("text").cast(pa.binary()).to_pylist()]
            ids, counts = searcher.symbols(texts)
            starts = np.concatenate(([0], np.cumsum(counts)))[: len(counts)]
            at = searcher.reduced(ids, starts)
            found: dict[int, dict] = {}
            # A shard of many symbols is indexed in parts that end between texts.
            doc_of = np.searchsorted(starts, at, "right") - 1
            begin = 0
            while begin < len(at):
                end = min(len(at), begin + SHARD_SYMBOLS)
                end = int(np.searchsorted(doc_of, doc_of[end - 1], "right")) if end < len(at) else end
                window, pos = searcher.search(ids, at[begin:end], starts)
                for w, p, d in zip(window.tolist(), pos.tolist(), (np.searchsorted(starts, pos, "right") - 1).tolist()):
                    s = p - int(starts[d])
                    for item in searcher.items[w]:
                        found.setdefault(d, {}).setdefault(item, []).append((s, s + int(searcher.lengths[w])))
                begin = end
            done = 0
            for b in shard:
                hits, spans = [], []
                for k in range(done, done + b.num_rows):
                    own = found.get(k, {})
                    hits.append([{"item": i, "start": s, "stop": e} for i in sorted(own, key=_item_order) for s, e in merged(own[i])])
                    spans.append([{"start": s, "stop": e} for s, e in merged([x for v in own.values() for x in v])])
                columns = [*(b.column(c) for c in keep), pa.array(counts[done : done + b.num_rows], pa.int64()), pa.array(hits, _HITS), pa.array(spans, _SPANS)]
                out = pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "hits", "spans"])
                yield out.filter(pa.array([bool(h) for h in hits], pa.bool_())) if only_hits else out
                done += b.num_rows

    return find


_HITS = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of several blocks of items as one list, an item's spans merged, and the spans of all."""
    for b in batches:
        hits, spans = [], []
        for lists in b.column("lists").to_pylist():
            own: dict = {}
            for h in (h for one in lists for h in one):
                own.setdefault(h["item"], []).append((h["start"], h["stop"]))
            hits.append([{"item": i, "start": s, "stop": e} for i in sorted(own, key=_item_order) for s, e in merged(own[i])])
            spans.append([{"start": s, "stop": e} for s, e in merged([x for v in own.values() for x in v])])
        yield pa.RecordBatch.from_arrays([b.column("__rid"), pa.array(hits, _HITS), pa.array(spans, _SPANS)], names=["__rid", "hits", "spans"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _cut_items(limit: int):
    """Items as their lower-cased words, long ones in pieces of at most `limit` bytes (but for one window) that share WINDOW - 1
    words, so that each window is in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column("item").to_pylist(), b.column("text")):
                w = words(memoryview(text.as_buffer()).tobytes())
                ends = np.cumsum([len(x) + 1 for x in w])
                start, pieces = 0, []
                while start < len(w):
                    base = ends[start - 1] if start else 0
                    stop = min(len(w), max(start + WINDOW, int(np.searchsorted(ends, base + limit, "right"))))
                    pieces.append(b" ".join(w[start:stop]))
                    start = len(w) if stop == len(w) else stop - WINDOW + 1
                    if sum(map(len, pieces)) >= limit:
                        yield _piece_batch(item, pieces)
                        pieces = []
                if pieces:
                    yield _piece_batch(item, pieces)

    return run


def _piece_batch(item: str | None, pieces: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([item] * len(pieces), pa.string()), pa.array(pieces, pa.binary())], names=["item", "piece"])


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark's items in blocks of at most `limit` bytes of words. The driver holds one block, and one batch of them as it
    comes."""
    held, size = [], 0
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("string").alias("item"), F.encode("text", "UTF-8").alias("text"))
    for item, piece in materialize(items.mapInArrow(_cut_items(limit), "item string, piece binary")).toLocalIterator():
        if held and size + len(piece) > limit:
            yield held
            held, size = [], 0
        held.append((item, bytes(piece)))
        size += len(piece)
    if held:
        yield held


def find(docs: DataFrame, benchmark: DataFrame, *, block_bytes: int = BLOCK_BYTES, keep_text: bool = True) -> DataFrame:
    """Every column of docs (but text, if keep_text is false), n_words, hits: array of (item, start, stop), the merged word spans (stop
    exclusive) of each item's windows in the text, and spans: array of (start, stop), those of all items merged.

    Words are lower-cased runs as of common.WORD_TABLE. A window is WINDOW consecutive words of an item, or all words of one that
    has fewer (none if it has no words). Each task indexes its texts by shards: words that are in no window, and runs of others
    too short for any, are left out, which loses no occurrence. The benchmark is the query set: it is cut into blocks of bounded
    size. One block is searched for in one pass over all rows, without a shuffle; of several, each has a pass of its own whose
    hits are written, so a task never holds more than one, and rows with hits are joined by row id.

    Null text: no words, no hits. Items with a null item_id are one item, null in hits; repeated items count once. Rows that
    repeat are searched each by itself. An empty benchmark gives no hits, an empty table no rows; columns named n_words, hits or
    spans are replaced.
    """
    docs = without(docs, ["n_words", "hits", "spans"])
    names = [c for c in docs.columns if keep_text or c != "text"]
    added = f"n_words long, hits {HITS}, spans {SPANS}"

    def schema(of: DataFrame, keep: list[str]):
        return of.select(*[F.col(f"`{c}`") for c in keep], F.lit(0).cast("long").alias("n_words"), F.array().cast(HITS).alias("hits"), F.array().cast(SPANS).alias("spans")).schema

    blocks = _blocks(benchmark, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return spread(docs).mapInArrow(_finder(first, names, False), schema(docs, names))
    rows = with_rid(repeatable(docs))
    texts, found = spread(rows.select("__rid", "text")), []
    for block in itertools.chain([first, second], blocks):
        found.append(materialize(texts.mapInArrow(_finder(block, ["__rid"], True), f"__rid long, {added}")).select("__rid", "hits"))
    lists = functools.reduce(DataFrame.union, found).groupBy("__rid").agg(F.collect_list("hits").alias("lists"))
    united = lists.mapInArrow(_unite, f"__rid long, hits {HITS}, spans {SPANS}")
    counted = rows.mapInArrow(_finder([], [*names, "__rid"], False), schema(rows, [*names, "__rid"])).drop("hits", "spans")
    out = counted.join(united, "__rid", "left")
    return out.select(*[F.col(f"`{c}`") for c in names], "n_words", *[F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("hits", HITS), ("spans", SPANS))])


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of merged spans and what stands between them; what stood around a cut stays."""
    at = [m.span() for m in re.finditer(WORD, text.translate(_LOWER))]
    out, done = [], 0
    for s, e in spans:
        out.append(text[done : at[s][0]])
        done = at[e - 1][1]
    return "".join(out) + text[done:]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = [[(x["start"], x["stop"]) for x in row] for row in b.column("spans").to_pylist()]
        if any(spans):
            at = b.schema.get_field_index("text")
            column = [cut(t, s) if s else t for t, s in zip(b.column(at).to_pylist(), spans)]
            b = b.set_column(at, b.schema.field(at), pa.array(column, b.schema.field(at).type))
        yield b


def remove(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the benchmark: its columns, with the merged spans cut out of text and n_chars counted anew if docs has it.

    Documents without hits stay as they are; one that is cut and has no words left goes.
    """
    found = find(docs, benchmark, **options)
    out = found.mapInArrow(_remove, found.schema)
    hit = F.size("hits") > 0
    out = out.where(~hit | F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in found.columns if c not in ("n_words", "hits", "spans")])
