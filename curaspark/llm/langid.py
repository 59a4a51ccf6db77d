"""Language identification by a byte convolutional network, trained and applied in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, spread, utf8, without

#: Bytes of a window; windows follow one another through the whole text, the last filled up with zeros.
WINDOW = 128
#: Widths of the filters, filters of each width, dimensions of a byte's embedding.
WIDTHS, FILTERS, DIM = (2, 3, 4), 16, 4
#: Labelled rows used for training: at most so many for each language (those of the smallest hashes), so many in all (but for one of
#: each language), and windows of each.
SAMPLE_ROWS, SAMPLE_ALL, SAMPLE_WINDOWS = 1_000, 100_000, 6
#: Windows computed at once.
CHUNK = 256
UNKNOWN = "und"
#: Score from which keep_known() takes a prediction as told.
LEAST_SCORE = 0.35
_LETTER = re.compile(r"[^\W\d_]")


def windows(text: bytes, width: int = WINDOW) -> np.ndarray:
    """The whole text as rows of bytes."""
    n = max(1, -(-len(text) // width))
    return np.frombuffer(text.ljust(n * width, b"\0"), np.uint8).reshape(n, width)


@dataclass
class Net:
    """embedding -> filters of several widths -> ReLU -> maximum over the window -> softmax. The filters of all widths are one
    matrix: those of a smaller width have zeros behind their end."""

    langs: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    @staticmethod
    def mask() -> np.ndarray:
        m = np.zeros((max(WIDTHS) * DIM, len(WIDTHS) * FILTERS), np.float32)
        for i, w in enumerate(WIDTHS):
            m[: w * DIM, i * FILTERS : (i + 1) * FILTERS] = 1
        return m

    @classmethod
    def fresh(cls, langs: list[str], rng: np.random.Generator) -> Net:
        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        embed = normal(256, DIM, scale=1.0)
        embed[0] = 0
        n = len(WIDTHS) * FILTERS
        return cls(langs, embed, normal(max(WIDTHS) * DIM, n, scale=0.4) * cls.mask(), np.zeros(n, np.float32), normal(n, len(langs), scale=0.2), np.zeros(len(langs), np.float32))

    def columns(self, x: np.ndarray) -> np.ndarray:
        """(windows * positions, widest filter * DIM): what lies under the filters at each position; zeros behind the window's end."""
        n, width = x.shape
        e = self.embed[np.pad(x, ((0, 0), (0, max(WIDTHS) - 1)))].reshape(n, -1)
        s = e.strides
        cols = np.lib.stride_tricks.as_strided(e, (n, width, max(WIDTHS) * DIM), (s[0], s[1] * DIM, s[1]))
        return np.ascontiguousarray(cols).reshape(n * width, -1)

    def pooled(self, x: np.ndarray) -> np.ndarray:
        out = (self.columns(x) @ self.filters).reshape(*x.shape, -1)
        return np.maximum(out.max(axis=1) + self.bias, 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.pooled(x[i : i + CHUNK]) @ self.dense + self.dense_bias for i in range(0, len(x), CHUNK)])


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, langs: list[str], *, steps: int = 900, batch: int = 128, rate: float = 0.01, seed: int = 0) -> Net:
    """Fit a net on windows x (rows of bytes) with labels y (indices into langs) by Adam, each language drawn equally often."""
    rng = np.random.default_rng(seed)
    net = Net.fresh(langs, rng)
    names = ("embed", "filters", "bias", "dense", "dense_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    by_lang = [np.flatnonzero(y == i) for i in range(len(langs))]
    by_lang = [b for b in by_lang if len(b)]
    mask, n_filters = Net.mask(), len(WIDTHS) * FILTERS
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(b, max(1, batch // len(by_lang))) for b in by_lang])
        xb, yb = x[pick], y[pick]
        n, width = xb.shape
        cols = net.columns(xb)
        conv = (cols @ net.filters).reshape(n, width, n_filters)
        at = conv.argmax(axis=1)
        top = np.take_along_axis(conv, at[:, None, :], axis=1)[:, 0] + net.bias
        pooled = np.maximum(top, 0)
        p = softmax(pooled @ net.dense + net.dense_bias)
        p[np.arange(n), yb] -= 1
        p /= n
        grad = {"dense": pooled.T @ p, "dense_bias": p.sum(axis=0)}
        d_top = (p @ net.dense.T) * (top > 0)
        grad["bias"] = d_top.sum(axis=0)
        # Only the position of the maximum passes a gradient on.
        under = cols.reshape(n, width, -1)[np.arange(n)[:, None], at]
        grad["filters"] = np.einsum("nfk,nf->kf", under, d_top) * mask
        d_under = d_top[:, :, None] * net.filters.T[None]
        padded = np.pad(xb, ((0, 0), (0, max(WIDTHS) - 1)))
        d_embed = np.zeros_like(net.embed)
        for k in range(max(WIDTHS)):
            np.add.at(d_embed, padded[np.arange(n)[:, None], at + k], d_under[:, :, k * DIM : (k + 1) * DIM])
        d_embed[0] = 0
        grad["embed"] = d_embed
        for k in names:
            first[k] = 0.9 * first[k] + 0.1 * grad[k]
            second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
            change = rate * (1 - 0.8 * step / steps) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            getattr(net, k)[...] -= change
    return net


def _sampler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id as text, lang, window) of windows spread evenly over each text; the last, filled up, only if it is alone."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [])
        for doc_id, lang, text in zip(batch.column("id").to_pylist(), batch.column("lang").to_pylist(), utf8(batch.column("text"))):
            w = windows(text)
            full = w[:-1] if len(w) > 1 else w
            for i in np.unique(np.linspace(0, len(full) - 1, SAMPLE_WINDOWS).astype(int)):
                for c, v in zip(out, (doc_id, lang, full[i].tobytes())):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.string(), pa.binary()))], names=["id", "lang", "window"])


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """(doc_id, lang, text) of at most `most` rows of each lang: those of the smallest hashes of doc_id and text.

    Where a language has many distinct rows, a share of them by hash is looked at first, some four times as many as wanted; the rest
    are ranked exactly, each task sending on no more than it could give. So no language is lost, whatever repeats.
    """
    h = F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit(11))
    rows = rows.select("doc_id", "lang", "text", h.alias("h"))
    share = rows.groupBy("lang").agg(F.greatest(F.lit(1), F.floor(F.approx_count_distinct("h") / (4 * most))).alias("every"))
    share = materialize(share).select(F.col("lang").alias("__l"), "every")  # a row for each language
    part = rows.join(F.broadcast(share), F.col("lang") == F.col("__l")).where(F.pmod("h", "every") == 0)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return part.withColumn("nth", nth).where(F.col("nth") <= most).select("doc_id", "lang", "text")


def fit(labelled: DataFrame, *, sample_rows: int = SAMPLE_ROWS, sample_all: int = SAMPLE_ALL, most_langs: int | None = None, **options) -> Net | None:
    """A net from labelled rows (doc_id, text, lang), of which at most `sample_rows` for each language and `sample_all` in all (but for
    one of each language) are used (see sampled()); None if no row has both lang and text. Every lang is learned, or the `most_langs`
    most frequent if that is given; rows of the others are then neither trained on nor predicted."""
    rows = labelled.where("lang IS NOT NULL AND length(text) > 0")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    langs = sorted(r["lang"] for r in (counts if most_langs is None else counts.limit(most_langs)).collect())
    if not langs:
        return None
    if most_langs is not None:
        rows = rows.where(F.col("lang").isin(langs))
    part = sampled(rows, max(1, min(sample_rows, sample_all // len(langs))))
    got = part.select(F.col("doc_id").cast("string").alias("id"), "lang", "text").mapInArrow(_sampler, "id string, lang string, window binary").toArrow()
    rows_ = sorted(zip(*(got.column(c).to_pylist() for c in ("id", "lang", "window"))))  # the same in every run
    x = np.array([np.frombuffer(w, np.uint8) for _, _, w in rows_])
    index = {lang: i for i, lang in enumerate(langs)}
    return train(x, np.array([index[lang] for _, lang, _ in rows_]), langs, **options)


def _has_letter(text: bytes | None) -> bool:
    return text is not None and bool(_LETTER.search(text.decode()))


def predict(net: Net | None, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
    """Language and score (mean probability over the windows of the whole text) of each text."""
    known = [bool(net) and _has_letter(t) for t in texts]
    if not any(known):
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    means = np.zeros((len(texts), len(net.langs)))
    held, owner, size = [], [], 0

    def flush() -> None:
        p = softmax(net.logits(np.concatenate(held)).astype(np.float64))
        np.add.at(means, np.concatenate(owner), p)

    for i, (t, ok) in enumerate(zip(texts, known)):
        if ok:
            w = windows(t)
            held.append(w)
            owner.append(np.full(len(w), i))
            size += len(w)
            if size >= 16 * CHUNK:
                flush()
                held, owner, size = [], [], 0
    if held:
        flush()
    total = means.sum(axis=1)
    best = means.argmax(axis=1)
    lang = [net.langs[b] if ok else UNKNOWN for b, ok in zip(best, known)]
    score = [min(1.0, float(means[i, b] / total[i])) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, known))]
    return lang, score


def _predictor(net: Net | None, text: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = predict(net, utf8(batch.column(text)))
            names = [*batch.schema.names, "lang_pred", "score"]
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=names)
            yield out if keep_text else out.drop_columns([names[text]])

    return run


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: CRC-32 of doc_id as text leaves 2 modulo 4; false for a null doc_id, which isn't trained on
    either."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _fitted(docs: DataFrame, **options) -> Net | None:
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), **options)


def identify(docs: DataFrame, net: Net | None = None, *, keep_text: bool = True, **options) -> DataFrame:
    """docs (without text, if keep_text is false) with held_out, lang_pred and score.

    The net is fitted on rows of docs with a lang that are not held out, unless one is given; a prediction uses the text alone, all
    of it: the mean of the softmax over its windows. A null text, one without a letter, or an empty training set gives
    `und` and score 0. Rows that repeat get equal results; columns named like those added are replaced; an empty table gives
    no rows.
    """
    docs = without(docs, ["held_out", "lang_pred", "score"])
    if net is None:
        net = _fitted(docs, **options)
    names = docs.columns
    out = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"))
    out = out if keep_text else out.drop("text")
    out = spread(docs).mapInArrow(_predictor(net, names.index("text"), keep_text), out.schema)
    return out.select(*[F.col(f"`{c}`") for c in names if keep_text or c != "text"], held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def _lettered(text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([_has_letter(t) for t in utf8(batch.column(text))], pa.bool_()))

    return run


def keep_known(docs: DataFrame, net: Net | None = None, *, least: float = LEAST_SCORE, **options) -> DataFrame:
    """docs without those whose language can't be told: null texts, texts without a letter, and texts of a score under `least`, to
    which no language of the net has that share (with four languages, chance alone gives one 0.25). Where no net is given and nothing could be learned (no row that trains has a
    lang), every text with a letter stays.

    A score tells texts between the languages, not all that is foreign to them: with two languages none is under it, and a
    text in a language that wasn't learned can have a high one.
    """
    if net is None:
        net = _fitted(docs, **options)
    if net is None:
        return docs.mapInArrow(_lettered(docs.columns.index("text")), docs.schema)
    told = identify(docs, net).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return told.select(*[F.col(f"`{c}`") for c in docs.columns])
