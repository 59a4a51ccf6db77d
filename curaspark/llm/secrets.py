"""Secret scans over an incremental, content-addressed blob ledger."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, spread


@dataclass(frozen=True)
class Rule:
    """One kind of secret. pattern: as of Python's re, leftmost non-overlapping; matches whose `group` has fewer than `least`
    characters are dropped. hint: an RE2 pattern that every text with a match meets."""

    kind: str
    version: int
    pattern: str
    hint: str
    group: int = 0
    least: int = 1
    flags: int = 0
    base: bool = False

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed values, in the order in which kinds are listed.
RULES = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
        group=2,
        least=6,
        flags=re.ASCII | re.IGNORECASE,
        base=True,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", least=20, base=True),
    Rule("hex", 1, r"[0-9a-f]{24,}", r"[0-9a-f]{24}", least=24, base=True),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_[A-Za-z0-9]"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]{8}"),
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", r"-----BEGIN "),
)

FINDINGS = "blob string, rule string, kind string, start int, stop int"
LEDGER = "blob string, rule string"
#: Bytes of text that a scanning task decompresses at once, but for a longer single text.
CHUNK_BYTES = 8 << 20


def spans_of(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Where rule matches in the whole text, in code points, end exclusive."""
    found = re.finditer(rule.pattern, text, rule.flags)
    return [m.span() for m in found if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(blob, content) compressed, the first of each blob in this task; the set of seen blobs is emptied when large."""
    squeeze, seen = zstandard.ZstdCompressor(level=1), set()
    for batch in batches:
        blobs, data = [], []
        for blob, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            if blob not in seen:
                if len(seen) >= 500_000:
                    seen.clear()
                seen.add(blob)
                blobs.append(blob)
                data.append(squeeze.compress(content.as_buffer()))
        yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.string()), pa.array(data, pa.binary())], names=["blob", "packed"])


def _scanner(rules: tuple[Rule, ...]):
    by_id = {r.id: r for r in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()

        def found(blobs: list[str], texts: list[bytes], todo: list[list[str]]) -> pa.RecordBatch:
            out: list[tuple] = []
            column = pa.array(texts, pa.binary()).cast(pa.string())
            for rule in by_id.values():
                hits = pc.match_substring_regex(column, rule.hint).to_pylist()
                for blob, text, ids, hit in zip(blobs, texts, todo, hits):
                    if hit and rule.id in ids:
                        out += [(blob, rule.id, rule.kind, *span) for span in spans_of(text.decode(), rule)]
            columns = list(zip(*out)) or [[]] * 5
            types = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["blob", "rule", "kind", "start", "stop"])

        for batch in batches:
            held: tuple[list, list, list] = ([], [], [])
            size = 0
            for blob, packed, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = expand.decompress(packed) if packed else b""
                for x, y in zip(held, (blob, text, ids)):
                    x.append(y)
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield found(*held)
                    held, size = ([], [], []), 0
            if held[0]:
                yield found(*held)

    return scan


def scan_versions(
    versions: DataFrame, ledger: DataFrame | None = None, *, rules: tuple[Rule, ...] = RULES, content: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Findings and ledger entries of a run: what the run scanned and the ledger did not list yet.

    versions has every historical version of every path, a row each; `content` is its text (null: empty). A blob is a distinct
    content, addressed by the SHA-256 of its UTF-8 bytes. Only pairs of blob and rule version that the ledger (blob, rule)
    lacks are scanned; the new entries are returned to be appended, with findings (blob, rule, kind, start, stop) to be kept
    beside those of earlier runs. Copies of a content are scanned once, however many there are: each task sends a blob on once.

    Repeated ledger rows count once; null ledger entries are ignored; an empty table gives no findings and no entries.
    """
    texts = spread(versions.select(content)).select(F.sha2(F.coalesce(F.col(f"`{content}`"), F.lit("")), 256).alias("blob"), F.encode(F.coalesce(F.col(f"`{content}`"), F.lit("")), "UTF-8").alias("content"))
    ids = F.array(*[F.lit(r.id) for r in rules])
    blobs = texts.mapInArrow(_pack, "blob string, packed binary").groupBy("blob").agg(F.first("packed").alias("packed"))
    if ledger is not None:
        done = ledger.where("blob IS NOT NULL AND rule IS NOT NULL").groupBy("blob").agg(F.collect_set("rule").alias("done"))
        blobs = blobs.join(done, "blob", "left").withColumn("todo", F.array_except(ids, F.coalesce("done", F.array().cast("array<string>"))))
        blobs = blobs.where(F.size("todo") > 0).select("blob", "packed", "todo")
    else:
        blobs = blobs.select("blob", "packed", ids.alias("todo"))
    findings = materialize(blobs.mapInArrow(_scanner(rules), FINDINGS))
    # What was scanned needs no text: the addresses alone say it.
    entries = texts.select("blob").distinct().select("blob", F.explode(ids).alias("rule"))
    if ledger is not None:
        entries = entries.join(ledger.select("blob", "rule"), ["blob", "rule"], "left_anti")
    return findings, entries


def scan_into(versions: DataFrame, store: str, *, rules: tuple[Rule, ...] = RULES, content: str = "text") -> DataFrame:
    """Scan what the ledger of a store (a folder on a file system that driver and executors share) does not list, add findings and
    entries to it, and return all its findings.

    Findings are written before entries: a run that ends between the two scans again, and findings that repeat count once (see
    by_path()). A new folder is an empty ledger.
    """
    spark = versions.sparkSession
    ledger = _stored(spark, f"{store}/ledger", LEDGER)
    findings, entries = scan_versions(versions, ledger, rules=rules, content=content)
    findings.write.mode("append").parquet(f"{store}/findings")
    materialize(entries).write.mode("append").parquet(f"{store}/ledger")
    return _stored(spark, f"{store}/findings", FINDINGS)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of a store, empty where nothing was written yet."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def by_path(versions: DataFrame, findings: DataFrame, *, rules: tuple[Rule, ...] = RULES, content: str = "text", keep: list[str] | None = None) -> DataFrame:
    """A row for each version (every column, or those of `keep`), with blob and its findings: array of (kind, start, stop) by start,
    then kind as listed; empty where there are none. Findings that repeat over runs count once."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    per_blob = findings.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("start", order[F.col("kind")].alias("n"), "kind", "stop"))).alias("__f"))
    columns = [c for c in (keep or versions.columns) if c not in ("blob", "findings")]
    paths = versions.select(*[F.col(f"`{c}`") for c in columns], F.sha2(F.coalesce(F.col(f"`{content}`"), F.lit("")), 256).alias("blob"))
    found = F.transform("__f", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))
    none = F.array().cast("array<struct<kind:string,start:int,stop:int>>")
    return paths.join(per_blob, "blob", "left").withColumn("findings", F.coalesce(found, none)).drop("__f")
