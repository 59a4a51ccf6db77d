"""The pipeline's stages, one after another, against brute force; and the queries against their SQL."""

from __future__ import annotations

import random

import oracle
import pytest
from test_operators import brute_classes, brute_hits, brute_lines, water

import corpus_pipeline
from curaspark.llm import common, mixing, queries


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    d = tmp_path_factory.mktemp("corpus")
    vocab = [f"word{i}" for i in range(400)]
    bench = [(i, " ".join(rng.choice(vocab) for _ in range(14))) for i in range(5)]
    shared = " ".join(rng.choice(vocab) for _ in range(12))
    rows = []
    for i in range(60):
        ls = [" ".join(rng.choice(vocab) for _ in range(15)) for _ in range(rng.randrange(2, 8))]
        if i % 6 == 0:
            ls.insert(1, shared)
        if i % 10 == 3:
            ls.append("see " + bench[i % 5][1] + " there")
        rows.append((i, "\n".join(ls), "en" if i % 2 else "fr", f"s{i % 4}", 0))
    # Near copies: every line differs in two words, so that line dedup leaves them, but few five-word runs do.
    base = [rng.choice(vocab) for _ in range(300)]
    for k in range(3):
        w = list(base)
        w[k], w[-1 - k] = "other", "others"
        rows.append((100 + k, " ".join(w) + f" end{k}", "en", "s1", 0))
    rows += [(200, None, "en", "s0", None), (201, "12 34 !!", "en", "s0", 8), (202, rows[0][1], "en", "s0", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), rows, bench


def test_stages_against_brute_force(spark, corpus, tmp_path):
    d, rows, bench = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, outs = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        outs.append(sorted((tuple(r) for r in docs.select(*columns).collect()), key=lambda r: r[0]))
        if k < 4:
            assert docs.columns == columns
    assert [r[0] for r in outs[0]] == [r[0] for r in rows if r[0] not in (200, 201)]
    gone = dict(brute_lines([r[:2] for r in outs[0]]))
    want = {}
    for r in outs[0]:
        left = "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in gone[r[0]])
        if not gone[r[0]] or common.words(left.encode()):
            want[r[0]] = left
    assert {r[0]: r[1] for r in outs[1]} == want and 202 not in want and any(gone.values())
    classes = brute_classes([r[:2] for r in outs[1]])
    assert [r[0] for r in outs[2]] == sorted({c for _, c, _ in classes}) and len(outs[2]) < len(outs[1])
    kept = {r[0]: r[1] for r in outs[3]}
    for r in outs[2]:
        _, hit, _ = brute_hits(r[1], bench)
        if not hit:
            assert kept[r[0]] == r[1]
        elif r[0] in kept:
            assert not brute_hits(kept[r[0]], bench)[1] and len(kept[r[0]]) < len(r[1])
    sizes: dict = {}
    for r in outs[3]:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    target = water(sizes)
    for s, t in target.items():
        taken = [len(r[1].split()) for r in outs[4] if r[3] == s]
        assert abs(sum(taken) - t) <= max(len(r[1].split()) for r in outs[3] if r[3] == s)
    final = sorted((tuple(r) for r in corpus_pipeline.run(spark, d).select(*columns).collect()), key=lambda r: r[0])
    assert final == outs[4]


def test_run_takes_every_document_of_the_mix(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and set(out.columns) > {"doc_id", "text", "lang", "source", "n_chars"}
    m = mixing.mixture(spark.read.parquet(f"{sf}/documents.parquet"))
    assert m.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    n, diff = oracle.compare([tuple(r) for r in df.collect()], df.columns, oracle.duck(sf), queries.ORACLES[name])
    assert not diff and n
