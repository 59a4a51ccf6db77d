"""The library's own operators: literal results, invariants, and queries against their SQL."""

from __future__ import annotations

import json
import math
import os
import random
import unicodedata

import oracle
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curaspark.functions import asciinorm, chem, jsonmeta, rules, text
from curaspark.operators import cascade, dedup, enrich, medians, representative, rowid, schema
from curaspark.plans import queries, workflows
from curaspark.sources import files, images, xlsx
from curaspark.streaming import rowlocal


def apply(spark, f, values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(f(F.col("v"))).collect()]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    n, diff = oracle.compare([tuple(r) for r in df.collect()], df.columns, oracle.duck(sf), queries.SQL[name])
    assert not diff and n


def test_queries_without_sql(spark, sf):
    for name in set(queries.QUERIES) - set(queries.SQL):
        assert queries.QUERIES[name](spark, sf).count()


# --- text ------------------------------------------------------------------------------------


def test_strip_and_collapse_are_those_of_python(spark):
    odd = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    values = [f"{c}a{c}{c}b{c}" for c in odd] + ["", "  ", "a", None, "\ta​b "]
    assert apply(spark, text.strip, values) == [None if v is None else v.strip() for v in values]
    assert apply(spark, text.collapse, values) == [None if v is None else " ".join(v.split()) for v in values]


def test_numbers(spark):
    values = ["1", " 5 ", "+5", ".5", "5.", "1e3", "inf", "-Infinity", "5d", "1f", "0x1p3", "1_000", "true", "1,000", "nan", "", None, "1e400", "abc"]
    want = [1, 5, 5, 0.5, 5, 1000, math.inf, -math.inf] + [None] * 11
    assert apply(spark, text.number, values) == want


def test_tokens_clean_and_join(spark):
    assert apply(spark, text.tokens, ["a, b,,\tc ", " , ", None, "x"]) == [["a", "b", "c"], [], [], ["x"]]
    assert apply(spark, text.clean, [" a ", "None", " NaN", None, ""]) == ["a", "", "", "", ""]
    assert apply(spark, lambda c: text.distinct_join(text.tokens(c)), ["b,a,b,,a|b", None]) == ["b|a|a|b", ""]
    assert apply(spark, lambda c: text.status_join([c, F.lit("x"), F.lit("nan"), F.lit(None)]), ["a", "", None]) == ["a;x", "x", "x"]


# --- ASCII -----------------------------------------------------------------------------------

ASCII = {
    "10 µM": "10 uM",
    "5 μM": "5 uM",
    "μ-opioid": "mu-opioid",
    "Gαqi5": "Galphaqi5",
    "dose–response": "dose-response",
    "56 ± 0.1 °C": "56 +/- 0.1 deg C",
    "5 °Celsius": "5 degCelsius",
    "μm²": "mum2",
    "αM": "uM",
    "10 μmol": "10 umol",
    "56°C": "56 deg C",
    "℃": " deg C",
    "a  b": "a b",
    "½": "1⁄2",
    "x⁻²₃": "x-23",
    "“q” ‘r’ … × ≥ ≤ ≠ —": "\"q\" 'r' ... x >= <= != -",
    "hμ-OR κ Κ λ": "hmu-OR kappa Kappa λ",
}


def test_ascii_cases(spark):
    assert apply(spark, asciinorm.normalise, [*ASCII, None]) == [*ASCII.values(), None]


def scanner(t: str) -> str:
    """Left to right over NFKC text, as a check on the chain of replacements."""
    out, i = "", 0
    while i < len(t):
        if t[i] in asciinorm.GREEK:
            for suffix, unit in asciinorm.UNITS:
                end = i + 1 + len(suffix)
                if t[i + 1 : end] == suffix and (end == len(t) or not (t[end].isalnum() or t[end] == "_" or unicodedata.category(t[end]).startswith("M"))):
                    out, i = out + unit, end
                    break
            else:
                out, i = out + asciinorm.GREEK[t[i]], i + 1
        else:
            out, i = out + t[i], i + 1
    return out


def test_greek_chain_equals_a_scanner(spark):
    rng = random.Random(1)
    values = ["".join(rng.choice("αμΔΜMLlgmsol .-1_é") for _ in range(rng.randrange(12))) for _ in range(3000)]
    assert apply(spark, asciinorm.greek, values) == [scanner(v) for v in values]


def test_normalisation_is_idempotent_and_reports_what_is_left(spark):
    rng = random.Random(2)
    values = ["".join(rng.choice("aμ°C ±–é½λ²  M") for _ in range(10)) for _ in range(500)] + ["𝄞é"]
    once = apply(spark, asciinorm.normalise, values)
    assert apply(spark, asciinorm.normalise, once) == once
    df = spark.createDataFrame(list(enumerate(once)), "i long, t string")
    left = sorted((r["i"], r["position"], r["character"]) for r in asciinorm.residual(df, "t").collect())
    assert left == sorted((i, k, c) for i, t in enumerate(once) for k, c in enumerate(t) if ord(c) > 127)


# --- rules -----------------------------------------------------------------------------------


def test_violations(spark):
    cases = {
        "": "empty description",
        " \t": "empty description",
        "The pki of it": "banned token present: 'pki'",
        "ok ``` x": "looks like JSON or Markdown fence in production output",
        " {x": "looks like JSON or Markdown fence in production output",
        "In mice, concentration–response": "in vivo description uses 'concentration-response' instead of 'dose-response'",
        "In cells, Dose-response": "in vitro description uses 'dose-response' instead of 'concentration-response'",
        "In rat brain membranes, dose-response": None,
        "given (s.c.) 5": None,
        "in C57BL/6 cells, concentration-response": None,
        "dose-response and concentration-response": None,
    }
    assert apply(spark, rules.violation, [*cases, None]) == [*cases.values(), "empty description"]


def test_response_phrase(spark):
    cases = {
        "Mouse Concentration-Response X": "Mouse dose-response X",
        "cells DOSE–Response": "cells concentration–response",
        "rat brain, dose-response": "rat brain, dose-response",
        "": "",
    }
    assert apply(spark, rules.fix_response_phrase, [*cases, None]) == [*cases.values(), None]


# --- JSON ------------------------------------------------------------------------------------


def test_recovery(spark):
    good = '{"a": "x}y", "b": {"c": 1}}'
    cases = {
        good: good,
        "```json\n" + good + "\n```": good,
        "Here: " + good + " done } {": good,
        "no object": None,
        "{'a': 1}": None,
        '{"a": 1': None,
        '{"a": "\\"}"} x': '{"a": "\\"}"}',
        "": None,
    }
    assert apply(spark, lambda c: jsonmeta.recovered(jsonmeta.unfenced(c)), [*cases, None]) == [*cases.values(), None]
    df = spark.createDataFrame([(1, good), (2, "bad"), (3, None)], "i long, raw string")
    assert [tuple(r) for r in jsonmeta.fields(df, "raw", ["a", "b", "z"]).orderBy("i").collect()] == [(1, good, "x}y", '{"c":1}', None), (2, "bad", None, None, None), (3, None, None, None, None)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='ab{}"\\ ', max_size=12), st.dictionaries(st.text(max_size=4), st.text(max_size=6), max_size=3))
def test_balanced_finds_an_object_after_any_plain_preamble(noise, obj):
    plain = noise.replace("{", "").replace('"', "")
    assert jsonmeta.balanced(plain + json.dumps(obj) + noise) == json.dumps(obj)


# --- schemas ---------------------------------------------------------------------------------


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" ﻿SMI​LES\xa0", "doc_ID", "Doc Id"])
    assert schema.clean_names(df).columns == ["SMILES", "doc_ID", "Doc Id"]
    assert schema.resolve(schema.clean_names(df), ["smiles", "SMILES"]) == "SMILES"
    assert schema.resolve_loosely(df, ["docid"]) == "Doc Id"
    for call in (lambda: schema.resolve(df, ["x"]), lambda: schema.resolve(df, [], "x"), lambda: schema.resolve_loosely(df, [], "docid"), lambda: schema.resolve_loosely(df, ["x"]), lambda: schema.require(df, ["x", "y"])):
        with pytest.raises(ValueError):
            call()
    df = spark.createDataFrame([(1, "a")], ["a.b", "c"])
    assert schema.renamed_in_place(df, "a.b", "z/w").columns == ["z/w", "c"]
    assert schema.fixed(df, (("c", "string"), ("n", "long"))).dtypes == [("c", "string"), ("n", "bigint")]


def test_typed_and_nan(spark):
    df = spark.createDataFrame([("NA", "1.5", "7"), (" nan ", "x", "")], "a string, b string, c string")
    assert [tuple(r) for r in schema.typed(df, numbers=["b"], integers=["c"]).collect()] == [(None, 1.5, 7), (" nan ", None, None)]
    df = spark.createDataFrame([(math.nan, 1), (2.0, 2)], "x double, i long")
    assert [tuple(r) for r in schema.nan_to_null(df).collect()] == [(None, 1), (2.0, 2)]


# --- representatives -------------------------------------------------------------------------


def brute_keep(rows):
    """rows: (pos, key, first, second, unit, year)."""
    keep, member = set(), set()
    for value, ok in ((2, lambda r: r[2] is not None), (3, lambda r: r[4] in workflows.STANDARD_UNITS and r[3] is not None)):
        part = [r for r in rows if ok(r)]
        member |= {r[0] for r in part}
        for k in {r[1] for r in part}:
            g = [r for r in part if r[1] == k]
            xs = sorted(r[value] for r in g)
            m = xs[len(xs) // 2] if len(xs) % 2 else (xs[len(xs) // 2 - 1] + xs[len(xs) // 2]) / 2
            keep.add(min(g, key=lambda r: (abs(r[value] - m), math.inf if r[5] is None else r[5], r[0]))[0])
    return keep | {r[0] for r in rows} - member


def test_two_paths_against_brute_force(spark):
    rng = random.Random(3)
    rows = [
        (i, rng.choice(["a", "b", "c", None]), rng.choice([None, 5.0, 6.5, 7.25]), rng.choice([None, 1.0, 2.0, 9.0]), rng.choice(["uM", "nM", "%", None]), rng.choice([None, 2001, 2010]))
        for i in range(120)
    ]
    s = workflows.ActivitySettings(keys=["key"])
    df = spark.createDataFrame(rows, "row_pos long, key string, `pChEMBL Value` double, `Standard Value` double, `Standard Units` string, `Document Year` int")
    out = workflows.aggregate_activities(df, s)
    kept = {r["row_pos"] for r in out.aggregated.collect()}
    gone = {r["row_pos"] for r in out.removed.collect()}
    assert kept == brute_keep(rows) and kept | gone == set(range(120)) and not kept & gone
    table = {r["Metric"]: r["Value"] for r in out.summary.collect()}
    assert table["Original rows"] == "120" and table["Rows remaining"] == str(len(kept)) and len(table) == 10
    on = [r for r in rows if r[2] is not None or (r[4] in workflows.STANDARD_UNITS and r[3] is not None)]
    assert table["Rows on neither path, counted"] == str(120 - len(on))


def test_medoids_by_either_strategy(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 2, None]), rng.choice([None, 1.0, 2.0, 4.0, 8.0])) for i in range(60)]
    df = spark.createDataFrame(rows, "pos long, k long, x double")
    a = representative.medoids(df, ["k"], F.col("x"), [F.col("pos")]).collect()
    b = representative.medoids(df, ["k"], F.col("x"), [F.col("pos")], strategy="aggregate").collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str) and len(a) == 3
    assert representative.medoids(df.limit(0), ["k"], F.col("x"), [F.col("pos")]).count() == 0


def test_fixture_of_descriptors(spark):
    got = medians.group_medians(
        spark.createDataFrame([(0, " a", "1", None), (1, "a", "2", "x"), (2, "", "9", "9"), (3, "b", "nan", "4"), (4, None, "1", "1"), (5, "a ", "4", "inf")], "row_pos long, k string, x string, y string"),
        "k", ["x", "y"], order=F.col("row_pos"),
    ).collect()
    assert [tuple(r) for r in got] == [("a", 3, 2.0, math.inf), ("b", 1, None, 4.0)]


# --- cascade ---------------------------------------------------------------------------------

RECORDS = [("A", "10.1/a", None, None), ("B", "None", "22", None), ("C", None, " 33 ", "P1"), ("D", "nan", None, "US1"), ("A", "10.1/a", None, None)]
CELLS = ["A", "B, A", "Z", None, " , ", "C,B,C", "D", "A"]
WANT = [("10.1/a", "doi"), ("10.1/a", "doi"), ("", "unresolved"), ("", "unresolved"), ("", "unresolved"), ("33|22", "pubmed_id"), ("US1", "patent_id"), ("10.1/a", "doi")]


def test_references(spark):
    records = spark.createDataFrame(RECORDS, "document_chembl_id string, doi string, pubmed_id string, patent_id string")
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(CELLS)], "row_pos long, `Document ChEMBL ID` string")
    out = workflows.resolve_references(rows, records, context=())
    got = rowid.in_order(out.rows).collect()
    assert [(r["reference_id"], r["reference_type"]) for r in got] == WANT
    assert [tuple(r) for r in out.breakdown.collect()] == [("doi", 3, 37.5), ("pubmed_id", 1, 12.5), ("patent_id", 1, 12.5), ("unresolved", 3, 37.5)]
    p = out.provenance()
    assert (p["input_rows"], p["unique_document_ids"], p["document_ids_with_no_record"], p["mean_rows_per_document"]) == (8, 5, 1, 1.6)
    dedup.check_annotated(rows, out.rows, row="row_pos", same=["Document ChEMBL ID"])
    shorter = workflows.resolve_references(rows, records, order=["patent_id", "doi"], context=())
    assert rowid.in_order(shorter.rows).collect()[5]["reference_id"] == "P1"
    with pytest.raises(ValueError):
        workflows.resolve_references(rows, records, order=["isbn"])


# --- keys and checks -------------------------------------------------------------------------


def test_map_back_never_multiplies_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, "a")], "i long, k string")
    dim = spark.createDataFrame([("a", 1), ("a", 1), (None, 9)], "k string, v long")
    for limit in (100, 0):
        out = dedup.map_back(df, dim, ["k"], defaults={"v": -1}, limit=limit).orderBy("i").collect()
        assert [r["v"] for r in out] == [1, 9, -1, 1]


def test_checks_raise(spark):
    df = spark.createDataFrame([(0, "a", "x"), (1, "a", "y"), (2, "b", "")], "row_pos long, k string, v string")
    dedup.check_annotated(df, df, row="row_pos", same=["k"])
    bad = [df.where("row_pos < 2"), df.union(df.limit(1)), df.withColumn("k", F.lit("q")), df.union(spark.createDataFrame([(9, "a", "b")], df.schema))]
    for b in bad:
        with pytest.raises(dedup.InvariantError):
            dedup.check_annotated(df, b, row="row_pos", same=["k"])
    with pytest.raises(dedup.InvariantError, match="empty"):
        dedup.check_annotated(df, df, row="row_pos", filled="v")
    with pytest.raises(dedup.InvariantError):
        dedup.check_consistent(df, ["k"], "v")
    dedup.check_consistent(df, ["row_pos"], "v")


# --- enrichment ------------------------------------------------------------------------------


def test_failure_policies():
    pauses: list = []

    def failing(keys):
        raise OSError("down")

    def wrong(keys):
        raise KeyError("bug")

    docs = enrich.Policy("raise", attempts=3, wait=5.0, sleep=pauses.append)
    with pytest.raises(enrich.RetryExhausted):
        enrich.attempt(failing, ["a"], docs)
    assert pauses == [5.0, 10.0]
    pauses.clear()
    compounds = enrich.Policy("status", attempts=3, wait=1.0, growth="linear", exhausted="cid_retry_exhausted", error="cid_error", sleep=pauses.append)
    assert enrich.attempt(failing, ["a"], compounds) == ({}, "cid_retry_exhausted") and pauses == [1.0, 2.0]
    assert enrich.attempt(wrong, ["a"], compounds) == ({}, "cid_error:KeyError")
    assert enrich.attempt(failing, ["a"], enrich.Policy("null", attempts=1)) == ({}, "missing")
    generator = enrich.Policy("status", attempts=8, wait=2.0, most_wait=60.0)
    assert [generator.pause(i) for i in range(1, 7)] == [2, 4, 8, 16, 32, 60]
    tries: list = []

    def second(keys):
        tries.append(1)
        if len(tries) < 2:
            raise OSError("once")
        return {k: {} for k in keys}

    assert enrich.attempt(second, ["a"], enrich.Policy(wait=0, sleep=pauses.append)) == ({"a": {}}, None)


def test_resume_asks_only_for_new_keys(spark):
    def fetch(keys):
        return {k: {"v": k * 2} for k in keys if k != "c"}

    quiet = enrich.Policy(batch=2)
    first = enrich.resumed(spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "k string"), "k", None, fetch, ["v"], quiet)
    assert sorted(map(tuple, first.collect())) == [("a", "aa", "found"), ("c", None, "missing")]
    more = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [tuple(r) for r in enrich.resumed(more, "k", first, fetch, ["v"], quiet).collect()] == [("b", "bb", "found")]


def test_tiers(spark):
    rows = spark.createDataFrame([(" P ", "9606"), ("Q", "1"), ("R", "1"), (None, "1"), ("P", None)], "protein_name string, ncbi_target_taxonomy_id string")
    kind = "protein_name string, taxonomy_id long, accession string, rank int"
    reviewed = spark.createDataFrame([("P", 9606, "P2", 2), ("P", 9606, "P1", 1)], kind)
    every = spark.createDataFrame([("P", 9606, "X", 0), ("Q", 1, "Q1", 0)], kind)
    got = workflows.protein_ids(rows, reviewed, every).collect()
    assert {(r[0], r["uniprot_id"]) for r in got} == {(" P ", "P1"), ("Q", "Q1"), ("R", None), (None, None), ("P", None)} and len(got) == 5
    with pytest.raises(Exception):
        workflows.protein_ids(spark.createDataFrame([("P", "x")], rows.schema), reviewed, every).collect()


# --- workflows -------------------------------------------------------------------------------


def test_descriptions(spark):
    rows = [(0, "Cells  in a dish", "P1", "first"), (1, " Cells in a dish", "P1", "second"), (2, "mice", "P2", None), (3, "bad", "P3", "x")]
    df = spark.createDataFrame(rows, "row_pos long, experimental_protocol string, protein_name string, assay_name string")
    asked: list = []

    def generator(message):
        if "bad" in message:
            raise ValueError("no")
        return "Mice, concentration-response " if "mice" in message else "Cells, dose-response of " + message.split("assay_name: ")[1]

    s = workflows.DescriptionSettings(policy=enrich.Policy("status", attempts=1, batch=1))
    keys = workflows.description_keys(df, s).collect()
    assert len(keys) == 3 and {r["__assay"] for r in keys} == {"first", "", "x"} and not asked
    made = workflows.generate(workflows.description_keys(df, s), generator, s)
    d = workflows.describe(df, made, s)
    got = [r["assay_description"] for r in rowid.in_order(d.rows).collect()]
    assert got == ["Cells, concentration-response of first"] * 2 + ["Mice, dose-response", ""]
    assert [(r["protein"], r["error"]) for r in d.errors.collect()] == [("P3", "empty description (API call failed)")]
    with pytest.raises(workflows.DescriptionError):
        workflows.finish(df, d, s)
    good = df.where("row_pos < 3")
    assert workflows.finish(good, workflows.describe(good, made, s), s).count() == 3


def test_validation_mode(spark):
    df = spark.createDataFrame([(0, "p", "x", "a")], "row_pos long, experimental_protocol string, protein_name string, assay_name string")
    s = workflows.DescriptionSettings(mode="validation", policy=enrich.Policy(batch=1))

    def generator(message):
        assert message.startswith("Output mode: JSON")
        return 'Sure: {"assay_class": "binding", "assay_description": " Binding. ", "platform": null} ok'

    d = workflows.describe(df, workflows.generate(workflows.description_keys(df, s), generator, s), s)
    r = workflows.finish(df, d, s).first()
    assert (r["assay_description"], r["assay_class"], r["platform"], r["target"]) == ("Binding.", "binding", None, None)
    assert "_raw_model_output" in d.debug.columns and set(jsonmeta.METADATA) <= set(d.rows.columns)


def test_compounds_without_a_chemistry_library(spark):
    df = spark.createDataFrame([(" CCO ",), (None,), ("C",), ("",)], ["﻿SMILES"])
    cids = spark.createDataFrame([("CCO", 702)], "smiles string, cid long")
    names = spark.createDataFrame([(702, "ethanol")], "cid long, iupac_name string")
    out = workflows.annotate_compounds(df, cids, names)
    assert [c for c, _ in out.dtypes] == [c for c, _ in workflows.COMPOUND_SCHEMA] and out.count() == 4
    by = {r["canonical_smiles"]: r for r in out.collect()}
    assert (by[" CCO "]["pubchem_cid"], by[" CCO "]["iupac_name"]) == (702, "ethanol")
    assert by["C"]["pubchem_cid_status"] == chem.NO_CID_MATCH and by["C"]["iupac_status"] == chem.MISSING_CID
    assert by[None]["annotation_status"] == ";".join([chem.MISSING_SMILES] * 3 + [chem.MISSING_CID])
    assert workflows.compound_counts(out).first()["pubchem_cid_found"] == 1
    if chem.Chem is None:
        assert by["C"]["rdkit_status"] == chem.UNAVAILABLE
        s = workflows.standardise_structures(spark.createDataFrame([("1", "C"), ("2", None)], "odo_id string, smiles string"))
        assert {(r["odo_id"], r["S0"], r["S5"], r["error"]) for r in s.collect()} == {("1", "C", None, chem.UNAVAILABLE), ("2", "nan", None, chem.UNAVAILABLE)}


def test_ascii_workflow(spark):
    df = spark.createDataFrame([(1, "5 μM", "x"), (2, None, "y"), (3, "plain", "z"), (4, "é", "w")], "i long, assay_description string, o string")
    out = workflows.to_ascii(df)
    assert out.rows.columns == ["i", "assay_description_ascii_compliant", "o"]
    assert tuple(out.counts.first()) == (4, 1) and [(r["i"], r["position"]) for r in out.residual.collect()] == [(4, 0)]


# --- files -----------------------------------------------------------------------------------


def test_csv_forms(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿k,"v ""q"""\r\n1,"x\r\ny"\r\nNA,é\r\n'.encode())
    df = files.read_csv(spark, f"{tmp_path}/a.csv")
    assert df.columns == ["k", 'v "q"'] and [tuple(r) for r in df.collect()] == [("1", "x\ny"), ("NA", "é")]
    (tmp_path / "b.txt").write_bytes("k,v\n1,caf\xe9\n".encode("latin-1"))
    assert files.encoding_of(spark, f"{tmp_path}/b.txt") == "ISO-8859-1"
    assert files.read_table(spark, f"{tmp_path}/b.txt").first()["v"] == "café"
    (tmp_path / "c.tsv").write_text("k\tv\n1\ta,b\n")
    assert files.read_table(spark, f"{tmp_path}/c.tsv").first()["v"] == "a,b"
    with pytest.raises(ValueError):
        files.read_table(spark, "x.pdf")
    with pytest.raises(ValueError):
        files.read_table(spark, "x.xls")


def test_finding_files(tmp_path):
    with pytest.raises(FileNotFoundError, match="data files in .*: none"):
        files.find_input(tmp_path, stem="in")
    for n in ("in.csv", "in.tsv", "b.csv"):
        (tmp_path / n).write_text("x")
    assert files.find_input(tmp_path, stem="in").name == "in.csv" and files.find_input(tmp_path, "/elsewhere/b").name == "b.csv"
    assert files.only_csv(tmp_path, "b.csv").name == "b.csv"
    with pytest.raises(FileNotFoundError, match="several"):
        files.only_csv(tmp_path)
    with pytest.raises(ValueError):
        files.require_file(tmp_path / "b.csv", [".xlsx"])
    for i in range(25):
        (tmp_path / f"z{i:02}.csv").write_text("x")
    assert "(and 8 others)" in files.available(tmp_path)
    p = files.write_provenance(tmp_path / "out.xlsx", {"n": 1})
    assert p.name == "out.xlsx.provenance.json" and json.loads(p.read_text()) == {"n": 1}


def test_workbooks_round_trip(spark, tmp_path):
    path = f"{tmp_path}/w.xlsx"
    a = spark.createDataFrame([(1, "é & <x>", 1.5, True), (2, None, math.nan, None)], "i long, `t s` string, x double, b boolean").orderBy("i")
    b = spark.createDataFrame([("only",)], "c string")
    xlsx.write(path, [("First & one", a), ("Second", b)])
    got = [tuple(r) for r in xlsx.read(spark, path).collect()]
    assert got == [("1", "é & <x>", "1.5", "True"), ("2", None, None, None)]
    assert xlsx.read(spark, path).columns == ["i", "t s", "x", "b"]
    assert [tuple(r) for r in xlsx.read(spark, path, "Second").collect()] == [("only",)]
    assert xlsx.read_anywhere(spark, f"file:{path}").collect() == xlsx.read(spark, path).collect()
    assert xlsx.header(["a", None, "a"]) == ["a", "Unnamed: 1", "a.1"] and xlsx.column_letters(701) == "ZZ" and xlsx.column_number("ZZ12") == 701


def test_csv_sink(spark, tmp_path):
    files.write_csv(spark.createDataFrame([(1, 'a "b", c')], "i long, t string"), f"{tmp_path}/o")
    assert [tuple(r) for r in files.read_csv(spark, f"{tmp_path}/o").collect()] == [("1", 'a "b", c')]


def test_tables_in_images(spark, tmp_path):
    (tmp_path / "i.png").write_bytes(b"image")
    html = "<table><tr><th rowspan=2>A</th><th colspan=2>B</th></tr><tr><td>1</td><td>2 &amp; 3</td></tr></table>"
    got = images.recognised(spark, f"{tmp_path}/i.png", lambda data: [html])
    assert [r["cells"] for r in images.cells(got).orderBy("row").collect()] == [["A", "B", "B"], ["A", "1", "2 & 3"]]
    for n in (0, 2):
        with pytest.raises(Exception, match="extraction"):
            images.recognised(spark, f"{tmp_path}/i.png", lambda data, n=n: [html] * n).collect()


def test_row_positions(spark, sf):
    df = rowid.parquet(spark.read.parquet(f"{sf}/nation.parquet"))
    assert sorted(r["row_pos"] for r in df.collect()) == list(range(25)) and rowid.head(df, 3).count() == 3


# --- plans and streams -----------------------------------------------------------------------


def test_one_exchange_for_both_paths(spark, sf):
    plan = queries._flagged(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_medoids_limit_groups_before_the_shuffle_result(spark, sf):
    plan = queries.representative_row(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ReadSchema" in plan


def test_streams(spark, tmp_path):
    src = f"{tmp_path}/in"
    spark.createDataFrame([(1, "a", "5 μM dose-response"), (2, "a", "x"), (3, "b", "IC50")], "i long, k string, t string").write.parquet(src)
    stream = spark.readStream.schema("i long, k string, t string").parquet(src)
    out = rowlocal.checked(rowlocal.normalise(stream, "t", "t"), "t")
    q = out.writeStream.format("memory").queryName("checked").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r["i"], r["t"]) for r in spark.table("checked").collect()} == {(1, "5 uM concentration-response"), (2, "x"), (3, "IC50")}
    got: list = []
    q = rowlocal.representatives(stream, ["k"], F.col("i").cast("double"), [F.col("i")], history=f"{tmp_path}/h", sink=lambda df, n: got.extend(df.collect()), checkpoint=f"{tmp_path}/c2")
    q.awaitTermination()
    assert {(r["k"], r["i"]) for r in got} == {("a", 1), ("b", 3)}


def test_entry_works_without_the_corpus_operators():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys\n"
        "class No:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.split('.')[:2] == ['curaspark', 'llm'] or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "assert 'representative_row' in e.queries() and not any(k.startswith('op') for k in e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_a_failed_lookup_keeps_its_finished_lots(spark, tmp_path):
    from curaspark.operators import enrich

    log, path = tmp_path / "asked", f"{tmp_path}/store"
    keys = spark.createDataFrame([(f"k{i}",) for i in range(30)] + [("k1",), (None,)], "id string")

    def fetcher(most):
        def fetch(part):
            asked = len(log.read_text().split()) if log.exists() else 0
            if asked >= most:
                raise ValueError("down")
            with log.open("a") as f:
                f.write("".join(f"{k}\n" for k in part))
            return {k: {"name": k.upper()} for k in part}

        return fetch

    policy = enrich.Policy(batch=1)
    with pytest.raises(Exception, match="down"):
        enrich.stored(keys, "id", path, fetcher(20), ["name"], policy, every=5)
    done = spark.read.parquet(path).count()
    assert 0 < done <= 20
    out = enrich.stored(keys, "id", path, fetcher(10**6), ["name"], policy, every=5).collect()
    assert sorted((r["id"], r["name"], r["status"]) for r in out) == sorted((f"k{i}", f"K{i}", "found") for i in range(30))
    assert len(log.read_text().split()) == 20 + 30 - done
