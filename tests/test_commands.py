"""Commands, clients of services, and stages of chemistry with stand-ins for what is not installed here."""

from __future__ import annotations

import json
import types
import urllib.error

import pytest
from pyspark.sql import functions as F

from curaspark import cli
from curaspark.functions import asciinorm, chem, rules
from curaspark.operators import enrich, representative
from curaspark.session import spread
from curaspark.sources import files, images, services


class Mol:
    def __init__(self, text):
        self.text = text


@pytest.fixture
def toolkit(monkeypatch):
    """Reads texts of letters and dots; S1 of `Bad` gives a text that can't be read again."""
    written = {"Bad": "un readable"}

    class Editable(Mol):
        def __init__(self, mol):
            super().__init__(mol.text)

        def BeginBatchEdit(self):
            self.gone = []

        def GetAtoms(self):
            kinds = {"H": 1}
            return [types.SimpleNamespace(GetAtomicNum=lambda c=c: kinds.get(c, 6), GetIdx=lambda i=i: i, SetIsotope=lambda n: None) for i, c in enumerate(self.text)]

        def RemoveAtom(self, i):
            self.gone.append(i)

        def CommitBatchEdit(self):
            self.text = "".join(c for i, c in enumerate(self.text) if i not in self.gone)

        def GetMol(self):
            return Mol(self.text)

    fake = types.SimpleNamespace(
        MolFromSmiles=lambda s: None if " " in s or s == "nan" else Mol(s),
        MolToSmiles=lambda m: written.get(m.text, m.text),
        MolFromSmarts=lambda s: s,
        RWMol=Editable,
        SanitizeMol=lambda m: None,
    )
    Mol.GetSubstructMatches = lambda self, pattern: []
    standard = types.SimpleNamespace(
        FragmentRemover=lambda: types.SimpleNamespace(remove=lambda m: Mol(m.text.replace(".Cl", ""))),
        LargestFragmentChooser=lambda: types.SimpleNamespace(choose=lambda m: Mol(max(m.text.split("."), key=len))),
        TautomerEnumerator=lambda: types.SimpleNamespace(Canonicalize=lambda m: Mol(m.text + "t")),
    )
    monkeypatch.setattr(chem, "Chem", fake)
    monkeypatch.setattr(chem, "rdMolStandardize", standard, raising=False)


def test_stages_record_their_texts(toolkit):
    run = chem._Standardiser(chem.STAGES).run
    assert run("CCH.O.Cl") == {"S1": "CCH.O.Cl", "S2": "CCH", "S3": "CCH", "S4": "CCHt", "S5": "CCt"}
    # The first text stays where it can't be read again; that is no error.
    assert run("Bad") == {"S1": "un readable"}
    assert run("nan") == {"error": "RDKit failed to parse SMILES"}
    assert chem._Standardiser(["S4", "S2"]).run("C.Cl") == {"S2": "C", "S4": "Ct"}


def test_a_service_status_is_data():
    assert enrich.service_status(lambda: [{"chembl_db_version": "X_1", "other": 2}]) == {"chembl_db_version": "X_1", "chembl_release_date": None, "api_version": None}
    assert enrich.service_status(lambda: 1 / 0) == {"error": "Could not retrieve ChEMBL status: division by zero"}


def test_clients_read_what_services_answer():
    answers = {
        "document.json": {"documents": [{"document_chembl_id": "D1", "doi": "10/x"}]},
        "smiles/cids": {"IdentifierList": {"CID": [241]}},
        "/cid/241/": {"PropertyTable": {"Properties": [{"CID": 241, "IUPACName": "benzene"}]}},
        "search": {"results": [{"primaryAccession": "P1"}]},
    }
    asked = []

    def get(url):
        asked.append(url)
        if "missing" in url or "/cid/9/" in url:
            raise urllib.error.HTTPError(url, 404, "no", None, None)
        return json.dumps(next(v for k, v in answers.items() if k in url)).encode()

    assert services.documents(get)(["D1", "D2"]) == {"D1": {"document_chembl_id": "D1", "doi": "10/x"}}
    assert services.compound_ids(get)(["c1ccccc1", "missing"]) == {"c1ccccc1": {"cid": 241}}
    assert services.compound_names(get)(["241", "9"]) == {"241": {"iupac_name": "benzene"}}
    assert services.protein_accessions(True, get)(["Mu receptor\t9606"]) == {"Mu receptor\t9606": {"accession": "P1"}}
    assert "document_chembl_id__in=D1%2CD2" in asked[0] and "reviewed%3Atrue" in asked[-1]


def test_a_store_is_deleted_in_the_end(spark, tmp_path):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(7)], "id string")
    done = enrich.stored(keys, "id", f"file:{tmp_path}/s", lambda ks: {k: {"v": k} for k in ks}, ["v"], enrich.Policy(), every=3)
    assert done.count() == 7
    enrich.discard_store(keys, f"file:{tmp_path}/s")
    assert not (tmp_path / "s").exists()


def test_references_as_a_command(spark, tmp_path, capsys):
    (tmp_path / "ids.csv").write_text("chembl_document_id,x\nA,1\nB,2\nZ,3\nA,4\n")
    (tmp_path / "records.csv").write_text("document_chembl_id,doi,pubmed_id,patent_id,journal,year,title,doc_type\nA,10/a,,,J,2001,T,P\nB,,22,,,,,\n")
    args = ["references", "--folder", str(tmp_path), "--in", "ids", "--out", "out.xlsx", "--records", str(tmp_path / "records.csv")]
    assert cli.main(args, spark) == 0
    rows = files.read_table(spark, str(tmp_path / "out.xlsx")).collect()
    assert [(r["chembl_document_id"], r["reference_id"], r["reference_type"]) for r in rows] == [
        ("A", "10/a", "doi"), ("B", "22", "pubmed_id"), ("Z", "", "unresolved"), ("A", "10/a", "doi")
    ]
    told = json.loads((tmp_path / "out.xlsx.provenance.json").read_text())
    assert (told["input_file"], told["output_file"], told["input_rows"], told["document_ids_with_no_record"]) == ("ids.csv", "out.xlsx", 4, 1)
    assert "error" in told["chembl_status"] and "doi" in capsys.readouterr().out
    assert cli.main(["references", "--folder", str(tmp_path), "--in", "none"], spark) == 1
    assert "data files in" in capsys.readouterr().err


def test_a_table_is_saved_beside_its_image(spark, tmp_path):
    html = "<table><tr><td colspan=2>a</td></tr><tr><td>b</td><td>c &amp; d</td></tr></table>"
    page, book = images.save(spark, html, tmp_path / "t")
    assert page.read_text() == html and book.exists()
    tables = spark.createDataFrame([("p", html), ("q", None)], "path string, html string")
    assert [tuple(r) for r in images.cells(tables).orderBy("row").collect()] == [("p", 0, ["a", "a"]), ("p", 1, ["b", "c & d"])]


def test_two_paths_agree_by_either_strategy(spark):
    rows = [(k, v, u, y, n) for n, (k, v, u, y) in enumerate([("a", 1.0, None, 5), ("a", 3.0, 2.0, None), ("a", 2.0, 2.0, 3), (None, 4.0, None, 1), (None, 4.0, 1.0, 1), ("b", None, None, 2)] * 3)]
    df = spark.createDataFrame(rows, "k string, v double, u double, y int, n int")
    paths = (representative.Path("v", F.lit(True), F.col("v")), representative.Path("u", F.col("y") > 0, F.col("u")))
    ties = [F.col("y"), F.col("n")]
    got = [sorted(map(str, representative.two_paths(df, ["k"], paths, ties, strategy=s).collect())) for s in ("auto", "aggregate")]
    got.append(sorted(map(str, representative.two_paths(df, ["k"], paths, [t.asc_nulls_last() for t in ties]).collect())))
    assert got[0] == got[1] == got[2]
    assert representative.chosen(df, ["k"], "auto") == "window"


def test_guards_change_no_text(spark):
    texts = ["5 μM  x", "a  b", "56 °C é", "–α  ° b", "½ x", "K ſ", "Ki", "making kids", "pKi EC50", "ıC50", "aIC50b", "ACCORDING TO", "", None, "μm² ℃"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    t = F.col("t")
    plain = asciinorm.punctuation(asciinorm.degrees(asciinorm.scripts(asciinorm.greek(asciinorm.nfkc(t)))))
    token = F.nullif(F.regexp_extract(t, rules.alternation(rules.BANNED), 0), F.lit(""))
    for r in df.select("t", asciinorm.normalise(t).alias("a"), plain.alias("b"), rules.banned_token(t).alias("c"), token.alias("d")).collect():
        assert r["a"] == r["b"] and r["c"] == r["d"], r


def test_spread_leaves_even_tables_alone(spark, tmp_path):
    spark.range(1000).repartition(8).write.parquet(f"{tmp_path}/even")
    even = spark.read.parquet(f"{tmp_path}/even")
    assert spread(even) is even
