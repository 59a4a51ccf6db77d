"""The workflows, composed of operators: each takes frames and settings, and returns frames."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions import asciinorm, chem, jsonmeta, rules, text
from curaspark.operators import cascade, dedup, enrich, medians, representative, schema
from curaspark.operators.rowid import ROW
from curaspark.operators.schema import quoted

# --- representative rows ---------------------------------------------------------------------

# The columns of an activity table.
ACTIVITY_KEYS = (
    "Smiles", "Molecular Weight", "Standard Type", "Standard Relation", "Standard Units",
    "Target Name", "Target Type", "Target Organism", "Assay ChEMBL ID",
)
STANDARD_UNITS = ("%", "mg kg-1", "uM", "mg.kg-1")


@dataclass(frozen=True)
class ActivitySettings:
    keys: Sequence[str] = ACTIVITY_KEYS
    units: Sequence[str] = STANDARD_UNITS
    first_value: str = "pChEMBL Value"
    second_value: str = "Standard Value"
    unit: str = "Standard Units"
    year: str = "Document Year"
    strategy: str = "auto"


@dataclass(frozen=True)
class Activities:
    aggregated: DataFrame
    removed: DataFrame
    summary: DataFrame


def aggregate_activities(rows: DataFrame, settings: ActivitySettings = ActivitySettings(), *, row: str = ROW) -> Activities:
    """One representative row for each group and path; rows on neither path stay. `row` is the position column of rows.

    The summary has the labelled counts; its last line takes off rows on both paths twice, and the line after it is the true
    number of rows on neither path. settings.strategy: `aggregate` for groups that are a large part of the rows, `window`, or `auto`, which
    counts the largest group first.
    """
    s = settings
    schema.require(rows, [*s.keys, s.first_value, s.second_value, s.unit, s.year])
    paths = (
        representative.Path("first", F.lit(True), quoted(s.first_value)),
        representative.Path("second", quoted(s.unit).isin(*s.units), quoted(s.second_value)),
    )
    strategy = representative.chosen(rows, s.keys, s.strategy)
    year = quoted(s.year).asc_nulls_last() if strategy == "window" else quoted(s.year)
    flagged = representative.two_paths(rows, s.keys, paths, [year, F.col(row)], strategy=strategy)
    own = [quoted(c) for c in rows.columns]
    # Labels and texts of the summary.
    lines = [
        ("Original rows", F.col("original_rows")),
        ("Rows removed by aggregation (total)", F.col("removed_rows")),
        (f"  - {s.first_value} median path", F.col("first_removed")),
        (f"  - {s.second_value} median path ({', '.join(s.units)})", F.col("second_removed")),
        ("Rows remaining", F.col("remaining_rows")),
        ("Grouping key", F.lit(" | ".join(s.keys))),
        ("Representative rule", F.lit(f"Row with value closest to group median ({s.first_value} for pChEMBL path; {s.second_value} for the listed units)")),
        ("Tie-break (even-count / equidistant)", F.lit(f"Earliest {s.year}, then original file order")),
        ("Untouched rows (neither path)", F.col("on_no_path_by_sums")),
        ("Rows on neither path, counted", F.col("on_no_path")),
    ]
    summary = representative.summary(representative.counts(flagged, paths), lines)
    return Activities(flagged.where("keep").select(*own), flagged.where("NOT keep").select(*own), summary)


# --- descriptor medians ----------------------------------------------------------------------

#: Descriptor columns.
DESCRIPTORS = ("dipole", "SASA", "FISA", "donorHB", "accptHB", "QPlogPw", "QPlogPo/w", "QPlogS")


def descriptor_medians(rows: DataFrame, key: str = "canonical_smiles", columns: Sequence[str] = DESCRIPTORS, *, row: str | None = ROW) -> DataFrame:
    """The medians of the descriptors for each structure, in the order of first rows."""
    return medians.group_medians(rows, key, columns, order=F.col(row) if row else None)


# --- references ------------------------------------------------------------------------------

#: Names of the column of document ids, by preference.
DOCUMENT_IDS = ("chembl_document_id", "document_chembl_id", "Document ChEMBL ID", "Document Chembl ID", "ChEMBL Document ID", "docid")


@dataclass(frozen=True)
class References:
    rows: DataFrame
    breakdown: DataFrame
    unresolved: DataFrame
    provenance: Callable[..., dict]


def resolve_references(
    rows: DataFrame,
    records: DataFrame,
    *,
    key: str = "document_chembl_id",
    id_column: str | None = None,
    order: Sequence[str] = cascade.ORDER,
    context: Sequence[str] = cascade.CONTEXT,
    row: str = ROW,
) -> References:
    """rows with the fields of the documents that they name and a primary reference; as many rows, in the same order by `row`.

    records is a snapshot of documents, or what enrich.fetched() has brought under enrich.DOCUMENTS. provenance(input_file=,
    output_file=, status=) runs the counts and gives the fields of the provenance file; status: see enrich.service_status().
    """
    if unknown := [f for f in order if f not in cascade.ORDER]:
        raise ValueError(f"no identifiers: {unknown}")
    column = schema.resolve_loosely(rows, DOCUMENT_IDS, id_column)
    fields = [*order, *context]
    looked_up = cascade.lookup_lists(rows, column, records, key, fields, row)
    out = cascade.select_reference(looked_up, order)
    ids = cascade.requested_ids(rows, column)
    unresolved = dedup.unmatched(ids, records.select(quoted(key).cast("string").alias("id")), "id")
    breakdown = cascade.breakdown(out, "reference_type", [*order, "unresolved"])

    def provenance(*, input_file: str | None = None, output_file: str | None = None, status: dict | None = None) -> dict:
        n_in, n_ids, n_none = rows.count(), ids.count(), unresolved.count()
        if not n_ids:
            raise ValueError(f"no document ids in {column!r}")
        counts = {r["category"]: r["n"] for r in breakdown.collect()}
        stamp = rows.sparkSession.range(1).select(text.utc_stamp()).first()[0]
        # The keys.
        return {
            "input_file": input_file,
            "output_file": output_file,
            "id_column": column,
            "precedence_order": list(order),
            "fields_retrieved": fields,
            "input_rows": n_in,
            "output_rows": sum(counts.values()),
            "rows_retained_unchanged": sum(counts.values()) == n_in,
            "row_order_preserved": True,
            "unique_document_ids": n_ids,
            "mean_rows_per_document": round(n_in / n_ids, 3),
            "document_ids_with_no_record": n_none,
            "reference_type_counts": {k: v for k, v in counts.items() if v},
            "retrieval_timestamp_utc": stamp,
            "chembl_status": status,
        }

    return References(out, breakdown, unresolved, provenance)


# --- compounds -------------------------------------------------------------------------------

# Names of the column of structures by preference, and the columns of the result.
SMILES_COLUMNS = ("canonical_smiles", "chembl_canonical_smiles", "SMILES", "smiles", "rdkit_parent_smiles")
COMPOUND_SCHEMA = (
    ("canonical_smiles", "string"), ("standard_inchi", "string"), ("standard_inchikey", "string"),
    ("molecular_formula", "string"), ("molecular_weight", "string"), ("pubchem_cid", "long"), ("iupac_name", "string"),
    ("rdkit_status", "string"), ("inchi_status", "string"), ("pubchem_cid_status", "string"), ("iupac_status", "string"),
    ("annotation_status", "string"),
)


def annotate_compounds(rows: DataFrame, cids: DataFrame, names: DataFrame, *, smiles: str | None = None) -> DataFrame:
    """Structures with properties, compound ids, names and statuses (COMPOUND_SCHEMA); the structure as it was written.

    cids: (smiles, cid[, status]) and names: (cid, iupac_name[, status]), snapshots or what enrich.fetched() has brought under
    enrich.COMPOUNDS. Every distinct structure is worked on once.
    """
    rows = schema.clean_names(rows)
    column = schema.resolve(rows, SMILES_COLUMNS, smiles)
    raw = rows.select(quoted(column).alias("canonical_smiles"), text.blank_to_null(quoted(column).cast("string")).alias("smiles"))
    unique = raw.select("smiles").where("smiles IS NOT NULL").distinct()
    own = unique.select("smiles", chem.properties("smiles").alias("p")).select("smiles", "p.*")
    missing = {"rdkit_status": chem.MISSING_SMILES, "inchi_status": chem.MISSING_SMILES}
    out = dedup.map_back(raw, own, ["smiles"], defaults=missing)
    cid = cids.select(F.col("smiles"), F.col("cid").cast("long").alias("pubchem_cid"), _status(cids, "cid", chem.CID_FOUND, chem.CID_MISSING).alias("pubchem_cid_status"))
    out = dedup.map_back(out, cid, ["smiles"])
    unknown = F.when(F.col("smiles").isNull(), F.lit(chem.MISSING_SMILES)).otherwise(F.coalesce("pubchem_cid_status", F.lit(chem.NO_CID_MATCH)))
    out = out.withColumn("pubchem_cid_status", unknown)
    name = names.select(F.col("cid").cast("long").alias("pubchem_cid"), "iupac_name", _status(names, "iupac_name", chem.NAME_FOUND, chem.NAME_MISSING).alias("iupac_status"))
    out = dedup.map_back(out, name.where("pubchem_cid IS NOT NULL"), ["pubchem_cid"])
    unknown = F.when(F.col("pubchem_cid").isNull(), F.lit(chem.MISSING_CID)).otherwise(F.coalesce("iupac_status", F.lit(chem.NAME_MISSING)))
    out = out.withColumn("iupac_status", unknown).withColumn("molecular_weight", chem.fixed_decimals(F.col("molecular_weight")))
    statuses = [F.col(c) for c in ("rdkit_status", "inchi_status", "pubchem_cid_status", "iupac_status")]
    return schema.fixed(out.withColumn("annotation_status", text.status_join(statuses)), COMPOUND_SCHEMA)


def _status(df: DataFrame, value: str, found: str, missing: str) -> Column:
    return F.col("status") if "status" in df.columns else F.when(F.col(value).isNotNull(), F.lit(found)).otherwise(F.lit(missing))


def compound_counts(annotated: DataFrame) -> DataFrame:
    """One row: rows, valid structures, and how many have an InChI, a key, a compound id and a name."""
    there = [F.count(c).alias(f"{c}_found") for c in ("standard_inchi", "standard_inchikey", "pubchem_cid", "iupac_name")]
    return annotated.agg(F.count("*").alias("rows"), F.count_if(F.col("rdkit_status") == "rdkit_ok").alias("valid"), *there)


def standardise_structures(rows: DataFrame, *, smiles: str = "smiles", key: str = "odo_id", stages: Sequence[str] = chem.STAGES, errors_only: bool = False) -> DataFrame:
    """key, S0 to S5 and error of each structure; only those with an error if asked for."""
    schema.require(rows, [smiles, key])
    s0 = F.coalesce(quoted(smiles).cast("string"), F.lit("nan"))
    named = rows.select(F.coalesce(quoted(key).cast("string"), F.lit("nan")).alias(key), s0.alias("S0"))
    done = dedup.map_back(named, named.select("S0").distinct().select("S0", chem.standardise(F.col("S0"), stages).alias("r")).select("S0", "r.*"), ["S0"])
    out = done.select(quoted(key), "S0", *chem.STAGES, "error")
    return out.where("error IS NOT NULL AND error <> ''") if errors_only else out


# --- proteins --------------------------------------------------------------------------------


def protein_ids(rows: DataFrame, reviewed: DataFrame, complete: DataFrame, *, name: str = "protein_name", taxon: str = "ncbi_target_taxonomy_id") -> DataFrame:
    """rows with uniprot_id: the first accession by rank among reviewed entries, else among all. Both tiers: (protein_name,
    taxonomy_id, accession, rank). A taxon that isn't a number is an error."""
    keyed = rows.withColumn("__name", text.strip(quoted(name))).withColumn("__taxon", quoted(taxon).cast("double").cast("long"))
    tiers = [t.select(F.col("protein_name").alias("__name"), F.col("taxonomy_id").cast("long").alias("__taxon"), F.col("accession").alias("uniprot_id"), "rank") for t in (reviewed, complete)]
    return enrich.tiered(keyed, ["__name", "__taxon"], tiers, "uniprot_id", "rank").drop("__name", "__taxon", "tier")


# --- descriptions ----------------------------------------------------------------------------

Generator = Callable[[str], str]


@dataclass(frozen=True)
class DescriptionSettings:
    mode: str = "production"
    protocol: str = "experimental_protocol"
    assay: str = "assay_name"
    protein: str = "protein_name"
    policy: enrich.Policy = field(default=enrich.GENERATOR)
    tasks: int = 1


@dataclass(frozen=True)
class Descriptions:
    rows: DataFrame
    errors: DataFrame
    debug: DataFrame


class DescriptionError(RuntimeError):
    """Descriptions break the rules."""


def description_keys(rows: DataFrame, s: DescriptionSettings, row: str = ROW) -> DataFrame:
    """The distinct (protocol, protein) keys, whitespace ignored, with the assay name of the first row and the generator's message."""
    schema.require(rows, [s.protocol, s.assay, s.protein])
    keyed = _with_keys(rows, s).withColumn("__assay", F.coalesce(quoted(s.assay).cast("string"), F.lit("")))
    first = dedup.first_seen(keyed, ["__protocol", "__protein"], F.col(row), ["__assay"])
    return first.withColumn("message", text.prompt(F.lit(s.mode), F.col("__protocol"), F.col("__protein"), F.col("__assay")))


def _with_keys(rows: DataFrame, s: DescriptionSettings) -> DataFrame:
    def key(c: str) -> Column:
        return text.collapse(F.coalesce(quoted(c).cast("string"), F.lit("")))

    return rows.withColumn("__protocol", key(s.protocol)).withColumn("__protein", key(s.protein))


def generate(keys: DataFrame, generator: Generator, s: DescriptionSettings) -> DataFrame:
    """(message, raw, status) of each key's message, each generated once; write it before use."""

    def fetch(messages: Sequence[str]) -> dict:
        return {m: {"raw": generator(m).strip()} for m in messages}

    return enrich.fetched(keys.select("message"), "message", fetch, ["raw"], s.policy, tasks=s.tasks)


def describe(rows: DataFrame, generated: DataFrame, s: DescriptionSettings = DescriptionSettings(), *, row: str = ROW) -> Descriptions:
    """rows with assay_description (response phrase corrected) and, in validation mode, its metadata; the rules that keys break; and
    the rows with raw outputs besides.

    Write debug before finish() is called. generated: see generate(), reread from where it was written.
    """
    keys = description_keys(rows, s, row).join(dedup.sized(generated.select("message", "raw", "status")), "message", "left")
    if s.mode == "validation":
        keys = jsonmeta.metadata(keys, "raw")
        keys = keys.withColumn(jsonmeta.DESCRIPTION, text.strip(F.coalesce(jsonmeta.DESCRIPTION, F.lit(""))))
        extra = [jsonmeta.DESCRIPTION, *jsonmeta.METADATA]
    else:
        keys = keys.withColumn(jsonmeta.DESCRIPTION, F.coalesce("raw", F.lit("")))
        extra = [jsonmeta.DESCRIPTION]
    keys = keys.withColumn(jsonmeta.DESCRIPTION, rules.fix_response_phrase(F.col(jsonmeta.DESCRIPTION)))
    d = F.col(jsonmeta.DESCRIPTION)
    message = F.when(d == "", F.lit("empty description (API call failed)")).otherwise(rules.violation(d))
    errors = keys.select(F.col("__protocol").alias("protocol"), F.col("__protein").alias("protein"), "first_at", message.alias("error"))
    results = keys.select("__protocol", "__protein", *extra, F.col("raw").alias("_raw_model_output"))
    debug = dedup.map_back(_with_keys(rows, s), results, ["__protocol", "__protein"]).drop("__protocol", "__protein")
    return Descriptions(debug.drop("_raw_model_output"), errors.where("error IS NOT NULL"), debug)


def write_and_finish(rows: DataFrame, d: Descriptions, write_debug: Callable[[DataFrame], None], s: DescriptionSettings = DescriptionSettings(), *, row: str = ROW) -> DataFrame:
    """finish(), with the debug table written before any check can end the run."""
    write_debug(d.debug)
    return finish(rows, d, s, row=row)


def finish(rows: DataFrame, d: Descriptions, s: DescriptionSettings = DescriptionSettings(), *, row: str = ROW) -> DataFrame:
    """d.rows, if it passes: in production no rule may be broken; in either mode every row has its description, and rows of one
    (protocol, protein) the same one."""
    if s.mode == "production" and (some := d.errors.orderBy("first_at").limit(10).collect()):
        raise DescriptionError(f"{d.errors.count()} descriptions break rules: {[(r['protein'], r['error']) for r in some]}")
    dedup.check_annotated(rows, d.rows, row=row, filled=jsonmeta.DESCRIPTION)
    dedup.check_consistent(d.rows, [s.protocol, s.protein], jsonmeta.DESCRIPTION)
    return d.rows


# --- ASCII -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Normalised:
    rows: DataFrame
    residual: DataFrame
    counts: DataFrame


def to_ascii(rows: DataFrame, column: str = "assay_description", output: str | None = None) -> Normalised:
    """rows with the column normalised, under `output` (column + _ascii_compliant) where it stood; what is still not ASCII; and
    one row of counts (rows, changed)."""
    schema.require(rows, [column])
    output = output or f"{column}_ascii_compliant"
    # Rows, residual and counts are frames of their own: each that is used runs the normalisation.
    both = rows.withColumn("__new", asciinorm.normalise(quoted(column)))
    counts = both.agg(F.count("*").alias("rows"), asciinorm.changed(quoted(column), F.col("__new")).alias("changed"))
    out = schema.renamed_in_place(both, column, output, F.col("__new")).drop("__new")
    return Normalised(out, asciinorm.residual(out, output), counts)
