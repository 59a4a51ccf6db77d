"""The workflows as commands: python -m curaspark.cli NAME --help. Small tables in and out, for people; at scale, call plans.workflows."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.operators import cascade, enrich, rowid
from curaspark.plans import workflows
from curaspark.session import session
from curaspark.sources import files, services, xlsx


def _read(spark: SparkSession, path: Path) -> DataFrame:
    return rowid.scanned(files.read_table(spark, str(path)))


def _write(path: Path, df: DataFrame, *more: tuple[str, DataFrame]) -> None:
    """A workbook of the rows and more sheets, or CSV files of either, by the extension of path."""
    if path.suffix.lower() in (".xlsx", ".xls"):
        xlsx.write(str(path.with_suffix(".xlsx")), [("Rows", df), *more])
        return
    for name, part in (("", df), *more):
        files.write_csv(part, str(path.with_name(f"{path.stem}{'_' + name if name else ''}{path.suffix or '.csv'}")))


def _tell(rows: DataFrame) -> None:
    """A small table of metrics on the console."""
    for r in rows.collect():
        print("  ".join(str(v) for v in r))


def references(spark: SparkSession, a: argparse.Namespace) -> None:
    path = files.find_input(a.folder, a.input, "chembl_doc_id_input")
    rows = _read(spark, path)
    fields = [*a.order, *([] if a.no_context else cascade.CONTEXT)]
    if a.records:
        records, status = files.read_table(spark, a.records), {"error": enrich.NO_RELEASE.format("a snapshot was used")}
    else:
        column = workflows.schema.resolve_loosely(rows, workflows.DOCUMENT_IDS, a.id_col)
        policy = enrich.Policy("raise", attempts=a.retries, wait=a.retry_wait, growth="double", batch=a.batch_size)
        store = f"{a.out}.records"
        records = enrich.stored(cascade.requested_ids(rows, column), "id", store, services.documents(), fields, policy, every=a.batch_size)
        records = records.where(F.col("status") == policy.found).withColumnRenamed("id", "document_chembl_id")
        status = enrich.service_status(services.release())
    found = workflows.resolve_references(rows, records, id_column=a.id_col, order=a.order, context=[] if a.no_context else cascade.CONTEXT)
    out = Path(a.folder) / Path(a.out).name
    _write(out, found.rows.orderBy(rowid.ROW).drop(rowid.ROW))
    files.write_provenance(out, found.provenance(input_file=path.name, output_file=out.name, status=status))
    _tell(found.breakdown)
    if not a.records:
        enrich.discard_store(rows, store)


def activities(spark: SparkSession, a: argparse.Namespace) -> None:
    done = workflows.aggregate_activities(_read(spark, files.only_csv(a.folder, a.input)))
    _write(Path(a.out), done.aggregated.drop(rowid.ROW), ("Removed rows", done.removed.drop(rowid.ROW)), ("Aggregation summary", done.summary))
    _tell(done.summary)


def medians(spark: SparkSession, a: argparse.Namespace) -> None:
    _write(Path(a.out), workflows.descriptor_medians(_read(spark, files.require_file(Path(a.folder) / a.input)), a.key))


def ascii_text(spark: SparkSession, a: argparse.Namespace) -> None:
    done = workflows.to_ascii(_read(spark, files.require_file(Path(a.folder) / a.input)), a.column)
    _write(Path(a.out), done.rows.drop(rowid.ROW), ("Residual", done.residual.drop(rowid.ROW)))
    _tell(done.counts)


def structures(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = _read(spark, files.require_file(Path(a.folder) / a.input, [".csv"]))
    _write(Path(a.out), workflows.standardise_structures(rows, smiles=a.smiles, key=a.key, errors_only=a.errors_only))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="curaspark", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(run, text: str, out: str) -> argparse.ArgumentParser:
        p = commands.add_parser(run.__name__, help=text)
        p.set_defaults(run=run)
        p.add_argument("--folder", default=".", help="where the input is")
        p.add_argument("--in", dest="input", help="the input's name there")
        p.add_argument("--out", default=out, help=f"the output; a workbook if it ends in .xlsx (default {out})")
        return p

    p = command(references, "primary references of documents", "references.xlsx")
    p.add_argument("--id-col", help="the column of document ids")
    p.add_argument("--order", nargs="+", default=list(cascade.ORDER), choices=cascade.ORDER, help="precedence, highest first")
    p.add_argument("--no-context", action="store_true", help="only the identifiers")
    p.add_argument("--records", help="a snapshot of documents instead of the service")
    p.add_argument("--batch-size", type=int, default=50)
    p.add_argument("--retries", type=int, default=3)
    p.add_argument("--retry-wait", type=float, default=5.0, help="seconds, doubled after each attempt")
    command(activities, "one representative row for each group of activities", "activities.xlsx")
    p = command(medians, "medians of descriptors for each structure", "medians.csv")
    p.add_argument("--key", default="canonical_smiles")
    p = command(ascii_text, "a text column in ASCII", "ascii.csv")
    p.add_argument("--column", default="assay_description")
    p = command(structures, "standardised structures", "structures.csv")
    p.add_argument("--smiles", default="smiles")
    p.add_argument("--key", default="odo_id")
    p.add_argument("--errors-only", action="store_true")
    return top


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """The exit code: 0, or 1 with a message where an input is missing or doesn't fit."""
    a = parser().parse_args(args)
    try:
        a.run(spark or session(), a)
    except (OSError, ValueError, RuntimeError, AssertionError) as e:
        print(f"{a.command}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
