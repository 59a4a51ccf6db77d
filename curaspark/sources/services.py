"""Clients of public web services, as fetchers for operators.enrich; not verified against the services here, for lack of a network.

Each takes `get`, which fetches a URL's bytes: urllib's by default, or whatever a caller has for proxies, keys, or tests.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Sequence

Get = Callable[[str], bytes]

# Where the services are.
DOCUMENTS = "https://www.ebi.ac.uk/chembl/api/data"
COMPOUNDS = "https://pubchem.ncbi.nlm.nih.gov/rest/pug/compound"
PROTEINS = "https://rest.uniprot.org/uniprotkb"


def fetch_url(url: str, timeout: float = 60.0) -> bytes:
    """The bytes of a URL; errors are OSErrors, after which a policy may try again."""
    with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=timeout) as r:
        return r.read()


def _asked(get: Get, url: str, **query: str) -> dict:
    return json.loads(get(f"{url}?{urllib.parse.urlencode(query)}" if query else url))


def _known(get: Get, url: str, **query: str) -> dict | None:
    """The answer, or None if the service says that there is no such record."""
    try:
        return _asked(get, url, **query)
    except urllib.error.HTTPError as e:
        if e.code == 404:
            return None
        raise


def documents(get: Get = fetch_url, base: str = DOCUMENTS) -> Callable[[Sequence[str]], dict[str, dict]]:
    """Batches of document ids: id -> record."""

    def fetch(ids: Sequence[str]) -> dict[str, dict]:
        found = _asked(get, f"{base}/document.json", document_chembl_id__in=",".join(ids), limit="1000")
        return {d["document_chembl_id"]: d for d in found.get("documents", [])}

    return fetch


def release(get: Get = fetch_url, base: str = DOCUMENTS) -> Callable[[], object]:
    """What enrich.service_status() asks."""
    return lambda: _asked(get, f"{base}/status.json")


def compound_ids(get: Get = fetch_url, base: str = COMPOUNDS) -> Callable[[Sequence[str]], dict[str, dict]]:
    """Structures, one by one: SMILES -> cid. The service gives 0 for a structure that it reads but doesn't have."""

    def fetch(structures: Sequence[str]) -> dict[str, dict]:
        out = {}
        for s in structures:
            answer = _known(get, f"{base}/smiles/cids/JSON", smiles=s)
            cids = (answer or {}).get("IdentifierList", {}).get("CID", [])
            if cids and cids[0]:
                out[s] = {"cid": cids[0]}
        return out

    return fetch


def compound_names(get: Get = fetch_url, base: str = COMPOUNDS) -> Callable[[Sequence[str]], dict[str, dict]]:
    """Compound ids, one by one: cid -> iupac_name."""

    def fetch(cids: Sequence[str]) -> dict[str, dict]:
        out = {}
        for cid in cids:
            answer = _known(get, f"{base}/cid/{urllib.parse.quote(str(cid))}/property/IUPACName/JSON")
            rows = (answer or {}).get("PropertyTable", {}).get("Properties", [])
            if rows and rows[0].get("IUPACName"):
                out[cid] = {"iupac_name": rows[0]["IUPACName"]}
        return out

    return fetch


def protein_accessions(reviewed: bool, get: Get = fetch_url, base: str = PROTEINS) -> Callable[[Sequence[str]], dict[str, dict]]:
    """Keys `name<TAB>taxon`, one by one: key -> accession, the service's first hit (among reviewed entries only, if so)."""

    def fetch(keys: Sequence[str]) -> dict[str, dict]:
        out = {}
        for key in keys:
            name, _, taxon = key.partition("\t")
            query = f'(protein_name:"{name}") AND (organism_id:{taxon})' + (" AND (reviewed:true)" if reviewed else "")
            hits = _asked(get, f"{base}/search", query=query, fields="accession", format="json", size="1").get("results", [])
            if hits:
                out[key] = {"accession": hits[0]["primaryAccession"]}
        return out

    return fetch
