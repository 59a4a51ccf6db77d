"""The library's operators as queries over the star-schema tables, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.session import spread
from curaspark.functions import asciinorm, jsonmeta, rules, text
from curaspark.operators import cascade, dedup, enrich, medians, representative, schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _nulls_last(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


KEYS = ["l_partkey", "l_returnflag"]
#: With the keys, these tell all rows of lineitem apart.
TIES = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_discount"]
OWN = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]


# --- representative rows ---------------------------------------------------------------------

_MEDOID = f"""
WITH m AS (
  SELECT *, median(l_extendedprice) OVER w AS group_median, count(*) OVER w AS group_rows
  FROM lineitem WHERE l_extendedprice IS NOT NULL WINDOW w AS (PARTITION BY l_partkey, l_returnflag)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag
    ORDER BY abs(l_extendedprice - group_median), {", ".join(t + " NULLS LAST" for t in TIES)}) AS n FROM m)
SELECT {", ".join(OWN)}, l_returnflag, group_rows, group_median FROM r WHERE n = 1
"""


@query(_MEDOID)
def representative_row(spark, d):
    out = representative.medoids(_t(spark, d, "lineitem"), KEYS, F.col("l_extendedprice"), _nulls_last(*TIES))
    return out.select(*OWN, "l_returnflag", "group_rows", "group_median")


@query(_MEDOID)
def representative_row_by_aggregates(spark, d):
    ties = [F.col(t) for t in TIES]
    out = representative.medoids(_t(spark, d, "lineitem"), KEYS, F.col("l_extendedprice"), ties, strategy="aggregate")
    return out.select(*OWN, "l_returnflag", "group_rows", "group_median")


def _paths():
    return (
        representative.Path("price", F.col("l_linenumber") % 2 == 0, F.col("l_extendedprice")),
        representative.Path("quantity", F.col("l_linestatus") == "O", F.col("l_quantity")),
    )


def _flagged(spark, d):
    return representative.two_paths(_t(spark, d, "lineitem"), KEYS, _paths(), _nulls_last(*TIES))


_ORDER = ", ".join(t + " NULLS LAST" for t in TIES)
_FLAGGED = f"""
WITH f AS (
  SELECT *, coalesce(l_linenumber % 2 = 0 AND l_extendedprice IS NOT NULL, false) AS p1,
         coalesce(l_linestatus = 'O' AND l_quantity IS NOT NULL, false) AS p2 FROM lineitem),
m AS (
  SELECT *, median(CASE WHEN p1 THEN l_extendedprice END) OVER w AS m1, median(CASE WHEN p2 THEN l_quantity END) OVER w AS m2
  FROM f WINDOW w AS (PARTITION BY l_partkey, l_returnflag)),
k AS (
  SELECT *,
    p1 AND row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY NOT p1, CASE WHEN p1 THEN abs(l_extendedprice - m1) END, {_ORDER}) = 1 AS k1,
    p2 AND row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY NOT p2, CASE WHEN p2 THEN abs(l_quantity - m2) END, {_ORDER}) = 1 AS k2
  FROM m),
z AS (SELECT *, (NOT p1 AND NOT p2) OR k1 OR k2 AS keep FROM k)
"""


@query(_FLAGGED + f"SELECT {', '.join(OWN)} FROM z WHERE keep")
def two_path_keep(spark, d):
    return _flagged(spark, d).where("keep").select(*OWN)


@query(_FLAGGED + f"SELECT {', '.join(OWN)} FROM z WHERE keep")
def two_path_keep_by_aggregates(spark, d):
    ties = [F.col(t) for t in TIES]
    return representative.two_paths(_t(spark, d, "lineitem"), KEYS, _paths(), ties, strategy="aggregate").where("keep").select(*OWN)


@query(_FLAGGED + f"SELECT {', '.join(OWN)} FROM z WHERE NOT keep")
def two_path_removed(spark, d):
    return _flagged(spark, d).where("NOT keep").select(*OWN)


@query(
    _FLAGGED
    + """SELECT count(*) AS original_rows, count(*) FILTER (WHERE NOT keep) AS removed_rows, count(*) FILTER (WHERE keep) AS remaining_rows,
  count(*) FILTER (WHERE p1 AND NOT k1) AS price_removed, count(*) FILTER (WHERE p2 AND NOT k2) AS quantity_removed,
  count(*) FILTER (WHERE NOT p1 AND NOT p2) AS on_no_path,
  (count(*) - count(*) FILTER (WHERE p1) - count(*) FILTER (WHERE p2))::BIGINT AS on_no_path_by_sums FROM z"""
)
def two_path_summary(spark, d):
    return representative.counts(_flagged(spark, d), _paths())


@query(
    _FLAGGED
    + """, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE NOT keep) AS r FROM z)
SELECT 'Original rows' AS "Metric", n::VARCHAR AS "Value" FROM c UNION ALL
SELECT 'Rows removed by aggregation (total)', r::VARCHAR FROM c UNION ALL
SELECT 'Rows remaining', (n - r)::VARCHAR FROM c UNION ALL SELECT 'Grouping key', 'l_partkey | l_returnflag'"""
)
def metric_value_table(spark, d):
    one = representative.counts(_flagged(spark, d), _paths())
    lines = [
        ("Original rows", F.col("original_rows")),
        ("Rows removed by aggregation (total)", F.col("removed_rows")),
        ("Rows remaining", F.col("remaining_rows")),
        ("Grouping key", F.lit(" | ".join(KEYS))),
    ]
    return representative.summary(one, lines)


@query(
    """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders)
SELECT o_custkey, o_orderkey, o_totalprice FROM r WHERE n = 1
"""
)
def first_ranked_hit(spark, d):
    orders = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return representative.first_hit(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")])


# --- medians and numbers ---------------------------------------------------------------------


@query(
    """
SELECT l_partkey, count(*) AS n_source_rows, median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice,
       median(l_discount) AS l_discount, median(l_tax) AS l_tax FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey
"""
)
def group_medians(spark, d):
    return medians.group_medians(_t(spark, d, "lineitem"), "l_partkey", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query(
    r"""
WITH t AS (SELECT p_partkey, replace(p_brand, 'Brand#', '') || CASE WHEN p_size % 5 = 0 THEN 'd' WHEN p_size % 7 = 0 THEN 'e2' ELSE '' END AS raw FROM part)
SELECT p_partkey, raw,
       CASE WHEN regexp_matches(raw, '^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)\s*$') THEN try_cast(raw AS DOUBLE) END AS value FROM t
"""
)
def numeric_coercion(spark, d):
    end = F.when(F.col("p_size") % 5 == 0, F.lit("d")).when(F.col("p_size") % 7 == 0, F.lit("e2")).otherwise(F.lit(""))
    raw = F.concat(F.replace("p_brand", F.lit("Brand#"), F.lit("")), end)
    return _t(spark, d, "part").select("p_partkey", raw.alias("raw")).withColumn("value", text.number(F.col("raw")))


@query(
    """
SELECT p_partkey, CASE WHEN p_type NOT IN ('', 'NA', 'nan') AND p_size % 3 <> 0 THEN p_type END AS p_type,
       CASE WHEN p_size % 4 <> 0 THEN p_size::DOUBLE END AS p_size FROM part
"""
)
def missing_value_tokens(spark, d):
    kind = F.when(F.col("p_size") % 3 == 0, F.lit("N/A")).otherwise(F.col("p_type"))
    size = F.when(F.col("p_size") % 4 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    raw = _t(spark, d, "part").select("p_partkey", kind.alias("p_type"), size.alias("p_size"))
    return schema.typed(raw, numbers=["p_size"])


# --- cascade ---------------------------------------------------------------------------------

_REFS = """
WITH r AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '10.1/' || o_orderkey ELSE 'None' END AS doi,
         CASE WHEN o_custkey % 2 = 0 THEN ' ' || o_custkey || ' ' ELSE 'nan' END AS pubmed_id,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'US' || o_orderkey END AS patent_id FROM orders),
c AS (
  SELECT o_orderkey, CASE WHEN lower(trim(coalesce(doi, ''))) IN ('none', 'nan') THEN '' ELSE trim(coalesce(doi, '')) END AS doi,
         CASE WHEN lower(trim(coalesce(pubmed_id, ''))) IN ('none', 'nan') THEN '' ELSE trim(coalesce(pubmed_id, '')) END AS pubmed_id,
         coalesce(patent_id, '') AS patent_id FROM r),
s AS (
  SELECT *, CASE WHEN doi <> '' THEN doi WHEN pubmed_id <> '' THEN pubmed_id ELSE patent_id END AS reference_id,
         CASE WHEN doi <> '' THEN 'doi' WHEN pubmed_id <> '' THEN 'pubmed_id' WHEN patent_id <> '' THEN 'patent_id'
              ELSE 'unresolved' END AS reference_type FROM c)
"""


def _references(spark, d):
    o = _t(spark, d, "orders")
    raw = o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("10.1/"), F.col("o_orderkey"))).otherwise(F.lit("None")).alias("doi"),
        F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit(" "), F.col("o_custkey"), F.lit(" "))).otherwise(F.lit("nan")).alias("pubmed_id"),
        F.when(F.col("o_orderpriority").startswith("1"), F.concat(F.lit("US"), F.col("o_orderkey"))).alias("patent_id"),
    )
    cleaned = raw.select("o_orderkey", *[text.clean(F.col(c)).alias(c) for c in cascade.ORDER])
    return cascade.select_reference(cleaned)


@query(_REFS + "SELECT * FROM s")
def reference_cascade(spark, d):
    return _references(spark, d)


@query(
    _REFS
    + """, l AS (SELECT * FROM (VALUES ('doi'), ('pubmed_id'), ('patent_id'), ('unresolved'), ('isbn')) v(category)),
n AS (SELECT reference_type, count(*) AS n FROM s GROUP BY reference_type)
SELECT l.category, coalesce(n.n, 0) AS n, round(100 * coalesce(n.n, 0) / (SELECT count(*) FROM s), 1) AS percent
FROM l LEFT JOIN n ON l.category = n.reference_type"""
)
def cascade_breakdown(spark, d):
    return cascade.breakdown(_references(spark, d), "reference_type", [*cascade.ORDER, "unresolved", "isbn"])


@query(
    """
WITH t AS (SELECT o_orderkey, [o_custkey % 40, o_orderkey % 40, o_custkey % 40, 41] AS ids FROM orders),
e AS (SELECT o_orderkey, unnest(ids) AS id, unnest(range(4)) AS pos FROM t),
v AS (SELECT e.o_orderkey, n.n_name AS v, min(e.pos) AS pos FROM e JOIN nation n ON e.id = n.n_nationkey GROUP BY 1, 2),
j AS (SELECT o_orderkey, string_agg(v, '|' ORDER BY pos) AS names FROM v GROUP BY 1)
SELECT t.o_orderkey, coalesce(j.names, '') AS n_name FROM t LEFT JOIN j ON t.o_orderkey = j.o_orderkey
"""
)
def id_list_lookup(spark, d):
    a, b = F.col("o_custkey") % 40, F.col("o_orderkey") % 40
    rows = _t(spark, d, "orders").select("o_orderkey", F.concat_ws(" , ", a.cast("string"), b.cast("string"), a.cast("string"), F.lit("41"), F.lit("")).alias("ids"))
    out = cascade.lookup_lists(rows, "ids", _t(spark, d, "nation"), "n_nationkey", ["n_name"], "o_orderkey")
    return out.select("o_orderkey", "n_name")


@query(
    """
WITH t AS (SELECT DISTINCT unnest([o_custkey % 40, o_orderkey % 40]) AS id FROM orders)
SELECT id::VARCHAR AS id FROM t WHERE id NOT IN (SELECT n_nationkey FROM nation)
"""
)
def ids_without_record(spark, d):
    ids = F.concat_ws(",", (F.col("o_custkey") % 40).cast("string"), (F.col("o_orderkey") % 40).cast("string"))
    asked = cascade.requested_ids(_t(spark, d, "orders").select(ids.alias("ids")), "ids")
    return dedup.unmatched(asked, _t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id")), "id")


# --- distinct keys and map-back --------------------------------------------------------------

_PLACE = "(l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_tax, l_discount)"


@query(
    f"SELECT l_partkey, arg_min(l_returnflag || l_linestatus, {_PLACE}) AS label, min(l_orderkey) AS first_at FROM lineitem GROUP BY l_partkey"
)
def first_seen_label(spark, d):
    rows = _t(spark, d, "lineitem").withColumn("label", F.concat("l_returnflag", "l_linestatus"))
    labels = dedup.first_seen(rows, ["l_partkey"], F.struct(*TIES), ["label"]).select("l_partkey", "label")
    firsts = dedup.first_seen(rows, ["l_partkey"], F.col("l_orderkey"))
    return labels.join(firsts, "l_partkey")


@query(
    r"""
SELECT trim(regexp_replace(text, '\s+', ' ', 'g')) AS key, count(*) AS n, min(doc_id) AS first_at FROM documents
WHERE text IS NOT NULL GROUP BY 1
"""
)
def whitespace_key_dedup(spark, d):
    keyed = _t(spark, d, "documents").where("text IS NOT NULL").select(text.collapse(F.col("text")).alias("key"), "doc_id")
    return keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_at"))


@query(
    """
SELECT l_orderkey, l_linenumber, count(DISTINCT l_partkey) AS n_values FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT l_partkey) > 1
"""
)
def duplicate_consistency(spark, d):
    return dedup.inconsistent(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_partkey")


@query(
    """
WITH k AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, round(sum(n) / greatest(count(*), 1), 3) AS rows_per_key FROM k
"""
)
def duplication_factor(spark, d):
    return dedup.duplication(_t(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query(
    """
SELECT c.c_custkey, c.c_nationkey, n.n_name, coalesce(r.r_name, 'none') AS r_name FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey AND n.n_nationkey % 5 <> 0 LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""
)
def map_back_chained(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, d, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = _t(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    out = dedup.map_back(dedup.map_back(c, n, ["c_nationkey"]), r, ["n_regionkey"], defaults={"r_name": "none"})
    return out.drop("n_regionkey")


# --- text ------------------------------------------------------------------------------------

_SYNTHETIC = """
SELECT p_partkey, '10 ' || chr(956) || CASE p_size % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'mol' WHEN 2 THEN '-opioid' ELSE 'mx' END
  || ' at ' || p_size || CASE p_size % 3 WHEN 0 THEN chr(176) || 'C' WHEN 1 THEN ' ' || chr(176) || 'F x' ELSE chr(176) || 'Celsius' END
  || ' ' || chr(177) || ' 0.1' || chr(8211) || p_brand || chr(8230) AS t FROM part
"""


def _synthetic(spark, d):
    s = F.col("p_size")
    unit = F.when(s % 4 == 0, F.lit("M")).when(s % 4 == 1, F.lit("mol")).when(s % 4 == 2, F.lit("-opioid")).otherwise(F.lit("mx"))
    degree = F.when(s % 3 == 0, F.lit("°C")).when(s % 3 == 1, F.lit(" °F x")).otherwise(F.lit("°Celsius"))
    t = F.concat(F.lit("10 μ"), unit, F.lit(" at "), s, degree, F.lit(" ± 0.1–"), F.col("p_brand"), F.lit("…"))
    return _t(spark, d, "part").select("p_partkey", t.alias("t"))


@query(
    rf"""
WITH s AS ({_SYNTHETIC}),
g AS (SELECT p_partkey, replace(regexp_replace(regexp_replace(t, chr(956) || 'mol\b', 'umol', 'g'), chr(956) || 'M\b', 'uM', 'g'), chr(956), 'mu') AS t FROM s),
h AS (SELECT p_partkey, regexp_replace(replace(regexp_replace(t, '\s*' || chr(176) || '\s*([CFK])\b', ' deg \1', 'g'), chr(176), ' deg'), '  +', ' ', 'g') AS t FROM g)
SELECT p_partkey, replace(replace(replace(t, chr(177), '+/-'), chr(8211), '-'), chr(8230), '...') AS ascii FROM h
"""
)
def unit_and_degree_normalise(spark, d):
    return _synthetic(spark, d).select("p_partkey", asciinorm.rules(F.col("t")).alias("ascii"))


@query(
    r"""
SELECT doc_id, replace(replace(replace(replace(regexp_replace(regexp_replace(nfc_normalize(text), '\s*' || chr(176) || '\s*([CFK])\b', ' deg \1', 'g'),
  '  +', ' ', 'g'), chr(8211), '-'), chr(8212), '-'), chr(8217), chr(39)), chr(8230), '...') AS text FROM documents
"""
)
def ascii_normalise(spark, d):
    """The SQL has no NFKC: it holds for texts without compatibility characters, as these are (the tests hold the rest)."""
    return spread(_t(spark, d, "documents").select("doc_id", "text")).select("doc_id", asciinorm.normalise(F.col("text")).alias("text"))


@query(
    r"""
SELECT doc_id, i - 1 AS position, substr(text, i, 1) AS character
FROM (SELECT doc_id, text, unnest(range(1, length(text) + 1)) AS i FROM documents) WHERE unicode(substr(text, i, 1)) > 127
"""
)
def residual_non_ascii(spark, d):
    return asciinorm.residual(spread(_t(spark, d, "documents").select("doc_id", "text")), "text").drop("text")


@query("SELECT count(*) FILTER (WHERE text <> upper(text)) AS changed FROM documents")
def changed_texts(spark, d):
    return _t(spark, d, "documents").agg(asciinorm.changed(F.col("text"), F.upper("text")).alias("changed"))


_DESCRIBED = """
SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'Dose-response in rat brain of ' WHEN 1 THEN 'Concentration-response in mice of '
  WHEN 2 THEN 'pKi by dose' || chr(8211) || 'response of ' WHEN 3 THEN '' WHEN 4 THEN '{ "a": 1 } ' ELSE 'A concentration-response assay in C57BL/6 of ' END
  || CASE WHEN p_size % 6 = 3 THEN '' ELSE p_type END AS t FROM part
"""


def _described(spark, d):
    s = F.col("p_size") % 6
    begin = (
        F.when(s == 0, F.lit("Dose-response in rat brain of "))
        .when(s == 1, F.lit("Concentration-response in mice of "))
        .when(s == 2, F.lit("pKi by dose–response of "))
        .when(s == 3, F.lit(""))
        .when(s == 4, F.lit('{ "a": 1 } '))
        .otherwise(F.lit("A concentration-response assay in C57BL/6 of "))
    )
    return _t(spark, d, "part").select("p_partkey", F.concat(begin, F.when(s == 3, F.lit("")).otherwise(F.col("p_type"))).alias("t"))


_VIVO = r"regexp_matches(t, '(?i)\b(mice|mouse|rat|rats|c57|oral(ly)?|wistar)\b')"


@query(
    rf"""
WITH d AS ({_DESCRIBED})
SELECT p_partkey, CASE WHEN t = '' THEN 'empty description'
  WHEN regexp_matches(t, '(?i)\bpKi\b') THEN 'banned token present: ''' || regexp_extract(t, '(?i)\bpKi\b') || ''''
  WHEN starts_with(t, '{{') THEN 'looks like JSON or Markdown fence in production output'
  WHEN {_VIVO} AND lower(t) LIKE '%concentration-response%' THEN 'in vivo description uses ''concentration-response'' instead of ''dose-response'''
  WHEN NOT {_VIVO} AND lower(t) LIKE '%dose-response%' THEN 'in vitro description uses ''dose-response'' instead of ''concentration-response''' END AS violation
FROM d
"""
)
def rule_violations(spark, d):
    return _described(spark, d).select("p_partkey", rules.violation(F.col("t")).alias("violation"))


@query(
    rf"""
WITH d AS ({_DESCRIBED})
SELECT p_partkey, CASE WHEN {_VIVO} THEN regexp_replace(t, 'concentration([-–])response', 'dose\1response', 'gi')
  ELSE regexp_replace(t, 'dose([-–])response', 'concentration\1response', 'gi') END AS fixed FROM d
"""
)
def response_phrase_autofix(spark, d):
    return _described(spark, d).select("p_partkey", rules.fix_response_phrase(F.col("t")).alias("fixed"))


@query(
    r"""
SELECT * FROM (SELECT doc_id, nullif(regexp_extract(text, '(?i)\bIC50\b|\bEC50\b|\bKi\b|\bKd\b|\bEmax\b|\bpIC50\b|\bpEC50\b|\bpKi\b|\bMPE\b|\bAD50\b|\bED50\b|according to|published procedure'), '') AS token
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' EC50 ' ELSE text END AS text FROM documents)) WHERE token IS NOT NULL
"""
)
def banned_token_scan(spark, d):
    docs = spread(_t(spark, d, "documents").select("doc_id", "text"))
    t = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" EC50 "))).otherwise(F.col("text"))
    return docs.select("doc_id", rules.banned_token(t).alias("token")).where("token IS NOT NULL")


@query(
    """
SELECT p_partkey, array_to_string(list_distinct(list_filter(list_transform(string_split(p_type, ' '), lambda x: trim(x)), lambda x: x <> '')), '|') AS joined
FROM part WHERE len(list_distinct(string_split(p_type, ' '))) = 1 UNION ALL
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_type, ' '), lambda x: trim(x)), lambda x: x <> ''), '|') FROM part
WHERE len(list_distinct(string_split(p_type, ' '))) > 1
"""
)
def token_distinct_join(spark, d):
    cell = F.concat(F.replace("p_type", F.lit(" "), F.lit(" , ")), F.lit(",, "), F.replace("p_type", F.lit(" "), F.lit(",")))
    return _t(spark, d, "part").select("p_partkey", text.distinct_join(text.tokens(cell)).alias("joined"))


@query(
    """
SELECT c_custkey, concat_ws(';', CASE WHEN c_acctbal > 0 THEN 'ok' END, nullif(c_mktsegment, ''), CASE WHEN c_nationkey % 3 = 0 THEN 'third' END) AS status FROM customer
"""
)
def status_concat(spark, d):
    c = _t(spark, d, "customer")
    parts = [F.when(F.col("c_acctbal") > 0, F.lit("ok")).otherwise(F.lit("nan")), F.col("c_mktsegment"), F.when(F.col("c_nationkey") % 3 == 0, F.lit("third")).otherwise(F.lit(""))]
    return c.select("c_custkey", text.status_join(parts).alias("status"))


@query(
    """
SELECT o_orderkey, 'Output mode: ' || CASE WHEN o_orderstatus = 'F' THEN 'JSON' ELSE 'TEXT' END || chr(10) || chr(10) || 'experimental_protocol:' || chr(10)
  || o_orderpriority || chr(10) || chr(10) || 'protein_name: ' || o_custkey || chr(10) || 'assay_name: ' || o_orderstatus AS message FROM orders
"""
)
def prompt_assembly(spark, d):
    mode = F.when(F.col("o_orderstatus") == "F", F.lit("validation")).otherwise(F.lit("production"))
    m = text.prompt(mode, F.col("o_orderpriority"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"))
    return _t(spark, d, "orders").select("o_orderkey", m.alias("message"))


@query("SELECT doc_id, substr(text, 1, 150) AS preview FROM documents ORDER BY doc_id LIMIT 20")
def head_previews(spark, d):
    return _t(spark, d, "documents").orderBy("doc_id").limit(20).select("doc_id", text.preview(F.col("text"), 150).alias("preview"))


# --- JSON, lookups, schemas ------------------------------------------------------------------


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent') AS absent FROM events")
def json_metadata(spark, d):
    return jsonmeta.fields(_t(spark, d, "events").select("event_id", "props"), "props", ["k", "absent"]).drop("props")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_recovery(spark, d):
    e = _t(spark, d, "events").select("event_id", F.concat(F.lit("```json\nHere it is: "), F.col("props"), F.lit(" as asked\n```")).alias("raw"))
    out = e.withColumn("clean", jsonmeta.recovered(jsonmeta.unfenced(F.col("raw"))))
    return jsonmeta.fields(out, "clean", ["k"]).drop("raw", "clean")


@query(
    """
WITH a AS (SELECT s_nationkey AS k, arg_min(s_name, s_suppkey) AS v FROM supplier WHERE s_acctbal > 5000 GROUP BY 1),
b AS (SELECT s_nationkey AS k, arg_min(s_name, s_suppkey) AS v FROM supplier GROUP BY 1)
SELECT c_custkey, c_nationkey AS k, coalesce(a.v, b.v) AS supplier, CASE WHEN a.v IS NOT NULL THEN 1 WHEN b.v IS NOT NULL THEN 2 END AS tier
FROM customer c LEFT JOIN a ON c.c_nationkey = a.k LEFT JOIN b ON c.c_nationkey = b.k
"""
)
def tiered_lookup(spark, d):
    s = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_name").alias("supplier"), F.col("s_suppkey").alias("rank"), "s_acctbal")
    rows = _t(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    return enrich.tiered(rows, ["k"], [s.where("s_acctbal > 5000"), s], "supplier", "rank")


@query(
    """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS k, n.n_name,
  CASE WHEN c_custkey % 7 = 0 THEN 'missing_key' WHEN n.n_name IS NULL THEN 'no_match' ELSE 'found' END AS name_status
FROM customer LEFT JOIN nation n ON c_custkey % 7 <> 0 AND c_nationkey = n.n_nationkey AND n_regionkey <> 1
"""
)
def snapshot_lookup(spark, d):
    rows = _t(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).alias("k"))
    dim = _t(spark, d, "nation").where("n_regionkey <> 1").select(F.col("n_nationkey").alias("k"), "n_name")
    return enrich.lookup(rows, "k", dim, ["n_name"], status="name_status", found="found", missing="no_match", no_key="missing_key")


@query("SELECT DISTINCT l_suppkey::VARCHAR AS k, 'S' || l_suppkey AS name, CASE WHEN l_suppkey % 4 = 0 THEN 'missing' ELSE 'found' END AS status FROM lineitem WHERE l_suppkey % 4 <> 0 UNION ALL SELECT DISTINCT l_suppkey::VARCHAR, NULL, 'missing' FROM lineitem WHERE l_suppkey % 4 = 0")
def fetched_distinct_keys(spark, d):
    def fetch(keys):
        return {k: {"name": f"S{k}"} for k in keys if int(k) % 4}

    keys = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"))
    return enrich.fetched(keys, "k", fetch, ["name"], enrich.DOCUMENTS, tasks=2)


@query("SELECT p_partkey, NULL::VARCHAR AS note, p_name AS name FROM part")
def fixed_schema(spark, d):
    renamed = schema.renamed_in_place(_t(spark, d, "part"), "p_name", "name")
    return schema.fixed(renamed, (("p_partkey", "long"), ("note", "string"), ("name", "string")))


@query(
    """
SELECT count(*) AS rows, count(DISTINCT l_suppkey) AS suppliers, count(l_shipdate) AS shipped, count(*) FILTER (WHERE l_returnflag = 'R') AS returned
FROM lineitem
"""
)
def global_counts(spark, d):
    returned = F.count_if(F.col("l_returnflag") == "R")
    return _t(spark, d, "lineitem").agg(
        F.count("*").alias("rows"), F.count_distinct("l_suppkey").alias("suppliers"), F.count("l_shipdate").alias("shipped"), returned.alias("returned")
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_linestatus IN ('O', 'X') AND l_extendedprice IS NOT NULL
  AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
"""
)
def literal_and_key_filters(spark, d):
    rows = _t(spark, d, "lineitem").where(F.col("l_linestatus").isin("O", "X") & F.col("l_extendedprice").isNotNull())
    big = _t(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    return rows.join(big, "l_partkey", "left_anti").select("l_orderkey", "l_linenumber", "l_extendedprice")
