"""Every operator as a query over the standard tables, with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar, text
from ..functions.vocabulary import CONCEPTS
from ..operators import audit, expectations, lineage, rights, segmentation, setops, translation
from ..operators.passages import passages
from ..session import kept, shared_dir
from ..sources import ordered, volumes
from ..streaming import collection, ingest
from ..streaming.ingest import ingest_files
from . import catalogue, closure, rebuild, release, snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WS = text.WS
_LIST = lambda c: F.concat_ws("|", c)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _norm_sql(x: str) -> str:
    x = f"replace({x}, chr(13), '')"
    x = f"regexp_replace({x}, '[’‘]', '''', 'g')"
    x = f"""regexp_replace({x}, '[_*\\[\\].,;:!?"]', ' ', 'g')"""
    x = f"regexp_replace(replace({x}, '-', ' '), '{WS}+', ' ', 'g')"
    return f"lower(trim({x}))"


def _document_id(c: Column) -> Column:
    return F.concat(F.lit("fa:document:driver:toc-"), text.pad(c, 6))


_DOC_ID_SQL = "'fa:document:driver:toc-' || lpad(CAST(doc_id AS VARCHAR), CAST(greatest(6, length(CAST(doc_id AS VARCHAR))) AS INT), '0')"
_SPLIT_SQL = "CASE CAST('0x' || substr(sha256(id), 1, 8) AS BIGINT) % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' ELSE 'train' END"

_SENTENCE_SQL = rf"""[^.!?]+(?:[.!?]+["'']?|$){WS}*|[.!?]"""
_PASSAGES_CTE = rf"""
WITH RECURSIVE p AS (
  SELECT doc_id, text, length(text) - length(regexp_replace(text, '^{WS}+', '')) AS s0, regexp_replace(regexp_replace(text, '^{WS}+', ''), '{WS}+$', '') AS body
  FROM documents WHERE text IS NOT NULL),
q AS (SELECT *, len(regexp_extract_all(body, '{WS}+')) + 1 AS words FROM p WHERE body <> ''),
tiles AS (SELECT doc_id, s0, unnest(ts) AS tile, unnest(range(len(ts))) AS k FROM (SELECT doc_id, s0, regexp_extract_all(body, '{_SENTENCE_SQL}') AS ts FROM q WHERE words > 220)),
placed AS (SELECT doc_id, k, tile, s0 + sum(length(tile)) OVER (PARTITION BY doc_id ORDER BY k) - length(tile) AS pos, regexp_replace(tile, '^{WS}+', '') AS rest FROM tiles),
sent AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS n, CAST(pos + length(tile) - length(rest) AS BIGINT) AS s,
    CAST(pos + length(tile) - length(rest) + length(regexp_replace(rest, '{WS}+$', '')) AS BIGINT) AS e,
    len(regexp_extract_all(regexp_replace(rest, '{WS}+$', ''), '{WS}+')) + 1 AS words
  FROM placed WHERE rest <> '' AND NOT regexp_matches(tile, '^[.!?]')),
pack AS (
  SELECT doc_id, n, s AS b, e, words AS w, CAST(NULL AS BIGINT) AS fb, CAST(NULL AS BIGINT) AS fe FROM sent WHERE n = 1
  UNION ALL
  SELECT t.doc_id, t.n, CASE WHEN k.w + t.words > 220 THEN t.s ELSE k.b END, t.e, CASE WHEN k.w + t.words > 220 THEN t.words ELSE k.w + t.words END,
    CASE WHEN k.w + t.words > 220 THEN k.b END, CASE WHEN k.w + t.words > 220 THEN k.e END
  FROM pack k JOIN sent t ON t.doc_id = k.doc_id AND t.n = k.n + 1),
slices AS (
  SELECT doc_id, fb AS s, fe AS e FROM pack WHERE fb IS NOT NULL
  UNION ALL SELECT doc_id, b, e FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC) AS r FROM pack) WHERE r = 1
  UNION ALL SELECT doc_id, s0, s0 + length(body) FROM q WHERE words <= 220),
numbered AS (
  SELECT l.doc_id, row_number() OVER (PARTITION BY l.doc_id ORDER BY s) AS n, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e,
    len(regexp_extract_all(substr(text, CAST(s AS BIGINT) + 1, CAST(e - s AS BIGINT)), '{WS}+')) + 1 AS words
  FROM slices l JOIN p ON l.doc_id = p.doc_id),
merge AS (
  SELECT doc_id, n, s AS b, e, words AS w, CAST(NULL AS BIGINT) AS fb, CAST(NULL AS BIGINT) AS fe FROM numbered WHERE n = 1
  UNION ALL
  SELECT t.doc_id, t.n, CASE WHEN m.w < 55 AND m.w + t.words <= 220 THEN m.b ELSE t.s END, t.e,
    CASE WHEN m.w < 55 AND m.w + t.words <= 220 THEN len(regexp_extract_all(substr(p.text, m.b + 1, t.e - m.b), '{WS}+')) + 1 ELSE t.words END,
    CASE WHEN m.w < 55 AND m.w + t.words <= 220 THEN NULL ELSE m.b END, CASE WHEN m.w < 55 AND m.w + t.words <= 220 THEN NULL ELSE m.e END
  FROM merge m JOIN numbered t ON t.doc_id = m.doc_id AND t.n = m.n + 1 JOIN p ON p.doc_id = t.doc_id),
done AS (
  SELECT doc_id, fb AS s, fe AS e FROM merge WHERE fb IS NOT NULL
  UNION ALL SELECT doc_id, b, e FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC) AS r FROM merge) WHERE r = 1),
passage AS (SELECT d.doc_id, row_number() OVER (PARTITION BY d.doc_id ORDER BY s) AS ordinal, s, e, substr(p.text, s + 1, e - s) AS text FROM done d JOIN p ON p.doc_id = d.doc_id)
"""


@query(_PASSAGES_CTE + "SELECT doc_id, CAST(ordinal AS INT) AS ordinal, CAST(s AS INT) AS start_at, CAST(e AS INT) AS end_at, sha256(text) AS text_sha256 FROM passage")
def passage_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STF-12, WIN-08, WIN-09, SCF-08."""
    return passages(_t(spark, sf_dir, "documents")).select("doc_id", "ordinal", F.col("start").alias("start_at"), F.col("end").alias("end_at"), F.sha2("text", 256).alias("text_sha256"))


@query(_PASSAGES_CTE + rf", ids AS (SELECT doc_id, {_DOC_ID_SQL} AS id FROM documents), s AS (SELECT doc_id, {_SPLIT_SQL} AS split FROM ids)"
       rf" SELECT split, CAST(count(*) AS BIGINT) AS passages, CAST(sum(len(regexp_extract_all(text, '[^{text.WS_CHARS}]+'))) AS BIGINT) AS words FROM passage JOIN s USING (doc_id) GROUP BY split")
def passage_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: documents to passages to splits to counts."""
    cut = passages(_t(spark, sf_dir, "documents")).withColumn("split", scalar.stable_split(_document_id(F.col("doc_id"))))
    return cut.groupBy("split").agg(F.count("*").alias("passages"), F.sum("words").alias("words"))


@query(f"SELECT doc_id, id AS document_id, {_SPLIT_SQL} AS split FROM (SELECT doc_id, {_DOC_ID_SQL} AS id FROM documents)")
def split_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCF-04, STF-05."""
    ids = _t(spark, sf_dir, "documents").select("doc_id", _document_id(F.col("doc_id")).alias("document_id"))
    return ids.withColumn("split", scalar.stable_split(F.col("document_id")))


@query(f"""SELECT count(*) FILTER (s = 'train') AS train, count(*) FILTER (s = 'validation') AS validation, count(*) FILTER (s = 'test') AS test
FROM (SELECT {_SPLIT_SQL} AS s FROM (SELECT {_DOC_ID_SQL} AS id FROM documents))""")
def split_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13."""
    return audit.split_histogram(split_assignment(spark, sf_dir))


@query(f"""SELECT key, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), '|' ORDER BY doc_id) AS members
FROM (SELECT doc_id, sha256(lower(regexp_replace(regexp_replace(regexp_replace(text, '{WS}+', ' ', 'g'), '^ ', ''), ' $', ''))) AS key FROM documents)
GROUP BY key HAVING count(*) > 1""")
def exact_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-08, AGG-09."""
    found = audit.duplicate_groups(_t(spark, sf_dir, "documents"), audit.text_key(F.col("text")), "doc_id")
    return found.select("key", "n", _LIST(F.col("members").cast("array<string>")).alias("members"))


def _concept_sql(kind: str) -> str:
    cases = ", ".join("CASE WHEN regexp_matches(text, '{}', 'i') THEN '{}' END".format(p.replace("'", "''"), label) for label, p in CONCEPTS[kind])
    return f"array_to_string(list_slice(list_filter([{cases}], lambda x: x IS NOT NULL), 1, 6), '|') AS {kind}"


@query(f"SELECT doc_id, {', '.join(_concept_sql(k) for k in CONCEPTS)} FROM documents")
def concept_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STF-13, SRT-05."""
    return _t(spark, sf_dir, "documents").select("doc_id", *[_LIST(text.detect(F.col("text"), v)).alias(k) for k, v in CONCEPTS.items()])


_COMMON = [("the", r"\bthe\b"), ("on", r"\bon\b"), ("and pair", r"\band .{0,20}\bthe\b"), ("in", r"\bin\b")]


@query("SELECT label, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{label}' AS label FROM documents WHERE regexp_matches(text, '{p}', 'i')" for label, p in _COMMON) + ") GROUP BY label")
def concept_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STF-13, AGG-01: the same patterns as rows, with ASCII word boundaries."""
    tags = _t(spark, sf_dir, "documents").select(F.explode(text.detect(F.col("text"), _COMMON)).alias("label"))
    return tags.groupBy("label").agg(F.count("*").alias("n"))


@query(f"""SELECT p_partkey, {_norm_sql('x')} AS normalized,
substr(regexp_replace(regexp_replace({_norm_sql('x')}, '[^a-z0-9 ]', '', 'g'), '{WS}+', '-', 'g'), 1, 70) AS slug
FROM (SELECT p_partkey, p_name || ' — ' || p_type || ' [' || p_brand || '], "New-Found"!' AS x FROM part)""")
def normalized_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STF-01, STF-02."""
    x = F.concat("p_name", F.lit(" — "), "p_type", F.lit(" ["), "p_brand", F.lit('], "New-Found"!'))
    return _t(spark, sf_dir, "part").select("p_partkey", text.normalize(x).alias("normalized"), text.slugify(x).alias("slug"))


@query(r"""SELECT p_partkey, list_aggregate(list_transform(regexp_extract_all(lower(x), '[^\s(—-]*[\s(—-]|[^\s(—-]+$'),
  lambda w: CASE WHEN regexp_matches(w, '^[a-z]') THEN upper(w[1]) || w[2:] ELSE w END), 'string_agg', '') AS title
FROM (SELECT p_partkey, p_name || ' (' || p_type || ') old-time' AS x FROM part)""")
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STF-03."""
    x = F.concat("p_name", F.lit(" ("), "p_type", F.lit(") old-time"))
    return _t(spark, sf_dir, "part").select("p_partkey", text.title_case(x).alias("title"))


@query(f"""SELECT doc_id, substr(regexp_replace(regexp_replace(regexp_replace(p, '{WS}+', ' ', 'g'), '^ ', ''), ' $', ''), 1, 260) || CASE WHEN length(p) > 260 THEN '…' ELSE '' END AS excerpt,
CAST(len(regexp_extract_all(text, '[^{text.WS_CHARS}]+')) AS BIGINT) AS words FROM (
SELECT doc_id, text, coalesce(list_filter(string_split_regex(text, '\\n{WS}*\\n'), lambda b: length(regexp_replace(regexp_replace(b, '^{WS}+', ''), '{WS}+$', '')) > 80)[1], text) AS p FROM documents)""")
def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STF-04, STF-06, SRT-08."""
    docs = _t(spark, sf_dir, "documents")
    return docs.select("doc_id", text.first_paragraph(F.col("text")).alias("excerpt"), text.word_count(F.col("text")).alias("words"))


@query(f"""SELECT source, count(*) AS documents, CAST(sum(w) AS BIGINT) AS total_words, min(w) AS min_words,
list_sort(list(w))[CAST(floor((count(*) - 1) * 0.5) AS INT) + 1] AS median_words, list_sort(list(w))[CAST(floor((count(*) - 1) * 0.9) AS INT) + 1] AS p90_words, max(w) AS max_words
FROM (SELECT source, CAST(len(regexp_extract_all(text, '[^{text.WS_CHARS}]+')) AS BIGINT) AS w FROM documents) GROUP BY source""")
def collection_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-10, AGG-11, GATE-12."""
    return audit.collection_metrics(_t(spark, sf_dir, "documents"), "source", "text")


_ASSESS_SQL = """
members AS (SELECT DISTINCT 'r' || doc_id % 2 AS release, m AS member FROM (
  SELECT doc_id, 'fa:representation:d' || doc_id AS m FROM documents UNION ALL SELECT doc_id, 'fa:artifact:d' || doc_id FROM documents
  UNION ALL SELECT doc_id, 'fa:rights-assessment:d' || doc_id FROM documents WHERE doc_id % 7 <> 0)),
resources AS (SELECT DISTINCT member AS id, split_part(member, ':', 2) AS kind FROM members),
labelled AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
assessments AS (SELECT 'fa:rights-assessment:d' || doc_id AS id, 'fa:representation:d' || doc_id AS subject, 'fa:artifact:d' || doc_id AS evidence,
  CASE WHEN doc_id % 5 = 0 THEN 'pending' ELSE 'accepted' END AS review_state, toxic = 0 AS evidence_use_allowed, quality = 1 AS quotation_allowed,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE toxic = 0 END AS redistribution_allowed, toxic = 0 AND quality = 1 AS access_private_use_allowed,
  quality = 1 AS ml_evaluation_allowed, quality = 1 AND toxic = 0 AS ml_use_allowed, CASE WHEN toxic = 1 THEN false END AS ml_training_allowed FROM labelled)"""
_GAPS_SQL = f"""WITH {_ASSESS_SQL},
uses AS (SELECT unnest(['evidence-use', 'quotation', 'redistribution', 'access-private-use', 'ml-evaluation', 'ml-training']) AS use_case),
gaps AS (SELECT m.release, u.use_case, m.member FROM members m JOIN resources r ON r.id = m.member AND r.kind IN ('artifact', 'representation') CROSS JOIN uses u
WHERE NOT EXISTS (SELECT 1 FROM assessments a WHERE a.subject = m.member AND a.review_state = 'accepted'
  AND CASE u.use_case WHEN 'evidence-use' THEN evidence_use_allowed WHEN 'quotation' THEN quotation_allowed WHEN 'redistribution' THEN redistribution_allowed
    WHEN 'access-private-use' THEN access_private_use_allowed WHEN 'ml-evaluation' THEN ml_evaluation_allowed ELSE ml_training_allowed END IS TRUE
  AND EXISTS (SELECT 1 FROM members x WHERE x.release = m.release AND x.member = a.id) AND EXISTS (SELECT 1 FROM members x WHERE x.release = m.release AND x.member = a.evidence)))"""


def _rights_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    d = F.col("doc_id").cast("string")
    named = lambda kind: F.concat(F.lit(f"fa:{kind}:d"), d)
    release = F.concat(F.lit("r"), (F.col("doc_id") % 2).cast("string"))
    kinds = F.when(F.col("doc_id") % 7 != 0, F.array(named("representation"), named("artifact"), named("rights-assessment"))).otherwise(F.array(named("representation"), named("artifact")))
    members = docs.select(release.alias("release"), F.explode(kinds).alias("member")).distinct()
    resources = members.select(F.col("member").alias("id"), F.split("member", ":")[1].alias("kind")).distinct()
    labels = _t(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    clean, good = F.col("toxic") == 0, F.col("quality") == 1
    values = (clean, good, F.when(F.col("doc_id") % 3 != 0, clean), clean & good, good, F.when(~clean, F.lit(False)))
    assessments = labels.select(named("rights-assessment").alias("id"), named("representation").alias("subject"), named("artifact").alias("evidence"), F.when(F.col("doc_id") % 5 == 0, "pending").otherwise("accepted").alias("review_state"), *[v.alias(c) for v, c in zip(values, rights.columns().values(), strict=True)], (clean & good).alias("ml_use_allowed"))
    return members, resources, assessments


@query(_GAPS_SQL + " SELECT release, use_case, member FROM gaps")
def rights_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GATE-01, EXT-02, JN-10, FLT-08, FLT-09."""
    return rights.catalogue_gaps(*_rights_tables(spark, sf_dir))


@query(f"""WITH {_ASSESS_SQL}, modes AS (SELECT unnest([false, true]) AS require_ml)
SELECT require_ml, m.release, m.member, r.kind FROM members m JOIN resources r ON r.id = m.member AND r.kind IN ('artifact', 'representation') CROSS JOIN modes
WHERE NOT EXISTS (SELECT 1 FROM assessments a WHERE a.subject = m.member AND a.review_state = 'accepted' AND a.redistribution_allowed IS TRUE AND (NOT require_ml OR a.ml_use_allowed IS TRUE)
  AND EXISTS (SELECT 1 FROM members x WHERE x.release = m.release AND x.member = a.id) AND EXISTS (SELECT 1 FROM members x WHERE x.release = m.release AND x.member = a.evidence))""")
def redistribution_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT-01: the first gate, without and with machine learning."""
    tables = _rights_tables(spark, sf_dir)
    both = [rights.redistribution_gaps(*tables, require_ml=m).withColumn("require_ml", F.lit(m)) for m in (False, True)]
    return both[0].unionByName(both[1])


@query(_GAPS_SQL + " SELECT u.use_case, count(g.member) AS n FROM uses u LEFT JOIN gaps g ON u.use_case = g.use_case GROUP BY u.use_case")
def rights_gap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GATE-01, MSC-05."""
    return rights.gap_counts(rights_gaps(spark, sf_dir))


@query(_GAPS_SQL + " SELECT release, count(*) FILTER (use_case = 'evidence-use') = 0 AS publishable FROM (SELECT release, use_case FROM gaps UNION ALL SELECT DISTINCT release, NULL FROM members) GROUP BY release")
def publishable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GATE-03, GATE-04: only the blocking use counts."""
    members, resources, assessments = _rights_tables(spark, sf_dir)
    gaps = rights.catalogue_gaps(members, resources, assessments).where(F.col("use_case") == rights.BLOCKING).select("release").distinct().withColumn("gap", F.lit(True))
    return members.select("release").distinct().join(gaps, "release", "left").select("release", F.col("gap").isNull().alias("publishable"))


@query("""WITH l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
governed AS (SELECT 'fa:representation:' || doc_id AS member FROM documents UNION SELECT 'fa:artifact:sha256-' || sha256(text) FROM documents),
permitted AS (SELECT 'fa:representation:' || doc_id AS member, 'quotation' AS use_case FROM l WHERE quality = 1 AND doc_id % 5 <> 0
  UNION SELECT 'fa:representation:' || doc_id, 'evidence-use' FROM l WHERE toxic = 0 AND doc_id % 5 <> 0),
uses AS (SELECT unnest(['evidence-use', 'quotation', 'redistribution', 'access-private-use', 'ml-evaluation', 'ml-training']) AS use_case)
SELECT u.use_case, g.member FROM governed g CROSS JOIN uses u WHERE NOT EXISTS (SELECT 1 FROM permitted p WHERE p.member = g.member AND p.use_case = u.use_case)""")
def release_rights_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GATE-02, SET-04, SET-01."""
    docs = _t(spark, sf_dir, "documents")
    labels = _t(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    artifact = F.concat(F.lit("fa:artifact:sha256-"), F.sha2("text", 256))
    none = F.lit(None).cast("boolean")
    values = {"evidenceUseAllowed": F.col("toxic") == 0, "quotationAllowed": F.col("quality") == 1}
    assessed = labels.select(F.concat(F.lit("fa:representation:"), "doc_id").alias("subjectId"), F.when(F.col("doc_id") % 5 == 0, "pending").otherwise("accepted").alias("reviewState"), *[values.get(f, none).alias(f) for f in rights.USE_CASES.values()])
    return rights.release_gaps(docs.select(F.sha2("text", 256).alias("rawSha256")), docs.select(F.concat(F.lit("fa:representation:"), "doc_id").alias("id"), artifact.alias("artifactId")), assessed)


@query("""WITH t AS (SELECT doc_id, 'fa:representation:' || (doc_id // 2) AS tr, CASE WHEN doc_id % 11 = 0 THEN 'fa:representation:' || (doc_id // 2) ELSE 'fa:representation:' || (doc_id + 1) END AS sr,
  CASE WHEN doc_id % 4 = 0 THEN 'fa:artifact:' || doc_id END AS ev FROM documents),
known AS (SELECT 'fa:representation:' || doc_id AS id FROM documents WHERE doc_id % 13 <> 0),
pairs AS (SELECT tr, sr FROM t WHERE doc_id % 3 <> 0), man AS (SELECT 'fa:artifact:' || doc_id AS id FROM documents WHERE doc_id % 8 = 0),
outs AS (SELECT tr, count(*) AS n FROM t GROUP BY tr)
SELECT * FROM (SELECT 'fa:translation:' || t.doc_id AS id, array_to_string(list_filter([
  CASE WHEN n > 1 THEN 'duplicate-translation-representation' END, CASE WHEN t.tr = t.sr THEN 'source-equals-translation' END,
  CASE WHEN t.tr NOT IN (SELECT id FROM known) THEN 'missing-translation-representation' END, CASE WHEN t.sr NOT IN (SELECT id FROM known) THEN 'missing-source-representation' END,
  CASE WHEN NOT EXISTS (SELECT 1 FROM pairs p WHERE p.tr = t.tr AND p.sr = t.sr) THEN 'missing-translation-derivation' END,
  CASE WHEN ev IS NOT NULL AND ev NOT IN (SELECT id FROM man) THEN 'missing-review-evidence' END], lambda x: x IS NOT NULL), '|') AS reasons
FROM t JOIN outs USING (tr)) WHERE reasons <> ''""")
def translation_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GATE-06, JN-17, AGG-17."""
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    name = lambda kind, c: F.concat(F.lit(f"fa:{kind}:"), c.cast("string"))
    d = F.col("doc_id")
    target = name("representation", F.floor(d / 2))
    t = docs.select("doc_id", name("translation", d).alias("id"), target.alias("translationRepresentationId"), F.when(d % 11 == 0, target).otherwise(name("representation", d + 1)).alias("sourceRepresentationId"), F.when(d % 4 == 0, name("artifact", d)).alias("reviewEvidenceArtifactId"))
    derived = t.where(d % 3 != 0).select(F.lit("translation").alias("type"), F.array("sourceRepresentationId").alias("inputIds"), F.array("translationRepresentationId").alias("outputIds"))
    known = docs.where(d % 13 != 0).select(name("representation", d).alias("id"))
    manifest = docs.where(d % 8 == 0).select(name("artifact", d).alias("id"))
    return translation.translation_gaps(t.drop("doc_id"), known, derived, manifest).select("id", _LIST(F.col("reasons")).alias("reasons"))


@query("""SELECT 'item-order' AS "check", CAST(l_orderkey AS VARCHAR) AS key, CAST(l_orderkey AS VARCHAR) AS detail FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderkey % 50 <> 0)
UNION ALL SELECT 'order-customer', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 20 <> 0)
UNION ALL SELECT 'customer-nation', CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'order-key', CAST(l_orderkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
UNION ALL SELECT 'price-positive', CAST(o_orderkey AS VARCHAR), NULL FROM orders WHERE NOT (o_totalprice > 5000)""")
def reference_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-11, JN-12, JN-14, AGG-18: references, uniqueness and checks as violations, some of them seeded."""
    items, orders, customers, nations = (_t(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation"))
    return expectations.all_of(
        expectations.references(items, "item-order", ["l_orderkey"], orders.where("o_orderkey % 50 <> 0"), ["o_orderkey"], "l_orderkey"),
        expectations.references(orders, "order-customer", ["o_custkey"], customers.where("c_custkey % 20 <> 0"), ["c_custkey"], "o_orderkey"),
        expectations.references(customers, "customer-nation", ["c_nationkey"], nations, ["n_nationkey"], "c_custkey"),
        expectations.unique(items, "order-key", "l_orderkey"),
        expectations.holds(orders, "price-positive", F.col("o_totalprice") > 5000, "o_orderkey"),
    )


@query("""SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS items_without_order,
(SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS orders_without_customer,
(SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS labels_without_document""")
def integrity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GATE-13, AGG-02."""
    def missing(rows: str, key: str, targets: str, target: str, name: str) -> DataFrame:
        a, b = _t(spark, sf_dir, rows), _t(spark, sf_dir, targets)
        return a.join(b, a[key] == b[target], "left_anti").agg(F.count("*").alias(name))

    one = missing("lineitem", "l_orderkey", "orders", "o_orderkey", "items_without_order")
    two = missing("orders", "o_custkey", "customer", "c_custkey", "orders_without_customer")
    return one.crossJoin(two).crossJoin(missing("labels", "doc_id", "documents", "doc_id", "labels_without_document"))


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "pages", "benchmark", "conversations")


@query(" UNION ALL ".join(f"SELECT '{t}' AS kind, count(*) AS n FROM {t}" for t in _TABLES))
def catalogue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01, AGG-14, SET-02."""
    return audit.kind_counts({t: _t(spark, sf_dir, t) for t in _TABLES})


@query("""SELECT CAST(n AS BIGINT) AS n, kind FROM (SELECT 'nation' AS kind, 26 AS declared, count(*) AS n FROM nation UNION ALL SELECT 'region', 5, count(*) FROM region) WHERE n <> declared""")
def count_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-19."""
    declared = spark.createDataFrame([("nation", 26), ("region", 5)], "kind string, n long")
    actual = audit.kind_counts({t: _t(spark, sf_dir, t) for t in ("nation", "region")})
    wrong = expectations.declared_counts(declared, actual, "counts")
    return wrong.join(actual, F.col("key") == F.col("kind")).select("n", "kind")


@query("""SELECT l_orderkey, l_linenumber, o_orderstatus, c_name, n_name, r_name, p_name, s_name FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0
WHERE (o_orderstatus = 'F' AND l_returnflag = 'R') OR (o_orderstatus = 'O' AND l_linenumber IN (1, 2))""")
def wide_release_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-01, JN-02, JN-05, FLT-04, FLT-07: dimensions are joined by key; their size decides about broadcasts."""
    t = {n: _t(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")}
    rows = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).where("(o_orderstatus = 'F' AND l_returnflag = 'R') OR (o_orderstatus = 'O' AND l_linenumber IN (1, 2))")
    rows = rows.join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.join(t["part"], F.col("l_partkey") == F.col("p_partkey")).join(t["supplier"].where("s_acctbal > 0"), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select("l_orderkey", "l_linenumber", "o_orderstatus", "c_name", "n_name", "r_name", "p_name", "s_name")


@query("""SELECT o_orderkey, c_name, s_name, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment FROM orders
LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000 LEFT JOIN supplier ON o_orderkey = s_suppkey""")
def optional_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-06, FLT-10, FLT-16."""
    orders, customers, suppliers = (_t(spark, sf_dir, n) for n in ("orders", "customer", "supplier"))
    rows = orders.join(customers.where("c_acctbal > 5000"), F.col("o_custkey") == F.col("c_custkey"), "left").join(suppliers, F.col("o_orderkey") == F.col("s_suppkey"), "left")
    return rows.select("o_orderkey", "c_name", "s_name", F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("none")).alias("segment"))


@query("""SELECT n_name, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS segments, count(DISTINCT c_mktsegment) AS n, min(c_name) AS first_name, max(c_name) AS last_name,
(SELECT string_agg(c_name, '|' ORDER BY c_custkey) FROM customer x WHERE x.c_nationkey = n_nationkey) AS names
FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey""")
def ordered_array_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-03, AGG-04, AGG-06, AGG-07, AGG-20."""
    rows = _t(spark, sf_dir, "nation").join(_t(spark, sf_dir, "customer"), F.col("n_nationkey") == F.col("c_nationkey"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "c_name"))), lambda s: s["c_name"])
    return rows.groupBy("n_name").agg(_LIST(F.sort_array(F.collect_set("c_mktsegment"))).alias("segments"), F.count_distinct("c_mktsegment").alias("n"), F.min("c_name").alias("first_name"), F.max("c_name").alias("last_name"), _LIST(in_order).alias("names"))


@query("""WITH RECURSIVE e AS (
  SELECT 'o' || o_orderkey AS output, 'c' || o_custkey AS input FROM orders UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
a AS (SELECT output AS start, output AS id FROM e WHERE output LIKE 'o%' UNION SELECT a.start, e.input FROM a JOIN e ON e.output = a.id)
SELECT start, id FROM a WHERE id LIKE 'r%'""")
def lineage_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-20, SET-03: from orders back to regions."""
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    orders = _t(spark, sf_dir, "orders").select(name("o", "o_orderkey").alias("output"), name("c", "o_custkey").alias("input"))
    edges = orders.union(_t(spark, sf_dir, "customer").select(name("c", "c_custkey"), name("n", "c_nationkey"))).union(_t(spark, sf_dir, "nation").select(name("n", "n_nationkey"), name("r", "n_regionkey")))
    regions = _t(spark, sf_dir, "region").select(name("r", "r_regionkey").alias("id"), F.lit("region").alias("kind"))
    return lineage.trace(orders.select(F.col("output").alias("start")), edges, regions, "region")


@query("""SELECT conv_id, turn, role, CAST(pos AS BIGINT) AS start_at, CAST(coalesce(lead(pos) OVER w, pos + length(text) + 1) AS BIGINT) AS end_at, lead(turn) OVER w AS next_turn FROM (
SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM conversations)
WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)""")
def section_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-03, WIN-04."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = _t(spark, sf_dir, "conversations").withColumn("at", F.coalesce(F.sum(F.length("text") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows.select("conv_id", "turn", "role", F.col("at").cast("long").alias("start_at"), F.coalesce(F.lead("at").over(order), F.col("at") + F.length("text") + 1).cast("long").alias("end_at"), F.lead("turn").over(order).alias("next_turn"))


@query("""SELECT conv_id, turn FROM (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role) AS before, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations)
WHERE before = role OR (before IS NULL AND role <> 'user') OR k > 3""")
def turn_order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-01, WIN-02, WIN-05, WIN-07."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role")
    rows = _t(spark, sf_dir, "conversations").withColumn("before", F.lag("role").over(order)).withColumn("k", F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")))
    return rows.where("before = role OR (before IS NULL AND role <> 'user') OR k > 3").select("conv_id", "turn")


@query("""SELECT doc_id, CAST(strlen(substr(text, 1, 100)) + length(substr(text, 1, 100)) - length(replace(substr(text, 1, 100), chr(10), '')) AS BIGINT) AS byte_at,
sha256(substr(text, 51, 100)) AS slice_sha256 FROM documents""")
def byte_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCF-03, SCF-06, SCF-07: a character slice is found again by its bytes."""
    docs = _t(spark, sf_dir, "documents")
    raw = F.encode("text", "UTF-8")
    start, end = (F.octet_length(F.substring("text", 1, n)) for n in (50, 150))
    return docs.select("doc_id", scalar.raw_byte_offset(F.col("text"), F.lit(100)).alias("byte_at"), scalar.slice_digest(raw, start, end).alias("slice_sha256"))


@query("""SELECT user_id, event_type AS status, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-10, STR-11, SRT-06, SRT-07: an append-only log folded to its latest entry."""
    last = F.max_by(F.struct("event_type", "event_id"), F.struct("ts", "event_id"))
    return _t(spark, sf_dir, "events").groupBy("user_id").agg(last.alias("l")).select("user_id", F.col("l.event_type").alias("status"), F.col("l.event_id").alias("event_id"))


@query("SELECT CAST(event_id AS VARCHAR) AS item_key, sha256(event_type || '|' || CAST(user_id AS VARCHAR)) AS digest FROM events")
def idempotent_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01, STR-02, STR-05, STR-10: events streamed from files and committed once, then once more without effect."""
    source = f"{sf_dir}/events.parquet"
    item = (F.col("event_id").cast("string"), F.sha2(F.concat_ws("|", "event_type", F.col("user_id").cast("string")), 256))
    return ingest_files(spark, source, _t(spark, sf_dir, "events").schema, *item, replays=2)


@query("""WITH n AS (SELECT count(DISTINCT doc_id) AS docs, count(DISTINCT sha256(coalesce(text, ''))) AS texts FROM documents WHERE doc_id IS NOT NULL)
SELECT kind, CASE kind WHEN 'capture' THEN 2 * docs WHEN 'artifact' THEN texts WHEN 'rights_assessment' THEN 2 * docs ELSE docs END AS n
FROM n, unnest(['artifact', 'capture', 'derivation', 'derivation_input', 'derivation_output', 'document', 'passage', 'passage_representation', 'representation', 'rights_assessment', 'source_item', 'witness']) AS k(kind)""")
def collection_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01, STR-03, STR-05, STR-06, SNK-07: every document with an id as an item, validated and committed by a stream in two
    runs of one request. Bytes of the second are known, so it adds its captures only. Null texts are empty ones. An assessment is named by its subject, its evidence and
    the whole policy with its capture keys, so equal texts of several documents have one each."""
    schema = _t(spark, sf_dir, "documents").schema
    docs = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{sf_dir}/documents.parque[t]").where("doc_id IS NOT NULL").withColumn("text", F.coalesce("text", F.lit("")))
    key, no = F.concat(F.lit("doc-"), F.col("doc_id").cast("string")), F.lit(None).cast("string")
    capture = F.struct(key.alias("key"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("byte_length"), F.lit("text/plain").alias("media_type"))
    span = F.struct(F.lit("TextPositionSelector").alias("type"), F.lit(0.0).alias("start"), F.length("text").cast("double").alias("end"))
    passage = F.struct(F.lit("p1").alias("external_key"), F.lit(1).alias("ordinal"), F.lit("text").alias("source_anchor"), no.alias("citation_label"), no.alias("language"), span.alias("selector"), F.col("text").alias("quoted_text"))
    copied = F.struct(no.alias("type"), F.lit("copy").alias("method"), F.lit("1").alias("method_version"), F.lit(True).alias("deterministic"), F.lit(None).cast("array<string>").alias("input_capture_keys"))
    representation = F.struct(F.lit("plain").alias("external_key"), key.alias("capture_key"), no.alias("artifact_key"), F.lit("source").alias("kind"), no.alias("language"), no.alias("script"), copied.alias("derivation"), F.array(passage).alias("passages"))
    stated = {"rights_source": "table", "attribution_text": "table", "jurisdiction": "FI", "reviewed_on": "2026-07-25", "review_state": "accepted", "statement_uri": "https://example.org/rights"}
    uses = [F.lit(True).alias(c) for c in (*(c for *_, c in rights.USES), "commercial_use_allowed", "derivatives_allowed", "ml_use_allowed")]
    terms = F.struct(F.array(key).alias("evidence_capture_keys"), *[F.lit(v).alias(c) for c, v in stated.items()], no.alias("controlled_status"), *uses)
    witness = F.struct(F.lit("w").alias("external_key"), F.lit("text").alias("kind"), F.array(representation).alias("representations"))
    item = docs.select(key.alias("external_key"), no.alias("checkpoint_after"), F.array(capture).alias("captures"), F.array().cast("array<struct<key:string,sha256:string,byte_length:bigint,media_type:string>>").alias("artifacts"), F.struct(key.alias("external_key"), F.col("doc_id").cast("string").alias("native_id"), no.alias("landing_uri")).alias("source_item"), F.array(witness).alias("witnesses"), terms.alias("rights"))
    root = f"{shared_dir(spark)}/collection-{uuid.uuid4().hex}"
    log, held = ingest.Catalogue(spark, f"{root}/log"), catalogue.Catalogue(spark, f"{root}/catalogue")
    for _ in range(2):
        collection.ingest_collection(log, held, item, "documents", "1", {"table": "documents"})
    return catalogue.counts(held).where("n > 0 AND kind <> 'resource'")


@query("""WITH t AS (SELECT 'documents' AS name, doc_id AS k, CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS c FROM documents WHERE doc_id IS NOT NULL
UNION ALL SELECT 'turns', conv_id, CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE 3 END FROM (SELECT DISTINCT conv_id, turn, role FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL))
SELECT v AS change, name, count(*) AS n, CAST(sum(k) AS BIGINT) AS keys FROM t, unnest([1, 2, 3]) AS u(v) WHERE c <= v GROUP BY v, name""")
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-05 to SNK-07, JN-09: documents and turns in three changes, each with all rows of the one before; what each version holds."""
    tables = {"documents": ("doc_id long, lang string, text_sha256 string", ("doc_id",), ("lang", "text_sha256")), "turns": ("conv_id long, turn long, role string", ("conv_id", "turn", "role"), ())}
    held = snapshots.KeyedTables(spark, f"{shared_dir(spark)}/changes-{uuid.uuid4().hex}", tables)
    docs, turns = _t(spark, sf_dir, "documents").where("doc_id IS NOT NULL").withColumn("text_sha256", F.sha2("text", 256)), _t(spark, sf_dir, "conversations").where("conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL")
    for lang, role in (("lang = 'en'", "role = 'user'"), ("lang IN ('en', 'de')", "role IN ('user', 'assistant')"), ("true", "true")):
        held.append_all({"documents": [docs.where(lang)], "turns": [turns.where(role)]})
    states = [held.table(name, v).agg(F.count("*").alias("n"), F.sum(key).alias("keys")).select(F.lit(v).alias("change"), F.lit(name).alias("name"), "n", "keys") for name, key in (("documents", "doc_id"), ("turns", "conv_id")) for v in (1, 2, 3)]
    return expectations.all_of(*states)


@query("""SELECT 'documents' AS kind, doc_id, CASE WHEN doc_id % 17 = 0 THEN 'removed' ELSE 'changed' END AS change FROM documents WHERE doc_id % 17 = 0 OR doc_id % 13 = 0
UNION ALL SELECT 'documents', doc_id + 1000000000000, 'added' FROM documents WHERE doc_id % 19 = 0
UNION ALL SELECT 'turns', conv_id, 'changed' FROM (SELECT conv_id, count(*) FILTER (turn % 2 = 0) AS n FROM conversations WHERE conv_id % 23 = 0 GROUP BY conv_id) WHERE n > 0""")
def rebuild_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GATE-10: two builds of documents and conversations, of which the second lacks some records, has others, and has changed ones; what differs, by their trees of digests."""
    docs, turns = _t(spark, sf_dir, "documents").where("doc_id IS NOT NULL"), _t(spark, sf_dir, "conversations").where("conv_id IS NOT NULL")
    again = docs.where("doc_id % 17 <> 0").withColumn("text", F.when(F.col("doc_id") % 13 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("."))).otherwise(F.col("text")))
    again = again.unionAll(docs.where("doc_id % 19 = 0").withColumn("doc_id", F.col("doc_id") + 1000000000000))
    said = turns.withColumn("text", F.when((F.col("conv_id") % 23 == 0) & (F.col("turn") % 2 == 0), F.concat(F.coalesce("text", F.lit("")), F.lit("."))).otherwise(F.col("text")))
    keys = {"documents": ("doc_id",), "turns": ("conv_id",)}
    bits = rebuild.block_bits({"documents": docs, "turns": turns})
    one, two = rebuild.Tree({"documents": docs, "turns": turns}, bits, keys), rebuild.Tree({"documents": again, "turns": said}, bits, keys)
    key = lambda c: F.get_json_object("key", f"$.{c}").cast("long")
    return rebuild.differences(one, two).select("kind", F.coalesce(key("doc_id"), key("conv_id")).alias("doc_id"), "change")


@query("""WITH l AS (SELECT source, doc_id, '{"doc_id":' || doc_id || CASE WHEN lang IS NULL THEN '' ELSE ',"lang":"' || lang || '"' END || CASE WHEN source IS NULL THEN '' ELSE ',"source":"' || source || '"' END || '}' AS line FROM documents WHERE doc_id IS NOT NULL)
SELECT doc_id, CAST(coalesce(sum(strlen(line) + 1) OVER (ORDER BY source NULLS FIRST, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at, sha256(line) AS line_sha256 FROM l""")
def ordered_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-01, SRT-01, SRT-03: documents as ordered lines, and the byte of the one file at which each begins."""
    docs = _t(spark, sf_dir, "documents").where("doc_id IS NOT NULL").select("doc_id", "lang", "source")
    placed, _, _ = ordered.placed_lines(ordered.ordered_lines(docs, "source", "doc_id"))
    return placed.select(F.get_json_object("line", "$.doc_id").cast("long").alias("doc_id"), "at", F.sha2("line", 256).alias("line_sha256"))


@query("""WITH d AS (SELECT doc_id AS k, CAST(doc_id AS VARCHAR) AS s, coalesce(lang, 'und') AS a, 'fa:artifact:sha256-' || sha256(coalesce(text, '')) AS art FROM documents WHERE doc_id IS NOT NULL),
reps AS (SELECT 'fa:representation:d' || s AS id, k, art FROM d WHERE a IN ('en', 'de') UNION ALL SELECT 'fa:representation:t' || s, k, 'fa:artifact:t' || s FROM d WHERE a = 'de' AND k % 3 = 0),
rights AS (SELECT 'fa:rights:r' || d.s AS id, d.art FROM d JOIN reps ON reps.id = 'fa:representation:d' || d.s WHERE d.k % 11 <> 0),
used AS (SELECT 'fa:capture:d' || s AS id FROM d WHERE a IN ('en', 'de') UNION SELECT art FROM d WHERE a = 'de' AND k % 3 = 0),
taken AS (SELECT k, s, art FROM d WHERE 'fa:capture:d' || s IN (SELECT id FROM used) OR art IN (SELECT id FROM used) OR art IN (SELECT art FROM rights))
SELECT 'representation' AS kind, id FROM reps UNION ALL SELECT 'rights', id FROM rights UNION ALL SELECT 'capture', 'fa:capture:d' || s FROM taken UNION ALL SELECT 'source-item', 'fa:source-item:d' || s FROM taken
UNION ALL SELECT 'artifact', id FROM (SELECT art AS id FROM taken UNION SELECT art FROM reps)
UNION ALL SELECT 'derivation', 'fa:derivation:' || p || s FROM d, unnest(['d', 't', 'y']) AS u(p) WHERE a IN ('en', 'de') AND (p = 'd' OR p = 't' AND a = 'de' AND k % 3 = 0 OR p = 'y' AND k % 7 = 0)
UNION ALL SELECT 'output', 'fa:representation:' || p || s FROM d, unnest(['d', 't', 'u']) AS u(p) WHERE a IN ('en', 'de') AND (p = 'd' OR p = 't' AND a = 'de' AND k % 3 = 0 OR p = 'u' AND k % 7 = 0)
UNION ALL SELECT 'evidence', 'fa:capture:d' || s FROM taken WHERE art IN (SELECT art FROM rights)
UNION ALL SELECT 'seed', art FROM (SELECT DISTINCT art FROM d WHERE a = 'fr' AND k <> 4)""")
def release_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-01, JN-04, JN-05, JN-07, FLT-04: documents as a catalogue in which much is not released: two languages of four, translations of
    one, derivations of things that nobody holds, rights without a record. What the closure of a release keeps."""
    docs = _t(spark, sf_dir, "documents").where("doc_id IS NOT NULL").select("doc_id", F.coalesce("lang", F.lit("und")).alias("archive_id"), F.concat(F.lit("fa:artifact:sha256-"), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("artifact"))
    docs = kept(docs, "documents")  # a score of frames are made from it, none of which needs the texts
    k = F.col("doc_id")
    named = lambda kind, name="id", p="d": F.concat(F.lit(f"fa:{kind}:{p}"), k.cast("string")).alias(name)
    art = F.col("artifact")
    third, fifth, seventh = docs.where(k % 3 == 0), docs.where(k % 5 == 0), docs.where(k % 7 == 0)
    both = expectations.all_of
    inputs = lambda rows, p, source: rows.select(named("derivation", "derivation_id", p), source.alias("input_id"), F.lit(0).alias("ordinal"))
    outputs = lambda rows, p, q, n=0: rows.select(named("derivation", "derivation_id", p), named("representation", "output_id", q), F.lit(n).alias("ordinal"))
    capture = named("capture")
    rights_of = docs.select(named("rights", p="r"), named("representation", "subject"), art.alias("evidence"), F.lit("accepted").alias("review_state"))
    held = catalogue.Frames(
        spark,
        resource=both(docs.select(named("representation")), docs.select(art.alias("id")), docs.where(k % 11 != 0).select(named("rights", p="r"))).select("id", F.lit("any").alias("kind")),
        artifact=both(docs.select(art.alias("id")).distinct(), third.select(named("artifact", p="t"))),
        source_item=docs.select(named("source-item"), "archive_id", k.cast("string").alias("native_id")),
        capture=docs.select(capture, named("source-item", "source_item_id"), art.alias("artifact_id")),
        edition=docs.select(named("edition"), named("capture", "capture_id")),
        document=docs.select(named("document"), named("edition", "edition_id")), witness=docs.select(named("witness"), named("document", "document_id")),
        representation=both(docs.select(named("representation"), named("witness", "witness_id"), art.alias("artifact_id"), F.lit("source").alias("kind")), third.select(named("representation", p="t"), named("witness", "witness_id"), named("artifact", "artifact_id", "t"), F.lit("translation").alias("kind"))),
        passage=docs.select(named("passage"), named("witness", "witness_id")), passage_representation=docs.select(named("passage", "passage_id"), named("representation", "representation_id")),
        derivation=both(*[rows.select(named("derivation", p=p)) for rows, p in ((docs, "d"), (third, "t"), (fifth, "x"), (seventh, "y"))]),
        derivation_input=both(inputs(docs, "d", capture), inputs(third, "t", art), inputs(fifth, "x", capture), inputs(seventh, "y", capture)),
        derivation_output=both(outputs(docs, "d", "d"), outputs(third, "t", "t"), outputs(fifth, "x", "v"), outputs(seventh, "y", "d"), outputs(seventh, "y", "u", 1)),
        rights_assessment=rights_of,
    )
    found = closure.released(held, {"en": ["source"], "de": ["source", "translation"]})
    parts = {"representation": "representation", "rights": "rights_assessment", "capture": "capture", "source-item": "source_item", "artifact": "artifact", "derivation": "derivation"}
    shown = [found.table(t).select(F.lit(kind).alias("kind"), "id") for kind, t in parts.items()]
    shown.append(found.table("derivation_output").select(F.lit("output").alias("kind"), F.col("output_id").alias("id")).distinct())
    shown.append(closure.evidence_captures(found).select(F.lit("evidence").alias("kind"), F.col("capture_id").alias("id")))
    shown.append(closure.archive_artifacts(held, "fr", "4").select(F.lit("seed").alias("kind"), "id"))
    return both(*shown)


@query(_PASSAGES_CTE + rf""", sp AS (SELECT doc_id, ordinal, s, CASE WHEN ordinal % 7 = 0 THEN e + 3 ELSE e END AS e FROM passage WHERE ordinal % 5 <> 0),
sw AS (SELECT *, coalesce(max(e) OVER (PARTITION BY doc_id ORDER BY s, e, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM sp),
r AS (SELECT sw.*, d.text, length(d.text) AS n FROM sw JOIN documents d USING (doc_id)),
ends AS (SELECT d.doc_id, coalesce(d.text, '') AS text, coalesce(max(e), 0) AS z FROM documents d LEFT JOIN sp USING (doc_id) GROUP BY d.doc_id, d.text)
SELECT 'span-outside' AS "check", doc_id || ':' || ordinal AS key, s || '-' || e AS detail FROM r WHERE e > n
UNION ALL SELECT 'span-overlap', doc_id || ':' || ordinal, s || '-' || upto FROM r WHERE s < upto
UNION ALL SELECT 'span-gap', doc_id || ':' || ordinal, upto || '-' || s FROM r WHERE s > upto AND regexp_replace(substr(text, upto + 1, s - upto), '{WS}+', '', 'g') <> ''
UNION ALL SELECT 'span-rest', CAST(doc_id AS VARCHAR), z || '-' || length(text) FROM ends WHERE length(text) > z AND regexp_replace(substr(text, z + 1, length(text) - z), '{WS}+', '', 'g') <> ''""")
def span_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GATE-09, SCF-08: passages of all documents with seeded faults, every fifth one missing and every seventh one too long, swept in order."""
    docs = _t(spark, sf_dir, "documents")
    cut = passages(docs).where("ordinal % 5 <> 0").select(F.col("doc_id").alias("owner"), F.concat_ws(":", F.col("doc_id").cast("string"), F.col("ordinal").cast("string")).alias("key"), "start", (F.col("end") + F.when(F.col("ordinal") % 7 == 0, 3).otherwise(0)).alias("end"))
    return expectations.sweep(cut, docs.select(F.col("doc_id").alias("owner"), "text"))


#: Ids in one volume.
VOLUME_IDS = 2000


@query(f"""WITH i AS (SELECT doc_id, doc_id // {VOLUME_IDS} AS volume, '<ITEM nro="' || doc_id || '"><META><ID>' || doc_id || '.</ID></META><TEXT><V>' || replace(replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</V></TEXT></ITEM>' AS xml FROM documents WHERE doc_id IS NOT NULL)
SELECT CAST(volume AS VARCHAR) AS volume, CAST(row_number() OVER (PARTITION BY volume ORDER BY doc_id) AS INT) AS ordinal, CAST(doc_id AS VARCHAR) AS electronic_id, sha256(xml) AS xml_sha256 FROM i""")
def volume_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05, SRC-06: every document with an id as an item of a volume, one file for a range of ids, read back by byte ranges."""
    docs = _t(spark, sf_dir, "documents").where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    volume = F.floor(F.col("doc_id") / VOLUME_IDS).alias("volume")
    item = F.concat(F.lit('<ITEM nro="'), F.col("doc_id"), F.lit('"><META><ID>'), F.col("doc_id"), F.lit(".</ID></META><TEXT><V>"), volumes.escaped(F.col("text")), F.lit("</V></TEXT></ITEM>"))
    items = docs.select(volume, F.lit(1).alias("part"), "doc_id", item.alias("value"))
    frame = items.select("volume").distinct().select("volume", F.explode(F.array(F.struct(F.lit(0).alias("part"), F.lit("<KOKOELMA>").alias("value")), F.struct(F.lit(2).alias("part"), F.lit("</KOKOELMA>").alias("value")))).alias("f"))
    rows = items.unionByName(frame.select("volume", "f.part", F.lit(None).cast("long").alias("doc_id"), "f.value"))
    path = f"{shared_dir(spark)}/volumes-{uuid.uuid4().hex}"
    rows.repartition("volume").sortWithinPartitions("volume", "part", "doc_id").select("volume", "value").write.partitionBy("volume").text(path)
    found = volumes.Volumes(spark, path).items()
    return found.select(F.regexp_extract("file", "/volume=([^/]*)/", 1).alias("volume"), "ordinal", "electronic_id", F.sha2("xml", 256).alias("xml_sha256"))


@query("""SELECT o_orderkey, 'fa:derivation:' || sha256('{"customer":' || o_custkey || ',"id":"o' || o_orderkey || '","note":null,"status":"' || o_orderstatus || '"}') AS derivation_id FROM orders""")
def canonical_json_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCF-05."""
    fields = {"status": F.col("o_orderstatus"), "id": F.concat(F.lit("o"), "o_orderkey"), "note": F.lit(None).cast("string"), "customer": F.col("o_custkey")}
    return _t(spark, sf_dir, "orders").select("o_orderkey", scalar.content_id("fa:derivation:", scalar.canonical_json(fields)).alias("derivation_id"))


@query("""SELECT event_id, x, regexp_full_match(x, '\\d{4}-\\d{2}-\\d{2}') AND try_cast(x AS DATE) IS NOT NULL AS valid FROM (
SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN '2026-02-' || lpad(CAST(event_id % 40 AS VARCHAR), 2, '0') WHEN 2 THEN strftime(ts, '%Y-%m-%d') || ' ' ELSE '2026-2-8' END AS x FROM events)""")
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCF-01, SCF-02."""
    day = scalar.iso_day(F.col("ts"))
    k = F.col("event_id") % 4
    x = F.when(k == 0, day).when(k == 1, F.concat(F.lit("2026-02-"), F.lpad((F.col("event_id") % 40).cast("string"), 2, "0"))).when(k == 2, F.concat(day, F.lit(" "))).otherwise("2026-2-8")
    return _t(spark, sf_dir, "events").select("event_id", x.alias("x")).withColumn("valid", scalar.is_iso_date(F.col("x")))


@query("""SELECT page_id, url LIKE 'https://%' AS secure, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
p <> '' AND NOT regexp_matches(p, '^/') AND len(list_filter(string_split(p, '/'), lambda s: s IN ('', '.', '..'))) = 0 AND position('\\' IN p) = 0 AS safe
FROM (SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN '../' WHEN 1 THEN '' ELSE '/' END || regexp_replace(url, '^https?://', '') AS p FROM pages)""")
def path_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCF-14, SRC-16, FLT-05, FLT-06, FLT-14."""
    front = F.when(F.col("page_id") % 3 == 0, "../").when(F.col("page_id") % 3 == 1, "").otherwise("/")
    p = F.concat(front, F.regexp_replace("url", "^https?://", ""))
    return _t(spark, sf_dir, "pages").select("page_id", F.col("url").startswith("https://").alias("secure"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), scalar.is_safe_path(p).alias("safe"))


@query("""SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order, arg_min(o_orderpriority, o_orderkey) AS first_priority FROM orders GROUP BY o_custkey""")
def keyed_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-07, SET-08: last wins and first wins by key."""
    orders = _t(spark, sf_dir, "orders")
    last = setops.last_wins(orders, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", F.col("o_orderkey").alias("last_order"))
    first = setops.first_wins(orders, ["o_custkey"], "o_orderpriority", "o_orderkey").withColumnRenamed("o_orderpriority", "first_priority")
    return last.join(first, "o_custkey")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels WHERE quality = 1")
def missing_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-04, SET-09."""
    return setops.difference(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels").where("quality = 1"), ["doc_id"])


@query("""SELECT conv_id, string_agg(role, '|' ORDER BY turn) AS expected, count(*) FILTER (role <> CASE WHEN rn % 2 = 1 THEN 'user' ELSE 'assistant' END) AS mismatches
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) GROUP BY conv_id""")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-19: actual sections against expected ones by place."""
    rows = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda s: s["role"]).alias("roles"))
    wrong = F.size(F.filter(F.transform("roles", lambda r, i: r != F.when(i % 2 == 0, "user").otherwise("assistant")), lambda x: x)).cast("long")
    return rows.select("conv_id", _LIST(F.col("roles")).alias("expected"), wrong.alias("mismatches"))


@query("""SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(try_cast(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type""")
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-11, AGG-05, AGG-16."""
    value = F.get_json_object("props", "$.k").try_cast("long")
    return _t(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(value).alias("total"))


@query("""SELECT o_orderkey, array_to_string(list_sort(map_keys(m)), '|') AS kept FROM (SELECT o_orderkey, map_from_entries(list_filter([('etag', o_orderstatus), ('x-cost', 'v'), ('content-type', o_orderpriority)], lambda e: e[1] IN ('content-type', 'etag', 'last-modified'))) AS m FROM orders)""")
def header_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-13, MSC-06."""
    headers = F.create_map(F.lit("ETag"), F.col("o_orderstatus"), F.lit("X-Cost"), F.lit("v"), F.lit("Content-Type"), F.col("o_orderpriority"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", _LIST(F.array_sort(F.map_keys(scalar.safe_headers(headers)))).alias("kept"))


@query("""SELECT (SELECT count(*) FROM documents) AS items, (SELECT count(DISTINCT doc_id) FROM documents) AS native_ids, (SELECT min(CAST(doc_id AS VARCHAR)) FROM documents) AS first_id,
(SELECT max(CAST(doc_id AS VARCHAR)) FROM documents) AS last_id, (SELECT count(*) FROM documents WHERE doc_id % 9 = 0) AS without_record, (SELECT count(*) FROM documents) AS representations,
(SELECT count(DISTINCT sha256(text)) FROM documents) AS artifacts, (SELECT string_agg(DISTINCT lang, '|' ORDER BY lang) FROM documents) AS languages, (SELECT count(*) FROM documents) AS passages,
(SELECT count(*) FROM documents WHERE nullif(text, '') IS NULL) AS without_text,
(SELECT count(*) FROM (SELECT 'r' || doc_id AS s FROM documents UNION SELECT 'a' || sha256(text) FROM documents) WHERE s NOT IN (SELECT 'r' || doc_id FROM labels WHERE quality = 1)) AS ungoverned,
(SELECT count(*) FROM labels WHERE quality = 1 AND toxic = 0 AND doc_id IN (SELECT doc_id FROM documents)) AS training_allowed, CAST(0 AS BIGINT) AS without_passage""")
def collection_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02, AGG-15, GATE-11, JN-12, JN-21, FLT-10."""
    docs, labels = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels")
    d = F.col("doc_id").cast("string")
    items = docs.select(d.alias("id"), d.alias("native_id"), F.when(F.col("doc_id") % 9 == 0, "").otherwise(d).alias("archive_record_id"))
    reps = docs.select(F.concat(F.lit("r"), d).alias("id"), d.alias("item_id"), F.lit("text").alias("kind"), F.col("lang").alias("language"), F.concat(F.lit("a"), F.sha2("text", 256)).alias("artifact_id"))
    cut = docs.select(d.alias("id"), d.alias("item_id"), F.col("text").alias("quoted_text"))
    assessed = labels.select(F.concat(F.lit("r"), d).alias("subject"), F.when(F.col("quality") == 1, "accepted").otherwise("rejected").alias("review_state"), (F.col("toxic") == 0).alias("ml_training_allowed"))
    return audit.collection_audit(items, reps, cut, assessed)


#: Ids in one book.
BOOK_IDS = 40


@query(None)
def book_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STF-10, STF-11, WIN-02 to WIN-05, JN-18, FLT-01 to FLT-03: all documents as books, one for each language and range of ids, cut up again."""
    end = "\n*** END OF\n"  # the texts have no newline left, so none holds it
    book = F.concat_ws("-", F.coalesce("lang", F.lit("und")), F.floor(F.col("doc_id") / BOOK_IDS).cast("string"))
    docs = _t(spark, sf_dir, "documents").select(book.alias("book_id"), F.concat(F.lit("STORY NUMBER "), F.col("doc_id").cast("string")).alias("title"), F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" ")).alias("text"))
    entries = F.sort_array(F.collect_list(F.struct("title", "text")))
    toc = F.array_join(F.transform(entries, lambda e: e["title"]), "\n")
    body = F.array_join(F.transform(entries, lambda e: F.concat(e["title"], F.lit("\n\n"), e["text"])), "\n\n")
    books = docs.groupBy("book_id").agg(F.concat(F.lit("CONTENTS\n"), toc, F.lit("\nTHE BOOK BEGINS\n\n"), body, F.lit(f"\n{end}")).alias("text"))
    spec = segmentation.BookSpec("CONTENTS", "THE BOOK BEGINS", "uppercase-lines", body_end=end)
    return segmentation.sections(books, spec, segmentation.titles(books, spec)).select("book_id", "ordinal", "title", F.length("text").alias("characters"), "start", "end")


@query("""WITH d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS k, coalesce(lang, 'und') AS a, sha256(coalesce(text, '')) AS s, strlen(coalesce(text, '')) AS n FROM documents WHERE doc_id IS NOT NULL),
c AS (SELECT *, CASE a WHEN 'en' THEN 'volume-en' ELSE 'd' || k END AS src FROM d),
r AS (SELECT *, 'fa:capture:sha256-' || sha256('{"archiveId":"' || a || '","artifactSha256":"' || s || '","byteLength":' || n || ',"retrievalUri":"https://example.org/' || a || '","sourceId":"' || src || '"}') AS cid FROM c)
SELECT 'captures' AS kind, cid AS id, concat_ws('|', any_value(src), CASE any_value(a) WHEN 'en' THEN 'Institute' ELSE any_value(a) END, min('https://example.org/d' || k), any_value(s), any_value(n)) AS detail FROM r GROUP BY cid
UNION ALL SELECT 'editions', 'fa:edition:d' || k, cid FROM r
UNION ALL SELECT 'source-items', 'fa:source-item:d' || k, concat_ws('|', a, 'd' || k) FROM r
UNION ALL SELECT 'lineage', 'fa:' || o || ':d' || k, concat_ws('|', o, cid, 'copy', s) FROM r, unnest(['document', 'witness', 'passage']) AS u(o)
UNION ALL SELECT 'translations', 'fa:translation:sha256-' || sha256('{"producerClass":"machine","reviewEvidenceArtifactId":null,"reviewStatus":"unreviewed","reviewedById":null,"sourceRepresentationId":"fa:representation:d' || k || '","translationRepresentationId":"fa:representation:t' || k || '"}'), 'fa:representation:t' || k FROM r
UNION ALL SELECT 'derivations', 'fa:derivation:sha256-' || sha256('{"deterministic":true,"inputIds":["' || cid || '"],"method":"copy","methodVersion":"1","outputIds":["fa:representation:d' || k || '"],"type":"extraction"}'), cid FROM r""")
def release_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-01, JN-03, JN-04, JN-06, FLT-15, MSC-01 to MSC-04: every document with an id as a captured item, released with where it comes
    from. Items of one language are cut from one volume, so its equal texts are one capture."""
    docs = _t(spark, sf_dir, "documents").where("doc_id IS NOT NULL").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"), F.coalesce("lang", F.lit("und")).alias("archive_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("key", "archive_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("byte_length"))
    named = lambda kind, name="id": F.concat(F.lit(f"fa:{kind}:"), "key").alias(name)
    artifact, key = F.concat(F.lit("fa:artifact:sha256-"), "sha256"), F.col("key")
    site = lambda c: F.concat(F.lit("https://example.org/"), c)
    held = catalogue.Frames(
        spark,
        artifact=docs.select(artifact.alias("id"), "sha256", "byte_length", F.col("sha256").alias("storage_key")).distinct(),
        source_item=docs.select(named("source-item"), "archive_id", key.alias("native_id"), site(key).alias("landing_uri")),
        capture=docs.select(named("capture"), named("source-item", "source_item_id"), artifact.alias("artifact_id"), site("archive_id").alias("retrieval_uri")),
        document=docs.select(named("document"), named("edition", "edition_id"), key.alias("title")),
        witness=docs.select(named("witness"), named("document", "document_id")),
        representation=docs.select(named("representation"), named("witness", "witness_id"), artifact.alias("artifact_id"), F.lit("source").alias("kind")),
        passage=docs.select(named("passage"), named("witness", "witness_id"), F.lit(1).alias("ordinal")),
        passage_representation=docs.select(named("passage", "passage_id"), named("representation", "representation_id")),
        derivation=docs.select(named("derivation"), F.lit("extraction").alias("type"), F.lit("copy").alias("method"), F.lit("1").alias("method_version"), F.lit(True).alias("deterministic")),
        derivation_input=docs.select(named("derivation", "derivation_id"), named("capture", "input_id"), F.lit("capture").alias("role"), F.lit(0).alias("ordinal")),
        derivation_output=docs.select(named("derivation", "derivation_id"), named("representation", "output_id"), F.lit("result").alias("role"), F.lit(0).alias("ordinal")),
        translation=docs.select(F.regexp_replace(named("representation"), ":d([^:]*)$", ":t$1").alias("translation_id"), named("representation", "source_id"), F.lit("machine").alias("producer_class"), F.lit("unreviewed").alias("review_status")),
    )
    records = release.project_evidence(held, release.ReleaseSpec("2026-07-25", {"en": "Institute"}, {"en": "volume-en"}))
    first = F.col("inputIds")[0]
    shown = {
        "captures": ("id", F.concat_ws("|", "sourceId", "institution", "landingPage", "rawSha256", F.col("byteLength").cast("string"))),
        "editions": ("id", F.col("captureId")),
        "source-items": ("id", F.concat_ws("|", "archiveId", "nativeId")),
        "lineage": ("outputId", F.concat_ws("|", F.col("outputKind"), first, F.col("method"), F.col("rawSha256"))),
        "translations": ("id", F.col("translationRepresentationId")),
        "derivations": ("id", first),
    }
    return expectations.all_of(*[records[kind].select(F.lit(kind).alias("kind"), F.col(i).alias("id"), d.alias("detail")) for kind, (i, d) in shown.items()])


@query("""SELECT doc_id, lower(hex(unhex(d))) = d AS same, octet_length(unhex(d)) AS n_bytes, CAST(500 * pow(2, n) AS BIGINT) AS wait_ms, coalesce(p.path, 'raw/' || d) AS raw_path
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS d, length(coalesce(lang, '')) AS n, lang FROM documents) LEFT JOIN (SELECT sha256(coalesce(text, '')) AS e, min('artifacts/' || lang) AS path FROM documents WHERE lang IS NOT NULL AND lang <> 'en' GROUP BY 1) p ON d = e""")
def digest_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCF-13, SCF-15, FLT-17: digests to bytes and back, waits between attempts, and paths by digest with a fallback."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("rawSha256"))
    artifacts = docs.where("lang IS NOT NULL AND lang <> 'en'").select(F.col("rawSha256").alias("sha256"), F.concat(F.lit("artifacts/"), "lang").alias("path"))
    rows = release.rewrite_raw_paths(docs.withColumn("rawPath", F.concat(F.lit("raw/"), "rawSha256")), artifacts)
    held = scalar.digest_bytes(F.col("rawSha256"))
    return rows.select("doc_id", (scalar.digest_hex(held) == F.col("rawSha256")).alias("same"), F.octet_length(held).cast("long").alias("n_bytes"), scalar.backoff_ms(F.length(F.coalesce("lang", F.lit("")))).alias("wait_ms"), F.col("rawPath").alias("raw_path"))
