"""Releases: records projected from the catalogue, checked as files, and a report of the gates."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import canonical_json, is_iso_date
from ..operators import expectations, rights, translation
from ..session import kept
from ..sources.files import RECORDS, read_jsonl
from ..sources.ordered import write_file
from ..sources.sinks import ReleaseError, build_manifest, check_manifest
from .catalogue import Catalogue, Frames

SCHEMA_VERSION = "corpus-release-v3"
KINDS = ("captures", "editions", "source-items", "documents", "witnesses", "passages", "lineage", "representations", "derivations", "translations", "rights")
#: Files whose records stand in the order of the Unicode collation; the others are in the order of their bytes.
COLLATED = ("derivations", "translations")
#: Fixed value: what a passage says of a recording that nobody has transcribed.
NO_TRANSCRIPT = "metadata-only-no-transcript"
#: Orders of files whose records have no id of their own.
ORDER = {"lineage": ("outputId", "outputKind", "inputIds", "method", "methodVersion")}


def wide_rows(catalogue: Catalogue | Frames, kinds: list[str] | None = None) -> DataFrame:
    """Passages with their representation, witness, document, artifact and quote: the one join that records are cut from."""
    reps = catalogue.table("representation")
    reps = reps.where(F.col("kind").isin(kinds)) if kinds else reps
    p, pr, w, d, a = (catalogue.table(t) for t in ("passage", "passage_representation", "witness", "document", "artifact"))
    rows = pr.join(reps.select(F.col("id").alias("representation_id"), "artifact_id", F.col("kind").alias("representation_kind"), F.col("language").alias("representation_language")), "representation_id")
    rows = rows.join(p.select(F.col("id").alias("passage_id"), "witness_id", "ordinal", F.col("language").alias("passage_language")), "passage_id")
    rows = rows.join(w.select(F.col("id").alias("witness_id"), "document_id"), "witness_id").join(d.select(F.col("id").alias("document_id"), "edition_id", "title"), "document_id")
    return rows.join(a.select(F.col("id").alias("artifact_id"), F.col("sha256").alias("artifact_sha256"), "byte_length", "media_type", "storage_key"), "artifact_id")


def publish_derivations(catalogue: Catalogue | Frames, capture_ids: DataFrame | None = None, outputs: DataFrame | None = None) -> DataFrame:
    """Derivation records with sorted ids and an id from their content; capture_ids (old, new) replaces run-bound ids. Only
    derivations with a released output are published, and these with all their outputs; outputs: the released ids, by
    default those of all representations that the catalogue, or the part of it that is given, holds."""
    outputs = catalogue.table("representation").select("id") if outputs is None else outputs
    chosen = catalogue.table("derivation_output").join(outputs.select(F.col("id").alias("output_id")), "output_id", "left_semi").select("derivation_id").distinct()
    inputs = catalogue.table("derivation_input").select("derivation_id", F.col("input_id").alias("old"))
    if capture_ids is not None:
        inputs = inputs.join(capture_ids, "old", "left").select("derivation_id", F.coalesce("new", "old").alias("old"))
    ins = inputs.groupBy("derivation_id").agg(F.sort_array(F.collect_set("old")).alias("inputIds"))
    outs = catalogue.table("derivation_output").groupBy("derivation_id").agg(F.sort_array(F.collect_set("output_id")).alias("outputIds"))
    rows = catalogue.table("derivation").withColumnRenamed("id", "derivation_id").join(chosen, "derivation_id", "left_semi").join(ins, "derivation_id").join(outs, "derivation_id")
    body = canonical_json({"deterministic": F.col("deterministic"), "inputIds": F.col("inputIds"), "method": F.col("method"), "methodVersion": F.col("method_version"), "outputIds": F.col("outputIds"), "type": F.col("type")})
    rows = rows.select(F.lit(SCHEMA_VERSION).alias("schemaVersion"), F.concat(F.lit("fa:derivation:sha256-"), F.sha2(body, 256)).alias("id"), "type", "method", F.col("method_version").alias("methodVersion"), "deterministic", "inputIds", "outputIds")
    return rows.dropDuplicates(["id"]).orderBy("id")


def rewrite_raw_paths(records: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Records whose rawPath is the path that artifacts (sha256, path) give for their rawSha256; without one it stays. Of
    several paths of a digest the first in order is taken."""
    paths = artifacts.groupBy(F.col("sha256").alias("rawSha256")).agg(F.min("path").alias("_artifact_path"))
    return records.join(paths, "rawSha256", "left").withColumn("rawPath", F.coalesce("_artifact_path", "rawPath")).select(*records.columns)


def artifact_conflicts(artifacts: DataFrame) -> DataFrame:
    """(check, key, detail): digests that are listed with different lengths, media types or storage keys."""
    told = F.struct("byte_length", "media_type", "storage_key")
    rows = artifacts.groupBy("sha256").agg(F.min(told).alias("_a"), F.max(told).alias("_b")).where("NOT (_a <=> _b)")
    return rows.select(F.lit("artifact-metadata").alias("check"), F.col("sha256").alias("key"), F.concat_ws("/", F.to_json("_a"), F.to_json("_b")).alias("detail"))


def require_apart(root: str | Path, *others: str | Path) -> None:
    """A release's folder may not lie in a catalogue or repository, hold one, or be one, links resolved."""
    own = Path(root).resolve()
    for other in (Path(o).resolve() for o in others):
        if own == other or own in other.parents or other in own.parents:
            raise ReleaseError(f"{root} overlaps {other}")


@dataclass(frozen=True)
class ReleaseSpec:
    """What a release states about its captures: one day for all, an institution for each archive (by its id where none is given), and the archives whose
    items were all cut from one volume, whose captures therefore go by the volume's name."""

    captured_at: str
    institutions: Mapping[str, str] = field(default_factory=dict)
    volumes: Mapping[str, str] = field(default_factory=dict)


def _by_archive(names: Mapping[str, str], otherwise: Column) -> Column:
    out = otherwise
    for archive, name in names.items():
        out = F.when(F.col("archive_id") == archive, F.lit(name)).otherwise(out)
    return out


def release_capture_id(archive: Column, source: Column, uri: Column, sha256: Column, size: Column) -> Column:
    """Identity of a capture from what was fetched, not from the run that fetched it."""
    body = canonical_json({"archiveId": archive, "sourceId": source, "retrievalUri": uri, "artifactSha256": sha256, "byteLength": size})
    return F.concat(F.lit("fa:capture:sha256-"), F.sha2(body, 256))


def capture_rows(catalogue: Catalogue | Frames, spec: ReleaseSpec) -> DataFrame:
    """Captures with their source item and artifact: capture_id as recorded, release_id as published, and what records state."""
    c, a, i = (catalogue.table(t) for t in ("capture", "artifact", "source_item"))
    rows = c.select(F.col("id").alias("capture_id"), "source_item_id", F.col("artifact_id").alias("capture_artifact_id"), "captured_at", "retrieval_uri")
    rows = rows.join(a.select(F.col("id").alias("capture_artifact_id"), F.col("sha256").alias("capture_sha256"), F.col("byte_length").alias("capture_bytes"), F.col("storage_key").alias("capture_key")), "capture_artifact_id")
    rows = rows.join(i.select(F.col("id").alias("source_item_id"), "archive_id", "native_id", "landing_uri"), "source_item_id")
    rows = rows.withColumn("source_id", _by_archive(spec.volumes, F.col("native_id")))
    return rows.withColumn("release_id", release_capture_id(F.col("archive_id"), F.col("source_id"), F.col("retrieval_uri"), F.col("capture_sha256"), F.col("capture_bytes")))


def evidence_rows(catalogue: Catalogue | Frames, captures: DataFrame) -> DataFrame:
    """(representation_id, method, method_version, and a row of captures): how each representation was made and from which
    capture, the first input of its derivation. An input is a capture or a captured artifact; the earliest capture of an
    artifact stands for it."""
    first = catalogue.table("derivation_input").where("ordinal = 0").select("derivation_id", F.col("input_id").alias("_input"))
    made = catalogue.table("derivation").select(F.col("id").alias("derivation_id"), "method", "method_version")
    outs = catalogue.table("derivation_output").select("derivation_id", F.col("output_id").alias("representation_id"))
    made = outs.join(made, "derivation_id").join(first, "derivation_id").groupBy("representation_id").agg(F.min_by(F.struct("method", "method_version", "_input"), "derivation_id").alias("_m")).select("representation_id", "_m.*")
    whole = F.struct(*captures.columns)
    by_bytes = captures.groupBy(F.col("capture_artifact_id").alias("_input")).agg(F.min_by(whole, F.struct("captured_at", "capture_id")).alias("_c"))
    return made.join(captures.select(F.col("capture_id").alias("_input"), whole.alias("_c")).unionByName(by_bytes), "_input").select("representation_id", "method", "method_version", "_c.*")


def publish_translations(catalogue: Catalogue | Frames) -> DataFrame:
    """Translation records with an id from their content; reviewer and evidence may be null."""
    fields = {"translationRepresentationId": "translation_id", "sourceRepresentationId": "source_id", "producerClass": "producer_class", "reviewStatus": "review_status", "reviewedById": "reviewed_by", "reviewEvidenceArtifactId": "review_evidence"}
    body = canonical_json({k: F.col(c) for k, c in fields.items()})
    return catalogue.table("translation").select(F.lit(SCHEMA_VERSION).alias("schemaVersion"), F.concat(F.lit("fa:translation:sha256-"), F.sha2(body, 256)).alias("id"), *[F.col(c).alias(k) for k, c in fields.items()])


def project_evidence(catalogue: Catalogue | Frames, spec: ReleaseSpec, kinds: list[str] | None = None) -> dict[str, DataFrame]:
    """The records that tell where passages come from: captures, editions, source-items, lineage, translations, and
    derivations whose capture ids are those of the release. Only captures behind a released representation are named; of
    several captures that become one, the first by landing page stands."""
    v = F.lit(SCHEMA_VERSION).alias("schemaVersion")
    captures = capture_rows(catalogue, spec)
    editions = catalogue.table("edition").select(F.col("id").alias("edition_id"), F.col("title").alias("edition_title"), F.col("language").alias("edition_language"))
    rows = kept(wide_rows(catalogue, kinds).join(evidence_rows(catalogue, captures), "representation_id").join(editions, "edition_id", "left"), "evidence")
    language = F.coalesce("edition_language", "passage_language", "representation_language", F.lit("und"))
    published = rows.groupBy(F.col("release_id").alias("id")).agg(F.min(F.struct("landing_uri", "source_id", "archive_id", "retrieval_uri", "capture_key", "capture_sha256", "capture_bytes")).alias("_c")).select("id", "_c.*")
    outputs = F.explode(F.array(*[F.struct(F.col(f"{k}_id").alias("outputId"), F.lit(k).alias("outputKind")) for k in ("document", "witness", "passage")])).alias("_o")
    lineage = rows.select(outputs, "release_id", "method", "method_version", "capture_sha256").select(v, "_o.*", F.array("release_id").alias("inputIds"), "method", F.col("method_version").alias("methodVersion"), F.col("capture_sha256").alias("rawSha256"))
    renamed = captures.select(F.col("capture_id").alias("old"), F.col("release_id").alias("new"))
    return {
        "captures": published.select(v, "id", F.col("source_id").alias("sourceId"), F.lit(spec.captured_at).alias("capturedAt"), _by_archive(spec.institutions, F.col("archive_id")).alias("institution"), F.col("landing_uri").alias("landingPage"), F.col("retrieval_uri").alias("retrievalUrl"), F.concat(F.lit("artifacts/"), "capture_key").alias("rawPath"), F.col("capture_sha256").alias("rawSha256"), F.col("capture_bytes").alias("byteLength")),
        "editions": rows.groupBy(F.col("edition_id").alias("id")).agg(F.min("release_id").alias("captureId"), F.min(F.coalesce("edition_title", "title")).alias("title"), F.min(language).alias("language"), F.min("landing_uri").alias("sourceUrl")).select(v, "id", "captureId", "title", "language", "sourceUrl"),
        "source-items": rows.select(v, F.col("source_item_id").alias("id"), F.col("archive_id").alias("archiveId"), F.col("native_id").alias("nativeId"), F.col("landing_uri").alias("landingUri")).distinct(),
        "lineage": lineage.distinct(),
        "translations": publish_translations(catalogue),
        "derivations": publish_derivations(catalogue, renamed, rows.select(F.col("representation_id").alias("id"))),
    }


def project(catalogue: Catalogue | Frames, kinds: list[str] | None = None) -> dict[str, DataFrame]:
    """Record frames by kind, all from one wide join, which is written once. A passage without a transcript has its document's title
    for a text, says so, and keeps where in the recording it is."""
    wide = kept(wide_rows(catalogue, kinds), "wide")
    v = F.lit(SCHEMA_VERSION).alias("schemaVersion")
    language = F.coalesce("passage_language", "representation_language", F.lit("und"))
    text = F.coalesce("quoted_text", F.concat("title", F.lit(" (no transcript)")))
    documents = wide.groupBy(F.col("document_id").alias("id"), F.col("edition_id").alias("editionId"), "title").agg(F.sort_array(F.collect_set("witness_id")).alias("witnessIds"), F.min(language).alias("language"))
    witness = wide.groupBy(F.col("witness_id").alias("id"), F.col("document_id").alias("documentId")).agg(F.min(language).alias("language"), F.array_join(F.transform(F.sort_array(F.collect_set(F.struct("ordinal", text.alias("t")))), lambda s: s["t"]), "\n\n").alias("text"), F.min("storage_key").alias("rawPath"), F.min("artifact_sha256").alias("rawSha256"))
    assessments = catalogue.table("rights_assessment")
    return {
        "documents": documents.select(v, "id", "editionId", "title", "language", "witnessIds"),
        "witnesses": witness.select(v, "id", "documentId", "language", "text", "rawPath", "rawSha256"),
        "passages": wide.groupBy(F.col("passage_id").alias("id"), F.col("document_id").alias("documentId"), F.col("witness_id").alias("witnessId"), "ordinal").agg(F.min(text).alias("text"), F.min(F.when(F.col("quoted_text").isNull(), NO_TRANSCRIPT)).alias("contentStatus"), F.min(F.when(F.col("quoted_text").isNull(), F.struct("selector.type", F.col("selector.start").alias("startSeconds"), F.col("selector.end").alias("endSeconds")))).alias("selector")).select(v, "id", "documentId", "witnessId", "ordinal", "text", "contentStatus", "selector"),
        "representations": wide.select(v, F.col("representation_id").alias("id"), F.col("witness_id").alias("witnessId"), F.col("representation_kind").alias("kind"), F.col("representation_language").alias("language"), F.col("artifact_id").alias("artifactId"), F.concat(F.lit("artifacts/"), "storage_key").alias("artifactPath"), F.col("artifact_sha256").alias("artifactSha256"), F.col("byte_length").alias("byteLength"), F.col("media_type").alias("mediaType")).distinct(),
        "derivations": publish_derivations(catalogue, outputs=wide.select(F.col("representation_id").alias("id"))),
        "rights": assessments.select(v, "id", F.col("subject").alias("subjectId"), F.col("evidence").alias("evidenceArtifactId"), F.col("review_state").alias("reviewState"), *[F.col(c).alias(field) for _, _, field, c in rights.USES], F.col("rights_source").alias("source"), F.col("attribution_text").alias("attribution"), "jurisdiction", F.col("reviewed_on").alias("reviewedOn"), F.col("statement_uri").alias("statementUri"), F.col("controlled_status").alias("controlledStatus")),
    }


def prospective_gaps(catalogue: Catalogue | Frames, members: DataFrame) -> DataFrame:
    """Rights gaps that a release with these members (release, member) would have. Nothing is written."""
    return rights.catalogue_gaps(members, catalogue.table("resource"), catalogue.table("rights_assessment"))


def file_gates(records: Mapping[str, DataFrame]) -> dict[str, Any]:
    """What the gates say of release records alone: gaps in rights by use, and translations by what they may be used for. Small
    numbers only; a validator derives them again from the files."""
    spark = records["representations"].sparkSession
    captures = records["captures"] if "captures" in records else spark.createDataFrame([], "rawSha256 string")
    gaps = rights.gap_counts(rights.release_gaps(captures, records["representations"], records["rights"]))
    out: dict[str, Any] = {"rights": {r["use_case"]: r["n"] for r in gaps.collect()}}
    if "translations" in records:
        t = records["translations"]
        machine = t["producerClass"].startswith("machine") & t["reviewStatus"].eqNullSafe(F.lit("unreviewed"))
        row = t.agg(F.count("*").alias("total"), F.count_if(F.coalesce(machine, F.lit(False))).alias("unreviewedMachine"), F.count_if(~translation.reviewed(t["reviewStatus"])).alias("languageSensitiveGaps")).first()
        out["translations"] = row.asDict()
    return out


def gate_report(records: dict[str, DataFrame], gaps: DataFrame, counts: Mapping[str, int] | None = None) -> dict[str, Any]:
    """Counts of records, rights gaps of the catalogue's members, and the gates of the records; small numbers only. counts: the records' numbers where they are known."""
    return {"counts": dict(counts) if counts is not None else {k: df.count() for k, df in sorted(records.items())}, "gaps": {r["use_case"]: r["n"] for r in rights.gap_counts(gaps).collect()}, "files": file_gates(records)}


def write_release(records: dict[str, DataFrame], root: str | Path, version: str, gaps: DataFrame, apart: Sequence[str | Path] = ()) -> dict[str, Any]:
    """Ordered JSONL files (the folder must be one that executors share), the gate report, and the manifest last. The folder must not exist, nor overlap this package's own folder
    or one of `apart` (the catalogue's, a repository's); gaps in evidence use stop it."""
    root = Path(root)
    require_apart(root, Path(__file__).resolve().parents[2], *apart)
    if root.exists():
        raise ReleaseError(f"{root} exists")
    rights.require_publishable(gaps)
    counts = {kind: write_file(df, root / f"{kind}.jsonl", *ORDER.get(kind, ("id",)), collated=kind in COLLATED) for kind, df in records.items()}
    report = gate_report(records, gaps, counts)
    (root / "gates.json").write_text(json.dumps(report, indent=2, sort_keys=True) + "\n", encoding="utf-8")
    return build_manifest(root, version, counts=counts)


def slice_faults(passages: DataFrame, expected: Mapping[str, int], recordings: Sequence[str] = ()) -> DataFrame:
    """(check, key, detail): collections, told by the beginning of passage ids, that have another number of passages than expected, and
    passages of recordings that claim a text, or don't say from where to where they are heard (from 0 on)."""
    spark = passages.sparkSession
    told = spark.createDataFrame(list(expected.items()) or [("", 0)], "kind string, n long").where("kind <> ''")
    kind = F.coalesce(*[F.when(F.startswith("id", F.lit(p)), F.lit(p)) for p in expected], F.lit(None).cast("string"))
    counted = passages.select(kind.alias("kind")).where("kind IS NOT NULL").groupBy("kind").agg(F.count("*").alias("n"))
    checks = [expectations.declared_counts(told, counted, "slice-count")]
    if recordings:
        heard = passages.where(F.col("id").rlike("^(?:" + "|".join(map(re.escape, recordings)) + ")"))
        span = F.col("selector")
        good = F.col("contentStatus").eqNullSafe(F.lit(NO_TRANSCRIPT)) & span["type"].eqNullSafe(F.lit("AudioTimeSelector")) & F.coalesce((span["startSeconds"] == 0) & (span["endSeconds"] > 0), F.lit(False))
        checks.append(expectations.holds(heard, "recording-text", good, "id"))
    return expectations.all_of(*checks)


def validate_release(spark: SparkSession, root: str | Path, expected: Mapping[str, int] | None = None, recordings: Sequence[str] = ()) -> DataFrame:
    """Everything derived again from the files alone: violations as (check, key, detail). expected, recordings: see slice_faults."""
    root = Path(root)
    manifest = check_manifest((root / "manifest.json").read_bytes())
    checks: list[DataFrame] = []
    listed = spark.createDataFrame([(a["path"], a["byteLength"], a["sha256"]) for a in manifest["artifacts"]], "path string, n long, sha256 string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"file://{root.resolve()}").select(F.expr(f"substring(regexp_replace(path, '^file:/*', '/'), {len(str(root.resolve())) + 2})").alias("p"), F.length("content").cast("long").alias("m"), F.sha2("content", 256).alias("s")).where("p <> 'manifest.json'")
    empty = [(p.relative_to(root).as_posix(), 0, hashlib.sha256().hexdigest()) for p in root.rglob("*") if p.is_file() and not p.stat().st_size]  # which Spark's scan leaves out
    files = files.where("m > 0").unionAll(spark.createDataFrame(empty, files.schema))
    differ = listed.join(files, listed.path == files.p, "full").where("path IS NULL OR p IS NULL OR n <> m OR sha256 <> s")
    checks.append(differ.select(F.lit("file").alias("check"), F.coalesce("path", "p").alias("key"), F.lit("missing, unlisted or changed").alias("detail")))
    t = {k: read_jsonl(spark, f"file://{root.resolve()}/{k}.jsonl", RECORDS[k]) for k in KINDS if (root / f"{k}.jsonl").exists()}
    for kind, df in t.items():
        if kind in ORDER:
            continue
        checks += [expectations.unique(df, f"{kind}-id", "id"), expectations.present(df, f"{kind}-no-id", "id", "id"), expectations.holds(df, f"{kind}-id-shape", F.col("id").rlike(r"^fa:[a-z-]+:"), "id")]
    actual = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in t.items()]
    declared = spark.createDataFrame(list(manifest.get("counts", {}).items()) or [("none", 0)], "kind string, n long")
    counted = actual[0]
    for a in actual[1:]:
        counted = counted.unionAll(a)
    checks.append(expectations.declared_counts(declared, counted, "count"))
    checks.append(expectations.references(t["witnesses"], "witness-document", ["documentId"], t["documents"], ["id"], "id"))
    checks.append(expectations.references(t["passages"], "passage-witness", ["witnessId", "documentId"], t["witnesses"], ["id", "documentId"], "id"))
    checks.append(expectations.references(t["documents"].select("id", F.explode("witnessIds").alias("w")), "document-witness", ["w"], t["witnesses"], ["id"], "id"))
    checks.append(expectations.references(t["representations"], "representation-witness", ["witnessId"], t["witnesses"], ["id"], "id"))
    known = t["representations"].select("id").union(t["representations"].select("artifactId")).union(t["rights"].select("evidenceArtifactId")).union(t["derivations"].select(F.explode("outputIds")))
    ends = t["derivations"].select("id", F.explode("outputIds").alias("o"))
    checks.append(expectations.references(ends, "derivation-output", ["o"], t["representations"], ["id"], "id"))
    checks.append(expectations.references(t["rights"], "rights-subject", ["subjectId"], known, ["id"], "id"))
    dated = t["rights"].where("reviewedOn IS NOT NULL")
    checks.append(expectations.holds(dated, "rights-date", is_iso_date(F.col("reviewedOn")), "id"))
    passages = t["passages"]
    checks.append(slice_faults(passages, expected or {}, recordings))
    # where passages say where they stand, they must cover their witness in order, with the text that stands there
    spans = passages.where("characterStart IS NOT NULL").select(F.col("witnessId").alias("owner"), F.col("id").alias("key"), F.col("characterStart").alias("start"), F.col("characterEnd").alias("end"), F.col("text").alias("said"))
    texts = t["witnesses"].select(F.col("id").alias("owner"), "text").join(spans.select("owner").distinct(), "owner", "left_semi")
    checks.append(expectations.sweep(spans, texts))
    quoted = spans.join(texts, "owner").where("NOT (said <=> substring(text, start + 1, end - start))")
    checks.append(quoted.select(F.lit("span-text").alias("check"), "key", F.concat_ws("-", "start", "end").alias("detail")))
    held = t["representations"].where("artifactId LIKE 'fa:artifact:sha256-%' AND artifactId <> concat('fa:artifact:sha256-', artifactSha256)")
    checks.append(held.select(F.lit("representation-bytes").alias("check"), F.col("id").alias("key"), F.col("artifactSha256").alias("detail")))
    sources = [t[k].select("id") for k in ("captures", "source-items", "representations") if k in t] + [t["representations"].select("artifactId"), t["rights"].select("evidenceArtifactId")]
    if "captures" in t:
        sources.append(t["captures"].select(F.concat(F.lit("fa:artifact:sha256-"), "rawSha256").alias("id")))
        checks.append(expectations.references(t["derivations"].select("id", F.explode("inputIds").alias("i")), "derivation-input", ["i"], reduce(DataFrame.unionAll, sources), [sources[0].columns[0]], "id"))
    checks.append(expectations.holds(t["derivations"], "derivation-ends", (F.size("inputIds") > 0) & (F.size("outputIds") > 0), "id"))
    report = json.loads((root / "gates.json").read_text(encoding="utf-8")) if (root / "gates.json").exists() else {}
    found = {f"{part}.{k}": n for part, own in file_gates(t).items() for k, n in own.items()}
    said = {f"{part}.{k}": n for part, own in report.get("files", {}).items() for k, n in own.items()}
    differ = [("gate-report", k, f"{said.get(k)}/{found.get(k)}") for k in sorted(found.keys() | said.keys()) if said.get(k) != found.get(k)]
    differ += [("gate-report", f"counts.{k}", f"{report.get('counts', {}).get(k)}/{n}") for k, n in manifest.get("counts", {}).items() if report.get("counts", {}).get(k) != n]
    checks.append(spark.createDataFrame(differ, "check string, key string, detail string"))
    blocked = found.get(f"rights.{rights.BLOCKING}", 0)
    checks.append(spark.createDataFrame([("publication", rights.BLOCKING, str(blocked))] * bool(blocked), "check string, key string, detail string"))
    if "captures" in t:
        checks.append(expectations.references(t["editions"], "edition-capture", ["captureId"], t["captures"], ["id"], "id"))
        checks.append(expectations.references(t["documents"], "document-edition", ["editionId"], t["editions"], ["id"], "id"))
        made = t["documents"].select("id").union(t["witnesses"].select("id")).union(t["passages"].select("id"))
        checks.append(expectations.references(t["lineage"], "lineage-output", ["outputId"], made, ["id"], "outputId"))
        checks.append(expectations.references(made, "no-lineage", ["id"], t["lineage"], ["outputId"], "id"))
        checks.append(expectations.references(t["lineage"].select("outputId", F.explode("inputIds").alias("i")), "lineage-input", ["i"], t["captures"], ["id"], "outputId"))
        checks.append(expectations.references(t["lineage"].select("outputId", "rawSha256"), "lineage-bytes", ["rawSha256"], t["captures"], ["rawSha256"], "outputId"))
    if "translations" in t:
        gaps = translation.translation_gaps(t["translations"], t["representations"], t["derivations"], t["rights"].select(F.col("evidenceArtifactId").alias("id")))
        checks.append(gaps.select(F.lit("translation").alias("check"), F.col("id").alias("key"), F.concat_ws(",", "reasons").alias("detail")))
    return expectations.all_of(*checks)


__all__ = ["ReleaseSpec", "artifact_conflicts", "capture_rows", "evidence_rows", "file_gates", "gate_report", "project", "project_evidence", "prospective_gaps", "publish_derivations", "publish_translations", "release_capture_id", "require_apart", "rewrite_raw_paths", "slice_faults", "translation", "validate_release", "wide_rows", "write_release"]
