"""Scans of record files, books and pinned captures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_STR = "string"
#: Fixed schemas of release records by kind.
RECORDS: dict[str, str] = {
    "captures": "schemaVersion string, id string, sourceId string, capturedAt string, institution string, landingPage string, retrievalUrl string, rawPath string, rawSha256 string, byteLength long, sourceUrl string, mediaType string",
    "editions": "schemaVersion string, id string, captureId string, title string, language string, author string, editor string",
    "documents": "schemaVersion string, id string, editionId string, title string, language string, captureId string, sourceOrdinal int, witnessIds array<string>",
    "witnesses": "schemaVersion string, id string, documentId string, language string, text string, rawPath string, rawSha256 string",
    "passages": "schemaVersion string, id string, documentId string, witnessId string, ordinal int, text string, characterStart int, characterEnd int, contentStatus string, selector struct<type: string, startSeconds: double, endSeconds: double>",
    "lineage": "schemaVersion string, outputId string, outputKind string, inputIds array<string>, method string, methodVersion string, rawSha256 string",
    "splits": "schemaVersion string, splitId string, documentId string, groupId string, split string",
    "aliases": "schemaVersion string, kind string, alias string, targetId string, reason string",
    "source-items": "schemaVersion string, id string, archiveId string, nativeId string, landingUri string, metadata variant",
    "representations": "schemaVersion string, id string, witnessId string, kind string, language string, artifactId string, artifactPath string, artifactSha256 string, byteLength long, mediaType string, derivationId string",
    "derivations": "schemaVersion string, id string, type string, method string, methodVersion string, deterministic boolean, inputIds array<string>, outputIds array<string>",
    "translations": "schemaVersion string, id string, translationRepresentationId string, sourceRepresentationId string, producerClass string, reviewStatus string, reviewedById string, reviewEvidenceArtifactId string",
    "rights": "schemaVersion string, id string, subjectId string, source string, attribution string, evidenceUseAllowed boolean, quotationAllowed boolean, redistributionAllowed boolean, accessPrivateUseAllowed boolean, mlEvaluationAllowed boolean, mlTrainingAllowed boolean, jurisdiction string, reviewedOn string, reviewState string, evidenceArtifactId string, statementUri string, controlledStatus string",
}


class PinnedSourceError(ValueError):
    pass


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One record per line with a fixed schema; blank lines are skipped, malformed ones stop the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, text) of raw books: UTF-8 without carriage returns; content keeps the captured bytes."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select("path", "content", F.regexp_replace(F.decode("content", "UTF-8"), "\r", "").alias("text"))


def read_pinned(spark: SparkSession, root: str, lock: DataFrame) -> DataFrame:
    """Captured files that a lock names, with all mismatches before anything is used.

    lock: sourcePath, sha256, byteLength. Result: sourcePath, content, sha256, byteLength, problem (null if the file is as
    pinned).
    """
    root = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.regexp_extract("path", "^(?:[a-z]+:/*)?(/.*)$", 1).alias("_p"), "content", "length")
    files = files.withColumn("_rel", F.expr(f"substring(_p, length('{root}/') + 1)"))
    joined = lock.join(files, F.col("sourcePath") == F.col("_rel"), "left")
    problem = (
        F.when(~F.coalesce(F.col("sha256").rlike(r"^[0-9a-f]{64}\z"), F.lit(False)), "expected digest is missing")
        .when(F.coalesce(F.col("byteLength"), F.lit(-1)) < 0, "expected length is missing")
        .when(F.col("content").isNull(), "file is missing")
        .when(F.col("length") != F.col("byteLength"), "length differs")
        .when(F.sha2("content", 256) != F.col("sha256"), "digest differs")
    )
    return joined.select("sourcePath", "content", "sha256", "byteLength", problem.alias("problem"))


def require_pinned(files: DataFrame) -> DataFrame:
    if bad := files.where("problem IS NOT NULL").select("sourcePath", "problem").take(10):
        raise PinnedSourceError("; ".join(f"{r['sourcePath']}: {r['problem']}" for r in bad))
    return files.drop("problem")


def lock_table(spark: SparkSession, sources: Mapping[str, Mapping[str, object]]) -> DataFrame:
    rows = [(k, str(v["uri"]), str(v["sourcePath"]), str(v["mediaType"]), int(v["byteLength"]), str(v["sha256"])) for k, v in sorted(sources.items())]  # type: ignore[call-overload]
    return spark.createDataFrame(rows, "sourceKey string, uri string, sourcePath string, mediaType string, byteLength long, sha256 string")
