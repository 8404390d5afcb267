"""The translation contract: reasons why a translation can't be used, in fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reason codes in the order in which they are reported.
REASONS = (
    "duplicate-translation-representation",
    "source-equals-translation",
    "missing-translation-representation",
    "missing-source-representation",
    "missing-translation-derivation",
    "missing-review-evidence",
)


def reviewed(status: Column) -> Column:
    """Only an accepted review supports uses that depend on the language."""
    return status.eqNullSafe(F.lit("accepted"))


def translation_gaps(translations: DataFrame, representations: DataFrame, derivations: DataFrame, manifest_artifacts: DataFrame) -> DataFrame:
    """(id, reasons) of translations with at least one reason.

    translations: id, translationRepresentationId, sourceRepresentationId, reviewStatus, reviewedById, reviewEvidenceArtifactId.
    representations: id. derivations: type, inputIds, outputIds. manifest_artifacts: id.
    """
    known = representations.select("id").distinct()
    pairs = derivations.where("type = 'translation'").select(F.explode("inputIds").alias("sourceRepresentationId"), F.col("outputIds")).select("sourceRepresentationId", F.explode("outputIds").alias("translationRepresentationId")).distinct().withColumn("_derived", F.lit(True))
    outputs = translations.groupBy("translationRepresentationId").agg(F.count("*").alias("_outputs"))
    t = translations.join(known.select(F.col("id").alias("sourceRepresentationId"), F.lit(True).alias("_source")), "sourceRepresentationId", "left")
    t = t.join(known.select(F.col("id").alias("translationRepresentationId"), F.lit(True).alias("_target")), "translationRepresentationId", "left")
    t = t.join(pairs, ["sourceRepresentationId", "translationRepresentationId"], "left").join(outputs, "translationRepresentationId", "left")
    evidence = F.col("reviewEvidenceArtifactId")
    # most have no evidence: a key of their own keeps those rows from meeting in one task
    t = t.withColumn("_key", F.coalesce(evidence, F.concat(F.lit("none:"), "id"))).join(manifest_artifacts.select(F.col("id").alias("_key"), F.lit(True).alias("_evidence")).distinct(), "_key", "left")
    bad = (
        F.col("_outputs") > 1,
        F.col("translationRepresentationId") == F.col("sourceRepresentationId"),
        F.col("_target").isNull(),
        F.col("_source").isNull(),
        F.col("_derived").isNull(),
        evidence.isNotNull() & (evidence != "") & F.col("_evidence").isNull(),
    )
    reasons = F.array_compact(F.array(*[F.when(b, F.lit(r)) for b, r in zip(bad, REASONS, strict=True)]))
    return t.select("id", reasons.alias("reasons")).where(F.size("reasons") > 0)
