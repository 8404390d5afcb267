"""What belongs to a release: the part of a catalogue that its chosen representations need, and nothing else.

The choice is made by archive and kind of representation. From there the closure goes up to witnesses, documents and
editions, down to passages, and back through derivations to captures, source items and the rights that govern them. Each
step is a semi-join on keys; each selected table is written once to the shared folder, so the projections that follow
read small tables and none repeats the choice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import kept
from .catalogue import Catalogue, Frames

#: Archive to the kinds of its representations that are released.
Rules = Mapping[str, Sequence[str]]


def _ids(rows: DataFrame, *cols: str) -> DataFrame:
    """(id) of some columns, without nulls."""
    return reduce(DataFrame.unionAll, (rows.select(F.col(c).alias("id")) for c in cols)).where("id IS NOT NULL").distinct()


def _among(rows: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    return rows.join(ids.withColumnRenamed("id", "_id"), F.col(col) == F.col("_id"), "left_semi")


def chosen_representations(catalogue: Catalogue | Frames, rules: Rules) -> DataFrame:
    """Representations of the kinds that the rules release for their archive: that of the source item which their document's edition
    was captured from. Equal bytes are one artifact, whichever archives hold them, so the artifacts that a derivation takes in
    say nothing about the archive of its outputs. Only where the catalogue records no captured edition does the archive of
    a capture count that a derivation of the representation takes in, as the capture itself or as its artifact."""
    captures = catalogue.table("capture").join(catalogue.table("source_item").select(F.col("id").alias("source_item_id"), "archive_id"), "source_item_id")
    of_editions = catalogue.table("edition").select(F.col("id").alias("edition_id"), F.col("capture_id")).join(captures.select(F.col("id").alias("capture_id"), "archive_id"), "capture_id")
    of_documents = catalogue.table("document").select(F.col("id").alias("document_id"), "edition_id").join(of_editions, "edition_id").select("document_id", "archive_id")
    of_witnesses = catalogue.table("witness").select(F.col("id").alias("witness_id"), "document_id").join(of_documents, "document_id").select("witness_id", "archive_id")
    sources = captures.select(F.col("id").alias("input_id"), "archive_id").unionAll(captures.select(F.col("artifact_id").alias("input_id"), "archive_id")).distinct()
    outputs = catalogue.table("derivation_output").select("derivation_id", F.col("output_id").alias("id"))
    made = outputs.join(catalogue.table("derivation_input").select("derivation_id", "input_id"), "derivation_id").join(sources, "input_id").select("id", "archive_id")
    allowed = reduce(lambda a, b: a | b, ((F.col("archive_id") == archive) & F.col("kind").isin(*kinds) for archive, kinds in rules.items()), F.lit(False))
    found = catalogue.table("representation")
    placed = found.join(of_witnesses, "witness_id", "left").select(*found.columns, "archive_id")
    by_edition = placed.where(F.col("archive_id").isNotNull() & allowed).select(*found.columns)
    by_capture = placed.where("archive_id IS NULL").drop("archive_id").join(made, "id").where(allowed).select(*found.columns)
    return by_edition.unionAll(by_capture).distinct()


def released(catalogue: Catalogue | Frames, rules: Rules) -> Frames:
    """The release's part of a catalogue. A derivation belongs to it if one of its outputs is released, and then with all its inputs
    and outputs; rights do if their own record, their subject and their evidence are resources, and the subject is a
    released representation or artifact; captures if a derivation or an assessment rests on them."""
    table = catalogue.table
    resources = table("resource").select("id").distinct()
    reps = kept(chosen_representations(catalogue, rules), "representation")
    witnesses = kept(_among(table("witness"), "id", _ids(reps, "witness_id")), "witness")
    documents = kept(_among(table("document"), "id", _ids(witnesses, "document_id")), "document")
    quotes = kept(_among(table("passage_representation"), "representation_id", _ids(reps, "id")), "passage_representation")
    outputs = table("derivation_output")
    chosen = kept(_ids(_among(outputs, "output_id", _ids(reps, "id")), "derivation_id"), "chosen")
    inputs = kept(_among(table("derivation_input"), "derivation_id", chosen), "derivation_input")
    rights = _among(_among(_among(table("rights_assessment"), "id", resources), "subject", resources), "evidence", resources)
    captures = table("capture")
    used = _ids(inputs, "input_id")
    taken = captures.where("artifact_id IS NOT NULL OR id IS NOT NULL")
    taken = _among(taken, "id", used).unionAll(_among(taken, "artifact_id", used)).distinct()
    governed = _ids(reps, "id", "artifact_id").union(_ids(taken, "artifact_id")).distinct()
    rights = kept(_among(rights, "subject", governed), "rights_assessment")
    taken = kept(taken.unionAll(_among(captures, "artifact_id", _ids(rights, "evidence"))).distinct(), "capture")
    artifacts = _ids(reps, "artifact_id").union(_ids(taken, "artifact_id")).union(_ids(rights, "evidence")).union(used).distinct()
    either = _ids(reps, "id")
    translations = table("translation")
    return Frames(
        catalogue.spark,
        resource=table("resource"), representation=reps, witness=witnesses, document=documents, passage_representation=quotes, derivation_input=inputs, rights_assessment=rights, capture=taken,
        edition=_among(table("edition"), "id", _ids(documents, "edition_id")),
        passage=kept(_among(table("passage"), "id", _ids(quotes, "passage_id")), "passage"),
        derivation=kept(_among(table("derivation"), "id", chosen), "derivation"),
        derivation_output=kept(_among(outputs, "derivation_id", chosen), "derivation_output"),
        source_item=kept(_among(table("source_item"), "id", _ids(taken, "source_item_id")), "source_item"),
        artifact=kept(_among(table("artifact"), "id", artifacts), "artifact"),
        translation=_among(translations, "translation_id", either).union(_among(translations, "source_id", either)).distinct(),
    )


def evidence_captures(catalogue: Catalogue | Frames) -> DataFrame:
    """What rights rest on, one row for each capture of an evidence artifact: artifact_id, sha256, byte_length, media_type,
    storage_key, capture_id, native_id, archive_id, landing_uri, retrieval_uri."""
    a, c, i = (catalogue.table(t) for t in ("artifact", "capture", "source_item"))
    rows = _among(a, "id", _ids(catalogue.table("rights_assessment"), "evidence")).withColumnRenamed("id", "artifact_id")
    rows = rows.join(c.select(F.col("id").alias("capture_id"), "artifact_id", "source_item_id", "retrieval_uri"), "artifact_id")
    rows = rows.join(i.select(F.col("id").alias("source_item_id"), "native_id", "archive_id", "landing_uri"), "source_item_id")
    return rows.select("artifact_id", "sha256", "byte_length", "media_type", "storage_key", "capture_id", "native_id", "archive_id", "landing_uri", "retrieval_uri").distinct()


def archive_artifacts(catalogue: Catalogue | Frames, archive: str, but: str) -> DataFrame:
    """Artifacts captured from one archive, but for one of its items (by native id): id and metadata, each once."""
    items = catalogue.table("source_item").where((F.col("archive_id") == archive) & (F.col("native_id") != but))
    return _among(catalogue.table("artifact"), "id", _ids(_among(catalogue.table("capture"), "source_item_id", _ids(items, "id")), "artifact_id")).distinct()
