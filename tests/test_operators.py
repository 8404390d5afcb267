from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from corvane.operators import expectations, lineage, rights, setops, translation
from corvane.sources import files, ordered, paths, sinks, xml
from corvane.streaming import ingest


def test_rights_truth_table(spark):
    cases = [(d, s, a, e) for d, s in itertools.product((True, False, None), ("accepted", "pending")) for a, e in itertools.product((True, False), repeat=2)]
    members, assessments = [], []
    for k, (d, s, a, e) in enumerate(cases):
        members += [("r", f"fa:representation:{k}")] + [("r", f"fa:rights:{k}")] * a + [("r", f"ev{k}")] * e
        assessments.append((f"fa:rights:{k}", f"fa:representation:{k}", f"ev{k}", s, d, None, None, None, None, None))
    m = spark.createDataFrame(members, "release string, member string")
    kinds = m.select(F.col("member").alias("id"), F.when(F.col("member").startswith("fa:representation"), "representation").otherwise("other").alias("kind")).distinct()
    a = spark.createDataFrame(assessments, "id string, subject string, evidence string, review_state string, " + ", ".join(f"{c} boolean" for c in rights.columns().values()))
    gaps = {(r["use_case"], r["member"]) for r in rights.catalogue_gaps(m, kinds, a).collect()}
    closed = {f"fa:representation:{k}" for k, (d, s, x, e) in enumerate(cases) if not (d is True and s == "accepted" and x and e)}
    assert {x for u, x in gaps if u == "evidence-use"} == closed
    assert all({x for u, x in gaps if u == use} == {f"fa:representation:{k}" for k in range(len(cases))} for use in list(rights.USE_CASES)[1:])
    with pytest.raises(rights.PublicationBlocked):
        rights.require_publishable(rights.catalogue_gaps(m, kinds, a))
    rights.require_publishable(rights.catalogue_gaps(m, kinds, a).where("use_case <> 'evidence-use'"))


def test_translation_reasons(spark):
    t = spark.createDataFrame([("t1", "b", "a", None), ("t2", "c", "c", "e9"), ("t3", "x", "y", "e1"), ("t4", "b", "z", None)], "id string, translationRepresentationId string, sourceRepresentationId string, reviewEvidenceArtifactId string")
    reps = spark.createDataFrame([("a",), ("b",), ("c",), ("z",)], "id string")
    der = spark.createDataFrame([("translation", ["a", "z"], ["b"]), ("normalization", ["c"], ["c"])], "type string, inputIds array<string>, outputIds array<string>")
    got = {r["id"]: r["reasons"] for r in translation.translation_gaps(t, reps, der, spark.createDataFrame([("e1",)], "id string")).collect()}
    r = translation.REASONS
    assert got == {"t1": [r[0]], "t2": [r[1], r[4], r[5]], "t3": [r[2], r[3], r[4]], "t4": [r[0]]}


def test_lineage_ends_on_cycles(spark):
    edges = spark.createDataFrame([("p", "r"), ("r", "c"), ("p", "c"), ("c", "p")], "output string, input string")
    got = {(x["start"], x["id"]) for x in lineage.ancestors(spark.createDataFrame([("p",)], "id string"), edges).collect()}
    assert got == {("p", "p"), ("p", "r"), ("p", "c")}


def test_expectations(spark):
    a = spark.createDataFrame([(1, "x", 5), (1, None, -1), (2, "y", None)], "id int, ref string, n int")
    b = spark.createDataFrame([("x",), ("z",)], "ref string")
    found = expectations.all_of(
        expectations.unique(a, "u", "id"), expectations.references(a, "f", ["ref"], b, ["ref"], "id"), expectations.holds(a, "c", F.col("n") > 0, "id"),
        expectations.present(a, "p", "ref", "id"), expectations.same_set(a.dropna(), b, "s", "ref"),
    )
    assert sorted((r["check"], r["key"]) for r in found.collect()) == [("c", "1"), ("f", "2"), ("p", "1"), ("s", "z"), ("u", "1")]
    with pytest.raises(expectations.ExpectationError):
        expectations.require(found)


def test_merges(spark):
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("l", 1, "c")], "key string, n int, v string")
    assert {(r["key"], r["v"]) for r in setops.last_wins(rows, ["key"], "n").collect()} == {("k", "b"), ("l", "c")}
    assert {(r["key"], r["v"]) for r in setops.first_wins(rows, ["key"], "v", "n").collect()} == {("k", "a"), ("l", "c")}
    assert setops.append_segments(rows, rows.select("key")).count() == 6


def volume(n):
    items = "".join(f'<ITEM nro="skvr01{i:05d}" y="18{i:02d}"><META><OSA>I1</OSA><ID>{i}.</ID><LOC>Vuo &amp;amp; k</LOC><COL>c{i}</COL></META><TEXT>{"".join(f"<{t}>line {i} {k}</{t}>" for k, t in enumerate(["V", "V"]))}</TEXT></ITEM>' for i in range(1, n + 1))
    return f"<KOKONAISUUS>{items}</KOKONAISUUS>"


def test_volume(spark):
    rows = xml.volume_poems(xml.volume_items(spark.createDataFrame([(volume(20),)], "xml string"))).orderBy("ordinal").collect()
    assert len(rows) == 20 and [r["poem_number"] for r in rows] == list(range(1, 21))
    assert rows[0]["region"] == "Vuo & k" and rows[3]["lines"][1]["source"] == "line 4 1" and rows[3]["year"] == "1804" and rows[0]["problem"] is None


RECORD = """<TEI xmlns="http://x" xml:id="skvr01100010" xml:lang="krl"><teiHeader><fileDesc><publicationStmt><idno type="electronic">skvr01100010</idno><idno type="URN">URN:N:1</idno></publicationStmt></fileDesc>
<profileDesc><langUsage><language ident="krl">Vienan  murre</language></langUsage></profileDesc></teiHeader><text><body><div><head>Poem</head><lg><l n="{a}">Prefix 1 <choice><orig>Or 1</orig><reg>Norm 1a</reg></choice> suffix</l><l n="{b}">Two</l></lg></div></body></text></TEI>"""


def test_encoded_record(spark):
    good = xml.parse_record(RECORD.format(a=1, b=2), "skvr01100010")
    assert good["problem"] is None and good["lines"][0] == {"number": 1, "source": "Prefix 1 Or 1 suffix", "normalized": "Prefix 1 Norm 1a suffix"}
    assert (good["poem_number"], good["dialect"], good["title"]) == (1, "Vienan murre", "Poem") or good["poem_number"] is not None
    for text, expected in ((RECORD.format(a=2, b=2), "skvr01100010"), (RECORD.format(a=1, b=2), "skvr01100020"), ("<TEI>", "x"), (RECORD.format(a=0, b=1), "skvr01100010")):
        assert xml.parse_record(text, expected)["problem"]
    rows = xml.encoded_records(spark.createDataFrame([("skvr01100010", RECORD.format(a=1, b=2)), ("y", None)], "electronic_id string, xml string")).collect()
    assert [r["problem"] is None for r in rows] == [True, False]


def test_pinned_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"hello")
    (tmp_path / "b.txt").write_bytes(b"changed")
    digest = "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"
    good = {"uri": "u", "sourcePath": "a.txt", "mediaType": "text/plain", "byteLength": 5, "sha256": digest}
    lock = files.lock_table(spark, {"a": good, "b": good | {"sourcePath": "b.txt"}, "c": good | {"sourcePath": "c.txt"}, "d": good | {"sha256": "0" * 64}, "e": good | {"sha256": ""}})
    got = files.read_pinned(spark, str(tmp_path), lock)
    assert sorted(r["problem"] or "" for r in got.collect()) == ["", "digest differs", "expected digest is missing", "file is missing", "length differs"]
    with pytest.raises(files.PinnedSourceError):
        files.require_pinned(got)


def test_paths(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "link").symlink_to(tmp_path)
    for bad in (".", "foo/..", "/etc/passwd", "a\\b", "", "link/x"):
        with pytest.raises(paths.UnsafePath):
            paths.resolve_safe(tmp_path / "in", bad)
    assert paths.resolve_safe(tmp_path / "in", "x/y").name == "y"
    assert paths.is_within(tmp_path, tmp_path / "in") and not paths.is_within(tmp_path / "in", tmp_path)


def test_artifacts(spark, tmp_path):
    store = sinks.ArtifactStore(spark, f"file://{tmp_path}/store")
    rows = spark.createDataFrame([(bytearray(b"one"), "t"), (bytearray(b"one"), "t"), (bytearray(b"two"), "t")], "content binary, media_type string")
    assert store.put(rows).count() == 3 and store.index().count() == 2
    store.put(rows)
    assert store.index().count() == 2 and store.damaged().count() == 0
    with pytest.raises(sinks.ReleaseError):
        store.put(spark.createDataFrame([(bytearray(b"one"), "other")], "content binary, media_type string"))


def test_archive_round_trip(spark, tmp_path):
    root = tmp_path / "release"
    ordered.write_file(spark.range(5).withColumn("text", F.lit("é")), root / "data" / "rows.jsonl", "id")
    (root / "notes.txt").write_text(sinks.rights_note())
    sinks.build_manifest(root, "0.1.0", counts={"rows": 5})
    one, two = (sinks.pack_release(root, tmp_path / k) for k in ("a", "b"))
    assert one["archiveSha256"] == two["archiveSha256"]
    assert sinks.verify_archive(one["archivePath"], one["archiveSha256"], one["manifestSha256"])["artifactCount"] == 2
    with open(one["archivePath"], "ab") as f:
        f.write(b"x")
    with pytest.raises(sinks.ReleaseError):
        sinks.verify_archive(one["archivePath"], one["archiveSha256"])
    (root / "notes.txt").write_text("changed")
    three = sinks.pack_release(root, tmp_path / "c")
    with pytest.raises(sinks.ReleaseError):
        sinks.verify_archive(three["archivePath"], three["archiveSha256"])


def items(spark, path, rows):
    spark.createDataFrame(rows, "item_key string, digest string").coalesce(1).write.mode("append").parquet(path)


def test_ingest_resumes_replays_and_refuses(spark, tmp_path):
    source, schema = f"file://{tmp_path}/source", "item_key string, digest string"
    items(spark, source, [(f"k{i}", f"d{i}") for i in range(50)])
    catalogue, run = ingest.Catalogue(spark, f"file://{tmp_path}/catalogue"), ingest.run_key("a", "1", {"b": 1, "a": 2})
    assert run == ingest.run_key("a", "1", {"a": 2, "b": 1}) and catalogue.status(run) is None
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    assert ingest.ingest(catalogue, stream(), run, f"{tmp_path}/check") == 50
    items(spark, source, [(f"k{i}", f"d{i}") for i in range(50, 100)])
    assert ingest.ingest(catalogue, stream(), run, f"{tmp_path}/check") == 50  # only what is new
    assert ingest.ingest(catalogue, stream(), run, f"{tmp_path}/fresh") == 0  # a whole replay changes nothing
    assert catalogue.items().count() == 100 and catalogue.status(run) == ingest.COMPLETED
    items(spark, source, [("k1", "other")])
    with pytest.raises(Exception, match="k1"):
        ingest.ingest(catalogue, stream(), run, f"{tmp_path}/check")
    assert catalogue.items().count() == 100 and catalogue.status(run) == ingest.FAILED


def test_invalid_items_commit_nothing(spark, tmp_path):
    source = f"file://{tmp_path}/source"
    items(spark, source, [("ok", "d"), ("Not ok", "d")])
    catalogue = ingest.Catalogue(spark, f"file://{tmp_path}/catalogue")
    stream = spark.readStream.schema("item_key string, digest string").parquet(source)
    with pytest.raises(Exception, match="Not ok"):
        ingest.ingest(catalogue, stream, "r", f"{tmp_path}/check", lambda b: b.where(~F.col("item_key").rlike("^[a-z0-9]+$")))
    assert catalogue.items().count() == 0 and catalogue.status("r") == ingest.FAILED
