from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corvane.operators import audit
from corvane.operators.segmentation import BookSpec, sections, titles
from corvane.sources import recordings
from corvane.streaming import ingest, source


def catalogue(spark, n=27, **change):
    rows = [{"id": str(k), "section_number": str(k), "title": f"Tale {k}", "listen_url": f"https://archive.example/x/{k}.mp3", "language": "en", "playtime": str(100 + k), "readers": [{"reader_id": f"r{k}", "display_name": f"Reader {k}"}]} for k in range(1, n + 1)]
    for k, v in change.items():
        rows[4][k] = v
    book = {"id": "1", "title": "B", "language": "English", "num_sections": str(n), "url_text_source": "t", "url_librivox": "l", "sections": rows}
    return spark.createDataFrame([{"books": [book]}], recordings.BOOKS)


def lock(spark, n=27):
    return spark.createDataFrame([(str(k), k, f"Tale {k}", f"r{k}", f"Reader {k}", 100.0 + k, f"{k}.mp3", "0" * 64, 1) for k in range(1, n + 1)], recordings.LOCKED)


def test_sections_against_lock(spark):
    good = recordings.sections(catalogue(spark), "1")
    assert good.count() == 27 and good.agg(F.sum("duration")).first()[0] == sum(100 + k for k in range(1, 28))
    assert recordings.against_lock(good, lock(spark)).collect() == []
    for change, check in (({"title": "Other"}, "section-title"), ({"playtime": "1"}, "section-duration"), ({"readers": []}, "section-readers"), ({"section_number": "x"}, "section-section_number")):
        assert check in {r["check"] for r in recordings.against_lock(recordings.sections(catalogue(spark, **change), "1"), lock(spark)).collect()}
    assert {r["key"] for r in recordings.against_lock(recordings.sections(catalogue(spark, 26), "1"), lock(spark)).where("check = 'section-id'").collect()} == {"27"}


def test_addresses_and_metadata(spark):
    rows = spark.createDataFrame([("https://archive.example/download/x/1.mp3",), ("http://archive.example/download/x/1.mp3",), ("https://evil.example/x",), ("https://archive.example/download/xy",), (None,)], "u string")
    got = [r["ok"] for r in rows.coalesce(1).select(recordings.approved_uri(F.col("u"), ("archive.example",), "x").alias("ok")).collect()]
    assert got == [True, False, False, False, False]
    row = spark.createDataFrame([("<metadata><identifier>x</identifier><licenseurl>https://l</licenseurl></metadata>",)], "m string").select(recordings.archive_metadata(F.col("m")).alias("m")).first()["m"]
    assert (row["identifier"], row["license"]) == ("x", "https://l")


def lines(a, b):
    return "".join(json.dumps({"externalKey": f"k{i}", "n": "é" * (i % 9)}) + "\n" + "\n" * (i % 5 == 0) for i in range(a, b))


def test_adapter_stream_is_bounded_and_resumes(spark, tmp_path):
    path = tmp_path / "items.jsonl"
    path.write_text(lines(0, 100))
    c, check = ingest.Catalogue(spark, f"file://{tmp_path}/catalogue"), f"file://{tmp_path}/check"
    opened = lambda: source.open_items(spark, check, "corvane.streaming.source:JsonLinesAdapter", str(path), batch=10, slice_=3).select(F.col("external_key").alias("item_key"), F.sha2("body", 256).alias("digest"))
    sizes, answers = [], iter([False] * 5 + [True])
    count = lambda b: sizes.append(b.count()) or b.limit(0)
    with pytest.raises(Exception, match="r"):
        ingest.ingest(c, opened(), "r", check, validate=count, stop=lambda: next(answers), bounded=True)
    assert sizes == [10] * 5 and c.items().count() == 50 and c.status("r") == ingest.PAUSED
    assert source.planned_place(spark, check)["item"] == 60  # the batch that was stopped comes again
    assert ingest.ingest(c, opened(), "r", check, validate=count, bounded=True) == 50
    assert sizes == [10] * 10 and c.items().count() == 100 and c.status("r") == ingest.COMPLETED
    with path.open("a") as f:
        f.write(lines(100, 115) + '{"externalKey": "half')
    assert ingest.ingest(c, opened(), "r", check, validate=count, bounded=True) == 15 and sizes[10:] == [10, 5]
    assert ingest.ingest(c, opened(), "r", check, validate=count, bounded=True) == 0
    assert {r["item_key"] for r in c.items().collect()} == {f"k{i}" for i in range(115)}


class Counted(source.JsonLinesAdapter):
    """Counts the bytes it reads."""

    read_bytes = 0

    def _records(self, f, at, stop=None):
        own = self

        class File:
            seek, tell = staticmethod(f.seek), staticmethod(f.tell)

            @staticmethod
            def read(n):
                data = f.read(n)
                own.read_bytes += len(data)
                return data

        return super()._records(File, at, stop)


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_slices_seek(tmp_path, block):
    path = tmp_path / "items.jsonl"
    path.write_text(lines(0, 5000))
    adapter = Counted(str(path))
    adapter.block = block
    places = [adapter.first()]
    while (to := adapter.after(places[-1], 700)) != places[-1]:
        places.append(to)
    assert [p["item"] for p in places] == [*range(0, 5000, 700), 5000] and places[-1]["byte"] <= path.stat().st_size
    adapter.read_bytes = 0
    found = [x["external_key"] for x in adapter.read(places[3], places[4], source.Context(None))]
    assert found == [f"k{i}" for i in range(2100, 2800)] and adapter.read_bytes == places[4]["byte"] - places[3]["byte"]


def test_context_holds_what_was_captured(tmp_path):
    context = source.Context(f"file://{tmp_path}/store")
    handle = context.capture("a", "é".encode(), "text/plain")
    assert context.read_text(handle) == "é" and context.capture("a", "é".encode(), "text/plain") == handle
    with pytest.raises(ValueError, match="other bytes"):
        context.capture("a", b"x", "text/plain")
    with pytest.raises(source.NotCaptured):
        context.read_text(handle | {"key": "b"})
    with pytest.raises(source.NotCaptured):
        source.Context(f"file://{tmp_path}/store").read_text(handle)
    with pytest.raises(source.NotCaptured):
        source.Context(None).capture("a", b"", "text/plain")
    (tmp_path / "store" / "sha256" / handle["sha256"][:2] / handle["sha256"]).write_bytes(b"e")
    with pytest.raises(ValueError, match="changed"):
        context.read_text(handle)


BODY = "a line of the tale that is long enough to be kept. " * 10


def book(toc, body, start="THE TALES", end="*** END OF"):
    return f"Front\nCONTENTS\n{toc}\n{start}\n\n{body}\n{end} THIS\nlicence"


@pytest.mark.parametrize(("mode", "toc", "want"), [
    ("uppercase-lines", "FIRST TALE\nFIRST TALE\n12. NO\nCONTENTS LIST\nsecond tale\nSECOND-TALE!\n", ["FIRST TALE", "SECOND-TALE!"]),
    ("indented-titlecase", "   First Tale\n  not this\n   Second Tale\n", ["First Tale", "Second Tale"]),
    ("roman-lines", "I. FIRST TALE\nXIV. SECOND TALE\n", ["FIRST TALE", "SECOND TALE"]),
    ("roman-paragraph", "I. First Tale. II. Second\nTale III. Third", ["First Tale", "Second Tale", "Third"]),
])
def test_titles(spark, mode, toc, want):
    books = spark.createDataFrame([("b", book(toc, "x"))], "book_id string, text string")
    found = titles(books, BookSpec("CONTENTS", "THE TALES", mode)).orderBy("ordinal").collect()
    assert [r["title"] for r in found] == want and [r["ordinal"] for r in found] == list(range(1, len(want) + 1))


def test_sections(spark):
    text = book("FIRST TALE\nSKIPPED\nSECOND TALE\nTHIRD TALE\n", f"First tale\n\n{BODY}\n\n\n\nmore\n\nsecond, TALE\nshort\n\nTHE THIRD ONE\n{BODY}\n\nSKIPPED\nFIRST TALE\nagain")
    books = spark.createDataFrame([("b", text)], "book_id string, text string")
    spec = BookSpec("CONTENTS", "THE TALES", "uppercase-lines", skipped_headings=("Skipped",), heading_aliases={"THE THIRD ONE": "THIRD TALE"})
    got = sections(books, spec, titles(books, spec)).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["title"]) for r in got] == [(1, "FIRST TALE"), (4, "THIRD TALE")]
    assert got[0]["text"] == f"{BODY}\n\nmore" or got[0]["text"] == f"{BODY.strip()} \n\nmore".replace(" \n", " \n")
    assert text[got[0]["start"] :].startswith("First tale") and text[got[0]["end"] :].startswith("second, TALE") and text[got[1]["start"] :].startswith("THE THIRD ONE")


def test_audit_row(spark):
    row = spark.createDataFrame([(1, "a")], "n long, s string")
    assert audit.require_row(row, {"n": 1})["s"] == "a"
    with pytest.raises(audit.AuditError, match="n: expected 2"):
        audit.require_row(row, {"n": 2})
