"""Recordings: a catalogue of sections against the lock that pins it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.expectations import all_of, holds

BOOKS = "books array<struct<id:string,title:string,language:string,num_sections:string,url_text_source:string,url_librivox:string,sections:array<struct<id:string,section_number:string,title:string,listen_url:string,language:string,playtime:string,readers:array<struct<reader_id:string,display_name:string>>>>>>"
LOCKED = "id string, section_number int, title string, reader_id string, reader_name string, duration double, path string, sha256 string, byte_length long"


def sections(catalogue: DataFrame, book_id: str) -> DataFrame:
    """One row per section of a book, in order: place, id, number, title, reader, seconds, address."""
    book = catalogue.select(F.explode("books").alias("b")).where(F.col("b.id") == book_id)
    s = book.select(F.col("b.language").alias("book_language"), F.posexplode("b.sections").alias("place", "s"))
    reader = F.get("s.readers", 0)
    return s.select("place", F.col("s.id").alias("id"), F.col("s.section_number").try_cast("int").alias("section_number"), F.col("s.title").alias("title"), reader["reader_id"].alias("reader_id"), reader["display_name"].alias("reader_name"), F.size("s.readers").alias("n_readers"), F.col("s.playtime").try_cast("double").alias("duration"), F.col("s.listen_url").alias("uri"))


def against_lock(found: DataFrame, lock: DataFrame) -> DataFrame:
    """Violations: sections that differ from the lock's at the same place, or stand on one side only."""
    want = lock.withColumn("place", F.col("section_number") - 1).select("place", *[F.col(c).alias(f"want_{c}") for c in ("id", "section_number", "title", "reader_id", "duration")])
    both = found.join(want, "place", "full").withColumn("key", F.coalesce("id", "want_id"))
    same = lambda c: F.col(c).eqNullSafe(F.col(f"want_{c}"))
    return all_of(*[holds(both, f"section-{c}", same(c), "key") for c in ("id", "section_number", "title", "reader_id", "duration")], holds(found, "section-readers", F.col("n_readers") == 1, "id"))


def approved_uri(uri: Column, hosts: tuple[str, ...], identifier: str) -> Column:
    """An https address on one of the hosts with the identifier as a path segment."""
    host, path = F.parse_url(uri, F.lit("HOST")), F.parse_url(uri, F.lit("PATH"))
    return F.coalesce(uri.startswith("https://") & host.isin(*hosts) & F.array_contains(F.split(path, "/"), identifier), F.lit(False))


def archive_metadata(xml: Column) -> Column:
    """Identifier and licence of an archive's metadata record."""
    return F.struct(F.xpath_string(xml, F.lit("/metadata/identifier")).alias("identifier"), F.xpath_string(xml, F.lit("/metadata/licenseurl")).alias("license"))
