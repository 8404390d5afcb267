"""Identity, digest, date and predicate functions as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

# Shapes of codes, keys, digests and ids.
SCRIPT_CODE = r"^[A-Z][a-z]{3}\z"
EXTERNAL_KEY = r"^[a-z0-9][a-z0-9._-]*\z"
SHA256 = r"^[a-f0-9]{64}\z"
COMMIT = r"^[a-f0-9]{40}\z"
DATABASE_ID = r"^fa:[a-z][a-z0-9-]*:"
RELEASE_ID = r"^fa:[a-z-]+:"
LANGUAGE_SHAPE = r"^[A-Za-z]{2,3}(?:-[A-Za-z0-9]{2,8})*\z"


def sha256_hex(x: Column) -> Column:
    return F.sha2(x, 256)


def stable_split(item_id: Column) -> Column:
    """test, validation or train, from the first 32 bits of the id's SHA-256 modulo 10."""
    bucket = F.conv(F.substring(F.sha2(item_id, 256), 1, 8), 16, 10).cast("long") % 10
    return F.when(bucket == 0, "test").when(bucket == 1, "validation").otherwise("train")


def is_iso_date(x: Column) -> Column:
    """yyyy-MM-dd and a day of the calendar; null is not."""
    return F.coalesce(x.rlike(r"^\d{4}-\d{2}-\d{2}\z") & F.try_to_date(x, "yyyy-MM-dd").isNotNull(), F.lit(False))


def iso_day(x: Column) -> Column:
    """A timestamp as its UTC day."""
    return F.date_format(x, "yyyy-MM-dd")


def reviewed_on(x: Column, kind: str) -> Column:
    """A day as text: dates and timestamps (kind date or timestamp) as their UTC day, text that is an ISO date as it stands; null
    stays null and any other text stops the job."""
    if kind in ("date", "timestamp"):
        return iso_day(x)
    return F.when(x.isNull() | is_iso_date(x), x).otherwise(F.raise_error(F.concat(F.lit("no ISO date: "), x)).cast("string"))


def digest_bytes(x: Column) -> Column:
    """A hex digest as bytes; null if it is none."""
    return F.when(x.rlike(SHA256), F.unhex(x))


def digest_hex(x: Column) -> Column:
    """Bytes as lower-case hex."""
    return F.lower(F.hex(x))


def backoff_ms(attempt: Column) -> Column:
    """Milliseconds to wait after an attempt, counted from 0: 500, 1000, 2000, ..."""
    return (F.lit(500) * F.pow(F.lit(2), attempt)).cast("long")


def icu_order(*cols: Column) -> Column:
    """Sort key: the first that is not null, in the order of the Unicode collation (`_`, `-`, `:`, digits, letters)."""
    return F.collate(F.coalesce(*cols), "UNICODE")


def _code_units(key: str) -> bytes:
    return key.encode("utf-16-be", "surrogatepass")


def canonical(x: Column, kind: DataType) -> Column:
    """The value with the fields and keys of all its objects, at every depth, in order of code units."""
    if isinstance(kind, StructType):
        parts = [canonical(x[f.name], f.dataType).alias(f.name) for f in sorted(kind, key=lambda f: _code_units(f.name))]
        return F.when(x.isNotNull(), F.struct(*parts))
    if isinstance(kind, ArrayType):
        return F.transform(x, lambda e: canonical(e, kind.elementType))
    if isinstance(kind, MapType):
        inner = F.transform_values(x, lambda _, v: canonical(v, kind.valueType))
        return F.map_from_entries(F.transform(F.array_sort(F.transform(F.map_entries(inner), lambda e: F.struct(F.encode(e["key"], "UTF-16BE").alias("o"), e["key"].alias("key"), e["value"].alias("value"))), lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)), lambda e: F.struct(e["key"], e["value"])))
    return x


def canonical_json(fields: Mapping[str, Column], kinds: Mapping[str, DataType] | None = None) -> Column:
    """Compact JSON with keys in order of code units and nulls kept. kinds: types of the fields that hold objects, whose keys
    are put in order as well, however deep."""
    kinds = kinds or {}
    return F.to_json(F.struct(*[(canonical(fields[k], kinds[k]) if k in kinds else fields[k]).alias(k) for k in sorted(fields, key=_code_units)]), {"ignoreNullFields": "false"})


def canonical_map_json(x: Column) -> Column:
    """Compact JSON of a map with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(x))), {"ignoreNullFields": "false"})


def content_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.sha2(F.concat_ws(":", *parts), 256))


def js_length(x: Column) -> Column:
    """Length in UTF-16 code units."""
    return (F.octet_length(F.encode(x, "UTF-16BE")) / 2).cast("long")


def raw_byte_offset(text: Column, characters: Column) -> Column:
    """Byte offset, in the captured file with CRLF line ends, of a character offset in the text with LF line ends."""
    prefix = F.substr(text, F.lit(1), characters)
    return (F.octet_length(prefix) + F.regexp_count(prefix, F.lit("\n"))).cast("long")


def slice_digest(data: Column, start: Column, end: Column) -> Column:
    """SHA-256 of bytes start to end."""
    return F.sha2(F.substr(data, (start + 1).cast("int"), (end - start).cast("int")), 256)


def is_language_tag(x: Column) -> Column:
    """Shape of a language tag; null passes."""
    return F.coalesce(x.rlike(LANGUAGE_SHAPE), F.lit(True))


def is_canonical_tag(x: Column) -> Column:
    """A language tag of the right shape whose parts are written as they should be: language and variants small, a script (four letters)
    with one capital, a region (two letters) in capitals, all small from an extension on; no variant twice. Null passes."""
    parts = F.split(x, "-")
    extension = F.array_position(F.transform(parts, lambda p, i: (F.length(p) == 1) & (i > 0)), F.lit(True))
    plain = lambda i: (i > 0) & ((extension == 0) | (i + 1 < extension))
    written = F.transform(parts, lambda p, i: F.when(plain(i) & p.rlike("^[A-Za-z]{4}$"), F.initcap(F.lower(p))).when(plain(i) & p.rlike("^[A-Za-z]{2}$"), F.upper(p)).otherwise(F.lower(p)))
    return F.coalesce(is_language_tag(x) & (F.array_join(written, "-") == x) & (F.size(F.array_distinct(parts)) == F.size(parts)), F.lit(True))


def is_safe_path(x: Column) -> Column:
    """Relative, with plain segments only."""
    return F.coalesce((x != "") & ~x.startswith("/") & ~x.contains("\\") & ~F.exists(F.split(x, "/"), lambda s: s.isin("", ".", "..")), F.lit(False))


def is_json(x: Column) -> Column:
    return F.try_parse_json(x).isNotNull()


# Response headers that may be kept.
SAFE_HEADERS = ("accept-ranges", "content-length", "content-range", "content-type", "etag", "last-modified")


def safe_headers(headers: Column) -> Column:
    """A map of response headers with lower-case names, and only those that may be kept."""
    return F.map_filter(F.transform_keys(headers, lambda k, _: F.lower(k)), lambda k, _: k.isin(*SAFE_HEADERS))


def without_run_ids(metadata: Column) -> Column:
    """A metadata map without keys that end in CaptureId."""
    return F.map_filter(metadata, lambda k, _: ~k.endswith("CaptureId"))


def floor_percentile(x: Column, p: float) -> Column:
    """Aggregate: the element at floor((n - 1) * p) of the sorted values; 0 for none."""
    values = F.sort_array(F.collect_list(x))
    return F.coalesce(F.get(values, F.floor((F.count(x) - 1) * p).cast("int")), F.lit(0))


def gate(x: Column) -> Column:
    """True only for true: unknown fails like false."""
    return x.eqNullSafe(F.lit(True))
