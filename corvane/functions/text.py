"""Text functions as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as ECMAScript has it; Java's \s lacks the no-break and other Unicode spaces.
WS_CHARS = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
WS = f"[{WS_CHARS}]"
#: A run of them, for counting in long texts: Java tests a class range by range, so what lies between the ASCII ones and the others is ruled out first.
WS_RUN = rf"[\x00- \x{{A0}}-\x{{FEFF}}&&{WS}]+"
#: The same characters as a string, for functions that trim by a set.
WS_SET = "\t\n\x0b\f\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
#: A word boundary between ASCII word characters; Java's \b follows Unicode letters.
ASCII_B = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"


def trim_ws(x: Column) -> Column:
    return F.btrim(x, F.lit(WS_SET))


def collapse_ws(x: Column) -> Column:
    return F.regexp_replace(x, f"{WS}+", " ")


def normalize(x: Column) -> Column:
    """Comparison form: no carriage returns, straight quotes, punctuation and hyphens as spaces, one space between words, lower case."""
    for old, new in (("\r", ""), ("’", "'"), ("‘", "'")):
        x = F.replace(x, F.lit(old), F.lit(new))
    return F.lower(F.trim(F.regexp_replace(x, rf'[_*\[\].,;:!?"\-{WS_CHARS}]+', " ")))


def slugify(x: Column) -> Column:
    """At most 70 characters of a-z, 0-9 and hyphens."""
    return F.substring(F.regexp_replace(F.regexp_replace(normalize(x), "[^a-z0-9 ]", ""), f"{WS}+", "-"), 1, 70)


def title_case(x: Column) -> Column:
    """Capitals at the start and after white space, parenthesis, dash and hyphen; a possessive 'S stays small."""
    parts = F.split(F.lower(x), rf"(?<=[{WS_CHARS}(—-])")
    raised = F.transform(parts, lambda p: F.when(p.rlike("^[a-z]"), F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))).otherwise(p))
    return F.regexp_replace(F.array_join(raised, ""), f"'S{ASCII_B}", "'s")


def first_paragraph(x: Column) -> Column:
    """Excerpt of 260 characters from the first paragraph of more than 80; an ellipsis follows if that paragraph is longer than 260."""
    blocks = F.filter(F.split(x, f"\n{WS}*\n"), lambda p: F.length(trim_ws(p)) > 80)
    chosen = F.coalesce(F.get(blocks, 0), x)
    return F.concat(F.substring(trim_ws(collapse_ws(chosen)), 1, 260), F.when(F.length(chosen) > 260, "…").otherwise(""))


def pad(x: Column, width: int) -> Column:
    """Zeros in front up to the width; longer values stay whole."""
    s = x.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def word_count(x: Column) -> Column:
    """Non-empty tokens between white space: one more than the runs of white space inside. Java tests a negated class character by
    character against each of its ranges, which costs many times as much as looking for the runs."""
    inner = trim_ws(x)
    return (F.regexp_count(inner, F.lit(WS_RUN)) + (inner != "").cast("int")).cast("long")


def kebab(x: Column) -> Column:
    return F.lower(F.regexp_replace(x, "([A-Z])", "-$1"))


#: A numeric character reference, decimal or hexadecimal.
NUMERIC = r"&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"


def _character(entity: Column) -> Column:
    """What a numeric reference stands for; itself where that is no character."""
    hexadecimal = F.lower(F.substring(entity, 3, 1)) == "x"
    digits = F.when(hexadecimal, F.regexp_extract(entity, "[xX]([0-9A-Fa-f]+);", 1)).otherwise(F.regexp_extract(entity, "#([0-9]+);", 1))
    code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(entity)


def clean_text(x: Column) -> Column:
    """Numeric and named entities that an XML parser left behind (the ampersand last), white space collapsed and trimmed."""
    pieces = F.split(x, NUMERIC, -1)
    entities = F.concat(F.transform(F.regexp_extract_all(x, F.lit(NUMERIC), 0), _character), F.array(F.lit("")))
    x = F.when(F.contains(x, F.lit("&#")), F.array_join(F.flatten(F.zip_with(pieces, entities, lambda p, e: F.array(p, e))), "")).otherwise(x)
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        x = F.replace(x, F.lit(f"&{name};"), F.lit(char))
    return trim_ws(collapse_ws(x))


def citation_label(*parts: Column) -> Column:
    return F.concat_ws(", ", *parts)


def list_with_and(items: Sequence[str]) -> str:
    return f"{', '.join(items[:-1])}, and {items[-1]}"


_BOUNDARY = re.compile(r"\\b(?=[A-Za-z(])|\\b")


def ascii_pattern(pattern: str, flags: str = "(?i)") -> str:
    """A pattern with \\b as the ASCII boundary. Before a letter or group it only has to look back, else only ahead, as
    the pattern's own letters stand on the other side."""
    return flags + _BOUNDARY.sub(lambda m: "(?<![A-Za-z0-9_])" if pattern[m.end() : m.end() + 1].isalpha() or pattern[m.end() : m.end() + 1] == "(" else "(?![A-Za-z0-9_])", pattern)


def ascii_lower(x: Column) -> Column:
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def required_literals(pattern: str) -> list[str]:
    """Strings of which any text that matches the pattern holds at least one; empty if none are known."""

    def of(items) -> list[str]:
        found: list[list[str]] = []
        run = ""
        for op, arg in [*items, (None, None)]:
            if op is not None and str(op) == "LITERAL":
                run += chr(arg)
                continue
            if len(run) > 1:
                found.append([run])
            run = ""
            if str(op) == "SUBPATTERN":
                found.append(of(arg[3]))
            elif str(op) == "BRANCH":
                parts = [of(b) for b in arg[1]]
                found.append([x for p in parts for x in p] if all(parts) else [])
            elif str(op) == "MAX_REPEAT" and arg[0] > 0:
                found.append(of(arg[2]))
        return max((f for f in found if f), key=lambda f: (min(map(len, f)), -len(f)), default=[])

    return sorted(set(of(re._parser.parse(pattern))))  # type: ignore[attr-defined]


def _occurs(t: Column, pattern: str) -> Column:
    """The pattern's literals are looked for first: a plain search decides most texts without the pattern."""
    found = t.rlike(ascii_pattern(pattern, ""))
    literals = required_literals(pattern)
    return reduce(or_, (F.contains(t, F.lit(x)) for x in literals)) & found if literals else found


def detect(x: Column, vocabulary: Sequence[tuple[str, str]], limit: int = 6) -> Column:
    """The first `limit` labels, in order of the vocabulary, whose pattern occurs, in any case of ASCII letters.

    The text is put in lower case once, so that patterns run without case folding. Patterns are in lower case.
    """
    found = F.transform(F.array(ascii_lower(x)), lambda t: F.array_compact(F.array(*[F.when(_occurs(t, p), F.lit(label)) for label, p in vocabulary])))
    return F.slice(F.element_at(found, 1), 1, limit)
