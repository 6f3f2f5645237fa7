"""String and array rules that are used by more than one job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inflecta.dims import PERSON_LABELS, literal_map

# Letters dropped by the 1990 reform and their replacements.
REFORM_FROM = "îû"
REFORM_TO = "iu"

# Whitespace as Unicode defines it, with the ASCII separators.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SPACE = f"[{WHITESPACE}]"
# The same as a property of a character: a list is looked through for each one.
_RUN = r"(?U)[\s\x1c-\x1f]+"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` reads it, also within its lambdas.

    A column that a lambda reads once in its text is inlined there by the optimizer and evaluated for each
    element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    """Trim Unicode whitespace on both sides."""
    return F.trim(text, F.lit(WHITESPACE))


def squeeze(text: Column) -> Column:
    """Collapse every whitespace run to one space and trim."""
    return F.trim(F.regexp_replace(text, _RUN, " "))


def plain_apostrophe(text: Column) -> Column:
    """Typographic apostrophe to the ASCII one."""
    return F.replace(text, F.lit("’"), F.lit("'"))


def has_reform_spelling(verb: Column, letters: str = REFORM_FROM) -> Column:
    """Whether the 1990 reform changes the spelling of ``verb``."""
    return verb.rlike(f"[{letters}]")


def reform_spelling(verb: Column, letters: str = REFORM_FROM, replacements: str = REFORM_TO) -> Column:
    """The reformed spelling, NULL when the reform does not touch ``verb``."""
    return F.when(has_reform_spelling(verb, letters), F.translate(verb, letters, replacements))


def pack_alternatives(form: Column) -> Column:
    """Alternatives are separated by ``;`` in published finite forms."""
    return F.replace(form, F.lit(","), F.lit(";"))


def reverse_alternatives(form: Column) -> Column:
    """``a;b;c`` to ``c;b;a``."""
    return F.array_join(F.reverse(F.split(form, ";")), ";")


def base_name(verb: Column) -> Column:
    """Name without a homonym suffix, NULL when there is no suffix."""
    return F.when(verb.rlike(r"_\d+$"), F.regexp_replace(verb, r"_\d+$", ""))


def canonical_headword(display: Column) -> Column:
    """Headword of a listing entry: before the first comma, no reflexive mark, no Roman numeral."""
    name = plain_apostrophe(strip(F.split_part(display, F.lit(","), F.lit(1))))
    name = F.replace(F.replace(name, F.lit(" (s')"), F.lit("")), F.lit(" (se)"), F.lit(""))
    return F.regexp_replace(name, rf"^[IVX]+\.{_SPACE}+", "")


def last_segment(href: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(href, "/", -1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, as the ASCII-insensitive LIKE of the source database does."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def like(text: Column, pattern: str, ci: bool = False) -> Column:
    """SQL LIKE; with ``ci`` ASCII letters match in either case."""
    if ci:
        lowered = "".join(c.lower() if c.isascii() else c for c in pattern)
        return ascii_lower(text).like(lowered)
    return text.like(pattern)


def drop_last(text: Column, n: int) -> Column:
    """``text`` without its last ``n`` characters."""
    return text.substr(F.lit(1), F.greatest(F.length(text) - n, F.lit(0)))


def person_label(personne: Column) -> Column:
    """Readable label of a merged person key; unknown parts are kept, repeats dropped."""
    labels = literal_map(PERSON_LABELS)
    parts = F.transform(F.split(personne, ";"), lambda p: F.coalesce(labels[p], p))
    return F.array_join(F.array_distinct(parts), ", ")


def unit_key(*parts: Column) -> Column:
    """Key of a review unit."""
    return F.concat_ws("|", *parts)


#: 64-bit words of the bitmap of ``key_filter``: 2 ** 20 bits, 128 kB, whatever the number of keys.
FILTER_WORDS = 1 << 14


def key_filter(keys: DataFrame, name: str) -> Callable[[Column], Column]:
    """A test of fixed size whether a value may be among ``keys[name]``: never false for one that is, rarely true for others.

    A bit for each hash of a key, as one array that a scalar subquery brings to the scan.
    """
    bits = FILTER_WORDS * 64
    cell = F.pmod(F.xxhash64(name), F.lit(bits))
    marked = keys.where(F.col(name).isNotNull()).select((cell / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int")).alias("bit"))
    none = keys.sparkSession.range(FILTER_WORDS).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = marked.unionByName(none).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bitmap = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("bitmap")).scalar()

    def test(value: Column) -> Column:
        at = F.pmod(F.xxhash64(value), F.lit(bits))
        return F.call_function("shiftright", F.get(bitmap, (at / 64).cast("int")), (at % 64).cast("int")).bitwiseAND(1) == 1

    return test
