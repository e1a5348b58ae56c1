"""Column functions for dirty text fields. Trimming takes all characters up to U+0020; patterns match whole fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "::"
# The domains of the three tables and the time bounds, in seconds.
AGES = ["1", "18", "25", "35", "45", "50", "56"]
GENRES = ["Action", "Adventure", "Animation", "Children's", "Comedy", "Crime", "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western"]
TS_MIN, TS_MAX = 631152000, 1047772799
T1, T2 = 1009843200, 1025481600
LAST_YEAR, LAST_OCCUPATION = 2003, 20


def full(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})\z")


def jtrim(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def fields(line: Column, sep: str = SEP) -> Column:
    return F.split(line, sep.replace("|", r"\|"), -1)


def at(f: Column, i: int) -> Column:
    """Field i, the empty string where there is none."""
    return F.coalesce(F.get(f, F.lit(i)), F.lit(""))


def join(*c: Column) -> Column:
    return F.concat_ws(SEP, *c)


def digits(c: Column) -> Column:
    return full(c, "[0-9]+")


def blank(c: Column) -> Column:
    return F.coalesce(jtrim(c), F.lit("")) == ""


def missing(c: Column) -> Column:
    return F.coalesce(jtrim(c), F.lit("")).isin("", "NULL")


def number(c: Column) -> Column:
    return F.when(digits(c), c.try_cast("long"))


def occupation(c: Column) -> Column:
    return F.coalesce(number(c) <= LAST_OCCUPATION, F.lit(False))


def year_of(title: Column) -> Column:
    """The four digits in brackets at a title's end, or null."""
    return F.nullif(F.regexp_extract(title, r"\(([0-9]{4})\)\s*$", 1), F.lit(""))


def plain_title(title: Column) -> Column:
    return F.lower(jtrim(F.regexp_replace(title, r"\s*\([0-9]{4}\)\s*$", "")))


def genres_legal(g: Column) -> Column:
    """Whether all genres are known; trailing empty ones do not count."""
    short = F.regexp_replace(g, r"\|+$", "")
    return ~blank(g) & ((short == "") | F.forall(F.split(short, r"\|", -1), lambda t: jtrim(t).isin(GENRES)))


def genres_kept(g: Column) -> Column:
    known = F.filter(F.transform(F.split(g, r"\|", -1), jtrim), lambda t: t.isin(GENRES))
    return F.coalesce(F.nullif(F.array_join(known, "|"), F.lit("")), F.lit("NULL"))


def unmojibake(t: Column) -> Column:
    """Text whose UTF-8 bytes were read as Latin-1, read rightly; other text as it is."""
    again = F.try_validate_utf8(F.encode(t, "ISO-8859-1").cast("string"))
    fixed = F.when(again.isNotNull() & ~F.contains(again, F.lit("�")), again).otherwise(t)
    reversible = ~full(t, r"(?s).*[^\x00-\xFF].*")
    return F.when((F.contains(t, F.lit("Ã")) | F.contains(t, F.lit("Â"))) & reversible, fixed).otherwise(t)


def offset_candidate(i: Column) -> Column:
    """The id that a shifted one may stand for: less two million, or else one."""
    v = i.try_cast("long")
    return F.when(v > 2_000_000, (v - 2_000_000).cast("string")).when(v > 1_000_000, (v - 1_000_000).cast("string"))


def record_id(version: Column | str, table: Column, file: Column, offset: Column) -> Column:
    zero = F.lit("\x00")
    version = F.lit(version) if isinstance(version, str) else version
    return F.sha2(F.concat(version, zero, table, zero, file, zero, offset.cast("string")), 256)


def split_label(ts: Column) -> Column:
    return F.when(ts <= T1, "TRAIN").when(ts <= T2, "VALID").otherwise("TEST")
