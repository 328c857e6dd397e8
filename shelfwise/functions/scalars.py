
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented Latin letters and what they become in a slug.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def trimmed(c: Column) -> Column:
    """null becomes empty; all Unicode white space at the ends goes."""
    return F.coalesce(F.regexp_replace(c, r"^[\s ﻿]+|[\s ﻿]+$", ""), F.lit(""))


def truthy(c: Column) -> Column:
    """F22."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))) == "true", F.lit(False))


def optional_truthy(c: Column) -> Column:
    """as F22, null when blank."""
    return F.when(trimmed(c) != "", truthy(c))


def hierarchy_prefixes(path: Column) -> Column:
    """[A, B] becomes [A, A|B]."""
    return F.transform(F.sequence(F.lit(1), F.size(path)), lambda i: F.array_join(F.slice(path, F.lit(1), i), "|"))


def slug(c: Column, ampersand: str = "and") -> Column:
    """lower case, accents off, & spelled out, apostrophes dropped, other runs become one hyphen."""
    x = F.translate(F.lower(F.coalesce(c, F.lit(""))), ACCENTED, PLAIN)
    x = F.replace(F.replace(x, F.lit("æ"), F.lit("ae")), F.lit("œ"), F.lit("oe"))
    x = F.replace(x, F.lit("&"), F.lit(f" {ampersand} "))
    x = F.regexp_replace(F.regexp_replace(x, "['’]", ""), "[^a-z0-9]+", "-")
    return F.regexp_replace(x, "^-+|-+$", "")


def html_document(c: Column) -> Column:
    """wraps text in a document unless it holds an html tag."""
    return F.when(F.coalesce(c, F.lit("")) == "", "").when(c.rlike(r"(?i)<html[\s>]"), c).otherwise(F.concat(F.lit("<html><body>"), c, F.lit("</body></html>")))


def rating(c: Column) -> Column:
    """a stable stand-in rating from the sum of the id's character codes."""
    s = F.aggregate(F.transform(F.split(c, ""), F.ascii), F.lit(0), lambda a, x: a + x)
    r = F.ceil((s % 3) + 2 + (s % 10) / 10 + 0.1)
    return F.when(r < 5, r + ((s % 10) * 0.1 + 0.1)).otherwise(r.cast("double"))


def quantity(c: Column) -> Column:
    """finite and above 0, rounded half up; else null."""
    v = F.when(F.trim(c).rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), F.trim(c).try_cast("double"))
    return F.when(v > 0, F.floor(v + 0.5).cast("long"))


def alias_suffix(c: Column) -> Column:
    """what follows the last hyphen, unless the hyphen is first."""
    tail = F.substring_index(c, "-", -1)
    return F.when(c.contains("-") & (F.length(c) - F.length(tail) - 1 > 0), tail)


def ordered_ids(c: Column) -> Column:
    """Trimmed, without blanks, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != "")))


def language(locale: Column) -> Column:
    """F19."""
    return F.lower(F.split(locale, "[-_]")[0])


def iso_time(c: Column) -> Column:
    """UTC with milliseconds; empty when missing."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit(""))


def sort_order(c: Column) -> Column:
    """the leading integer, else 0."""
    return F.coalesce(F.regexp_extract(c, r"^\s*([-+]?\d+)", 1).try_cast("int"), F.lit(0))


def absolute_url(base: Column, path: Column) -> Column:
    """F32."""
    joined = F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(path, "^/+", ""))
    return F.when(path.rlike("(?i)^https?://"), path).otherwise(joined)


def relative_url(path: Column) -> Column:
    """F33."""
    bare = F.regexp_replace(path, "(?i)^https?://[^/]+", "")
    return F.concat(F.lit("/"), F.regexp_replace(bare, "^/+", ""))


def money(c: Column) -> Column:
    """A price to the cent, halves away from zero: the cents are rounded as a double, so that an amount that SQL finds at half a cent goes up here too."""
    return F.round(c * 100) / 100


def price_pair(sales: Column, base: Column) -> tuple[Column, Column]:
    """The base price (sales if there is none) and the promotional one, only if strictly below."""
    return F.coalesce(base, sales), F.when(sales < base, sales)
