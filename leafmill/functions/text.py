"""Column functions with the text semantics of the document operators.

Patterns are written for Java's engine: ``(?d)`` keeps ``.`` from matching a newline only, and
character classes are spelled out, so that other engines given the same pattern agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and shapes that announce a chart or table in a text.
INDICATORS = [
    r"figure\s*\d+", r"fig\.\s*\d+", r"table\s*\d+", r"chart\s*\d+", r"graph\s*\d+", r"diagram\s*\d+", "%", r"\$\d", "million",
    "billion", "percent", r"x[\-\s]?axis", r"y[\-\s]?axis", "legend", "scatter", "histogram", "bar chart", "pie chart",
]
INDICATOR = "(?i)(?:" + "|".join(INDICATORS) + ")"
# Fixed value: a reference to a figure or table with the rest of its sentence.
REFERENCE = r"(?i)((?:Figure|Fig\.?|Table|Chart)\s*\d+[^.]*\.)"
MISSING = "N/A"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def rstrip_lines(text: Column) -> Column:
    """Without white space at the end of any line."""
    return F.regexp_replace(text, r"[ \t\r\f\x0B]+(?=\n|\z)", "")


def has_indicators(text: Column) -> Column:
    return F.coalesce(text.rlike(INDICATOR), F.lit(False))


def truncate_with_references(text: Column, limit: int) -> Column:
    """At most about ``limit`` characters, the references to figures and tables kept at the end.

    0 is no limit.  The mark of three dots may exceed the limit.
    """
    if limit == 0:
        return text
    found = F.array_join(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)), " ")
    room = F.lit(limit - 20) - F.length(found)
    with_refs = F.concat(F.substring(text, F.lit(1), room), F.lit("...\n[Refs: "), found, F.lit("]"))
    useful = (F.length(found) > 0) & (F.length(found) < limit) & (room > 50)
    return F.when(F.length(text) <= limit, text).when(useful, with_refs).otherwise(F.concat(F.substring(text, 1, limit), F.lit("...")))


def backoff_seconds(attempt: Column, base: float = 1.0, most: float = 30.0, chance: Column | None = None) -> Column:
    """Wait before a repeated call, doubled each time; with ``chance`` (0 to 1) up to a quarter less or more, 0.1 at least."""
    wait = F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(most))
    return wait if chance is None else F.greatest(wait + wait * 0.25 * (chance * 2 - 1), F.lit(0.1))


def rating(score: Column) -> Column:
    return F.when(score >= 90, "Excellent").when(score >= 80, "Good").when(score >= 60, "Fair").when(score >= 40, "Poor").otherwise("Very Poor")


def duration_short(seconds: Column) -> Column:
    """``Ns``, ``Nm Ns`` or ``Nh Nm``."""
    s = F.floor(seconds)
    hours, minutes = F.floor(s / 3600), F.floor(s / 60)
    join = lambda a, x, b, y: F.concat(a.cast("string"), F.lit(f"{x} "), b.cast("string"), F.lit(y))
    return F.when(s < 60, F.concat(s.cast("string"), F.lit("s"))).when(s < 3600, join(minutes, "m", s % 60, "s")).otherwise(join(hours, "h", minutes % 60, "m"))


def duration_long(seconds: Column) -> Column:
    """``Ns``, ``Nm Ns`` or ``Nh Nm Ns``."""
    s = F.floor(seconds)
    hours, minutes = F.floor(s / 3600), F.floor(s / 60)
    tail = F.concat((minutes % 60).cast("string"), F.lit("m "), (s % 60).cast("string"), F.lit("s"))
    return F.when(s < 60, F.concat(s.cast("string"), F.lit("s"))).when(s < 3600, tail).otherwise(F.concat(hours.cast("string"), F.lit("h "), tail))


def bar(share: Column, width: int = 20) -> Column:
    """A text bar for a share of 0 to 1."""
    full = F.floor(share * width).cast("int")
    return F.concat(F.repeat(F.lit("█"), full), F.repeat(F.lit("░"), F.lit(width) - full))


def rounded(value: Column, places: int) -> Column:
    """Half up in binary, the same on every engine."""
    scale = 10.0**places
    return F.floor(value * scale + 0.5) / scale


def normal_name(name: Column) -> Column:
    """A document name without part marks, blanks, ``_`` and ``-``, in lower case."""
    bare = F.regexp_replace(F.regexp_replace(name, r"_part\d+of\d+", ""), r"_chunk\d+", "")
    return F.lower(F.regexp_replace(bare, "[_ -]", ""))


def alnum_name(name: Column) -> Column:
    """Letters and digits of the name without its last part mark, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"_part\d+of\d+$", ""), "[^a-zA-Z0-9]", ""))


def delivery_name(name: Column) -> Column:
    """First 50 characters, blanks to ``-``, other signs dropped."""
    return F.regexp_replace(F.replace(F.substring(name, 1, 50), F.lit(" "), F.lit("-")), "[^a-zA-Z0-9-]", "")


def figure_file(reference: Column, page: Column) -> Column:
    return F.concat(F.replace(F.replace(reference, F.lit(" "), F.lit("_")), F.lit(":"), F.lit("")), F.lit("_page"), page.cast("string"), F.lit(".yaml"))


def page_of_name(name: Column) -> Column:
    """The number after ``page`` (or ``page_``) in a file name; null without."""
    return F.nullif(F.regexp_extract(name, r"page_?(\d+)", 1), F.lit("")).cast("int")


def page_image(page: Column) -> Column:
    """Path of a page's image below its document; null without a page."""
    return F.concat(F.lit("images/"), image_name(page))


def image_name(page: Column) -> Column:
    return F.concat(F.lit("page_"), F.lpad(page.cast("string"), F.greatest(F.length(page.cast("string")), F.lit(3)), F.lit("0")), F.lit(".png"))


def data_uri(content: Column, kind: str = "image/png") -> Column:
    """Binary content as a data URI."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def masked_key(key: Column) -> Column:
    return F.concat(F.substring(key, 1, 8), F.lit("..."), F.substring(key, -4, 4))


def keywords(text: Column) -> Column:
    """Distinct lower-case words of more than two characters."""
    words = F.transform(F.split(text, r"[^\p{L}\p{N}_]+"), F.lower)
    return F.array_distinct(F.filter(words, lambda w: F.length(w) > 2))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two sets; 0 if either is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


def number(value: Column) -> Column:
    """A cell as a number: currency signs, thousands marks and blanks dropped; null if it is none."""
    bare = F.regexp_replace(value, r"[£$€¥,\s]", "")
    plain = F.regexp_replace(bare, "%$", "")
    shape = bare.rlike(r"^[+-]?(?:\d+|\d+\.\d*|\.\d+|\d+\.\d*[eE][+-]?\d+)%?$")
    return F.when(shape, plain.try_cast("double"))


def is_numeric(value: Column) -> Column:
    """Whether a cell is a number once currency, per cent and thousands marks, dashes and question marks are gone."""
    bare = F.regexp_replace(value, r"[£$€¥%,\s\-–—?]", "")
    return F.coalesce(bare.rlike(r"^\+?(?:\d+\.?\d*|\.\d+)(?:[eE]\+?\d+)?$"), F.lit(False))


def normal_value(value: Column) -> Column:
    """A cell for comparison: trimmed, in lower case, without commas, dashes as hyphens; empty for null."""
    return F.lower(F.translate(strip(F.coalesce(value, F.lit(""))), "–—,", "--"))


def number_kind(value: Column) -> Column:
    """``int``, ``float`` or ``text``."""
    bare = F.regexp_replace(value, r"[£$€¥,\s]", "")
    return F.when(number(value).isNull(), "text").when(bare.contains(".") | bare.endswith("%"), "float").otherwise("int")


def cells(row: Column) -> Column:
    """Cells of a Markdown table row."""
    return F.transform(F.split(F.regexp_replace(strip(row), r"^\||\|$", ""), r"\|"), strip)


def slug(heading: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(heading), r"[^\p{L}\p{N}_\s-]", ""), r"\s+", "-")


def squeeze_blank_lines(text: Column, most: int = 2) -> Column:
    """Runs of more than ``most`` + 1 newlines become ``most`` + 1."""
    return F.regexp_replace(text, rf"\n{{{most + 2},}}", "\n" * (most + 1))
