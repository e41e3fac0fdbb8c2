"""Text rules, each from Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends (plain ``trim`` knows blanks only)."""
    return F.btrim(text, F.lit(fixed.WHITE_SPACE))


def zfill(text: Column, width: int) -> Column:
    """Pad with zeros on the left; longer text stays as it is (``lpad`` would cut it)."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def without_null_marks(text: Column) -> Column:
    """Null where the posted text is one of the marks for a missing value."""
    return F.when(~text.isin(fixed.NULL_MARKS), text)


def null_or_empty(text: Column) -> Column:
    return text.isNull() | (text.cast("string") == "")


def file_safe(text: Column) -> Column:
    """A segment's text as it appears in a file name."""
    return F.replace(F.replace(text, F.lit("/"), F.lit("")), F.lit(" "), F.lit("_"))


def last_part(path: Column, separator: str = "/") -> Column:
    return F.element_at(F.split(path, separator), -1)


def read_path(path: Column) -> Column:
    """A reader's ``_metadata.file_path``, which is a URL, as the path that the file system lists."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def posting_name(path: Column) -> Column:
    """Name of the posting a data file belongs to.

    A posting is either one file ``<name>.csv`` or, as Spark writes it, a
    folder of that name (plain, or a ``column=<name>.csv`` partition) with part
    files inside.
    """
    return F.regexp_extract(path, r"(?:^|[/=])([^/=]+\.csv)(?:/part-[^/]*)?$", 1)


def pipe_of_posting(name: Column) -> Column:
    return strip(F.split_part(name, F.lit("_"), F.lit(1)))


def date_of_posting(name: Column) -> Column:
    """The eight digits between underscores, or in front of the extension, as text; else null."""
    return F.nullif(F.regexp_extract(name, r"_(\d{8})[_.]", 1), F.lit(""))


_POST_TIME = r"_(\d{4}-\d{2}-\d{2}_\d{4})(?=\.csv$)"


def post_time_of_posting(name: Column) -> Column:
    """Day and time of the download at the end of the name as text that sorts, empty where there is none."""
    return F.regexp_extract(name, _POST_TIME, 1)


def unit_of_posting(name: Column) -> Column:
    """What a posting is about: its name without the time of the download.

    Pipe, dataset, segment and gas day stay in it, so postings of one unit replace
    each other and those of other units add up.
    """
    return F.regexp_replace(name, _POST_TIME, "")


def pipe_label(label: Column) -> Column:
    """``Name (CODE)`` as a struct of name and code; null without a bracket."""
    code = F.regexp_replace(F.regexp_extract(label, r"(?s)^[^(]*\((.*)$", 1), r"\)+\z", "")
    name = F.regexp_extract(label, r"(?s)^([^(]*)\(", 1)
    return F.when(
        label.contains("("), F.struct(strip(name).alias("name"), strip(code).alias("code"))
    )
