"""Fill-in-the-middle: texts cut in three and put together in another order.

A text has n units, which are code points; ``regexp_count`` counts them. Two cuts a <= b
are drawn from a hash of the id, so no state and no random generator is needed and
every rerun agrees. A pattern is then written for each row, with possessive counted
groups ``(.{a}+)(.{b-a}+)(.*+)``: one match of it captures prefix, middle and suffix,
and one replacement puts them in the order of the row's form. A possessive group of a
fixed count never goes back, so a match costs one walk over the text, however long.

Everything is a DataFrame expression; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named

#: Markers in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Units that are counted at a time, so that a count never makes an array of all units.
STRIDE = 4096

_UNIT = "(?s)."


def unit_count(text: Column) -> Column:
    """Code points of ``text``: whole strides first, then what they leave."""
    stride = f"{_UNIT}{{{STRIDE}}}+"
    rest = F.regexp_replace(text, stride, "")
    return (F.regexp_count(text, F.lit(stride)) * STRIDE + F.regexp_count(rest, F.lit(_UNIT))).cast("long")


def _draws(id_text: Column, seed: int) -> Column:
    """Four numbers below 2**32 of an id: groups of eight digits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_text), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, suffix_first_percent: int = 20,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n, form, prefix_chars, middle_chars and output of each row.

    Form ``psm`` is prefix, suffix, middle; ``spm`` is suffix, prefix, middle (of
    ``suffix_first_percent``); ``plain`` is the text as it is: of ``plain_percent``, of
    empty texts and of those that hold a marker, which could not be told from ours.
    A null text counts as empty, a null id as an empty id text. Repeated rows come
    out alike, an empty table gives no rows, and no order or tie plays a part. Columns
    other than id and text are left out.
    """
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    has_marker = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        has_marker = has_marker | F.contains("text", F.lit(marker))
    drawn = rows.withColumn("_h", _draws(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), seed)).withColumn("n", unit_count(F.col("text")))
    cuts = drawn.withColumns({
        "_a": F.least(F.col("_h")[0] % (F.col("n") + 1), F.col("_h")[1] % (F.col("n") + 1)),
        "_b": F.greatest(F.col("_h")[0] % (F.col("n") + 1), F.col("_h")[1] % (F.col("n") + 1)),
        "form": F.when((F.col("text") == "") | has_marker | (F.col("_h")[2] % 100 >= 100 - plain_percent), "plain")
        .when(F.col("_h")[3] % 100 < suffix_first_percent, "spm").otherwise("psm"),
    })
    cut = F.col("form") != "plain"
    pattern = F.concat(
        F.lit(r"(?s)\A(.{"), F.col("_a").cast("string"), F.lit("}+)(.{"), (F.col("_b") - F.col("_a")).cast("string"), F.lit(r"}+)(.*+)\z"),
    )
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    return cuts.select(
        "doc_id", "text", "n", "form",
        F.when(cut, F.col("_a")).alias("prefix_chars"),
        F.when(cut, F.col("_b") - F.col("_a")).alias("middle_chars"),
        F.when(cut, F.regexp_replace(F.col("text"), pattern, order)).otherwise(F.col("text")).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text again, from what ``fill_in_middle`` made of it and the form.

    No text with a marker is cut, and no marker can start inside another, so the
    first of each kind is ours.
    """
    parts = {"psm": (PREFIX, SUFFIX, "$1$3$2"), "spm": (SUFFIX, PREFIX, "$2$3$1")}
    text = output
    for name, (first, second, order) in parts.items():
        text = F.when(form == name, F.regexp_replace(output, rf"(?s)\A{first}(.*?){second}(.*?){MIDDLE}(.*+)\z", order)).otherwise(text)
    return text


def fill_digest(filled: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with digests of the output and of the text rebuilt from it."""
    return filled.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
