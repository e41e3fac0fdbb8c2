"""Documents with every awkward case, and an empty table of the same columns."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "digest string, size string, fp string, source_key string, rank string, view_text string, mix_id string, spots string"
)


def words(rnd: random.Random, n: int) -> list[str]:
    return ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(2, 7))) for _ in range(n)]


def rows() -> list[tuple]:
    rnd = random.Random(5)
    passage = " ".join(words(rnd, 40))
    base = " ".join(words(rnd, 300))
    texts = [
        None, "", " \t\n", "one", "one two three", base, base, base.replace(" ", "\n", 1), base + " tail",
        " ".join(words(rnd, 30_000)), "x" * 200_000, passage, f"{' '.join(words(rnd, 20))} {passage} {' '.join(words(rnd, 20))}",
        f"Intro words. {passage}", "the same " * 60, "Licensed under the Apache License, Version 2.0.\nMIT license MIT License",
        "Ünïcode   spaces\x1f and <|endoftext|> marks it's don't 12 ²³ \r\n\r\n end ",
    ]
    out = []
    for i, text in enumerate(texts):
        source = [None, "a", "b", "B", "é"][i % 5]
        out.append((i * 3 % 17, text, [None, "en", "de"][i % 3], source, None if i % 4 == 0 else len(text or ""), *["clash"] * 8))
    out.append(out[5])  # a repeated row
    out.append((None, base, "en", "a", 5, *["clash"] * 8))
    out.append((None, "no id at all", None, None, None, *[None] * 8))
    return out


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def with_ids(spark):
    """The same without rows that lack an id or repeat one."""
    return spark.createDataFrame([r for k, r in enumerate(rows()) if r[0] is not None and k != 17], SCHEMA)
