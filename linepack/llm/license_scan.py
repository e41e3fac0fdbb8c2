"""License scan: an exact containment join of text blocks with notice templates.

A block is a line of a text, a template is the set of words of a notice. A block
matches if it holds at least a given share of the template's words. All template
words are put in order of how many blocks of the corpus hold them, rarest first. A
match must then share a word among the first of both (prefix filter), be long
enough (length filter), and have enough words left behind the shared one on both
sides (positional filter); what remains is verified. Words of no template cannot
count towards a match, so blocks are reduced to template words first.

Next to it, fixed phrases are found wherever their words stand in a row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sub_batches, text_rows

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Lines of well-known notices, by label.
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved."],
    "apache-notice": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd-notice": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
    ],
    "cc-by-nc-notice": ["Licensed under CC BY-NC 4.0."],
    "cc-by-sa-notice": ["Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl-notice": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ],
    "mit-notice": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ],
    "mpl-notice": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "public-domain": ["This work has been dedicated to the public domain."],
}
THRESHOLD = 0.8

#: All ASCII characters but digits and small letters part words.
_PARTS = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

MATCH = "struct<label:string,block:int,containment:double>"
SCANNED = f"doc_id long, n_words long, phrases array<struct<label:string,word:int>>, matches array<{MATCH}>"


def words(text: str) -> list[bytes]:
    """Words of the text with A-Z lowered."""
    return text.encode().lower().translate(_PARTS).split()


@dataclass(frozen=True)
class Template:
    label: str
    tokens: frozenset[bytes]
    need: int  # words of it that a block must hold


def template_list(templates: Mapping[str, Sequence[str]], threshold: float) -> list[Template]:
    out = []
    for label, lines in templates.items():
        for line in lines:
            tokens = frozenset(words(line))
            out.append(Template(label, tokens, max(1, math.ceil(threshold * len(tokens) - 1e-9))))
    return out


class TemplateIndex:
    """Prefix index over templates whose words are ordered by ``frequency``."""

    def __init__(self, templates: Sequence[Template], frequency: Mapping[bytes, int]) -> None:
        vocabulary = {t for template in templates for t in template.tokens}
        self.order = {t: i for i, t in enumerate(sorted(vocabulary, key=lambda t: (frequency.get(t, 0), t)))}
        self.templates = templates
        self.least = min((t.need for t in templates), default=0)
        self.index: dict[int, list[tuple[int, int]]] = {}
        for n, template in enumerate(templates):
            ranked = sorted(self.order[t] for t in template.tokens)
            for place, token in enumerate(ranked[: len(ranked) - template.need + 1]):
                self.index.setdefault(token, []).append((n, place))
        self.first = frozenset(t for t, i in self.order.items() if i in self.index)

    def matches(self, block: list[bytes]) -> list[tuple[str, float]]:
        """Label and containment of every template that the block holds enough of."""
        if self.first.isdisjoint(block):
            return []
        own = {t for t in block if t in self.order}
        if len(own) < self.least:
            return []
        ranked = sorted(self.order[t] for t in own)
        seen: set[int] = set()
        out = []
        for place, token in enumerate(ranked):
            for n, at in self.index.get(token, ()):
                template = self.templates[n]
                if n in seen or place > len(ranked) - template.need:
                    continue
                # The first shared word of a pair: nothing in front of it counts.
                seen.add(n)
                if min(len(ranked) - place, len(template.tokens) - at) < template.need:
                    continue
                overlap = len(template.tokens & own)
                if overlap >= template.need:
                    out.append((template.label, overlap / len(template.tokens)))
        return out


def _phrase_places(found: list[bytes], phrases: Mapping[str, str]) -> list[dict]:
    joined = b" " + b" ".join(found) + b" "
    out = []
    for phrase, label in phrases.items():
        own = words(phrase)
        if b" " + b" ".join(own) + b" " not in joined:
            continue
        out += [{"label": label, "word": i} for i, w in enumerate(found) if w == own[0] and found[i : i + len(own)] == own]
    return out


def block_frequency(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """The number of blocks of the corpus that hold each word; at most ``vocabulary`` comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in sub_batches(batches):
            for text in batch.column("text").to_pylist():
                for line in text.split("\n"):
                    seen.update(vocabulary.intersection(words(line)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "blocks"]
        )

    counted = docs.select("text").mapInArrow(run, "token binary, blocks long").groupBy("token").agg(F.sum("blocks").alias("blocks"))
    return {bytes(r.token): r.blocks for r in counted.collect()}


def scan(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, threshold: float = THRESHOLD,
         phrases: Mapping[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, phrases (label and first word, from 0) and matches (label, line, containment).

    Null and empty texts have no words and no matches. Every line of every row is
    judged, however long; repeated rows are judged each, a null id stays null and other
    columns are ignored. Two passes over the texts, no shuffle but one count for each
    template word.
    """
    rows = text_rows(docs, id_col, text_col)
    known = template_list(templates, threshold)
    index = TemplateIndex(known, block_frequency(rows, frozenset(t for k in known for t in k.tokens)))
    kind = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("phrases", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int32())]))),
        ("matches", pa.list_(pa.struct([("label", pa.string()), ("block", pa.int32()), ("containment", pa.float64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            n, places, matches = [], [], []
            for text in batch.column("text").to_pylist():
                found: list[bytes] = []
                met = []
                for k, line in enumerate(text.split("\n")):
                    own = words(line)
                    found += own
                    met += [{"label": label, "block": k, "containment": c} for label, c in index.matches(own)]
                n.append(len(found))
                places.append(_phrase_places(found, phrases))
                matches.append(met)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(v, kind.field(i + 1).type) for i, v in enumerate((n, places, matches))]],
                schema=kind,
            )

    return rows.mapInArrow(run, SCANNED)


def license_digest(scanned: DataFrame) -> DataFrame:
    """Per document: places of phrases, labels of phrases and of both, and a score.

    The score is 1 with a phrase, else the largest containment that met the threshold,
    else 0.
    """
    base = F.array_sort(F.array_distinct("phrases.label"))
    labels = F.array_sort(F.array_union("phrases.label", "matches.label"))
    return scanned.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.word").cast("long").alias("first_word"),
        F.array_max("phrases.word").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0))).alias("score"),
    )
