"""License scans by fuzzy search for short notices.

A notice may differ from the text by a bounded number of edits. Split into one piece more
than that, it has one piece that is not edited at all (pigeonhole): an automaton of all
pieces finds those seeds, and the ``regex`` library's bounded-error matching then checks
the text around a seed, counts the edits and gives the span.

Defined cases: a null text is empty and has no words or labels (empty strings) and score 0.
Whole texts are searched. Places of a phrase are counted once each, however often labels
repeat. Repeated rows get equal results. Extra columns of the input are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import strings, text_of

# fixed values: exact phrases and their labels
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# fixed values: wording of common short notices and their labels
NOTICES = [
    ("licensed under the apache license, version 2.0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("this program is free software: you can redistribute it and/or modify", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms, with or without modification", "bsd"),
    ("permission to use, copy, modify, and/or distribute this software for any purpose", "isc"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("licensed under the eclipse public license", "epl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("licensed under cc by", "cc-by"),
]
CHARS_PER_EDIT = 12  # one edit is allowed for so many characters of a notice

_DELIMITERS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


@dataclass
class Found:
    label: str
    start: int
    end: int
    edits: int
    length: int


def count_words(data: bytes) -> int:
    """Words of lower-cased UTF-8: runs of digits, a-z and anything beyond ASCII."""
    if not data:
        return 0
    inside = _IS_WORD[np.frombuffer(data, np.uint8)]
    return int(inside[0]) + int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def phrase_patterns(phrases=PHRASES):
    word = rb"[0-9a-z\x80-\xff]"
    return [
        (re.compile(rb"(?<!%b)%b(?!%b)" % (word, _DELIMITERS.join(p.encode().split()), word)), label)
        for p, label in phrases
    ]


class Notices:
    """Seeds and matchers of a list of notices."""

    def __init__(self, notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT):
        self.seeds = ahocorasick.Automaton()
        self.notices = []
        posted: dict[str, list] = {}
        for k, (text, label) in enumerate(notices):
            edits = len(text) // chars_per_edit
            pattern = regex.compile(f"(?b)(?:{regex.escape(text, special_only=True, literal_spaces=True)}){{e<={edits}}}")
            self.notices.append((text, label, edits, pattern))
            cuts = np.linspace(0, len(text), edits + 2).astype(int).tolist()
            for a, b in zip(cuts, cuts[1:], strict=False):
                posted.setdefault(text[a:b], []).append((k, a))
        for piece, at in posted.items():
            self.seeds.add_word(piece, (len(piece), at))
        self.seeds.make_automaton()

    def find(self, text: str) -> list[Found]:
        """Verified places in a lower-cased text, one for each notice and stretch of text."""
        windows: dict[int, list[list[int]]] = {}
        for end, (length, posted) in self.seeds.iter(text):
            for k, offset in posted:
                whole, _, edits, _ = self.notices[k]
                start = end + 1 - length - offset
                a, b = max(0, start - edits), min(len(text), start + len(whole) + edits)
                own = windows.setdefault(k, [])
                if own and a <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(a, own[-1][0]), max(b, own[-1][1])
                else:
                    own.append([a, b])
        out = []
        for k, own in windows.items():
            whole, label, _, pattern = self.notices[k]
            for a, b in own:
                for m in pattern.finditer(text, a, b):
                    out.append(Found(label, m.start(), m.end(), sum(m.fuzzy_counts), len(whole)))
        return sorted(out, key=lambda f: (f.start, f.end, f.label))


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,start:int,end:int,edits:int>>"
)


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """One row per document; ``spans`` are the fuzzy places in characters of the text."""

    def run(batches):
        exact, fuzzy = phrase_patterns(phrases), Notices(notices, chars_per_edit)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), strings(batch, "text"), strict=True):
                data = text.encode("utf-8", "surrogatepass").lower()
                at, base = [], set()
                for pattern, label in exact:
                    for m in pattern.finditer(data):
                        at.append(m.start())
                        base.add(label)
                found = fuzzy.find(data.decode("utf-8", "surrogatepass"))
                near = {f.label for f in found}
                best = max([1.0] * bool(base) + [1 - f.edits / f.length for f in found], default=0.0)
                ends = [count_words(data[: min(at)]), count_words(data[: max(at)])] if at else [None, None]
                rows.append(
                    {
                        "doc_id": doc_id, "n_words": count_words(data), "n_base": len(at),
                        "first_word": ends[0], "last_word": ends[1],
                        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | near)), "score": best,
                        "spans": [{"label": f.label, "start": f.start, "end": f.end, "edits": f.edits} for f in found],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(run, SCHEMA)


_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    + [("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())])))]
)
