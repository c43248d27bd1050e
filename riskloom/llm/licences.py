"""Licence scan by a positional index of rare words (operator 10).

Templates (short licence phrases and passages) are indexed by word: postings
of (template, place).  A text's words are looked up from the rarest licence
word on (by inverse document frequency over all documents); each hit proposes
a start for every posting, and the start is kept if the template's other words
stand at the same relative place.  Phrases must match in full; of a passage at
least ``MATCH`` of its words must stand in place, and its key phrase must
occur in the text.  Of a passage so many places are looked up, those of the
rarest words, that every match has one of them in place: one more than a match
may lack.

Words are runs of letters, digits and characters beyond ASCII, with A-Z in
lower case.

Defined results: a null text is an empty one, without words and labels;
repeated rows are scanned alike; overlapping places all count; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCH = 0.8  # share of a passage's words that must stand in place

# Phrases with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Openings of public licence texts: label, key phrase, passage.
PASSAGES = (
    ("mit-text", "the software without restriction",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction"),
    ("bsd-text", "redistribution and use",
     "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met"),
    ("isc-text", "with or without fee",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted"),
    ("apache-text", "you may obtain a copy of the license",
     "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-text", "free software foundation",
     "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
     "the free software foundation"),
    ("mpl-text", "mozilla public license",
     "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense-text", "public domain",
     "this is free and unencumbered software released into the public domain"),
)

_WORD = bytes(c if chr(c).isdigit() or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
              for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


def vocabulary(phrases=PHRASES, passages=PASSAGES) -> list[bytes]:
    return sorted({w for t in [*phrases, *[x for p in passages for x in p[1:]]] for w in words(t)})


def frequencies(docs: DataFrame, vocab: list[bytes]) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those that hold each word of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, count = set(vocab), 0, dict.fromkeys(vocab, 0)
        for b in batches:
            for t in b.column(0):
                n += 1
                for w in known.intersection(words(t.as_py())):
                    count[w] += 1
        rows = [("", n), *((w.decode(), c) for w, c in count.items() if c)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64())],
                                         names=["word", "n"])

    got = (docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
           .collect())  # a row for each licence word
    count = {r.word.encode(): r.n for r in got}
    return count.pop(b"", 0), count


class Index:
    """Positional postings of phrases and passages, ordered by inverse document frequency."""

    def __init__(self, documents: int, count: dict[bytes, int], phrases=PHRASES, passages=PASSAGES):
        from math import log
        vocab = vocabulary(phrases, passages)
        self.idf = {w: log((1 + documents) / (1 + count.get(w, 0))) for w in vocab}
        rank = sorted(vocab, key=lambda w: (-self.idf[w], w))
        self.rank = {w: i for i, w in enumerate(rank)}
        self.phrases = [(words(p), label) for p, label in phrases.items()]
        self.passages = [(words(p), words(key), label) for label, key, p in passages]
        self.probes = [self.rarest_places(w) for w, _, _ in self.passages]
        self.rare = [min(w, key=self.rank.__getitem__) for w, _ in self.phrases]

    def rarest_places(self, template: list[bytes]) -> list[int]:
        """Places of a passage, rarest word first: one more than a match may lack."""
        lacks = max(k for k in range(len(template) + 1) if (len(template) - k) / len(template) >= MATCH)
        return sorted(range(len(template)), key=lambda j: (self.rank[template[j]], j))[:lacks + 1]

    def starts(self, at: dict[bytes, list[int]], template: list[bytes]) -> list[int]:
        """All starts at which every word of a phrase stands in place, rarest word first."""
        order = sorted(range(len(template)), key=lambda j: (self.rank[template[j]], j))
        found = None
        for j in order:
            here = {p - j for p in at.get(template[j], ())}
            found = here if found is None else found & here
            if not found:
                return []
        return sorted(x for x in found if x >= 0)

    def scan(self, text: str | None) -> dict:
        w = words(text)
        known = self.rank.keys() & set(w)
        out = {"n_words": len(w), "n_base": 0, "first_word": None, "last_word": None, "base": set(), "labels": set(),
               "spans": [], "score": 0.0}
        if not known:
            return out
        rarest = [r in known for r in self.rare]
        wanted = [(*p, probe) for p, probe in zip(self.passages, self.probes)
                  if sum(x in known for x in p[0]) / len(p[0]) >= MATCH]
        if not any(rarest) and not wanted:
            return out
        at: dict[bytes, list[int]] = {}
        for i, x in enumerate(w):
            if x in known:
                at.setdefault(x, []).append(i)
        for (template, label), on in zip(self.phrases, rarest):
            for s in self.starts(at, template) if on else ():
                out["n_base"] += 1
                out["base"].add(label)
                out["spans"].append((label, s, s + len(template)))
        for template, key, label, probe in wanted:
            if not self.starts(at, key):
                continue
            votes = {p - j for j in probe for p in at.get(template[j], ())}
            places = [set(at.get(y, ())) for y in template]
            for s in sorted(votes):
                share = sum(s + j in here for j, here in enumerate(places)) / len(template)
                if share >= MATCH:
                    out["labels"].add(label)
                    out["spans"].append((label, max(s, 0), s + len(template)))
                    out["score"] = max(out["score"], share)
        if out["n_base"]:
            base = [s for label, s, _ in out["spans"] if label in out["base"]]
            out["first_word"], out["last_word"], out["score"] = min(base), max(base), 1.0
        return out


def scan(docs: DataFrame, index: Index) -> DataFrame:
    """Counts, labels and spans (label, first word, word after the last) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                x = index.scan(t.as_py())
                rows.append((x["n_words"], x["n_base"], x["first_word"], x["last_word"],
                             ",".join(sorted(x["base"])), ",".join(sorted(x["base"] | x["labels"])), x["score"],
                             [dict(zip(("label", "start", "stop"), s)) for s in x["spans"]]))
            cols = list(zip(*rows)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
             "labels string, score double, spans array<struct<label: string, start: long, stop: long>>")


__all__ = ["Index", "PASSAGES", "PHRASES", "frequencies", "scan", "vocabulary", "words"]
