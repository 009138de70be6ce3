"""License scan: an exact set-similarity join of text blocks with license templates.

A template of m words is looked for in the text blocks of its size: windows of 2h words that start every h words, h
being the least power of two with h >= m, so that any passage of up to h words lies whole in a block.  Words count with
their multiplicity: the k-th occurrence of a word in a block or template is a token of its own.  A block holds a template
if it holds at least ``percent`` % of its tokens; every such block is found, by the filters of prefix joins:

- **order**: tokens are ordered by the number of documents that hold them, rarest first (counted over all documents);
- **prefix**: with a need of a tokens, one of the template's m - a + 1 rarest tokens must be in the block, so only
  blocks with such a token are looked at, and only templates listed under one;
- **length**: a block with fewer than a template tokens is out;
- **position**: at the first common token, no more can follow than what is left of either side in the order;
- **check**: the rest is held against the full token sets.

The templates come as a Python list, so their index is a closure of that size; it joins the documents in one pass without a
shuffle.  What the driver gathers is one count a token of the templates.

Beside the templates, base phrases are always reported with all their places.

Defined cases: a NULL text is an empty text (no words, no places, score 0); a NULL or repeated doc_id is a row like any
other; empty table: empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, bound_batches

#: Phrase and label.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
#: Label and notice, as their licenses ask for them.
TEMPLATES = [
    ("agpl", "GNU Affero General Public License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("boost", "Boost Software License, Version 1.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd", "licensed under CC BY-ND 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide"),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl", "GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software"),
]
#: Templates below ten words must be there whole.
PERCENT = 90
FOUND = "array<struct<label:string,template:int,first_word:long,last_word:long,containment:double>>"
PLACES = "array<struct<label:string,word:long>>"
RESULT = f"n_words long, places {PLACES}, found {FOUND}"

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and all other code points above U+007F; A-Z in lower case."""
    return text.encode().translate(_FOLD).split()


def tokens_of(words: list[bytes]) -> list[tuple[bytes, int]]:
    """Each word with the number of the occurrence, from 1."""
    seen: Counter = Counter()
    out = []
    for w in words:
        seen[w] += 1
        out.append((w, seen[w]))
    return out


def base_places(words: list[bytes]) -> list[tuple[str, int]]:
    """(label, word number) of every place of a base phrase."""
    found = []
    line = b" " + b" ".join(words) + b" "
    for phrase, label in BASE:
        parts = phrase.encode().split()
        if b" " + phrase.encode() + b" " not in line:
            continue
        at = -1
        for _ in range(words.count(parts[0])):
            at = words.index(parts[0], at + 1)
            if words[at:at + len(parts)] == parts:
                found.append((label, at))
    return sorted(found, key=lambda x: (x[1], x[0]))


class TemplateIndex:
    """The templates' tokens in their global order, and what the filters need."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[tuple[bytes, int], int], percent: int = PERCENT):
        self.labels = [label for label, _ in templates]
        sets = [tokens_of(words_of(text)) for _, text in templates]
        order = sorted({t for s in sets for t in s}, key=lambda t: (frequency.get(t, 0), t))
        rank = {t: r for r, t in enumerate(order)}
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for w, _ in order}))}
        self.word_of = np.array([self.vocabulary[w] for w, _ in order], np.int64)
        self.nth_of = np.array([k for _, k in order], np.int64)
        self.ranks = [np.array(sorted(rank[t] for t in s), np.int64) for s in sets]
        self.need = [-(-percent * len(s) // 100) for s in sets]
        #: half the block size -> rank -> templates of that size with the token in their prefix, and its position
        self.listed: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        self.least: dict[int, int] = {}
        for t, ranks in enumerate(self.ranks):
            if len(ranks):
                half = 1 << (len(ranks) - 1).bit_length()
                self.least[half] = min(self.least.get(half, len(ranks)), self.need[t])
                for i, r in enumerate(ranks[:len(ranks) - self.need[t] + 1].tolist()):
                    self.listed[half][r].append((t, i))
        self.listed = {half: dict(x) for half, x in self.listed.items()}
        self.seeds = {half: np.isin(np.arange(len(self.vocabulary)), self.word_of[list(x)]) for half, x in self.listed.items()}
        seed_ids = np.flatnonzero(np.logical_or.reduce(list(self.seeds.values()))) if self.seeds else []
        names = list(self.vocabulary)
        self.seed_words = {names[i] for i in seed_ids}

    def scan(self, words: list[bytes]) -> list[tuple[str, int, int, int, float]]:
        """(label, template, first word, last word exclusive, containment) of every block that holds a template."""
        if self.seed_words.isdisjoint(words):
            return []
        ids = np.fromiter((self.vocabulary.get(w, -1) for w in words), np.int64, len(words))
        at = np.flatnonzero(ids >= 0)
        ids = ids[at]
        found = []
        for half, listed in self.listed.items():
            first = at[self.seeds[half][ids]] // half
            blocks = np.unique(np.concatenate([first, first - 1]))
            for start in (blocks[blocks >= 0] * half).tolist():
                lo, hi = np.searchsorted(at, (start, start + 2 * half))
                found += [(self.labels[t], t, start, min(start + 2 * half, len(words)), share)
                          for t, share in self.held(ids[lo:hi], listed, self.least[half])]
        return sorted(found, key=lambda x: (x[2], x[3], x[0], x[1]))

    def held(self, block: np.ndarray, listed: dict[int, list[tuple[int, int]]], least: int) -> Iterator[tuple[int, float]]:
        """Templates held by a block of word ids, with the share of their tokens."""
        if len(block) < least:
            return
        present = np.bincount(block, minlength=len(self.vocabulary))[self.word_of] >= self.nth_of
        ranks = np.flatnonzero(present)
        seen = set()
        for j, r in enumerate(ranks.tolist()):
            for t, i in listed.get(r, ()):
                if t in seen:
                    continue
                seen.add(t)
                m, need = len(self.ranks[t]), self.need[t]
                if 1 + min(m - i - 1, len(ranks) - j - 1) < need:
                    continue
                both = int(present[self.ranks[t]].sum())
                if both >= need:
                    yield t, both / m


def token_frequencies(docs: DataFrame, templates: list[tuple[str, str]]) -> dict[tuple[bytes, int], int]:
    """Number of documents that hold each token of the templates; tasks add up their own counts first."""
    tokens = {t for _, text in templates for t in tokens_of(words_of(text))}
    most: dict[bytes, int] = {}
    for w, k in tokens:
        most[w] = max(k, most.get(w, 0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                for w, n in Counter(filter(most.__contains__, words_of(text))).items():
                    total[w, min(n, most[w])] += 1
        yield pd.DataFrame({"word": [w for w, _ in total], "nth": [k for _, k in total], "n": list(total.values())})
    counts = docs.select(body().alias("text")).mapInPandas(run, "word binary, nth int, n long")
    out: Counter = Counter()
    for r in counts.groupBy("word", "nth").agg(F.sum("n").alias("n")).collect():  # at most one row a token of the templates
        for k in range(1, r["nth"] + 1):  # a document with the k-th occurrence has those before it
            out[bytes(r["word"]), k] += r["n"]
    return dict(out)


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, places of base phrases, found (every block that holds a template) for every row."""
    bound_batches(docs.sparkSession)
    templates = TEMPLATES if templates is None else templates
    index = TemplateIndex(templates, token_frequencies(docs, templates), percent)

    @F.pandas_udf(f"struct<n_words:long,places:{PLACES},found:{FOUND}>")
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = words_of(text)
            rows.append((len(words), [dict(zip(("label", "word"), p, strict=True)) for p in base_places(words)],
                         [dict(zip(("label", "template", "first_word", "last_word", "containment"), f, strict=True)) for f in index.scan(words)]))
        return pd.DataFrame(rows, columns=["n_words", "places", "found"])
    return docs.select("doc_id", scan(body()).alias("s")).select("doc_id", "s.*")
