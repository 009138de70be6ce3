"""Document fingerprints by locally consistent parsing.

A text's code points are cut into short phrases by deterministic coin tossing, the phrases are named by a hash, and
the sequence of names is parsed again, level by level, until one name is left.  Where a phrase ends depends on a few
symbols around it only, so equal substrings get equal phrases except near their borders, at any offset.

One level: runs of one symbol become one symbol; every symbol is replaced by the position and value of the lowest bit
that tells it from its left neighbour, three times more on the small labels, which leaves six labels with neighbours
apart; a phrase starts at each local maximum, so phrases have 2 to about 11 symbols.

The fingerprint is the last name (the same for equal texts) and a bottom-k sketch of the phrase names from the second
level on.  The likeness of two fingerprints estimates the Jaccard similarity of their phrase sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, body, bound_batches, chunks, mix64, partitions, range_bounds, range_index

SKETCH = 64
FIRST_LEVEL = 2
#: Code points parsed together; arrays of one parse hold a few multiples of this.
TOGETHER = 1_000_000
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def coin_labels(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5, different for neighbours in one text; ``s`` has no equal neighbours in one text."""
    x = np.empty_like(s)
    x[1:] = s[1:] ^ s[:-1]
    x[first] = 1
    low = x & (~x + U64(1))
    label = (np.bitwise_count(low - U64(1)) << 1).astype(np.uint8)
    label += (s & low) != 0
    for _ in range(3):
        y = np.empty_like(label)
        y[1:] = label[1:] ^ label[:-1]
        y[first] = 1
        low8 = y & (~y + np.uint8(1))
        bit = (label & low8) != 0
        label = np.bitwise_count(low8 - np.uint8(1)) << 1
        label += bit
    return label


def parse_level(s: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of symbol sequences (``doc`` numbers the texts, ascending)."""
    start = np.empty(len(s), bool)
    start[0] = True
    start[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(start)
    if len(at) < len(s):
        run = np.diff(at, append=len(s)).astype(U64)
        s, doc = s[at], doc[at]
        many = run > 1
        s[many] = mix64(s[many] + U64(0x9E3779B97F4A7C15) * run[many])
    first = np.empty(len(s), bool)
    first[0] = True
    np.not_equal(doc[1:], doc[:-1], out=first[1:])
    label = coin_labels(s, first)
    mark = first.copy()
    mark[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
    at = np.flatnonzero(mark)
    size = np.diff(at, append=len(s))
    place = np.arange(len(s)) - np.repeat(at, size)
    names = np.add.reduceat(mix64(s + U64(0xD1B54A32D192ED03) * place.astype(U64)), at)
    return mix64(names + size.astype(U64)), doc[at]


def parse(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Roots of the texts, and all phrases from FIRST_LEVEL on as (text number, 32-bit hash)."""
    lengths = np.array([len(t) for t in texts])
    root = np.zeros(len(texts), U64)
    s = np.concatenate(texts).astype(U64) if len(texts) else np.empty(0, U64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    found_doc, found = [], []
    level = 0
    while len(s):
        s, doc = parse_level(s, doc)
        level += 1
        if level >= FIRST_LEVEL:
            found.append((mix64(s + U64(level)) >> U64(32)).astype(np.uint32))
            found_doc.append(doc)
        count = np.bincount(doc, minlength=len(texts))
        done = count[doc] == 1
        if level >= FIRST_LEVEL and done.any():
            root[doc[done]] = mix64(s[done] + U64(level))
            s, doc = s[~done], doc[~done]
    return root, np.concatenate(found_doc or [np.empty(0, np.int64)]), np.concatenate(found or [np.empty(0, np.uint32)])


def fingerprints(texts: list[np.ndarray]) -> list[str]:
    """Fingerprint of each text (an array of code points): root, and the sketch in ascending order."""
    root, doc, phrase = parse(texts)
    count = np.bincount(doc, minlength=len(texts))
    # only small hashes can be among the lowest; where repeats leave too few, the text's others are taken as well
    bound = np.minimum(4.0 * SKETCH / np.maximum(count, 1), 1.0) * 2.0**32
    low = phrase < bound[doc]
    key = np.unique(doc[low].astype(U64) << U64(32) | phrase[low])
    have = np.bincount((key >> U64(32)).astype(np.int64), minlength=len(texts))
    more = (have < SKETCH) & (bound < 2.0**32)
    if more.any():
        rest = more[doc]
        key = np.unique(np.concatenate([key, doc[rest].astype(U64) << U64(32) | phrase[rest]]))
        have = np.bincount((key >> U64(32)).astype(np.int64), minlength=len(texts))
    ends = np.cumsum(have)
    raw = (key & U64(0xFFFFFFFF)).astype(">u4")
    return [f"{r:016x}:" + raw[e - n:min(e, e - n + SKETCH)].tobytes().hex() for r, e, n in zip(root.tolist(), ends.tolist(), have.tolist(), strict=True)]


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard similarity of the phrase sets behind two fingerprints, 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.partition(":")[2]), ">u4") for f in (a, b))
    if not len(x) or not len(y):
        return 0.0
    lowest = np.union1d(x, y)[:SKETCH]
    return float(np.isin(lowest, x).__and__(np.isin(lowest, y)).mean())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def edited(text: str, following: str) -> str:
    """The last floor(n / 4) code points replaced by the first as many (or all) of the following text."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


def fingerprint_texts(texts: list[str]) -> list[str]:
    out = []
    for i, j in chunks([len(t) for t in texts], TOGETHER):
        out += fingerprints([code_points(t) for t in texts[i:j]])
    return out


def _neighbours(texts: list[str], ids: list) -> pd.DataFrame:
    """Result rows of all texts but the last, which is only the following one."""
    own, changed = fingerprint_texts(texts), [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    other = fingerprint_texts(changed)
    return pd.DataFrame({
        "doc_id": pd.array(ids, "Int64"), "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": own[:-1], "edited_fingerprint": other,
        "near_edited": [likeness(a, b) for a, b in zip(own, other, strict=False)],
        "near_next": [likeness(a, b) for a, b in zip(own, own[1:], strict=False)]})


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of sorted ranges, each ended by the first row of the following range (marked ``tail``)."""
    texts, ids, at, closed = [], [], None, False
    for batch in batches:
        for r, tail, doc_id, null, text in zip(batch["range"], batch["tail"], batch["key"], batch["no_id"], batch["text"], strict=True):
            if r != at:
                at, closed = r, False
                texts, ids = [], []
            if tail:
                if not closed and ids:
                    yield _neighbours([*texts, text], ids)
                texts, ids, closed = [], [], True
                continue
            texts.append(text)
            ids.append(None if null else doc_id)
        if len(ids) > 1:
            yield _neighbours(texts, ids[:-1])
            texts, ids = texts[-1:], ids[-1:]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (see ``edited``), with their likenesses.

    The following document is the next in doc_id order (NULL first, equal ids by text; after the last the first).
    Documents are dealt into key ranges by quantiles of doc_id, each sorted and streamed.  The first document of a
    range also goes to the end of the range before it, so ranges need nothing from one another: one shuffle of texts.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    n = partitions(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63).cast("long"))
    bounds = range_bounds(docs, 3 * n)
    keyed = docs.select(range_index(F.col("doc_id").cast("long"), bounds).alias("range"), key.alias("key"),
                        F.col("doc_id").isNull().alias("no_id"), body().alias("text"))
    # one row a range: three times the number of shuffle partitions
    firsts = sorted((r["range"], r["k"]) for r in keyed.groupBy("range").agg(F.min("key").alias("k")).collect())
    before = [(k, firsts[i - 1][0]) for i, (_, k) in enumerate(firsts)]
    one = F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("tail")))
    if before:
        to = F.create_map(*[F.lit(x) for pair in before for x in pair])[F.col("key")]
        one = F.when(to.isNull(), one).otherwise(F.concat(one, F.array(F.struct(to.alias("range"), F.lit(True).alias("tail")))))
    dealt = keyed.select(F.explode(one).alias("to"), "key", "no_id", "text").select("to.range", "to.tail", "key", "no_id", "text")
    dealt = dealt.repartition(n, "range").sortWithinPartitions("range", "tail", "key", F.col("no_id").desc(), "text")
    return dealt.mapInPandas(_stream, RESULT)
