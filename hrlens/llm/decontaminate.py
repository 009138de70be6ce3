"""Benchmark decontamination: two-word seeds, counted within a window, then Smith-Waterman alignment.

1. A seed is a pair of an item's words that stand next to each other or one word apart.  One pass over the documents
   looks up their pairs of the same kind.  Seeds are broadcast; a benchmark of more than ``SEED_BLOCK`` words is dealt
   into blocks of items, one pass each.
2. An alignment that reaches the threshold has few edits for its matches, so a known number of its matched words are
   followed by the next one at most one word on, in the document and in the item (``need_of``).  A document with that
   many seeds of an item within the longest stretch such an alignment can take is a candidate.  The gate follows from
   the score alone: it drops no pair that aligns, however often its seeds occur elsewhere.
3. The candidate's stretches are aligned with the item, word by word (match 2, mismatch and gap -1); equal stretches
   once.  The score is the best local alignment over that of a perfect copy; from ``THRESHOLD`` on the document is
   contaminated.  Items of one or two words have to occur with all their words.

Words are runs of characters between white space and ASCII punctuation, in lower case.
"""

from __future__ import annotations

import functools
import math
import string
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import body, bound_batches, chunks

SEED_BLOCK = 2_000_000
THRESHOLD = 0.5
MATCH, MISS, GAP = 2, -1, 1
TOGETHER = 1_000_000
HITS_TOGETHER = 2_000_000
REMEMBERED = 20_000
_TABLE = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_TABLE).split()


def need_of(n_words: int) -> int:
    """Least number of close pairs in an alignment that reaches the threshold.

    With x matched words and costs c between one and the next, 2x - sum(c) >= 2 * THRESHOLD * n.  If k of the x - 1 steps
    cost at most 1 (no more than one word between, on either side) and the others at least 2, k >= THRESHOLD * n - 1.
    """
    return max(1, math.ceil(THRESHOLD * n_words) - 1)


def reach_of(n_words: int) -> int:
    """Words of a document that such an alignment spans at most: x + sum(c) <= 3x - 2 * THRESHOLD * n."""
    return max(1, math.floor((3 - 2 * THRESHOLD) * n_words))


class Seeds:
    """The items' words as numbers, and for every seed the items that have it."""

    def __init__(self, item_ids: list[int], texts: list[str]):
        split = [(i, w) for i, w in zip(item_ids, map(words_of, texts), strict=True) if w]
        self.item_ids = [i for i, _ in split]
        self.vocabulary: dict[bytes, int] = {}
        self.items = [np.array([self.vocabulary.setdefault(x, len(self.vocabulary)) for x in w], np.int64) for _, w in split]
        self.n_words = len(self.vocabulary)
        self.single = any(len(w) == 1 for w in self.items)
        self.need = np.array([need_of(len(w)) for w in self.items], np.int64)
        self.reach = np.array([reach_of(len(w)) for w in self.items], np.int64)
        keys = [np.unique(self.keys_of(w)) for w in self.items]
        key = np.concatenate([np.empty(0, np.int64), *keys])
        order = np.argsort(key, kind="stable")
        self.owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])[order]
        self.key, self.first = np.unique(key[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(key)))
        self.known: dict[tuple[int, bytes], tuple[int, int, int, int]] = {}

    def keys_of(self, w: np.ndarray) -> np.ndarray:
        n = self.n_words
        if len(w) == 1:
            return n * n + w
        return np.concatenate([w[:-1] * n + w[1:], w[:-2] * n + w[2:]]) if len(w) > 2 else w[:1] * n + w[1:]

    def lookup(self, flat: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``flat`` and number of the seed, of every seed found; by place."""
        places, seeds = [], []
        for apart in (1, 2, *([0] if self.single else [])):
            a, b = flat[:len(flat) - apart], flat[apart:]
            at = np.flatnonzero((a >= 0) & (b >= 0) & (doc[:len(a)] == doc[apart:]))
            key = a[at] * self.n_words + b[at] if apart else self.n_words**2 + a[at]
            near = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = np.flatnonzero(self.key[near] == key)
            places.append(at[hit])
            seeds.append(near[hit])
        place, seed = np.concatenate(places), np.concatenate(seeds)
        order = np.argsort(place, kind="stable")
        return place[order], seed[order]

    def best(self, item: int, window: np.ndarray) -> tuple[int, int, int, int]:
        """``align``, remembered for equal stretches."""
        key = (item, window.tobytes())
        if key not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[key] = align(self.items[item], window)
        return self.known[key]

    def matches(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, float, int, int]]:
        """(text, item_id, n_seeds, matched, score, first word, end word) of every text and item it holds a copy of."""
        if not self.items:
            return
        for i, j in chunks([len(t) for t in texts], TOGETHER):
            words = [words_of(t) for t in texts[i:j]]
            starts = np.cumsum([0, *map(len, words)])
            flat = np.fromiter(map(self.vocabulary.get, chain.from_iterable(words), repeat(-1)), np.int64, starts[-1])
            doc = np.repeat(np.arange(j - i), np.diff(starts))
            place, seed = self.lookup(flat, doc)
            total = np.bincount(doc[place], self.count[seed], j - i).astype(np.int64).tolist()
            for d, e in chunks(total, HITS_TOGETHER):
                a, b = np.searchsorted(place, (starts[d], starts[e]))
                for k, *found in self._candidates(flat, doc, starts, place[a:b], seed[a:b]):
                    yield (i + k, *found)

    def _candidates(self, flat: np.ndarray, doc: np.ndarray, starts: np.ndarray, place: np.ndarray, seed: np.ndarray) -> Iterator[tuple]:
        n = self.count[seed]
        post = np.repeat(self.first[seed] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        hits = np.unique(self.owner[post] * len(flat) + np.repeat(place, n))
        item, at = np.divmod(hits, max(1, len(flat)))
        last = np.arange(len(hits)) + self.need[item] - 1
        first = np.flatnonzero(last < len(hits))
        last = last[first]
        first, last = (x[(item[first] == item[last]) & (doc[at[first]] == doc[at[last]]) & (at[last] - at[first] < self.reach[item[first]])] for x in (first, last))
        if not len(first):
            return
        item_of, doc_of = item[first], doc[at[first]]
        low = np.maximum(at[last] - self.reach[item_of], starts[doc_of])
        high = np.minimum(at[first] + self.reach[item_of] + 1, starts[doc_of + 1])
        cut = np.flatnonzero((np.diff(item_of) != 0) | (np.diff(doc_of) != 0) | (low[1:] > high[:-1])) + 1
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for x, y in zip([0, *cut], [*cut - 1, len(first) - 1], strict=True):
            k, d, reach = int(item_of[x]), int(doc_of[x]), int(self.reach[item_of[x]])
            a, b, step = int(low[x]), int(high[y]), 64 * reach
            for c in range(a, max(a + 1, b - reach), step):  # an alignment is no longer than the overlap
                score, matched, f, end = self.best(k, flat[c:min(b, c + step + reach)])
                if score > best.get((d, k), (0,))[0]:
                    best[d, k] = (score, matched, c + f - int(starts[d]), c + end - int(starts[d]))
        for (d, k), (score, matched, f, end) in best.items():
            size = len(self.items[k])
            if matched < size if size <= 2 else score < THRESHOLD * MATCH * size:
                continue
            a, b = np.searchsorted(hits, (k * len(flat) + starts[d], k * len(flat) + starts[d + 1]))
            yield d, self.item_ids[k], int(b - a), matched, score / (MATCH * size), f, end


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment: score, matched words, first word and end in the window."""
    m, w = len(item), len(window)
    grid = np.zeros((m + 1, w + 1), np.int64)
    steps = GAP * np.arange(1, w + 1)
    for i in range(1, m + 1):
        fresh = np.maximum(grid[i - 1, :-1] + np.where(window == item[i - 1], MATCH, MISS), grid[i - 1, 1:] - GAP)
        np.maximum(fresh, 0, out=fresh)
        grid[i, 1:] = np.maximum.accumulate(fresh + steps) - steps
    i, j = divmod(int(grid.argmax()), w + 1)
    score, end, matched = int(grid[i, j]), j, 0
    while grid[i, j] > 0:
        if grid[i, j] == grid[i - 1, j - 1] + (MATCH if item[i - 1] == window[j - 1] else MISS):
            matched += item[i - 1] == window[j - 1]
            i, j = i - 1, j - 1
        elif grid[i, j] == grid[i - 1, j] - GAP:
            i -= 1
        else:
            j -= 1
    return score, int(matched), j, end


def seed_blocks(items: DataFrame) -> Iterator[Seeds]:
    """The items in blocks whose seeds are few enough to broadcast; at least one."""
    rows = items.where("item_id is not null").select(F.col("item_id").cast("long"), body().alias("item")).distinct()
    n_words = rows.agg(F.sum(F.length("item") / 2 + 1)).first()[0] or 0
    n_blocks = max(1, math.ceil(n_words / SEED_BLOCK))
    for b in range(n_blocks):
        block = rows.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(n_blocks)) == b).collect()
        yield Seeds([r["item_id"] for r in block], [r["item"] for r in block])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for every document and item it holds a copy of, exact or edited.

    ``n_seeds`` counts the document's places with a seed of the item.  Documents and items without words match nothing,
    nor does a NULL item_id.  Rows that repeat a document give a row each, rows that repeat an item count once.
    """
    bound_batches(docs.sparkSession)
    return functools.reduce(DataFrame.unionByName, [_in_block(docs, seeds) for seeds in seed_blocks(items)])


def _in_block(docs: DataFrame, seeds: Seeds) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame(shared.value.matches(list(batch["text"])), columns=["k", "item_id", "n_seeds", "matched", "score", "first_word", "end_word"])
            if len(found):
                k = found.pop("k").to_numpy()
                yield pd.DataFrame({"id": batch["id"].to_numpy()[k], "no_id": batch["no_id"].to_numpy()[k]}).join(found)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), body().alias("text"))
    pairs = rows.mapInPandas(run, "id long, no_id boolean, item_id long, n_seeds long, matched long, score double, first_word long, end_word long")
    return pairs.select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "item_id", "n_seeds", "matched", "score", "first_word", "end_word")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows whose own text holds no benchmark item, with their columns."""
    bound_batches(docs.sparkSession)
    for seeds in seed_blocks(items):
        docs = docs.where(~_holds(docs, seeds))
    return docs


def _holds(docs: DataFrame, seeds: Seeds) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(seeds)

    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), bool)
        for k, *_ in shared.value.matches(list(texts)):
            out[k] = True
        return pd.Series(out)
    return holds(body())
