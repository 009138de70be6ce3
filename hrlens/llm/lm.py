"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Training counts all words and word pairs exactly (tasks count locally with numpy, Spark shuffles sorted blocks by hash
segment and sums them).  A count c is quantised to the level floor(log2 c), and the pairs (n-gram, 0) .. (n-gram, level)
are inserted.  A lookup probes levels upwards until one is absent, so it never underestimates the level and passes it
with the filter's false-positive rate only.  With d(.) the middle of a level's counts and N, V the exact numbers of
tokens and distinct tokens:

    P(w)     = (d(w) + 1) / (N + V + 1)
    P(w | h) = (min(d(h w), d(h)) + a P(w)) / (d(h) + a)

The filter consists of one part per hash segment.  Workers get it in broadcast slices of at most ``SLICE_BYTES``, and
a task holds one slice at a time while it goes through a chunk of documents; so memory does not grow with the corpus,
the slices (about ``BITS`` bits an insertion) lie on the executors' disks.

The base score needs exact counts: words with at least N / HEAD_WORDS occurrences, of which there are HEAD_WORDS at
most, are broadcast; the other words of a document are joined with the counts by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, Scratch, WordIds, body, bound_batches, chunks, crc_of_id, mix64, partitions

END = b"\n"  # no word holds white space
BITS, HASHES = 10, 6
MAX_LEVELS = 48
SLICE_BYTES = 64 << 20
SEGMENT_GRAMS = 1_000_000
HEAD_WORDS = 1 << 22
BACKOFF = 1000.0
#: Tokens a task handles together.
TOGETHER = 1_500_000


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; the end token is added by the callers."""
    return text.encode().lower().split()


def sequence(ids: WordIds, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of the texts, an end after each and one before the first; and each text's token count."""
    end = ids[END]
    parts, sizes = [np.array([end])], []
    for t in texts:
        words = tokens(t)
        words.append(END)
        parts.append(ids.index(words))
        sizes.append(len(words))
    return np.concatenate(parts), np.array(sizes, np.int64)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of word pairs, lowest bit 1; words have lowest bit 0."""
    return mix64(a * U64(0x9E3779B97F4A7C15) + b) | U64(1)


def word_hash(h: np.ndarray) -> np.ndarray:
    return h & ~U64(1)


def segment_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((mix64(h) >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def spread(h: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 32-bit hashes of (n-gram, level), from which all probes follow."""
    a = mix64(h + U64((0xA0761D6478BD642F * (level + 1)) & 0xFFFFFFFFFFFFFFFF))
    return a & U64(0xFFFFFFFF), a >> U64(32)


def probe(low: np.ndarray, high: np.ndarray, k: int, size: np.ndarray) -> np.ndarray:
    """Bit position of the k-th probe in a part of ``size`` bits."""
    return ((low + U64(k) * high & U64(0xFFFFFFFF)) * size >> U64(32)).astype(np.int64)


def build_part(h: np.ndarray, c: np.ndarray) -> bytes:
    """Filter part of n-grams and their counts, BITS bits an insertion."""
    level = np.floor(np.log2(c)).astype(np.int64) if len(c) else np.empty(0, np.int64)
    size = max(64, -(-int((level + 1).sum()) * BITS // 8) * 8)
    bits = np.zeros(size, bool)
    for j in range(int(level.max(initial=-1)) + 1):
        low, high = spread(h[level >= j], j)
        for k in range(HASHES):
            bits[probe(low, high, k, U64(size))] = True
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class Slice:
    """Parts of consecutive segments, as one byte array."""
    first: int
    bits: np.ndarray
    start: np.ndarray          # first bit of each part
    size: np.ndarray           # bits of each part
    _TOGETHER = 1 << 15

    def levels(self, h: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Highest level found of each n-gram, -1 for none."""
        out = np.full(len(h), -1, np.int64)
        for i in range(0, len(h), self._TOGETHER):  # arrays of a block stay in the processor's cache
            live = np.arange(i, min(i + self._TOGETHER, len(h)))
            part = segment[live] - self.first
            gram, size, start = h[live], self.size[part], self.start[part]
            for level in range(MAX_LEVELS):
                low, high = spread(gram, level)
                ok = np.ones(len(live), bool)
                for k in range(HASHES):
                    at = probe(low, high, k, size) + start
                    ok &= self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
                    if np.count_nonzero(ok) < 0.7 * len(ok) or k == HASHES - 1:
                        live, gram, size, start, low, high = (x[ok] for x in (live, gram, size, start, low, high))
                        ok = np.ones(len(live), bool)
                out[live] = level
                if not len(live):
                    break
        return out


def middle(level: np.ndarray) -> np.ndarray:
    """Middle of the counts 2**level .. 2**(level + 1) - 1; 0 for level -1."""
    return np.where(level < 0, 0.0, 1.5 * np.exp2(level) - 0.5)


@dataclass
class LanguageModel:
    n_tokens: int
    n_distinct: int
    n_segments: int
    slices: list = field(default_factory=list)      # broadcasts of Slice
    spans: list = field(default_factory=list)       # segments (first, last + 1) of each slice
    head_hash: object = None                        # broadcast of sorted hashes and their counts
    counts: DataFrame | None = None                 # all words: h, c

    def levels(self, h: np.ndarray) -> np.ndarray:
        segment = segment_of(h, self.n_segments)
        out = np.full(len(h), -1, np.int64)
        for (first, end), shared in zip(self.spans, self.slices, strict=True):
            inside = np.flatnonzero((segment >= first) & (segment < end))
            if len(inside):
                part = shared.load_from_path(shared._path) if getattr(shared, "_path", None) and len(self.slices) > 1 else shared.value
                out[inside] = part.levels(h[inside], segment[inside])
        return out


def count_blocks(docs: DataFrame, n_segments: int) -> DataFrame:
    """Rows (segment, h, c): sorted hashes and counts of the words and pairs that one task has seen."""
    def blocks(ids: WordIds, seqs: list[np.ndarray]) -> pd.DataFrame:
        hashes = word_hash(ids.hashes())
        words = np.bincount(np.concatenate([s[1:] for s in seqs]), minlength=len(hashes))
        pairs, pair_c = np.unique(np.concatenate([s[:-1] << 32 | s[1:] for s in seqs]), return_counts=True)
        h = np.concatenate([hashes[words > 0], pair_hash(hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF])])
        c = np.concatenate([words[words > 0], pair_c]).astype(np.uint32)
        segment = segment_of(h, n_segments)
        order = np.argsort(segment, kind="stable")
        h, c, segment = h[order], c[order], segment[order]
        cuts = np.flatnonzero(np.diff(segment, prepend=-1)) if len(h) else []
        ends = np.append(cuts[1:], len(h)).astype(int) if len(h) else []
        return pd.DataFrame({"segment": segment[cuts], "h": [h[i:j].tobytes() for i, j in zip(cuts, ends, strict=True)],
                             "c": [c[i:j].tobytes() for i, j in zip(cuts, ends, strict=True)]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, seqs, n = WordIds(), [], 0
        for batch in batches:
            texts = list(batch["text"])
            for i, j in chunks([len(t) for t in texts], 6 * TOGETHER):
                s, _ = sequence(ids, texts[i:j])
                seqs.append(s)
                n += len(s)
                if n > TOGETHER:
                    yield blocks(ids, seqs)
                    seqs, n = [], 0
                    ids.room()
        if seqs:
            yield blocks(ids, seqs)
    return docs.select(body().alias("text")).mapInPandas(count, "segment long, h binary, c binary")


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """One segment: exact counts of its n-grams, its part of the filter, and its words."""
    h = np.concatenate([np.frombuffer(x, U64) for x in group["h"]])
    c = np.concatenate([np.frombuffer(x, np.uint32) for x in group["c"]]).astype(np.int64)
    order = np.argsort(h)
    h, c = h[order], c[order]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    h, c = h[at], np.add.reduceat(c, at)
    word = h & U64(1) == 0
    return pd.DataFrame({"segment": [group["segment"].iloc[0]], "part": [build_part(h, c)],
                         "word_h": [h[word].tobytes()], "word_c": [c[word].tobytes()],
                         "n": [int(c[word].sum())], "v": [int(word.sum())]})


def train_model(training: DataFrame, scratch: Scratch) -> LanguageModel:
    """Count the texts and build the filter.  An empty table gives a model without counts."""
    spark = training.sparkSession
    bound_batches(spark)
    size = training.agg(F.sum(F.octet_length(body())).alias("b"), F.count(F.lit(1)).alias("n")).first()
    n_segments = max(partitions(spark), -(-((size["b"] or 0) // 5 + size["n"]) // SEGMENT_GRAMS))
    model = scratch.table("model", count_blocks(training, n_segments).groupBy("segment")
                          .applyInPandas(_merge, "segment long, part binary, word_h binary, word_c binary, n long, v long"))
    total = model.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum(F.length("part")).alias("b")).first()
    lm = LanguageModel(total["n"] or 0, total["v"] or 0, n_segments)

    # the filter, slice by slice: each is bounded, and only one is on the driver at a time
    sizes = {r["segment"]: r["b"] for r in model.select("segment", F.length("part").alias("b")).collect()}
    for first, end in chunks([sizes.get(s, 0) for s in range(n_segments)], SLICE_BYTES):
        bytes_of = np.array([sizes.get(s, 0) for s in range(first, end)], np.int64)
        start = np.cumsum(bytes_of) - bytes_of
        bits = np.zeros(max(1, int(bytes_of.sum())), np.uint8)
        for r in model.where(F.col("segment").between(first, end - 1)).select("segment", "part").toLocalIterator():
            at = start[r["segment"] - first]
            bits[at:at + len(r["part"])] = np.frombuffer(r["part"], np.uint8)
        lm.slices.append(spark.sparkContext.broadcast(Slice(first, bits, start * 8, np.maximum(bytes_of * 8, 1).astype(U64))))
        lm.spans.append((first, end))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for h, c in zip(batch["word_h"], batch["word_c"], strict=True):
                yield pd.DataFrame({"h": np.frombuffer(h, np.int64), "c": np.frombuffer(c, np.int64)})
    lm.counts = model.select("word_h", "word_c").mapInPandas(words, "h long, c long")
    # at most HEAD_WORDS words have a count of n_tokens / HEAD_WORDS or more
    head = lm.counts.where(F.col("c") >= max(1, lm.n_tokens / HEAD_WORDS)).toPandas().sort_values("h")
    lm.head_hash = spark.sparkContext.broadcast((head["h"].to_numpy(np.int64), head["c"].to_numpy(np.int64)))
    return lm


def look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of sorted keys, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], -1)


class _KnownWords(WordIds):
    """Words of a task with their exact counts (-1: not a head word) and their counts in the filter."""

    def __init__(self, lm: LanguageModel):
        super().__init__(400_000)
        self.lm, self.exact, self.quantised = lm, np.empty(0, np.int64), np.empty(0)

    def room(self) -> None:
        super().room()
        self.exact, self.quantised = self.exact[:len(self)], self.quantised[:len(self)]

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = word_hash(self.hashes())
        new = h[len(self.exact):]
        if len(new):
            self.exact = np.concatenate([self.exact, look_up(*self.lm.head_hash.value, new.view(np.int64))])
            self.quantised = np.concatenate([self.quantised, middle(self.lm.levels(new))])
        return h, self.exact, self.quantised


def _score_chunk(lm: LanguageModel, ids: _KnownWords, texts: list[str], backoff: float) -> pd.DataFrame:
    seq, sizes = sequence(ids, texts)
    hashes, exact, quantised = ids.counts()
    history, word = seq[:-1], seq[1:]
    pairs = middle(lm.levels(pair_hash(hashes[history], hashes[word])))
    p1 = (quantised + 1) / (lm.n_tokens + lm.n_distinct + 1)
    before = quantised[history]
    p = (np.minimum(pairs, before) + backoff * p1[word]) / (before + backoff)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    logs = np.where(exact > 0, np.log10(np.maximum(exact, 0) + 1.0), 0.0)
    known = (exact > 0).astype(np.int64)
    tail = np.flatnonzero(exact[word] < 0)
    doc = np.searchsorted(ends, tail, side="right")
    key, times = np.unique(doc << 32 | word[tail], return_counts=True)
    cuts = np.searchsorted(key >> 32, np.arange(len(texts) + 1))
    tail_h = hashes.view(np.int64)[key & 0xFFFFFFFF]
    return pd.DataFrame({
        "n_tokens": sizes, "score": np.add.reduceat(np.log10(p), starts),
        "known": np.add.reduceat(known[word], starts), "logs": np.add.reduceat(logs[word], starts),
        "tail_h": [tail_h[i:j] for i, j in zip(cuts, cuts[1:], strict=False)],
        "tail_n": [times[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]})


def score_texts(docs: DataFrame, lm: LanguageModel, scratch: Scratch, backoff: float = BACKOFF) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = LanguageModel(lm.n_tokens, lm.n_distinct, lm.n_segments, lm.slices, lm.spans, lm.head_hash)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _KnownWords(shared)
        for batch in batches:
            texts = list(batch["text"])
            for i, j in chunks([len(t) for t in texts], 6 * TOGETHER):
                out = _score_chunk(shared, ids, texts[i:j], backoff)
                out.insert(0, "doc_id", pd.array([None if n else int(d) for d, n in zip(batch["id"][i:j], batch["no_id"][i:j], strict=True)], "Int64"))
                yield out
                ids.room()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), body().alias("text"))
    scored = rows.mapInPandas(score, "doc_id long, n_tokens long, score double, known long, logs double, tail_h array<long>, tail_n array<long>")
    scored = scratch.table("scored", scored.withColumn("row", F.monotonically_increasing_id()))
    tail = (scored.select("row", F.explode(F.arrays_zip("tail_h", "tail_n")).alias("t")).select("row", "t.tail_h", "t.tail_n")
            .join(lm.counts, F.col("tail_h") == F.col("h"))
            .groupBy("row").agg(F.sum("tail_n").alias("more"), F.sum(F.col("tail_n") * F.log10(F.col("c") + 1)).alias("more_logs")))
    none = float(np.log10(lm.n_tokens + lm.n_distinct + 1))
    return (scored.join(tail, "row", "left")
            .select("doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                    F.lit(lm.n_tokens).cast("long").alias("train_tokens"),
                    (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * none).alias("base_score"), "score"))


def held_out(doc_id: Column) -> Column:
    return crc_of_id(doc_id) % 7 == 2


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of all texts, learned from the documents that are not held out."""
    scratch = Scratch(docs.sparkSession, "lm")
    lm = train_model(docs.where(~held_out(F.col("doc_id"))), scratch)
    return score_texts(docs, lm, scratch).withColumn("held_out", held_out(F.col("doc_id")))
