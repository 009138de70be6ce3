"""Spelling variants: near words by blocked Gram matrices of letter counts.

Words are counted over whole texts.  Each distinct word has a vector of letter counts; one edit changes it by a squared
distance of at most two (one inserted or deleted letter: 1, one replaced letter: 2), and the length by at most one.

1. The alphabet is split into ``CLASSES`` letter classes of about equal use.  Words with the same number of letters in
   every class form a block; they have one length.  An edit moves a word to its own block, to the block with one letter
   more or less in one class (an adjacent length), or to the one with a letter more in one class and one less in
   another.  So blocks are joined by key with their few neighbours, each pair of blocks once.
2. For a pair of blocks a NumPy product of the letter counts gives all squared distances at once:
   ``|u|^2 + |v|^2 - 2 u.v``.  Pairs at 1 (adjacent lengths) or 2 (equal lengths) are then held against the words
   themselves: exactly one inserted, deleted or replaced code point.
3. A word's form is its most frequent near word, if that is frequent enough; roots follow forms by pointer doubling.

A block of many words is dealt into chunks that are packed in a sorted stream, so no task holds a whole block, and
chunks meet by the skew join rule.  The driver sees only the letters' counts (at most ``LETTERS`` rows).

Defined cases: a NULL text has no words; a NULL doc_id is written as the empty text; rows that repeat a doc_id or a
text are rows of their own and count each; an empty table, or one without a frequent word, gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, body, bound_batches, partitions

MIN_LENGTH, MIN_COUNT = 6, 5
#: A form occurs at least so many times as often as the word.
RATIO = 5
#: Of the dropped letters: one in so many runs of a document.
DAMAGE = 199
CLASSES = 8
#: The letters: a-z and the code points from U+00C0 to U+00FF, one byte each in Latin-1.
ALPHABET = np.r_[ord("a"):ord("z") + 1, 0xC0:0x100]
LETTERS = len(ALPHABET)
#: Words and letters in one chunk of a block.
CHUNK_WORDS, CHUNK_LETTERS = 1024, 1 << 16
#: Distances worked out at once.
PRODUCT = 1 << 21
#: Distinct words counted together in a task.
TOGETHER = 300_000

_INDEX = np.zeros(256, np.int64)
_INDEX[ALPHABET] = np.arange(LETTERS)
#: Latin-1 bytes to lower case (A-Z only); all that is no letter becomes a space.
_FOLD = bytes(b + 32 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else b if b in ALPHABET else 32 for b in range(256))
CHUNK = "key string, meets array<string>, length int, letters binary, counts array<long>"
COLUMNS = [c.split()[0] for c in CHUNK.split(", ")]


def texts(values: list[str]) -> pd.Series:
    """A column of plain strings; pandas' own string type may come in several pieces, which Arrow batches can't hold."""
    return pd.Series(values, dtype=object)


def add_runs(total: Counter, doc_id: str, text: str) -> None:
    """Counts the words of one text; some runs of a document lose a letter, as the checksum of id and run says."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(_FOLD).split()).items():
        if len(run) < MIN_LENGTH:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_LENGTH:
                continue
        total[run] += n


def count_words(docs: DataFrame) -> DataFrame:
    """word, n of all words of at least MIN_LENGTH letters with at least MIN_COUNT occurrences."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()

        def counted() -> pd.DataFrame:
            return pd.DataFrame({"word": texts([w.decode("latin-1") for w in total]), "n": list(total.values())})
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"], strict=True):
                add_runs(total, doc_id, text)
                if len(total) > TOGETHER:
                    yield counted()
                    total.clear()
        yield counted()
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    parts = docs.select(ids, body().alias("text")).mapInPandas(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def letter_classes(words: DataFrame) -> np.ndarray:
    """A class for each letter, classes being used about equally; letters go to the least used class, most used first."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()  # at most LETTERS rows
    used = {ord(r["letter"]): r["count"] for r in letters if r["letter"]}
    classes, load = np.zeros(LETTERS, np.int64), [0] * CLASSES
    for letter in sorted(used, key=lambda x: (-used[x], x)):
        c = min(range(CLASSES), key=lambda x: (load[x], x))
        classes[_INDEX[letter]] = c
        load[c] += used[letter]
    return classes


def matrix(letters: bytes, length: int) -> np.ndarray:
    """One row of letters a word."""
    return np.frombuffer(letters, np.uint8).reshape(-1, length)


def letter_counts(words: np.ndarray) -> np.ndarray:
    """Counts by letter, one row a word; float32 holds squared distances exactly for words below 2,048 letters."""
    n = len(words)
    at = _INDEX[words] + np.arange(n)[:, None] * LETTERS
    return np.bincount(at.ravel(), minlength=n * LETTERS).reshape(n, LETTERS).astype(np.float32 if words.shape[1] < 2048 else np.float64)


def key_of(counts) -> str:
    return ",".join(map(str, counts))


def neighbours(key: str) -> list[str]:
    """The block itself and those that an insertion, or a replacement by a letter of a later class, leads to."""
    c = [int(x) for x in key.split(",")]
    out = [key]
    for i in range(len(c)):
        c[i] += 1
        out.append(key_of(c))
        for j in range(i):
            if c[j]:
                c[j] -= 1
                out.append(key_of(c))
                c[j] += 1
        c[i] -= 1
    return out


def blocks(words: DataFrame, classes: np.ndarray) -> DataFrame:
    """The words in chunks of their blocks: key, meets (neighbours), length, letters (Latin-1, one word after the other), counts."""
    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            latin = [w.encode("latin-1") for w in batch["word"]]
            length = np.fromiter(map(len, latin), np.int64, len(latin))
            flat = classes[_INDEX[np.frombuffer(b"".join(latin), np.uint8)]]
            at = flat + np.repeat(np.arange(len(latin)), length) * CLASSES
            counts = np.bincount(at, minlength=len(latin) * CLASSES).reshape(-1, CLASSES)
            yield pd.DataFrame({"key": texts([key_of(c) for c in counts.tolist()]), "word": latin, "n": batch["n"]})

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, words, counts, size = None, [], [], 0

        def chunk() -> tuple:
            return key, neighbours(key), len(words[0]), b"".join(words), counts
        for batch in batches:
            out = []
            for k, w, n in zip(batch["key"], batch["word"], batch["n"], strict=True):
                if words and (k != key or len(words) == CHUNK_WORDS or size + len(w) > CHUNK_LETTERS):
                    out.append(chunk())
                    words, counts, size = [], [], 0
                key = k
                words.append(w)
                counts.append(n)
                size += len(w)
            if out:
                yield pd.DataFrame(out, columns=COLUMNS)
        if words:
            yield pd.DataFrame([chunk()], columns=COLUMNS)
    rows = words.select("word", "n").mapInPandas(keyed, "key string, word binary, n long")
    return (rows.repartitionByRange(partitions(words.sparkSession), "key", "word").sortWithinPartitions("key", "word")
            .mapInPandas(packed, CHUNK))


def edits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of letters: whether exactly one replacement, or insertion into the shorter ``a``, leads from a to b."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(np.c_[np.ones(len(a), bool), a == b[:, :n]], axis=1)        # the first p letters agree
    behind = np.logical_and.accumulate(np.c_[np.ones(len(a), bool), (a == b[:, 1:])[:, ::-1]], axis=1)[:, ::-1]  # the rest agrees one later
    return (ahead & behind).any(axis=1)


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` that are one edit apart; ``same``: they are one chunk, each pair counts once."""
    u, v = letter_counts(a), letter_counts(b)
    wanted = 2 if a.shape[1] == b.shape[1] else 1
    nv = (v * v).sum(axis=1)
    found = []
    step = max(1, PRODUCT // len(b))
    for i in range(0, len(a), step):
        x = u[i:i + step]
        d = (x * x).sum(axis=1)[:, None] + nv - 2 * (x @ v.T)
        p, q = np.nonzero(d == wanted)
        p += i
        if same:
            p, q = p[p < q], q[p < q]
        ok = edits(a[p], b[q]) if len(p) else np.zeros(0, bool)
        found.append((p[ok], q[ok]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def near_words(chunks: DataFrame) -> DataFrame:
    """word, near, near_n for each word and each of its near words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # chunks of one length that meet the same chunk are multiplied together
            for _, g in batch.groupby(["b_id", "a_length"], sort=False):
                first = g.iloc[0]
                b, nb = matrix(first["b_letters"], first["b_length"]), np.asarray(first["b_counts"])
                own = (g["a_id"] == g["b_id"]).to_numpy()
                for same in (False, True):
                    part = g[own == same]
                    if part.empty:
                        continue
                    a = matrix(b"".join(part["a_letters"]), first["a_length"])
                    na = np.concatenate(list(part["a_counts"]))
                    p, q = near_pairs(a, b, same)
                    if len(p):
                        wa = [x.tobytes().decode("latin-1") for x in a[p]]
                        wb = [x.tobytes().decode("latin-1") for x in b[q]]
                        yield pd.DataFrame({"word": texts(wa + wb), "near": texts(wb + wa), "near_n": np.concatenate([nb[q], na[p]])})

    def side(s: str) -> DataFrame:
        return chunks.select(*[F.col(c).alias(f"{s}_{c}") for c in chunks.columns])
    a = side("a").withColumn("meet", F.explode("a_meets"))
    # both sides grow with the vocabulary, one by its neighbours beyond what Spark foresees: never a broadcast
    met = (a.hint("merge").join(side("b"), F.col("meet") == F.col("b_key"))
           .where((F.col("meet") != F.col("a_key")) | (F.col("a_id") <= F.col("b_id")))
           .select(*[f"{s}_{c}" for s in "ab" for c in ("id", "length", "letters", "counts")]))
    return met.mapInPandas(run, "word string, near string, near_n long")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root of words with a form; each round doubles the steps made, so rounds grow with the log of the longest chain."""
    at = scratch.table("root-0", forms.select("word", F.col("form").alias("root")))
    i = 0
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = scratch.table(f"root-{i + 1}", at.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(f"root-{i}")
        i += 1
        at = new.select("word", "root")
        if new.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every frequent word of the texts.

    ``form``: the near word of largest n (ties: smallest in code-point order), if that n is at least RATIO times the
    word's; ``root``: the end of the chain of forms, the word itself without one.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "variants")
    words = scratch.table("words", count_words(docs))
    chunks = scratch.table("chunks", blocks(words, letter_classes(words)).withColumn("id", F.monotonically_increasing_id()))
    near = near_words(chunks).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    judged = scratch.table("judged", words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.minus") >= RATIO * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.minus")).alias("n"))).alias("f")))
    root = roots(judged.where("f is not null").select("word", "f.form"), scratch)
    return (judged.join(root, "word", "left")
            .select("word", F.col("f.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("f.n").alias("form_n")))
