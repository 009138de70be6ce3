"""Token ids in directly addressable codes: random access to any token without decoding a block.

An id is split into 8-bit chunks, lowest first.  Level k holds the k-th chunks of the ids that have one, in order, as
a byte array, with one continuation bit a chunk saying whether the id goes on in level k + 1.  The place of an id's
chunk in the next level is the number of continuation bits before it (rank), answered by a directory of counts every
512 bits and a popcount of at most 64 bytes.  Reading one id touches one chunk and one directory entry a level.

Layout of one code (little endian): ``DAC1``, number of levels (u32), and per level: length n (u64), n chunk bytes,
ceil(n / 8) bitmap bytes, ceil(n / 512) + 1 directory entries (u64).

Files are Parquet tables of segments.  A segment holds consecutive documents of one key range: their ids as one code,
their lengths as another, so a document is found by summing lengths and any of its tokens by rank.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, bound_batches, chunks, partitions, range_bounds, range_index

MAGIC = b"DAC1"
END_ID = 0
#: Ids after which a segment is closed (a longer document is a segment of its own).
SEGMENT_IDS = 1_000_000
#: Characters of text encoded together (a longer document is encoded alone).
CHUNK_CHARS = 2_000_000
#: Bytes of one Arrow batch, of texts or of segments (a longer row is a batch of its own).
BATCH_BYTES = 4 << 20
#: Rows the Parquet reader decodes together; it holds their texts in arrays that double as they grow.
READER_ROWS = 512
SEGMENTS = "range int, segment long, start long, n_ids long, doc_ids array<long>, lengths binary, ids binary"


def dac_encode(values: np.ndarray) -> bytes:
    """Code of non-negative integers below 2**32."""
    rest = np.ascontiguousarray(values, np.uint32)
    levels = []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(rest) // 512) * 64, np.uint8)
        padded[:len(bits)] = bits
        counts = np.bitwise_count(padded).reshape(-1, 64).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        if not more.any():
            return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)
        rest = rest[more] >> 8


class DacReader:
    """Random access into a code."""

    def __init__(self, code: bytes):
        if code[:4] != MAGIC:
            raise ValueError("not a directly addressable code")
        self.levels, at = [], 8
        for _ in range(struct.unpack_from("<I", code, 4)[0]):
            n = struct.unpack_from("<Q", code, at)[0]
            chunks = np.frombuffer(code, np.uint8, n, at + 8)
            bits = np.frombuffer(code, np.uint8, -(-n // 8), at + 8 + n)
            at += 8 + n + len(bits)
            ranks = np.frombuffer(code, "<u8", -(-n // 512) + 1, at)
            at += 8 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i >> 9
            last = int(bits[i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(ranks[block]) + int(np.bitwise_count(bits[block << 6:i >> 3]).sum()) + last.bit_count()
        return value

    def all(self) -> np.ndarray:
        """All ids, level by level."""
        values, who = self.levels[0][0].astype(np.uint32), np.arange(len(self))
        for k, (_, bits, _) in enumerate(self.levels[:-1]):
            who = who[np.unpackbits(bits, count=len(who), bitorder="little").view(bool)]
            values[who] |= self.levels[k + 1][0].astype(np.uint32) << np.uint32(8 * (k + 1))
        return values


class _Pieces(dict):
    """Piece -> number, in order of first use."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        i = self[piece] = len(self)
        self.new.append(piece)
        return i


class WordEncoder:
    """Ids of texts from a byte-level tokenizer, each distinct word encoded once by the library.

    The tokenizer's pattern lets a match begin with one space but never run from a non-space character into a space.
    So a text may be cut before every space that stands between two non-space characters, and the pieces' ids
    joined: the result equals encoding the whole text.  About ``limit`` pieces are remembered; beyond that the half
    used most stays.
    """

    _NEAR_SPACE = re.compile(r"[\s]\s")
    _TOGETHER = 2000
    #: Characters that end a word; ``>`` is not among them, since special tokens end in it.
    _PUNCTUATION = ".,;:!?|)$&#%*\"]}"
    _LINE = re.compile(r"(?<=\S)\n(?=\S)")
    #: Marks a piece that has no space before it.
    _BARE = " "

    def __init__(self, path: str, limit: int = 600_000):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.known = _Pieces()
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.start, self.size, self.uses = (np.empty(0, np.int64) for _ in range(3))

    def _forget(self) -> None:
        keep = np.sort(np.argpartition(-self.uses, self.limit // 2)[:self.limit // 2])
        pieces = list(self.known)
        self.flat, size = self._gather(keep)
        self.start, self.size, self.uses, self.used = np.cumsum(size) - size, size, self.uses[keep], len(self.flat)
        self.known = _Pieces()
        self.known.update({pieces[k]: i for i, k in enumerate(keep.tolist())})

    @classmethod
    def pieces(cls, text: str) -> list[str]:
        """The text's pieces; all but the first stand for themselves with a space before them.

        The first one is marked by a leading space, which no other piece has.
        """
        words = text.split(" ")
        if text[0].isspace() or text[-1].isspace() or cls._NEAR_SPACE.search(text):
            out = words[:1]
            for a, w in zip(words, words[1:], strict=False):
                if a and w and not a[-1].isspace() and not w[0].isspace():
                    out.append(w)
                else:
                    out[-1] += " " + w
            words = out
        words[0] = cls._BARE + words[0]
        return words

    @classmethod
    def leaves(cls, piece: str) -> list[str]:
        """The parts that the pattern always separates: the lines, and in each the word and the punctuation after it."""
        out = []
        for k, line in enumerate(cls._LINE.split(piece)):
            if k:
                out.append(cls._BARE + "\n")
                line = cls._BARE + line
            core = line.rstrip(cls._PUNCTUATION)
            if len(core) < len(line) and core and core[-1].isalnum():
                out += [core, cls._BARE + line[len(core):]]
            else:
                out.append(line)
        return out

    def _learn(self) -> None:
        """Encode the new pieces.  A piece of several leaves is their ids joined; only leaves go to the library."""
        pieces, number, ends = self.known.new, self.known.__getitem__, frozenset(self._PUNCTUATION)
        first = len(self.size)
        whole, joined, parts, counts = [], [], [], []
        i = 0
        while i < len(pieces):  # leaves found here are appended and handled in turn
            p = pieces[i]
            found = self.leaves(p) if p[-1:] in ends or "\n" in p else (p,)
            if len(found) == 1:
                whole.append(i)
            else:
                joined.append(i)
                parts.extend(map(number, found))
                counts.append(len(found))
            i += 1
        self.known.new = []
        none = np.zeros(len(pieces), np.int64)
        self.start, self.size = np.concatenate([self.start, none]), np.concatenate([self.size, none])
        for index, ids, sizes in self._encode(pieces, whole):
            self._append(first + index, ids, sizes)
        if joined:
            ids, sizes = self._gather(np.array(parts, np.int64))
            begin = np.cumsum(counts) - counts
            self._append(first + np.array(joined, np.int64), ids, np.add.reduceat(sizes, begin))

    def _append(self, index: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Store the joined ids of the pieces of these numbers."""
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[:self.used], np.empty(2 * len(ids) + self.used, np.uint32)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[index] = self.used + np.cumsum(sizes) - sizes
        self.size[index] = sizes
        self.used += len(ids)

    def _gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joined ids of pieces, and each piece's number of ids."""
        size = self.size[index]
        ends = np.cumsum(size)
        at = np.repeat(self.start[index] - (ends - size), size)
        at += np.arange(len(at))
        return self.flat[at], size

    def _encode(self, pieces: list[str], whole: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of these pieces: numbers, joined ids and sizes.  Those without line breaks or spaces at an end go together,
        one a line: a line break beside a non-space, or before a space, is a token of its own, so the ids are cut there."""
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        spaced, bare, alone = [], [], []
        for i in whole:
            p = pieces[i]
            own = p[1:] if p[0] == self._BARE else p
            if len(line) != 1 or not own or own[0].isspace() or own[-1].isspace() or "\n" in own:
                alone.append(i)
            else:
                (spaced if own is p else bare).append(i)

        def ids_of(text: str) -> np.ndarray:  # one text a call: the library holds some 150 bytes a token until then
            return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        for some, text in ((spaced, lambda g: "".join([" " + pieces[i] + "\n" for i in g]) + " "),
                           (bare, lambda g: "".join([pieces[i][1:] + "\n" for i in g]))):
            for at in range(0, len(some), self._TOGETHER):
                g = some[at:at + self._TOGETHER]
                ids = ids_of(text(g))
                breaks = np.flatnonzero(ids == line[0])
                if len(breaks) != len(g):
                    raise ValueError("the tokenizer joins line breaks with what stands beside them")
                yield np.array(g), np.delete(ids[:breaks[-1]], breaks[:-1]), np.diff(breaks, prepend=-1) - 1
        for i in alone:
            ids = ids_of(pieces[i][1:] if pieces[i][0] == self._BARE else " " + pieces[i])
            yield np.array([i]), ids, np.array([len(ids)])

    def _apart(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words without the punctuation at their ends, and of that punctuation (-1: none).

        Same rule as ``leaves`` for words of one line; done by Arrow, so that only leaves are asked for."""
        number = self.known.__getitem__
        core = pc.utf8_rtrim(words, self._PUNCTUATION)
        last = pc.utf8_slice_codeunits(core, -1).dictionary_encode()
        wordly = pc.match_substring_regex(last.dictionary, r"[\p{L}\p{N}]\z").take(last.indices)
        cut = pc.subtract(pc.binary_length(words), pc.binary_length(core))
        ended = pc.and_(pc.greater(cut, 0), pc.and_(wordly, pc.invert(pc.match_substring(words, "\n"))))
        base = pc.if_else(ended, core, words).dictionary_encode()
        numbers = np.fromiter(map(number, base.dictionary.to_numpy(zero_copy_only=False)), np.int64, len(base.dictionary))[base.indices.to_numpy()]
        ends = np.full(len(words), -1)
        where, cut, ended_words = np.flatnonzero(ended.to_numpy(zero_copy_only=False)), cut.filter(ended), words.filter(ended)
        for size in pc.unique(cut).to_pylist():  # the punctuation is ASCII: as many characters as bytes
            these = pc.equal(cut, size)
            tail = pc.utf8_slice_codeunits(ended_words.filter(these), -size).dictionary_encode()
            bare = np.array([number(self._BARE + t) for t in tail.dictionary.to_pylist()], np.int64)
            ends[where[these.to_numpy(zero_copy_only=False)]] = bare[tail.indices.to_numpy()]
        return numbers, ends

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        if len(self.known) > self.limit:
            self._forget()
        number = self.known.__getitem__
        plain, rests, odd, words, first = [], [], [], [], []
        counts = np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if not t:
                continue
            if self._NEAR_SPACE.search(t) or t[0].isspace() or t[-1].isspace():
                pieces = self.pieces(t)
                odd.append(k)
                counts[k] = len(pieces)
                words += map(number, pieces)
            else:
                word, _, rest = t.partition(" ")
                plain.append(k)
                first.append(number(self._BARE + word))
                rests.append(rest or None)
        # words between single spaces: split and made distinct by Arrow, so that one batch asks for each word once
        split = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        counts[plain] = 1 + pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
        coded = split.flatten().dictionary_encode()
        word, end = self._apart(coded.dictionary)
        m = len(word)
        word = np.concatenate([word, np.array(first + words, np.int64)])
        end = np.concatenate([end, np.full(len(first) + len(words), -1)])
        index = np.empty(counts.sum(), np.int64)  # of every word its place in ``word`` and ``end``
        starts = np.cumsum(counts) - counts
        is_odd = np.zeros(len(texts), bool)
        is_odd[odd] = True
        of_odd = np.repeat(is_odd, counts)
        of_first = np.zeros(len(index), bool)
        of_first[starts[plain]] = True
        index[of_first], index[of_odd] = m + np.arange(len(first)), m + len(first) + np.arange(len(words))
        index[~of_odd & ~of_first] = coded.indices.to_numpy()
        if self.known.new:
            self._learn()
        ended = end[index]
        two = ended >= 0
        ends = np.cumsum(1 + two)
        numbers = np.empty(ends[-1] if len(ends) else 0, np.int64)
        numbers[ends - 1 - two] = word[index]
        numbers[ends[two] - 1] = ended[two]
        used = np.bincount(numbers, minlength=len(self.known))
        used[:len(self.uses)] += self.uses
        self.uses = used
        all_ids, size = self._gather(numbers)
        cuts = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], ends])[np.cumsum(counts)]]
        del split, coded
        pa.default_memory_pool().release_unused()  # else a worker keeps some 80 MB of Arrow's freed memory to its end
        return np.split(all_ids, cuts[:-1])


def _bound_memory(spark) -> None:
    """Rows here are long (whole texts, codes of a million ids), so batches are bounded by bytes, not by rows alone."""
    bound_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@functools.lru_cache(1)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder: tasks that follow one another in a worker share its pieces."""
    return WordEncoder(path)


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode every text (NULL: empty), end each document with ``end_id`` and write segments in doc_id order.

    The rows are dealt into key ranges by quantiles of doc_id, each range sorted (doc_id, then text) and
    streamed into segments.  ``start`` of a segment counts ids inside its range; ``read_tokens`` adds the ranges
    before it.  Segments bound a task's memory, not the range.
    """
    spark = docs.sparkSession
    _bound_memory(spark)
    n = partitions(spark)
    bounds = range_bounds(docs, 3 * n)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(tokenizer)
        state = {"range": None, "segment": 0, "start": 0}
        docs_in, ids_in, total = [], [], 0

        def close():
            ids = np.concatenate(ids_in)
            row = pd.DataFrame({"range": [state["range"]], "segment": [state["segment"]], "start": [state["start"]],
                                "n_ids": [len(ids)], "doc_ids": [list(docs_in)],
                                "lengths": [dac_encode(np.array([len(x) for x in ids_in]))], "ids": [dac_encode(ids)]})
            state["segment"] += 1
            state["start"] += len(ids)
            docs_in.clear()
            ids_in.clear()
            return row

        for batch in batches:
            texts = list(batch["text"])
            coded = (ids for a, b in chunks([len(t) for t in texts], CHUNK_CHARS) for ids in words.encode(texts[a:b]))
            for r, doc_id, null, ids in zip(batch["range"], batch["doc_id"], batch["no_id"], coded, strict=True):
                if r != state["range"] or total > SEGMENT_IDS:
                    if docs_in:
                        yield close()
                    if r != state["range"]:
                        state |= {"range": r, "segment": 0, "start": 0}
                    total = 0
                docs_in.append(None if null else int(doc_id))
                ids_in.append(np.append(ids, np.uint32(end_id)))
                total += len(ids) + 1
        if docs_in:
            yield close()

    key = F.col("doc_id").cast("long")
    rows = docs.select(range_index(key, bounds).alias("range"), F.coalesce(key, F.lit(0)).alias("doc_id"),
                       key.isNull().alias("no_id"), body().alias("text"))
    rows = rows.repartition(n, "range").sortWithinPartitions("range", F.col("no_id").desc(), "doc_id", "text")
    usual = spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
    try:
        rows.mapInPandas(encode, SEGMENTS).write.parquet(path)
    finally:
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", usual)  # other queries' rows are short


def read_tokens(spark, path: str) -> DataFrame:
    """Per document, in any order: doc_id, start (ids of all documents before it), ids (array, with the end id)."""
    _bound_memory(spark)
    segments = spark.read.schema(SEGMENTS).parquet(path)
    # one row a key range, of which there are three for each shuffle partition
    totals = {r["range"]: r["n"] for r in segments.groupBy("range").agg(F.sum("n_ids").alias("n")).collect()}
    before, offset = {}, 0
    for r in sorted(totals):
        before[r], offset = offset, offset + totals[r]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in batch.itertuples():
                ids, lengths = DacReader(s.ids).all(), DacReader(s.lengths).all().astype(np.int64)
                ends = np.cumsum(lengths)
                parts = np.split(ids, ends[:-1])
                yield pd.DataFrame({"doc_id": pd.array([None if d is None or d != d else int(d) for d in s.doc_ids], "Int64"),
                                    "start": before[s.range] + s.start + ends - lengths,
                                    "n_tokens": lengths,
                                    "ids_crc32": [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]})
    return segments.mapInPandas(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_at(spark, path: str, range_: int, segment: int, i: int) -> int:
    """The i-th id of a segment, by random access."""
    row = (spark.read.schema(SEGMENTS).parquet(path).where((F.col("range") == range_) & (F.col("segment") == segment))
           .select("ids").first())
    return DacReader(row["ids"])[i]
