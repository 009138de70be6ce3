"""Helpers shared by the operators: scratch tables, batches, hashing and ordered ranges."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rows in one Arrow batch; with texts of up to some 100 kB a batch stays far below a worker's memory.
ARROW_ROWS = 2000


def bound_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch may hold; applied by every operator that runs Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


class Scratch:
    """A folder of written intermediate tables inside the shared checkpoint folder.

    A written table cuts the lineage: a lost executor costs a re-read.  Tables that the returned DataFrame
    still reads stay until the caller removes the folder; the others are removed with ``drop``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def table(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def body(text: Column | str = "text") -> Column:
    """The text, empty where NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A helper column's name that no column of ``df`` has, in either case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(names: list[str]) -> list[Column]:
    """Columns by their literal names, dots included."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in names]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(docs: DataFrame, n: int, key: str = "doc_id") -> list[int]:
    """Up to n - 1 ascending cut points that deal the keys into ranges of about equal counts.

    Reads the key column only; the sketch behind ``percentile_approx`` merges per partition.
    """
    if n <= 1:
        return []
    cuts = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n).alias("c")).first()["c"]
    return sorted(set(cuts or []))


def range_index(key: Column, bounds: list[int]) -> Column:
    """Index of the key's range: the number of cut points at or below it; a NULL key is in range 0."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*[F.lit(int(b)) for b in bounds])
    return F.coalesce(F.size(F.filter(cuts, lambda c: c <= key)), F.lit(0))


U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (multiply and xor-shift, twice)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


class WordIds(dict):
    """Word -> small integer, with a 64-bit hash of each word beside it.

    Used inside one task to turn words into numpy arrays; ``room()`` empties it once it holds ``limit`` words,
    so a task's memory does not grow with its vocabulary.
    """

    def __init__(self, limit: int = 300_000, seed: int = 0):
        super().__init__()
        self.limit, self.seed, self.words = limit, seed, []
        self._hashes = np.empty(0, U64)

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self.words)
        self.words.append(word)
        return i

    def room(self) -> None:
        if len(self.words) > self.limit:
            self.clear()
            self.words.clear()
            self._hashes = np.empty(0, U64)

    def hashes(self) -> np.ndarray:
        import xxhash
        n = len(self._hashes)
        if n < len(self.words):
            new = np.fromiter((xxhash.xxh3_64_intdigest(w, self.seed) for w in self.words[n:]), U64, len(self.words) - n)
            self._hashes = np.concatenate([self._hashes, new])
        return self._hashes

    def index(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def chunks(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive slices whose summed lengths stay below ``most`` (a longer single item is its own slice)."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
