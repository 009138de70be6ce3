"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard similarity.

Two permutations of the 32-bit integers give all coordinates: ``sigma`` shuffles a shingle's hash once, and coordinate
k is the least ``pi(sigma(x) + k mod 2**32)``, the second permutation circularly shifted by k.  128 coordinates in 32
bands of 4 let a pair of similarity 0.8 through with a probability above 1 - 1e-7.

Equal shingle sets are one node from the start.  Documents that share a band meet in a bucket, and no bucket's pairs
are listed.  First each bucket is a star around its best connected member (the one with the largest buckets, as the
original of a family of edited copies), which costs one comparison a member.  What is left are buckets with several
components.  There the members outside a bucket's largest component are held against the members of its other
components, first by a bound: each set has 1024 bits, a bit being the parity of the number of its shingles that hash
there, and the bits in which two sets differ are never more than the shingles in which they differ.  Pairs that may
reach the threshold are compared on full shingle sets, as all links are; so star and bound lose none.

Sets are made of 64-bit hashes of shingles.  Everything is keyed joins and aggregates; a hot bucket is pre-aggregated
or split by the skew join rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Scratch, WordIds, body, bound_batches, chunks, fresh, mix64, own_columns

PERMUTATIONS, ROWS = 128, 4
BANDS = PERMUTATIONS // ROWS
PERCENT = 80
PARITY_BITS = 1024
TOGETHER = 2_000_000
_U32 = np.uint32


def shingle_sets(ids: WordIds, texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-word shingles.

    Words lie between ASCII white space, A-Z in lower case.  Fewer than n words are one shingle; no words none.
    """
    words = [t.encode().lower().split() for t in texts]
    index = [ids.index(w) for w in words]
    hashes = ids.hashes()
    flat = hashes[np.concatenate(index)] if index else np.empty(0, U64)
    rolled = mix64(flat + U64(n))
    for k in range(1, n):
        rolled[:max(0, len(flat) - k)] = mix64(rolled[:max(0, len(flat) - k)] * U64(0x9E3779B97F4A7C15) + flat[k:])
    out, at = [], 0
    for w in index:
        if len(w) >= n or not len(w):
            out.append(np.unique(rolled[at:at + max(0, len(w) - n + 1)]))
        else:
            h = U64(len(w))
            for x in flat[at:at + len(w)]:
                h = mix64(np.array([h]) * U64(0xD1B54A32D192ED03) + x)[0]
            out.append(np.array([h], U64))
        at += len(w)
    return out


def _scramble(v: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit integers, in place."""
    v *= _U32(a)
    v ^= v >> _U32(15)
    v *= _U32(b)
    v ^= v >> _U32(13)
    return v


def sigma(x: np.ndarray) -> np.ndarray:
    return _scramble(x.copy(), 0x85EBCA6B, 0xC2B2AE35)


def pi(x: np.ndarray) -> np.ndarray:
    return _scramble(x, 0x2C1B3C6D, 0x297A2D39)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Signature rows of non-empty sets."""
    out = np.empty((len(sets), PERMUTATIONS), _U32)
    for i, j in chunks([len(s) for s in sets], 1 << 16):
        x = sigma((np.concatenate(sets[i:j]) >> U64(32)).astype(_U32))
        starts = np.cumsum([0, *(len(s) for s in sets[i:j - 1])])
        for k in range(PERMUTATIONS):
            out[i:j, k] = np.minimum.reduceat(pi(x + _U32(k)), starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, the band's number mixed in."""
    rows = signature.reshape(len(signature), BANDS, ROWS).astype(U64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), rows.shape[:2]).copy()
    for r in range(ROWS):
        key = mix64(key * U64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return key


def sketch(docs: DataFrame, n: int, row: str | None = None) -> DataFrame:
    """row, doc_id, text_hash, n_shingles, set_id (NULL without shingles), keys for every row; ``row``: a column that numbers the rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = WordIds()
        for batch in batches:
            texts = list(batch["text"])
            for i, j in chunks([len(t) for t in texts], TOGETHER):
                ids.room()
                sets = shingle_sets(ids, texts[i:j], n)
                some = [k for k, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                for k, row in zip(some, band_keys(signatures([sets[k] for k in some])).view(np.int64), strict=True):
                    keys[k] = row
                yield pd.DataFrame({"row": batch["row"].to_numpy()[i:j], "text_hash": batch["text_hash"].to_numpy()[i:j], "n_shingles": [len(s) for s in sets],
                                    "set_id": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                                    "keys": keys, "id": batch["id"].to_numpy()[i:j], "no_id": batch["no_id"].to_numpy()[i:j]})
    rows = docs.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       F.col("doc_id").isNull().alias("no_id"), F.xxhash64(body()).alias("text_hash"), body().alias("text"))
    made = rows.mapInPandas(run, "row long, id long, no_id boolean, text_hash long, n_shingles long, set_id binary, keys array<long>")
    return made.select("row", F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "text_hash", "n_shingles", "set_id", "keys")


def parity(shingles: np.ndarray) -> np.ndarray:
    """Parities of the shingle counts in PARITY_BITS hash places, as 64-bit integers."""
    odd = np.bincount((shingles & U64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def sets_of(docs: DataFrame, wanted: DataFrame, n: int, row: str | None = None) -> DataFrame:
    """node, its shingles and their parities; ``wanted`` has (node, low, text_hash, set_id): id and text hash of a document with that set.

    Where ``row`` numbers the rows, a node is such a number and its text is found by it, else by id and text hash, so
    rows that share an id (or have none) meet only the sets of their own texts.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = WordIds()
        for batch in batches:
            texts = list(batch["text"])
            for i, j in chunks([len(t) for t in texts], TOGETHER):
                ids.room()
                sets = shingle_sets(ids, texts[i:j], n)
                same = [k for k, (s, w) in enumerate(zip(sets, batch["set_id"][i:j], strict=True)) if xxhash.xxh3_128_digest(s.tobytes()) == w]
                if not same:
                    continue
                yield pd.DataFrame({"node": batch["node"].to_numpy()[i:j][same], "shingles": [sets[k].view(np.int64) for k in same],
                                    "parity": [parity(sets[k]) for k in same]})
    if row:
        rows = docs.select(F.col(row).alias("node"), body().alias("text")).join(wanted, "node").select("node", "set_id", "text")
    else:
        texts = docs.select("doc_id", F.xxhash64(body()).alias("own_hash"), body().alias("text"))
        rows = (texts.join(wanted, (F.col("own_hash") == F.col("text_hash")) & F.col("doc_id").eqNullSafe(F.col("low")))
                .select("node", "set_id", "text"))
    # rows that repeat a doc_id and a set come out alike, so any one of a node serves
    return rows.mapInPandas(run, "node long, shingles array<long>, parity array<long>").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links: 100 * intersection >= 80 * union on full sets."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    na, nb, both = F.size("sa"), F.size("sb"), F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(a, "a").join(b, "b").where(F.least(na, nb) * 100 >= F.greatest(na, nb) * PERCENT)
            .where(both * 100 >= (na + nb - both) * PERCENT).select("a", "b"))


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node and comp (the least node reachable) of all nodes with a link.

    Each round takes the least label around and then the label's own label; rounds are written tables.
    """
    links = scratch.table(f"{name}-links", links)
    both = links.union(links.select("b", "a")).toDF("node", "other").where("node <> other")
    label = scratch.table(f"{name}-0", both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("comp")))
    i = 0
    while True:
        near = (both.join(label.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("comp").alias("near")))
        step = label.join(near, "node").select("node", "comp", F.least("comp", "near").alias("to"))
        jump = label.select(F.col("node").alias("to"), F.col("comp").alias("next"))
        new = scratch.table(f"{name}-{i + 1}", step.join(jump, "to", "left").select(
            "node", F.least("to", F.coalesce("next", "to")).alias("comp"), (F.least("to", F.coalesce("next", "to")) < F.col("comp")).alias("moved")))
        scratch.drop(f"{name}-{i}")
        i += 1
        label = new.select("node", "comp")
        if new.where("moved").isEmpty():
            return label


def links_of(nodes: DataFrame, docs: DataFrame, n: int, scratch: Scratch, row: str | None = None) -> DataFrame:
    """Components (node, comp) of all nodes that have a link.  ``nodes``: node, low, text_hash, set_id, keys."""
    meet = nodes.select("node", F.explode("keys").alias("key"))
    sizes = meet.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = scratch.table("members", meet.join(sizes, "key"))
    degree = members.groupBy("node").agg(F.sum("size").alias("degree"))
    sets = scratch.table("shingles", sets_of(docs, nodes.select("node", "low", "text_hash", "set_id").join(degree.select("node"), "node", "left_semi"), n, row))
    hubs = members.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("minus"))).alias("h"))
    star = members.join(hubs.select("key", (-F.col("h.minus")).alias("hub")), "key").where("node <> hub")
    pairs = star.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = scratch.table("star", verified(pairs, sets))
    comp = components(links, scratch, "star-comp")

    placed = members.join(comp, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    placed = scratch.table("placed", placed)

    def mixed(p: DataFrame) -> DataFrame:
        """Keys of the buckets with several components."""
        return p.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    mark = sets.select("node", F.size("shingles").alias("n"), *[F.col("parity")[i].alias(f"p{i}") for i in range(PARITY_BITS // 64)])
    rest = scratch.table("rest", placed.join(mixed(placed), "key", "left_semi").join(mark, "node"))
    largest = (rest.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("key")
               .agg(F.max(F.struct("m", "comp")).alias("l")).select("key", F.col("l.comp").alias("largest")))
    rest = rest.join(largest, "key")
    x, y = (rest.select("key", *[F.col(c).alias(f"{s}_{c}") for c in rest.columns if c != "key"]) for s in "xy")
    apart = sum(F.bit_count(F.col(f"x_p{i}").bitwiseXOR(F.col(f"y_p{i}"))) for i in range(PARITY_BITS // 64))
    both = F.col("x_n") + F.col("y_n")
    meets = ((x["key"] == y["key"]) & (F.col("x_comp") != F.col("y_comp"))
             & ((F.col("y_comp") == F.col("y_largest")) | (F.col("x_node") < F.col("y_node")))
             & (F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * PERCENT) & (apart * (100 + PERCENT) <= both * (100 - PERCENT)))
    pairs = (x.where("x_comp <> x_largest").join(y, meets)
             .select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct())
    more = scratch.table("more", verified(pairs, sets))
    if more.isEmpty():
        return comp
    return components(links.union(more), scratch, "all-comp")


def near_duplicates(docs: DataFrame, n_words: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Documents are linked from a Jaccard similarity of 0.8 of their n-word shingle sets on; ``component_id`` is the
    smallest doc_id reachable, itself included; one row of a component is kept, the one with that doc_id.  A document
    without words is linked with nothing and kept.  A NULL doc_id counts as larger than any other.
    """
    return _judged(docs, n_words, Scratch(docs.sparkSession, "neardup")).drop("row")


def _judged(docs: DataFrame, n_words: int, scratch: Scratch, row: str | None = None) -> DataFrame:
    """``near_duplicates`` with the number of the row."""
    bound_batches(docs.sparkSession)
    rows = scratch.table("rows", sketch(docs, n_words, row))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "text_hash")
    nodes = scratch.table("nodes", rows.where("set_id is not null").groupBy("set_id")
                          .agg(F.min(first).alias("first"), F.first("keys").alias("keys"))
                          .select("set_id", F.col("first.row").alias("node"), "first", F.col("first.doc_id").alias("low"), F.col("first.text_hash").alias("text_hash"), "keys"))
    comp = links_of(nodes, docs, n_words, scratch, row)
    grouped = nodes.select("set_id", "node", "first").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    keeper = grouped.groupBy("comp").agg(F.min("first").alias("keeper"))
    of_set = grouped.join(keeper, "comp").select("set_id", "keeper")
    return (rows.select("row", "doc_id", "n_shingles", "set_id").join(of_set, "set_id", "left")
            .select("row", "doc_id", "n_shingles", F.when(F.col("keeper").isNotNull(), F.col("keeper.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce(F.col("row") == F.col("keeper.row"), F.lit(True)).alias("kept")))


def drop_near_duplicates(docs: DataFrame, n_words: int = 5) -> DataFrame:
    """One row of each group, with its columns; rows that share a doc_id are told apart by a number written with them."""
    scratch = Scratch(docs.sparkSession, "neardup")
    number = fresh(docs, "row_number")
    numbered = scratch.table("input", docs.withColumn(number, F.monotonically_increasing_id()))
    out = _judged(numbered, n_words, scratch, number).where("not kept").select(F.col("row").alias(number))
    return numbered.join(out, number, "left_anti").select(own_columns(docs.columns))
