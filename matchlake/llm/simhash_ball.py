"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``distance`` bits have a common variant
within ``distance / 2`` bits of both.  So every distinct fingerprint emits all
variants in that half radius, the variants are shuffled, and fingerprints that
meet on one are linked.

A fingerprint has 2,081 variants in radius 2, and shuffling each as a row would
multiply the input.  The shuffle goes by the first bits of the variants instead:
a fingerprint is sent once to every slice of the variant space that holds any of
its variants (1 + b + b(b-1)/2 of 2^b slices), and the slice's task emits those
that lie in it, sorts them and finds the meetings.  Slices that hold too many
fingerprints are split on further bits, down to single variants if need be.
Members of one meeting are linked to its smallest, not pair by pair: all of them
lie within the half radius of the variant, so within ``distance`` of each other.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import bounded_batches, broadcast_if_small, col, free_name, keyed, packed, stored, trim, unpacked
from matchlake.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
SLICE_VARIANTS = 500_000  # variants that a slice's task should emit: 4 MB
SPLIT_BITS = 4
BROADCAST_KEYS = 1_000_000  # longs: some 30 MB as a hash table


def fingerprint(raw: bytes | None, size: int = SHINGLE) -> int:
    """The fingerprint of a text in UTF-8 as an unsigned integer; 0 without words."""
    words = (raw or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    if n <= size:
        return digest(b" ".join(words), SEED)
    text = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(length + 1) - 1
    start = end - length
    counts = np.zeros(BITS, np.int64)
    m = n - size + 1
    for at in range(0, m, 32768):
        stop = min(m, at + 32768)
        h = np.array([digest(text[i:j], SEED) for i, j in zip(start[at:stop].tolist(), end[at + size - 1:stop + size - 1].tolist(), strict=True)], ">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > m).tobytes(), "big")


def fingerprint_column(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint of a string column as a long (its 64 bits)."""

    @F.pandas_udf(T.LongType())
    def udf(raw: pd.Series) -> pd.Series:
        trim()
        prints = np.array([fingerprint(bytes(x) if x is not None else None, size) for x in raw], np.uint64)
        return pd.Series(prints.view(np.int64))

    return udf(text.cast("binary"))


def _masks(bits: int, most: int) -> list[int]:
    """All masks of ``bits`` bits with at most ``most`` of them set."""
    return [sum(1 << k for k in c) for r in range(most + 1) for c in combinations(range(bits), r)]


def _emit(fps: DataFrame, bits: int, radius: int) -> DataFrame:
    """(fp, slice): each fingerprint once for every slice that holds a variant."""
    if bits == 0:
        return fps.select("fp", F.lit(0).cast("long").alias("slice"))
    prefix = F.shiftrightunsigned("fp", BITS - bits)
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(bits, radius)])
    return fps.select("fp", F.explode(masks).alias("mask")).select("fp", prefix.bitwiseXOR(F.col("mask")).alias("slice"))


def _split(entries: DataFrame, bits: int, more: int, radius: int) -> DataFrame:
    """The entries of oversized slices on ``more`` further bits."""
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(more, radius)])
    used = F.bit_count(F.shiftrightunsigned("fp", BITS - bits).bitwiseXOR(F.col("slice"))) if bits else F.lit(0)
    part = F.shiftrightunsigned("fp", BITS - bits - more).bitwiseAND(F.lit((1 << more) - 1).cast("long"))
    out = entries.select("fp", "slice", F.explode(masks).alias("mask")).filter(used + F.bit_count("mask") <= radius)
    return out.select("fp", F.shiftleft("slice", more).bitwiseOR(part.bitwiseXOR(F.col("mask"))).alias("slice"))


def _meetings(fp: np.ndarray, slice_: int, bits: int, radius: int, distance: int) -> np.ndarray:
    """Links (larger, smaller) among the fingerprints of one slice: a spanning
    forest of those that meet on a variant in it."""
    fp = np.unique(fp)
    low = BITS - bits
    base, used = fp, np.zeros(len(fp), np.int64)
    if bits:
        used = np.bitwise_count((fp >> np.uint64(low)) ^ np.uint64(slice_)).astype(np.int64)
        base = (fp & np.uint64((1 << low) - 1)) | np.uint64((slice_ << low) & ((1 << BITS) - 1))
    values, owners = [], []
    for u in range(radius + 1):
        at = np.flatnonzero(used == u)
        if len(at):
            masks = np.array(_masks(low, radius - u), np.uint64)
            values.append((base[at][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(at.astype(np.int32), len(masks)))
    if not values:
        return np.zeros((0, 2), np.uint64)
    value, owner = np.concatenate(values), np.concatenate(owners)
    ordered = np.sort(value)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    if not len(shared):
        return np.zeros((0, 2), np.uint64)
    place = np.minimum(np.searchsorted(shared, value), len(shared) - 1)
    hit = shared[place] == value
    place, owner = place[hit], owner[hit].astype(np.int64)
    first = np.full(len(shared), len(fp), np.int64)
    np.minimum.at(first, place, owner)
    a, b = owner, first[place]
    links = np.unique((a * len(fp) + b)[a != b])
    a, b = links // len(fp), links % len(fp)
    near = np.bitwise_count(fp[a] ^ fp[b]) <= distance  # always so; the check of the method
    parent = list(range(len(fp)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a[near].tolist(), b[near].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((max(x, y), min(x, y)))
    kept = np.array(kept, np.int64).reshape(-1, 2)
    return fp[kept]


def _slice_task(bits: int, radius: int, distance: int):
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        trim()
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        found = _meetings(fp, int(pdf["slice"].iloc[0]) & ((1 << BITS) - 1), bits, radius, distance).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return meet


def links(fps: DataFrame, distance: int = DISTANCE, slice_variants: int = SLICE_VARIANTS) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints of ``fps(fp)`` (distinct
    longs) within ``distance`` bits of each other, directly or through others.
    ``distance`` must be even.  A slice's task emits at most four times
    ``slice_variants`` variants: larger slices are split on further bits, and one
    of all 64 bits is a single variant, which at most 2,081 fingerprints reach.
    """
    if distance % 2 or distance < 0:
        raise ValueError("the distance must be even")
    radius = distance // 2
    variants = sum(math.comb(BITS, r) for r in range(radius + 1))
    bits = min(20, max(0, math.ceil(math.log2(max(1, fps.count() * variants / slice_variants)))))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    entries, out = _emit(fps, bits, radius), None
    while True:
        used = F.bit_count(F.shiftrightunsigned("fp", BITS - bits).bitwiseXOR(F.col("slice"))) if bits else F.lit(0)
        emitted = F.array(*[F.lit(sum(math.comb(BITS - bits, r) for r in range(radius - u + 1))) for u in range(radius + 1)])[used.cast("int")]
        large = entries.groupBy("slice").agg(F.sum(emitted.cast("long")).alias("n")).filter(F.col("n") > 4 * slice_variants)
        large = stored(large.select("slice"), "large")
        hot = bits < BITS and large.limit(1).count() > 0
        cold = entries.join(large, "slice", "left_anti") if hot else entries
        found = cold.groupBy("slice").applyInPandas(_slice_task(bits, radius, distance), schema)
        out = found if out is None else out.unionByName(found)
        if not hot:
            return out
        more = min(SPLIT_BITS, BITS - bits)
        entries = stored(_split(entries.join(large, "slice", "left_semi"), bits, more, radius), "entries")
        bits += more


def _roots(prints: DataFrame, distance: int, slice_variants: int) -> DataFrame:
    """``prints(id, fp)`` to ``(fp, id, root)``: each fingerprint with its smallest
    id and the smallest fingerprint of its group."""
    fps = stored(prints.groupBy("fp").agg(F.min("id").alias("id")), "distinct")
    stars = components(links(fps.select("fp"), distance, slice_variants))
    roots = fps.join(stars.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
    return stored(roots.select("fp", "id", F.coalesce("root", "fp").alias("root")), "roots")


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, size: int = SHINGLE, distance: int = DISTANCE,
           slice_variants: int = SLICE_VARIANTS, carry: list[str] | None = None, out: str = "near") -> DataFrame:
    """The columns of ``docs`` (or those in ``carry``) plus a struct column
    ``out``: ``fingerprint`` (long), ``root`` (long, the smallest fingerprint of
    the document's group as a signed number) and ``component_id`` (the group's
    smallest ``doc_id``).

    Defined results: texts that are NULL, empty or without words have fingerprint
    0, which links like any other; texts shorter than a shingle are one shingle.
    Repeated rows stay and share a group.  A group whose ids are all NULL has a
    NULL ``component_id`` but its own ``root``.  An empty table gives an empty
    result.  Clashing names: only ``out`` is taken; if it exists, the new column
    gets a leading underscore.
    """
    bounded_batches(docs)
    names = docs.columns if carry is None else carry
    out = free_name(names, out)
    table = stored(docs.select(packed(docs, names).alias("row"), col(doc_id).alias("id"), fingerprint_column(col(text), size).alias("fp")), "prints")
    roots = _roots(table, distance, slice_variants)
    least = roots.groupBy("root").agg(F.min("id").alias("component_id"))
    joined = table.join(roots.select("fp", "root").join(least, "root"), "fp")
    return joined.select(*unpacked(names), F.struct(F.col("fp").alias("fingerprint"), "root", "component_id").alias(out))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, size: int = SHINGLE, distance: int = DISTANCE,
                slice_variants: int = SLICE_VARIANTS) -> DataFrame:
    """One row of each group of :func:`groups`, with the columns of ``docs``: the
    one with the smallest ``doc_id`` (NULL last).  Of several with that id, the one
    whose text has the smallest hash stays, and of those any one.

    Decisions are made on narrow rows; texts are not shuffled if the list of rows
    to drop is small enough to be broadcast.
    """
    bounded_batches(docs)
    names = docs.columns
    rows = keyed(docs, names, doc_id)
    own = lambda c: F.col("row").getField(c)
    narrow = stored(rows.select("key", own(doc_id).alias("id"), fingerprint_column(own(text), size).alias("fp"), F.xxhash64(own(text)).alias("h")), "prints")
    roots = _roots(narrow, distance, slice_variants)
    placed = stored(narrow.join(roots.select("fp", "root"), "fp").select("key", "root", F.struct(F.col("id").isNull().alias("none"), "id", "h", "key").alias("order")), "placed")
    kept = placed.groupBy("root").agg(F.min("order").alias("order")).select("order.key")
    dropped = stored(placed.join(kept, "key", "left_anti").select("key"), "dropped")
    return rows.join(broadcast_if_small(dropped, BROADCAST_KEYS), "key", "left_anti").select(*unpacked(names))
