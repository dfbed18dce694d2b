"""Sharding by extendible hashing.

Rows are hashed to 60 bits; a shard is a prefix of these bits.  The directory
starts as one bucket of zero bits, and only buckets above the byte limit split, on
their next bit, until every shard fits.  Splitting bucket by bucket would take a
job for each bit, so bytes are first summed for every prefix of ``depth`` bits,
and a prefix's leaf is the shortest of its beginnings whose sum fits; prefixes
that are still too large go on with further bits, alone.  Buckets that the hash
cannot split (equal keys) become pages of consecutive rows, cut by a running sum
that is taken part by part.

All DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import broadcast_if_small, col, free_name, packed, stored, unpacked

HASH_BITS = 60
LIMIT = 1 << 20  # bytes
EXTRA_BITS = 3  # first depth beyond the bits that equal shards would take
STEP_BITS = 8  # bits that oversized prefixes go on by
BROADCAST_SHARDS = 200_000


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the key's MD5 as a long; NULL hashes like ''."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _shifted(h: Column, bits: Column) -> Column:
    return F.call_function("shiftright", h, bits.cast("int"))


def _prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, HASH_BITS - depth)


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``rows(h, bytes)`` to the leaves that hold rows: ``depth, prefix, bytes,
    cells``, where ``cells`` is the number of bits of the sums that showed the
    leaf.  Only a leaf of all 60 bits may exceed the limit."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    floor, depth = 0, min(HASH_BITS, math.ceil(math.log2(max(1.0, total / limit))) + EXTRA_BITS)
    out, now = None, rows
    while True:
        cells = now.groupBy(_prefix(F.col("h"), depth).alias("cell")).agg(F.sum("bytes").alias("bytes"))
        levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(floor), F.lit(depth))).alias("depth"))
        nodes = levels.groupBy("depth", _shifted(F.col("cell"), F.lit(depth) - F.col("depth")).alias("prefix")).agg(F.sum("bytes").alias("bytes"))
        nodes = stored(nodes, f"nodes{depth}")
        split = nodes.filter((F.col("bytes") > limit) & (F.col("depth") < depth)).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        reached = nodes.withColumn("parent", F.shiftright("prefix", 1)).join(split, ["depth", "parent"], "left_semi")
        if floor == 0:
            reached = reached.unionByName(nodes.filter("depth = 0").withColumn("parent", F.lit(0).cast("long")))
        leaves = reached.filter((F.col("bytes") <= limit) | (F.col("depth") == HASH_BITS))
        leaves = leaves.select("depth", "prefix", "bytes", F.lit(depth).alias("cells"))
        out = leaves if out is None else out.unionByName(leaves)
        large = stored(nodes.filter((F.col("depth") == depth) & (F.col("bytes") > limit)).select(F.col("prefix").alias("large")), f"large{depth}")
        if depth == HASH_BITS or large.limit(1).count() == 0:
            return stored(out, "directory")
        now = now.join(broadcast_if_small(large, BROADCAST_SHARDS), _prefix(F.col("h"), depth) == F.col("large"), "left_semi")
        floor, depth = depth, min(HASH_BITS, depth + STEP_BITS)


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """``rows(row, h, bytes, pos, ...)`` of buckets that the hash cannot split, with
    ``page`` and ``shard_bytes``.  A row above half the limit is a page by itself; of
    the others, in the order of ``pos``, each stretch of half the limit that running
    sums enter is a page, which so fits with the row that crosses into the next.
    Sums run within the parts in which ``pos`` was numbered, on top of those of
    earlier parts, so a task orders the rows of one part at most."""
    rows = rows.withColumn("part", F.shiftrightunsigned("pos", 33))
    large = rows.filter(2 * F.col("bytes") > limit).withColumn("shard_bytes", F.col("bytes")).withColumn("page", F.concat(F.lit("r"), F.col("pos").cast("string"))).drop("part")
    rows = rows.filter(2 * F.col("bytes") <= limit)
    sums = rows.groupBy("h", "part").agg(F.sum("bytes").alias("of_part"))
    before = F.sum("of_part").over(Window.partitionBy("h").orderBy("part")) - F.col("of_part")
    sums = sums.select("h", "part", before.alias("before"))
    within = F.sum("bytes").over(Window.partitionBy("h", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")
    dealt = rows.withColumn("within", within).join(sums, ["h", "part"])
    dealt = dealt.withColumn("page", F.floor((F.col("within") + F.col("before")) * 2 / limit).cast("string")).drop("shard_bytes", "part", "within", "before")
    pages = dealt.groupBy("h", "page").agg(F.sum("bytes").alias("shard_bytes"))
    return dealt.join(pages, ["h", "page"]).unionByName(large)


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", *, limit: int = LIMIT, carry: list[str] | None = None, out: str = "shard") -> DataFrame:
    """The columns of ``docs`` (or those in ``carry``) plus a struct column
    ``out``: ``id`` (the prefix as a string of 0 and 1, with ``/page`` for a bucket
    that cannot be split), ``depth``, ``bytes`` (of the row's text) and
    ``shard_bytes``, at most ``limit`` unless the shard is a single larger row.

    Defined results: a NULL text has no bytes; NULL keys are equal keys.  A row
    larger than the limit ends in a bucket of all 60 bits, paged like those of
    equal keys, among them repeated rows that exceed the limit together.  If
    ``docs`` has a column ``out``, the new one gets a leading underscore.  An empty
    table gives an empty result.
    """
    names = docs.columns if carry is None else carry
    out = free_name(names, out)
    size = F.coalesce(F.octet_length(col(text)), F.lit(0)).cast("long")
    table = stored(docs.select(packed(docs, names).alias("row"), hash_bits(col(key)).alias("h"), size.alias("bytes"), F.monotonically_increasing_id().alias("pos")), "hashed")
    leaves = directory(table.select("h", "bytes"), limit)
    depths = sorted(r["cells"] for r in leaves.select("cells").distinct().collect())  # one for each round: 9 at most
    span = F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, cells - depth) - 1"))
    marks = leaves.select("depth", F.col("bytes").alias("shard_bytes"), "cells", "prefix", F.explode(span).alias("k"))
    marks = marks.select("depth", "shard_bytes", "cells", (F.expr("shiftleft(prefix, cells - depth)") + F.col("k")).alias("cell"))
    keys = F.array(*[F.struct(F.lit(c).alias("cells"), _prefix(F.col("h"), c).alias("cell")) for c in depths or [0]])
    rows = table.select("row", "h", "bytes", "pos", F.explode(keys).alias("at")).select("row", "h", "bytes", "pos", "at.cells", "at.cell")
    rows = rows.join(broadcast_if_small(marks, BROADCAST_SHARDS), ["cells", "cell"]).drop("cells", "cell")
    bits = F.expr(f"substring(lpad(bin(h), {HASH_BITS}, '0'), 1, depth)")
    plain = F.struct(bits.alias("id"), "depth", "bytes", "shard_bytes")
    if leaves.filter(F.col("bytes") > limit).limit(1).count() == 0:
        return rows.select(*unpacked(names), plain.alias(out))
    fits = rows.filter(F.col("shard_bytes") <= limit).select("row", plain.alias("s"))
    paged = _paged(rows.filter(F.col("shard_bytes") > limit), limit)
    paged = paged.select("row", F.struct(F.concat(bits, F.lit("/"), "page").alias("id"), "depth", "bytes", "shard_bytes").alias("s"))
    return fits.unionByName(paged).select(*unpacked(names), F.col("s").alias(out))
