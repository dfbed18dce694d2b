"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the expected number of copies of each of its
documents.  Whole copies are given outright; of the fractional rest, documents
are paired, and one of a pair passes mass (in words) to the other at random until
one of the two is integral.  The direction's odds keep every document's
expectation, and the pair's words are kept exactly, so a source ends within one
document's size of its target.

Pairing runs over a reduction tree: documents fall into blocks of about BLOCK by
hash, a block is folded by an array aggregate and leaves one fractional document,
these form the blocks of the next level, and so on up to one per source.  Blocks
of repeated ids that grow beyond four times BLOCK are split.  All DataFrame
functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import WORD_PATTERN, broadcast_if_small, free_name, keyed, stored, unpacked

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
CAP = 2.0  # times a source's size
BLOCK = 128
SEED = 20240
SNAP = 1e-7
BROADCAST_SOURCES = 50_000
BROADCAST_KEYS = 400_000  # rows of seven numbers: some 40 MB as a hash table


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def _ranked(sources: DataFrame) -> DataFrame:
    """``index``: the place of each source in code point order, NULL last.
    Ranks within range partitions plus the sizes of the earlier ones."""
    from pyspark.sql import Window

    dealt = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"))  # a row for each range partition
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return dealt.withColumn("within", within).join(before, "part").withColumn("index", F.col("within") + F.col("before")).drop("part", "within", "before")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sizes(source, size)`` to one row a source: ``source, source_size, target``.

    Targets are ``min(cap * size, level * weight)`` with the one level at which
    they add up to the share; raising it round by round is resharing the excess.
    Each round is one aggregate over the sources.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("index") % len(weights) + 1).cast("int"))
    sources = stored(_ranked(sources).select("source", "source_size", w.alias("w")), "sources")
    top = F.col("source_size") * float(cap)
    total = sources.agg(F.sum("source_size").alias("s"), F.sum("w").alias("w")).first()
    goal = share * (total["s"] or 0)
    level, seen = (goal / total["w"] if total["w"] else 0.0), None
    while True:
        above = F.col("w") * level > top
        got = sources.agg(F.sum(F.when(above, top)).alias("capped"), F.sum(F.when(~above, F.col("w"))).alias("w"), F.count(F.when(above, 1)).alias("n")).first()
        if got["n"] == seen or not got["w"]:
            break
        seen, level = got["n"], (goal - (got["capped"] or 0.0)) / got["w"]
    return sources.select("source", "source_size", F.least(top, F.col("w") * level).alias("target"))


_ITEM = "struct<u:bigint,pos:bigint,size:bigint,mass:double>"


def _fold(items: Column, level: int, seed: int) -> Column:
    """Folds an array of items: the last fractional one, and those decided."""

    def item(u, pos, size, mass):
        return F.struct(u.alias("u"), pos.alias("pos"), size.alias("size"), mass.alias("mass"))

    def snap(mass, size):
        return F.when(mass < size * SNAP, F.lit(0.0)).when(mass > size * (1 - SNAP), size.cast("double")).otherwise(mass)

    def moved(state, x):
        a = state["last"]
        up = F.least(a["size"] - a["mass"], x["mass"])
        down = F.least(a["mass"], x["size"] - x["mass"])
        rises = _uniform(x["u"], state["k"], F.lit(level), F.lit(seed)) * (up + down) < down
        return F.struct(state.alias("state"), x.alias("x"), F.when(rises, up).otherwise(-down).alias("d"))

    def merge(state, x):
        # one-element transforms stand for local names: each step's value is computed once
        step = F.transform(F.array(moved(state, x)), lambda m: F.struct(
            item(m["state"]["last"]["u"], m["state"]["last"]["pos"], m["state"]["last"]["size"], snap(m["state"]["last"]["mass"] + m["d"], m["state"]["last"]["size"])).alias("a"),
            item(m["x"]["u"], m["x"]["pos"], m["x"]["size"], snap(m["x"]["mass"] - m["d"], m["x"]["size"])).alias("b"),
            m["state"]["done"].alias("done"), m["state"]["k"].alias("k")))
        decided = F.transform(step, lambda s: F.struct(
            s.alias("s"), ((s["a"]["mass"] == 0) | (s["a"]["mass"] == s["a"]["size"])).alias("first")))
        out = F.transform(decided, lambda d: F.struct(
            F.when(d["first"], d["s"]["b"]).otherwise(d["s"]["a"]).alias("last"),
            F.concat(d["s"]["done"], F.array(F.when(d["first"], d["s"]["a"]).otherwise(d["s"]["b"]))).alias("done"),
            (d["s"]["k"] + 1).alias("k")))
        return F.when(state["last"].isNull(), F.struct(x.alias("last"), state["done"].alias("done"), state["k"].alias("k"))).otherwise(out[0])

    start = F.struct(F.lit(None).cast(_ITEM).alias("last"), F.array().cast(f"array<{_ITEM}>").alias("done"), F.lit(0).alias("k"))
    return F.aggregate(items, start, merge)


def rounded(items: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``items(source, u, pos, size, mass)`` with 0 < mass < size to ``(pos, up)``:
    whether each is taken once more.  ``u`` is a hash that orders and pairs them;
    ``pos`` tells apart rows of equal ``u``."""
    share = F.shiftrightunsigned("u", 1).cast("double") / float(1 << 63)
    counts = items.groupBy("source").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("long").alias("blocks"))
    now = items.join(broadcast_if_small(stored(counts, "counts"), BROADCAST_SOURCES), "source")
    now = now.select("source", F.least(F.floor(share * F.col("blocks")), F.col("blocks") - 1).alias("blk"), "u", "pos", "size", "mass")
    level, out = 0, None
    while True:
        sizes = now.groupBy("source", "blk").agg(F.count("*").alias("n"))
        over = stored(sizes.filter(F.col("n") > 4 * block).select("source", "blk", F.ceil(F.col("n") / block).alias("parts")), f"over{level}")
        dealt = now.join(broadcast_if_small(over, BROADCAST_SOURCES), ["source", "blk"], "left")
        dealt = dealt.withColumn("part", F.coalesce(F.pmod(F.xxhash64("pos", F.lit(level)), F.col("parts")), F.lit(0)))
        folded = dealt.groupBy("source", "blk", "part").agg(_fold(F.array_sort(F.collect_list(F.struct("u", "pos", "size", "mass"))), level, seed).alias("f"))
        folded = stored(folded.select("source", "blk", "f.last", "f.done"), f"level{level}")
        decided = folded.select(F.explode("done").alias("x")).select("x.pos", (F.col("x.mass") > 0).alias("up"))
        out = decided if out is None else out.unionByName(decided)
        left = folded.groupBy("source").agg(F.count("*").alias("n"), F.max("blk").alias("blk")).agg(F.max("n").alias("n")).first()["n"]
        if left is None or left <= 1:
            last = folded.select(F.col("last.pos").alias("pos"), (_uniform(F.col("last.u"), F.lit(-1), F.lit(seed)) * F.col("last.size") < F.col("last.mass")).alias("up"))
            return out.unionByName(last)
        now = folded.select("source", F.floor(F.col("blk") / block).alias("blk"), "last.u", "last.pos", "last.size", "last.mass")
        level += 1


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
        cap: float = CAP, block: int = BLOCK, seed: int = SEED, carry: list[str] | None = None, out: str = "mix") -> DataFrame:
    """The columns of ``docs`` (or those in ``carry``) plus a struct column
    ``out``: ``size`` (words), ``source_size``, ``target``, ``copies`` and
    ``taken`` (``copies * size``).

    Defined results: NULL, empty and blank texts have size 0 and take part only by
    a random number of copies; a NULL source is a source of its own, the last.
    Repeated rows are separate documents that may get different numbers of copies.
    The same rows give the same result whatever their order and partitioning,
    except that rows with equal id, source and size may swap their numbers.  If
    ``docs`` has a column ``out``, the new one gets a leading underscore.  An
    empty table gives an empty result.
    """
    names = docs.columns if carry is None else carry
    out = free_name(names, out)
    rows = keyed(docs, [*names, *[c for c in (text, source, doc_id) if c not in names]], doc_id)
    own = lambda c: F.col("row").getField(c)
    size = F.coalesce(F.regexp_count(own(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    src = F.coalesce(F.concat(F.lit("="), own(source).cast("string")), F.lit("-"))
    table = stored(rows.select(F.col("key").alias("pos"), own(source).cast("string").alias("source"), src.alias("src"), size.alias("size"), F.xxhash64(own(doc_id), F.lit(seed)).alias("u")), "sizes")
    goals = targets(table.select("source", "size"), weights, share, cap)
    goals = goals.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("src"), "source_size", "target",
                         F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("ratio"))
    goals = broadcast_if_small(stored(goals, "targets"), BROADCAST_SOURCES)
    whole = F.when(F.col("ratio") % 1 < SNAP, F.floor("ratio")).when(F.col("ratio") % 1 > 1 - SNAP, F.ceil("ratio")).otherwise(F.floor("ratio")).cast("long")
    sized = table.join(goals, "src").withColumn("whole", whole).withColumn("rest", F.greatest(F.lit(0.0), F.col("ratio") - F.col("whole")))
    items = sized.filter((F.col("size") > 0) & (F.col("rest") > SNAP)).select(F.col("src").alias("source"), "u", "pos", "size", (F.col("size") * F.col("rest")).alias("mass"))
    up = rounded(items, block, seed)
    lone = (F.col("size") == 0) & (_uniform(F.col("u"), F.lit(-2)) < F.col("rest"))
    copies = F.col("whole") + F.coalesce(F.col("up"), lone).cast("long")
    decided = sized.join(up, "pos", "left").select(F.col("pos").alias("key"), F.struct("size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")).alias("m"))
    decided = stored(decided, "copies")
    wanted = rows.select("key", F.struct(*unpacked(names)).alias("row")) if names else rows
    if carry is None:  # whole texts stay where they are, if the decisions may be broadcast
        decided = broadcast_if_small(decided, BROADCAST_KEYS)
    return wanted.join(decided, "key").select(*unpacked(names), F.col("m").alias(out))
