"""Removal of passages that documents with smaller ids hold, by phrase automata.

A phrase is WORDS consecutive words of one document.  A word is removed if a phrase that
covers it also starts in a document with a smaller id; the document with the
smallest id that holds a phrase is its home and keeps it.

1. Exact copies of a text leave the search: a text's phrases all start in the copy with
   the smallest id, so the others lose every word, and only their ids are compared.
2. Recurring phrases are confirmed in two steps, both by grouped aggregation of
   64-bit hashes (two phrases with one hash would be given one home; about one pair in 6 * 10^9 phrases) with a map-side minimum and maximum of the ids.  First anchors: the
   ANCHOR-word part of a phrase with the smallest hash, which neighbouring phrases
   mostly share.  Anchors of several documents go into a bit filter of at most
   FILTER_BITS bits (one hash; what it lets through too much costs time, not
   correctness).  Then the phrases with such an anchor.
3. Phrases are sharded by home (a long home's by hash, too), about SHARD_PHRASES a
   shard.  A task compiles one shard's phrases, as words read from their homes, into an Aho-Corasick automaton,
   and streams the documents through it that hold one of these phrases by hash.  The
   automaton compares words, so a hash that two phrases share removes nothing.
   A shard that many documents need is compiled by several tasks, each with a part of them.
4. The stretches that a document's shards found are joined, and its words cut.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import WORD_PATTERN, bounded_batches, broadcast_if_small, col, free_name, keyed, packed, stored, unpacked

WORDS, ANCHOR = 13, 6
FILTER_BITS = 1 << 29  # 64 MB
SHARD_PHRASES = 50_000
SHARD_DOCUMENTS = 16_384  # documents that one task streams through a shard's automaton
BROADCAST_ROWS = 1_000_000

_WORD = re.compile(WORD_PATTERN)
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_LETTER = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])  # bytes of words; no part of a longer UTF-8 character is among the others
_BYTE = np.random.default_rng(13).integers(1, 1 << 63, 256, np.uint64)
CHUNK = 1 << 20


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of a column of texts, and the text it is in: a polynomial of
    the word's UTF-8 bytes, in chunks of about CHUNK bytes of whole texts."""
    texts = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    hashes, text = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        own = data[offsets[i]:offsets[j]]
        edges = offsets[i:j] - offsets[i]
        letter = _LETTER[own]
        begin = letter.copy()
        begin[1:] &= ~letter[:-1]
        some = edges[edges < len(own)]
        begin[some] = letter[some]
        at, starts = np.flatnonzero(letter), np.flatnonzero(begin)
        if len(starts):
            first = np.flatnonzero(begin[at])
            place = at - np.repeat(starts, np.diff(np.r_[first, len(at)]))
            powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(int(place.max()), _BASE)])
            h = np.add.reduceat(_BYTE[own[at]] * powers[place], first)
            hashes.append((h ^ h >> np.uint64(32)) * _MIX)
            text.append(i + np.searchsorted(edges, starts, "right") - 1)
        i = j
    return np.concatenate(hashes), np.concatenate(text)


def _sequence(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` consecutive words, by the first of them."""
    n = len(hashes) - k + 1
    h = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        h = (h ^ hashes[j:j + n]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def phrase_hashes(texts: pa.Array, words: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text, anchor and hash of each phrase of the texts, in order."""
    hashes, text = _word_hashes(texts)
    n = len(hashes) - words + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    parts = _sequence(hashes, anchor)
    least = parts[:n].copy()
    for j in range(1, words - anchor + 1):
        np.minimum(least, parts[j:j + n], out=least)
    whole = text[:n] == text[words - 1:]
    return text[:n][whole], least[whole], _sequence(hashes, words)[whole]


def _pairs(batch: pa.RecordBatch, text: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """(hash, id) for each text, once where neighbours are equal."""
    new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])]) if len(text) else text
    ids = batch.column("id").to_numpy()[text[new]]
    return pa.RecordBatch.from_arrays([pa.array(hashes[new].view(np.int64)), pa.array(ids, pa.int64())], names=["h", "id"])


def _anchors(words: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, least, _ = phrase_hashes(batch.column("text"), words, anchor)
            yield _pairs(batch, text, least)

    return run


def _phrases(words: int, anchor: int, bits: np.ndarray, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, least, whole = phrase_hashes(batch.column("text"), words, anchor)
            place = least & np.uint64(size - 1)
            seen = np.flatnonzero(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1))
            yield _pairs(batch, text[seen], whole[seen])

    return run


def _recurring(pairs: DataFrame) -> DataFrame:
    """``(h, home)``: the hashes that several ids have, and the smallest of these."""
    ends = pairs.groupBy("h").agg(F.min("id").alias("home"), F.max("id").alias("last"))
    return ends.filter("home < last").select("h", "home")


def _filter(anchors: DataFrame, most_bits: int) -> tuple[np.ndarray, int]:
    """The bit filter of the anchors: bit ``h mod size``.  ``size`` is 16 bits an anchor, at most ``most_bits``."""
    size = 1 << 20
    while size < most_bits and size < 16 * anchors.count():
        size *= 2
    place = F.col("h").bitwiseAND(F.lit(size - 1)) + 1  # bitmap buckets hold 32,768 values from 1 on
    parts = anchors.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("at")).groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for r in parts.toLocalIterator():  # at most size / 32,768 rows of 4 KB
        bits[(r["part"] - 1) * 4096:r["part"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return bits, size


class Automaton:
    """An Aho-Corasick automaton over words.

    The library looks through a node's children one by one, so a word is written as
    two letters from alphabets of its own, each about the root of the vocabulary in size:
    a node has at most that many children.  ``homes`` has the id, words and first words of phrases of each home.
    """

    def __init__(self, homes: list[tuple[int, list[str], np.ndarray]], words: int):
        self.words, self.numbers = words, {}
        for _, own, _ in homes:
            for w in own:
                self.numbers.setdefault(w, len(self.numbers))
        self.base = math.isqrt(len(self.numbers)) + 1
        self.places = [home for home, _, _ in homes]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for place in reversed(range(len(homes))):  # homes are sorted by id: the smallest one of a phrase is set last
            _, own, starts = homes[place]
            letters = self._letters(self._numbered(own))
            for s in starts.tolist():
                self.automaton.add_word(letters[2 * s:2 * (s + words)], place)
        self.automaton.make_automaton()

    def _numbered(self, own: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.get, own, repeat(-1)), np.int64, len(own))

    def _letters(self, ids: np.ndarray) -> tuple[int, ...]:
        return tuple(np.column_stack([ids // self.base, ids % self.base + self.base]).ravel().tolist())

    def ends(self, own: list[str], below: int) -> np.ndarray:
        """The last words of the phrases in a text whose home is smaller than ``below``."""
        if not len(self.automaton):
            return np.zeros(0, np.int64)
        ids = self._numbered(own)
        edge = np.flatnonzero(np.diff(np.r_[False, ids >= 0, False].astype(np.int8)))
        found = []
        for a, z in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if z - a >= self.words:  # words of no phrase end every match
                found += [a + e // 2 for e, home in self.automaton.iter(self._letters(ids[a:z])) if self.places[home] < below]
        return np.unique(np.array(found, np.int64))


def _located(words: int):
    """Streams rows sorted by (shard, part, kind, id): the homes of a shard's phrases (kind 0),
    then the documents (kind 1); gives the stretches of each that phrases of smaller ids cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, homes, ready = None, [], None
        for batch in batches:
            keys, starts, ends = [], [], []
            for r in batch.to_pylist():
                if at != (r["shard"], r["part"]):
                    at, homes, ready = (r["shard"], r["part"]), [], None
                own = _WORD.findall(r["text"] or "")
                if r["kind"] == 0:
                    found = _sequence(_word_hashes(pa.array([r["text"]], pa.string()))[0], words).view(np.int64)
                    wanted = np.flatnonzero(np.isin(found, np.array(r["hs"], np.int64)))
                    # only the words around its phrases
                    need = np.zeros(len(own) + 1, np.int64)
                    np.add.at(need, wanted, 1)
                    np.add.at(need, wanted + words, -1)
                    need = np.cumsum(need[:-1]) > 0
                    homes.append((r["id"], [w for w, n in zip(own, need, strict=True) if n], (np.cumsum(need) - 1)[wanted]))
                    continue
                if ready is None:
                    ready, homes = Automaton(homes, words), []
                e = ready.ends(own, r["id"])
                if not len(e):
                    continue
                new = np.flatnonzero(np.r_[True, e[1:] - e[:-1] > words])  # stretches that touch are one
                keys.append(r["key"])
                starts.append((e[new] - words + 1).tolist())
                ends.append((e[np.r_[new[1:] - 1, len(e) - 1]] + 1).tolist())
            spans = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, spans), pa.array(ends, spans)], names=["key", "starts", "ends"])

    return run


def passages(texts: DataFrame, *, words: int = WORDS, anchor: int = ANCHOR, filter_bits: int = FILTER_BITS, shard_phrases: int = SHARD_PHRASES,
             shard_documents: int = SHARD_DOCUMENTS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``(key, starts, ends)``: the stretches of words (end exclusive) of each text ``(key, id, text)`` that are
    covered by a phrase which also starts in a text with a smaller id.  Each row must
    have a key of its own."""
    anchors = _recurring(texts.select("id", "text").mapInArrow(_anchors(words, anchor), "h long, id long"))
    anchors = stored(anchors.select("h"), "anchors")
    bits, size = _filter(anchors, filter_bits)
    pairs = stored(texts.select("id", "text").mapInArrow(_phrases(words, anchor, bits, size), "h long, id long"), "phrases")
    recurring = stored(_recurring(pairs), "recurring")
    shards = max(1, -(-recurring.count() // shard_phrases))
    long = recurring.groupBy("home").agg(F.count("*").alias("n")).filter(F.col("n") > shard_phrases)
    long = long.select("home", F.ceil(F.col("n") / shard_phrases).alias("pieces"))
    piece = F.pmod("h", F.coalesce("pieces", F.lit(1)))
    sharded = recurring.join(broadcast_if_small(long, broadcast_rows), "home", "left").select("h", "home", F.pmod(F.xxhash64("home", piece), F.lit(shards)).cast("int").alias("shard"))
    phrases = sharded.groupBy(F.col("home").alias("id"), "shard").agg(F.collect_list("h").alias("hs"))
    routes = stored(pairs.join(sharded, "h").filter("id > home").select("id", "shard").distinct(), "routes")

    parts = routes.groupBy("shard").agg(F.ceil(F.count("*") / shard_documents).cast("int").alias("parts"))
    parts = broadcast_if_small(stored(parts, "parts"), broadcast_rows)
    homes = recurring.select(F.col("home").alias("id")).distinct()
    sources = texts.join(broadcast_if_small(stored(homes, "homes"), broadcast_rows), "id", "left_semi").join(phrases, "id")
    sources = sources.join(parts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "id", "key", "text", "hs")
    readers = texts.join(broadcast_if_small(routes, broadcast_rows), "id").join(parts, "shard")
    readers = readers.select("shard", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), "id", "key", "text", F.lit(None).cast("array<bigint>").alias("hs"))
    rows = sources.unionByName(readers).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind", "id")
    found = rows.mapInArrow(_located(words), "key long, starts array<int>, ends array<int>")
    return found.groupBy("key").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))


_CUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())])


def _cutter(words: int):
    @F.pandas_udf(_CUT)
    def udf(texts: pd.Series, copies: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        pa.default_memory_pool().release_unused()
        rows = []
        for text, copy, first, last in zip(texts, copies, starts, ends, strict=True):
            own = _WORD.findall(text) if text else []
            kept = own
            if copy and len(own) >= words:
                kept = []
            elif first is not None and len(first):
                cut = np.zeros(len(own) + 1, np.int64)
                np.add.at(cut, np.asarray(first), 1)
                np.add.at(cut, np.asarray(last), -1)
                kept = [own[i] for i in np.flatnonzero(np.cumsum(cut[:-1]) == 0)]
            rows.append((len(own), len(own) - len(kept), " ".join(kept)))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "text"])

    return udf


def drop_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, carry: list[str] | None = None, out: str = "unique", **options) -> DataFrame:
    """The columns of ``docs`` (or those in ``carry``) plus a struct column ``out``:
    ``n_words``, ``n_removed`` and ``text``, the words left, joined by one space.

    Defined results: a NULL or empty text has no words.  Rows with a NULL id lose
    nothing and nothing is removed for them.  Rows that share an id (repeated rows, ties) are no copies of
    each other, as neither id is smaller; each loses what smaller ids hold.  Texts of any length are
    searched whole.  If ``docs`` has a column ``out``, the new one gets a leading
    underscore; other names are free.  An empty table gives an empty result.
    """
    bounded_batches(docs)
    names = docs.columns if carry is None else carry
    out = free_name(names, out)
    words = options.get("words", WORDS)
    few = options.get("broadcast_rows", BROADCAST_ROWS)
    all_names = list(dict.fromkeys([*names, doc_id, text]))
    base = keyed(docs, all_names, doc_id)
    texts = base.select("key", F.col("row").getField(doc_id).cast("long").alias("id"), F.col("row").getField(text).alias("text"))
    digest = F.md5(F.col("text").cast("binary"))
    sums = stored(texts.filter("id is not null and text is not null").select("key", "id", digest.alias("md5")), "digests")
    firsts = sums.groupBy("md5").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("md5", "first")
    copies = sums.join(broadcast_if_small(stored(firsts, "firsts"), few), "md5").filter(F.col("id") > F.col("first")).select("key")
    copies = broadcast_if_small(stored(copies, "copies"), few)
    searched = texts.filter("id is not null and text is not null").join(copies, "key", "left_anti")
    found = broadcast_if_small(stored(passages(searched, **options), "found"), few)
    joined = base.join(copies.withColumn("copy", F.lit(True)), "key", "left").join(found, "key", "left")
    cut = _cutter(words)(F.col("row").getField(text), F.coalesce("copy", F.lit(False)), F.col("starts"), F.col("ends"))
    return joined.select("row", cut.alias("cut")).select(*unpacked(names), F.col("cut").alias(out))
