"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

The distinct words of an Arrow batch form one flat array of symbols.  In each
round every adjacent pair is looked up by binary search over the sorted pair keys
of the merge table, each word's lowest rank is found by a segmented minimum, and
all its pairs of that rank are merged, left to right without overlap.  Words
without a pair left drop out; the rounds end when none is active.

The vocabulary is a public tokenizer file in JSON whose path is a parameter.  It
is read on the driver, and its tables (fixed by the file: about 2 MB) are broadcast.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import bounded_batches, col, free_name, packed, trim, unpacked

CACHE_WORDS = 150_000  # distinct words that a worker remembers: some 30 MB
CACHE_CHARS = 64  # longer words are encoded anew
NO_RANK = np.iinfo(np.int32).max

# Letters and numbers of a later Unicode version than that of the
# vocabulary's own pre-tokenizer, which splits at them (hexadecimal code points).
NEWER = """558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee
11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20
18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2
1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"""

_NEWER_CLASS = "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in NEWER.split())
_MAY_HAVE_NEWER, _HAS_NEWER = re.compile("[\u0558-\U0010ffff]"), re.compile(f"[{_NEWER_CLASS}]")
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_ASCII = re.compile(rf"{_CONTRACTIONS}| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_ANY = regex.compile(rf"{_CONTRACTIONS}| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+|\s+(?!\S)|\s+")
_L, _N = rf"[\p{{L}}--[{_NEWER_CLASS}]]", rf"[\p{{N}}--[{_NEWER_CLASS}]]"
_EXACT = regex.compile(rf"{_CONTRACTIONS}| ?{_L}+| ?{_N}+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+", regex.V1)


def words_of(text: str) -> list[str]:
    """The text split into the words that merges never cross."""
    if text.isascii():
        return _ASCII.findall(text)
    return (_EXACT if _MAY_HAVE_NEWER.search(text) and _HAS_NEWER.search(text) else _ANY).findall(text)


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Vocabulary:
    first: np.ndarray  # byte -> id
    keys: np.ndarray  # sorted left * size + right
    ranks: np.ndarray  # of the pair at the same place in keys
    merged: np.ndarray  # rank -> id
    size: int
    pieces: list[bytes]  # id -> bytes
    added: dict[str, int]  # strings that are one token wherever they occur

    @staticmethod
    def read(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE vocabulary without normalizer is expected")
        symbols = _byte_symbols()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *added.values()]) + 1
        pieces = [b""] * size
        for token, i in vocab.items():
            pieces[i] = bytes(symbols[c] for c in token)
        for token, i in added.items():
            pieces[i] = token.encode()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        first = np.zeros(256, np.int32)
        for c, b in symbols.items():
            first[b] = vocab[c]
        return Vocabulary(first, keys[order], order.astype(np.int32), np.array([vocab[a + b] for a, b in pairs], np.int32), size, pieces, added)


def encode_words(words: list[bytes], v: Vocabulary) -> list[bytes]:
    """The ids of each (non-empty) word, as the bytes of 32-bit integers."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    sym = v.first[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    done_sym, done_word = [], []
    rank = np.full(len(sym), NO_RANK, np.int32)

    def look_up(places: np.ndarray) -> None:
        """Sets the rank of the pairs that begin at ``places``."""
        places = places[places < len(sym) - 1]
        key = sym[places].astype(np.int64) * v.size + sym[places + 1]
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        known = (v.keys[at] == key) & (word[places + 1] == word[places])
        rank[places] = np.where(known, v.ranks[at], NO_RANK)

    look_up(np.arange(len(sym)))
    while len(sym):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(sym)]))
        still = least != NO_RANK
        done_sym.append(sym[~still])
        done_word.append(word[~still])
        sym, word, rank, least = sym[still], word[still], rank[still], least[still]
        hit = np.flatnonzero(rank == least)
        if not len(hit):
            break
        # of hits in a row (a pair of equal symbols) every second one stands
        run = np.maximum.accumulate(np.where(np.r_[True, np.diff(hit) != 1], np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        sym[hit] = v.merged[rank[hit]]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        rank[hit] = NO_RANK
        sym, word, rank = sym[keep], word[keep], rank[keep]
        hit -= np.arange(len(hit))  # places after the removals
        look_up(np.concatenate([hit[hit > 0] - 1, hit]))
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    ids, ends = sym[order].astype(np.int32).tobytes(), (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
    return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class Codec:
    """Encodes and decodes lists of texts; remembers words between calls."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.known: dict[str, bytes] = {}
        longest = sorted(v.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.special = {t: np.int32(i).tobytes() for t, i in v.added.items()}

    def encoded(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as the bytes of 32-bit integers."""
        split = []
        for text in texts:
            parts = self.added.split(text or "") if self.added else [text or ""]
            split.append([(words_of(p), b"") if k % 2 == 0 else ((), self.special[p]) for k, p in enumerate(parts)])
        known = self.known
        new = [w for w in dict.fromkeys(chain.from_iterable(w for parts in split for w, _ in parts)) if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = list(dict.fromkeys(chain.from_iterable(w for parts in split for w, _ in parts)))
        if new:
            known.update(zip(new, encode_words([w.encode() for w in new], self.v), strict=True))
        out = [b"".join(chain.from_iterable((*map(known.__getitem__, words), special) for words, special in parts)) for parts in split]
        for w in new:
            if len(w) > CACHE_CHARS:
                del known[w]
        return out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [np.frombuffer(x, np.int32).tolist() for x in self.encoded(texts)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.v.pieces.__getitem__, ids)).decode("utf-8", errors="replace")


TEXT_CHARS = 400_000  # characters whose words are held at once


def _in_parts(texts: pa.Array):
    """Runs of texts of about TEXT_CHARS together."""
    part, size = [], 0
    for x in texts:
        t = x.as_py()
        part.append(t)
        size += len(t or "")
        if size > TEXT_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


_RESULT = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])


class _Shared:
    """A codec that is made once in a worker and serves all its tasks: broadcast
    values stay in the worker while their query runs."""

    def __init__(self, v: Vocabulary):
        self.v, self.codec = v, None

    def get(self) -> Codec:
        self.codec = self.codec or Codec(self.v)
        return self.codec


def _broadcast(vocabulary: str):
    return SparkSession.active().sparkContext.broadcast(_Shared(Vocabulary.read(vocabulary)))


def transcoded(text: Column, vocabulary: str, decode: bool = True) -> Column:
    """Struct of a text's ``ids`` and, if ``decode``, the text ``decoded`` from them."""
    shared = _broadcast(vocabulary)

    @F.arrow_udf(_RESULT)
    def udf(batch: pa.Array) -> pa.Array:
        trim()  # what earlier batches took goes back to the system
        codec, offsets, ids, texts = shared.value.get(), [0], [], []
        for part in _in_parts(batch):
            for x in codec.encoded(part):
                offsets.append(offsets[-1] + len(x) // 4)
                ids.append(x)
                texts.append(codec.decode(np.frombuffer(x, np.int32).tolist()) if decode else None)
        flat = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(ids))])
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), pa.array(texts, pa.string())], ["ids", "decoded"])

    return udf(text)


def decoded(ids: Column, vocabulary: str) -> Column:
    """The text of a column of ids; NULL for NULL.  Bytes that form no character
    become U+FFFD, as do those of a character that was cut."""
    shared = _broadcast(vocabulary)

    @F.arrow_udf(T.StringType())
    def udf(batch: pa.Array) -> pa.Array:
        codec = shared.value.get()
        return pa.array([None if x is None else codec.decode(x) for x in batch.to_pylist()], pa.string())

    return udf(ids)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", *, decode: bool = True, carry: list[str] | None = None, out: str = "tokens") -> DataFrame:
    """The columns of ``docs`` (or those in ``carry``) plus a struct column
    ``out``: ``ids`` and ``decoded`` (the ids decoded again; NULL unless
    ``decode``).

    Defined results: a NULL text is encoded like an empty one, to no ids.  Strings
    of added tokens in a text become those tokens.  Repeated rows get equal
    results.  If ``docs`` has a column ``out``, the new one gets a leading
    underscore; other names are free.  An empty table gives an empty result.
    """
    bounded_batches(docs)
    names = docs.columns if carry is None else carry
    out = free_name(names, out)
    return docs.select(packed(docs, names).alias("row"), transcoded(col(text), vocabulary, decode).alias("t")).select(*unpacked(names), F.col("t").alias(out))
