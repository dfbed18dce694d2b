"""Information-theoretic sanitisation of personal data.

Protected entities are the personal data found by pattern (e-mail and IP
addresses, card and phone numbers), each distinct value being one entity ``e``, and
so is what it shares with others: mail domain, address prefixes, issuer, number block.
A term ``t`` discloses ``e`` by as much as seeing it raises the odds of ``e``:
the point-wise mutual information ``PMI(e; t) = log p(e, t) / (p(e) p(t))``,
estimated from the whole corpus, against what there is to disclose, the
information content ``IC(e) = -log p(e)``.  Terms with ``PMI >= IC / alpha`` for
some entity reveal too much in the texts that hold this entity: there, fully revealing ones
(``PMI >= IC / alpha_remove``) are removed, the others generalised to a placeholder.
A text that holds no entity has nothing to disclose and stays as it is.

Terms are the words outside the personal data, of letters and digits and of any
length.  Probabilities are shares of distinct texts (copies are one piece of evidence).
``p(e, t)`` counts the texts that hold both, wherever in the text.  There is no least
number of them: ``p(e | t)`` is drawn towards ``p(e)`` by PRIOR_TEXTS texts, so that
a pair seen once says less than one seen often.  As a term passes
only up to a number of texts that follows from ``e`` alone, common words drop out
before they are paired; entities that lie in the same texts have equal information
and are paired once, so a text full of personal data does not multiply its words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import bounded_batches, broadcast_if_small, col, free_name, packed, stored, trim, unpacked

KINDS = ["email", "ip", "card", "phone", "term"]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match cannot begin inside a run of digits: it would end where the run's own does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\w+(?:['’-]\w+)*")
_SEPARATORS = str.maketrans("", "", " -")
_DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]

MIN_TEXTS = 1  # distinct texts that must show a term with an entity: no floor
PRIOR_TEXTS = 1.0  # texts without evidence that p(e | t) is smoothed by
ALPHA = 1.25  # a term is generalised at PMI >= IC / ALPHA ...
ALPHA_REMOVE = 1.05  # ... and removed at PMI >= IC / ALPHA_REMOVE
FILTER_BITS = 1 << 29  # a bit filter of the candidate terms: at most 64 MB
BROADCAST_TEXTS = 50_000  # texts with their terms, joined without a shuffle up to that many
ABSENT_WORDS = 300_000  # words that a task remembers as no terms

Span = tuple[int, int, int]  # start, kind, end


def _luhn(digits: str) -> bool:
    return sum(_DOUBLED[int(c)] if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Personal data by pattern, leftmost and without overlap within a kind, by
    start and then kind; matches that fail their test are dropped."""
    found: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:
        left = at
        while left > last and text[left - 1] in _LOCAL:
            left -= 1
        if left < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((left, 0, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(map(_octet, m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := m[0].translate(_SEPARATORS)) <= 19 and _luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def entity(text: str, span: Span) -> str:
    """The value that a span stands for, whatever its spelling."""
    value = text[span[0]:span[2]]
    if span[1] == 0:
        value = value.lower()
    elif span[1] > 1:
        value = "".join(filter(str.isdigit, value))
    return f"{KINDS[span[1]]}:{value}"


def _terms(text: str, spans: list[Span]) -> Iterator[tuple[int, int, str]]:
    """The words outside the spans, in lower case."""
    parts, at = [], 0
    for start, _, end in spans:  # by start; they may overlap
        if end > at:
            parts += [text[at:start], " " * (end - max(at, start))]
            at = end
    for m in _WORD.finditer("".join([*parts, text[at:]]) if spans else text):
        yield m.start(), m.end(), m[0].lower()


def _distinct_terms(text: str, spans: list[Span]) -> set[str]:
    if spans:
        return {t for _, _, t in _terms(text, spans)}
    if "\u0130" in text or "\u03a3" in text:  # lower case of other length, or by the letters around
        return {w.lower() for w in set(_WORD.findall(text))}
    return set(_WORD.findall(text.lower()))


def _keys(terms: list[str]) -> np.ndarray:
    """Spark's xxhash64 of each term."""
    return np.fromiter((xxhash.xxh64_intdigest(t.encode(), 42) for t in terms), np.uint64, len(terms)).view(np.int64)


def _lookup(bits: np.ndarray):
    """The keys of a set's words that pass the bit filter.  Words seen not to are
    remembered, as most words of a text are common ones."""
    absent: set[str] = set()
    mask = np.uint64(8 * len(bits) - 1)

    def find(words: set[str]) -> np.ndarray:
        if len(absent) > ABSENT_WORDS:
            absent.clear()
        new = list(words - absent)
        keys = _keys(new)
        place = keys.view(np.uint64) & mask
        hit = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)
        absent.update(new[k] for k in np.flatnonzero(~hit))
        return keys[hit]

    return find


def entities(text: str, spans: list[Span]) -> set[str]:
    """The values of the spans and the coarser ones that they belong to."""
    out = set()
    for s in spans:
        e = entity(text, s)
        out.add(e)
        value = e.partition(":")[2]
        if s[1] == 0:
            out.add("domain:" + value.partition("@")[2])
        elif s[1] == 1:
            a, b, c, _ = value.split(".")
            out |= {f"net:{a}.{b}.{c}", f"net:{a}.{b}"}
        elif s[1] == 2:
            out.add("issuer:" + value[:6])
        else:
            out.add("block:" + value[:-4])
    return out


def contexts(text: str) -> set[tuple[str, str]]:
    """(entity, term) for the entities and terms of a text; each entity also
    appears with an empty term."""
    spans = base_spans(text)
    terms = ["", *_distinct_terms(text, spans)]
    return {(e, t) for e in entities(text, spans) for t in terms}


_PRIVATE = T.StructType([T.StructField("h", T.LongType()), T.StructField("es", T.ArrayType(T.StringType())), T.StructField("ts", T.ArrayType(T.StringType()))])


def _private(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The entities and terms of the texts that hold an entity."""
    for pdf in frames:
        trim()
        rows = []
        for h, text in zip(pdf["h"], pdf["text"], strict=True):
            if text and (spans := base_spans(text)):
                rows.append((h, sorted(entities(text, spans)), sorted(_distinct_terms(text, spans))))
        yield pd.DataFrame(rows, columns=["h", "es", "ts"])
    trim()


_SEEN = T.StructType([T.StructField("k", T.LongType()), T.StructField("h", T.LongType())])


def _occurrences(bits: np.ndarray):
    """(term key, text hash) for the words of each text that pass the filter."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, find = set(), _lookup(bits)
        for pdf in frames:
            trim()
            ks, hs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for h, text in zip(pdf["h"], pdf["text"], strict=True):
                if text and h not in done:
                    done.add(h)
                    ks.append(find(_distinct_terms(text, base_spans(text))))
                    hs.append(np.full(len(ks[-1]), h, np.int64))
            yield pd.DataFrame({"k": np.concatenate(ks), "h": np.concatenate(hs)})
        del done, find  # with the words remembered
        trim()

    return run


def _bit_filter(keys: DataFrame, most_bits: int) -> np.ndarray:
    """Bit ``k mod size`` of each key; ``size`` is 32 bits a key and at most ``most_bits``."""
    size, n = 1 << 15, keys.count()
    while size < min(most_bits, 32 * n):
        size *= 2
    place = F.col("k").bitwiseAND(F.lit(size - 1)) + 1  # bitmap buckets hold 32,768 values from 1 on
    parts = keys.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("at")).groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for r in parts.toLocalIterator():  # at most size / 32,768 rows of 4 KB
        bits[(r["part"] - 1) * 4096:r["part"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _texts_with(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``(k, n_t)``: in how many distinct texts each of the terms ``(k)`` occurs.  One pass over
    the texts however many terms: what passes the filter is counted and joined with them."""
    bits = _bit_filter(terms, FILTER_BITS)
    seen = texts.select("h", "text").mapInPandas(_occurrences(bits), _SEEN)
    return seen.distinct().groupBy("k").agg(F.count("*").alias("n_t")).join(terms, "k")


def disclosing_terms(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``(t, remove, k)``: the terms that disclose an entity by more than the
    threshold, whether they do so fully for one, and their hash."""
    pairs, _ = _disclosing(docs, text, **options)
    return pairs.groupBy("t").agg(F.max("remove").alias("remove")).withColumn("k", F.xxhash64("t"))


def _disclosing(docs: DataFrame, text: str = "text", *, min_texts: int = MIN_TEXTS, alpha: float = ALPHA, alpha_remove: float = ALPHA_REMOVE) -> tuple[DataFrame, DataFrame]:
    """``(e, t, remove)``: the pairs of an entity and a term that discloses it by more than the
    threshold, and ``(h, t, remove)``: the texts that hold both.  Also see the module's text.

    With ``p = n_e / N``, ``p(e | t) = (n_et + w p) / (n_t + w)`` and ``w`` for PRIOR_TEXTS,
    ``PMI >= IC / alpha`` is ``n_t <= (n_et + w p) / p ** (1 - 1 / alpha) - w``.
    As ``n_et <= n_e``, an entity has a greatest ``n_t`` of its own.
    """
    bounded_batches(docs)
    texts = docs.select(col(text).alias("text"), F.xxhash64(col(text)).alias("h")).filter("text is not null")
    private = stored(texts.select("h", "text").mapInPandas(_private, _PRIVATE).dropDuplicates(["h"]), "private")
    total = float(texts.select("h").distinct().count())
    share = F.col("n_e") / F.lit(total)

    def most(n_et: Column, a: float) -> Column:
        return (n_et + PRIOR_TEXTS * share) * F.pow(share, F.lit(1 / a - 1)) * math.exp(1e-9) - PRIOR_TEXTS

    held = private.select(F.explode("es").alias("e"), "h")
    same = [F.bit_xor("h").alias("x"), F.bit_xor(F.xxhash64("h")).alias("y")]
    found = held.groupBy("e").agg(F.count("*").alias("n_e"), *same).filter(F.col("n_e") < total)
    one = found.groupBy("n_e", "x", "y").agg(F.min("e").alias("e"))
    one = stored(one.select("e", "n_e", most(F.col("n_e"), alpha).alias("bound")), "entities")
    words = private.select(F.explode("ts").alias("t"), "h")
    widest = one.agg(F.max("bound")).first()[0] or 0.0
    # A term has at least the texts that show it with any entity.
    least = words.groupBy("t").agg(F.count("*").alias("least")).filter(F.col("least") <= widest)
    pairs = words.join(least, "t").join(held.join(one, "e"), "h").filter(F.col("least") <= F.col("bound"))
    joint = pairs.groupBy("e", "t", "least", "n_e").agg(F.count("*").alias("n_et"))
    if min_texts > 1:
        joint = joint.filter(F.col("n_et") >= min_texts)
    joint = joint.select("e", "t", "least", most(F.col("n_et"), alpha).alias("most"), most(F.col("n_et"), alpha_remove).alias("most_removed"))
    joint = stored(joint.filter(F.col("least") <= F.col("most")).withColumn("k", F.xxhash64("t")), "joint")
    counted = joint.join(_texts_with(texts, joint.select("k").distinct()), "k").filter(F.col("n_t") <= F.col("most"))
    pairs = stored(counted.select("e", "t", (F.col("n_t") <= F.col("most_removed")).alias("remove")), "pairs")
    # by text first: the texts of an entity times its terms would grow with the square of the corpus
    shown = words.join(pairs.select("t").distinct(), "t").join(held.join(pairs.select("e").distinct(), "e"), "h")
    both = shown.join(pairs, ["e", "t"]).groupBy("h", "t").agg(F.max("remove").alias("remove"))
    return pairs, both


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("end", T.IntegerType()), T.StructField("remove", T.BooleanType())])


def rewritten(text: str, spans: list) -> str:
    """The text with each span replaced by its kind, or by nothing; spans that
    overlap an earlier one extend it."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at:s["start"]], "" if s["remove"] else f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def _spans_of(text: str | None, terms: dict[str, bool]) -> list[dict]:
    """Spans of a text: personal data, and outside it the given terms."""
    if not text:
        return []
    own = base_spans(text)
    out = [(s, k, e, False) for s, k, e in own]
    if terms:
        out += [(b, 4, z, terms[t]) for b, z, t in _terms(text, own) if t in terms]
        out.sort()
    return [{"start": s, "kind": KINDS[k], "end": e, "remove": r} for s, k, e, r in out]


def _sanitiser(rewrite: bool):
    """Struct of spans and, if ``rewrite``, the rewritten text, from a text and its
    terms.  One function, so that a task needs one Python worker."""
    result = T.StructType([T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("text", T.StringType())])

    @F.pandas_udf(result)
    def udf(texts: pd.Series, terms: pd.Series, removes: pd.Series) -> pd.DataFrame:
        trim()
        spans, clean = [], []
        for text, own, remove in zip(texts, terms, removes, strict=True):
            found = _spans_of(text, dict(zip(own, remove, strict=True)) if own is not None else {})
            spans.append(found)
            clean.append(rewritten(text, found) if rewrite and found else text if rewrite else None)
        return pd.DataFrame({"spans": pd.Series(spans, dtype=object), "text": pd.Series(clean, dtype=object)})

    return udf


def sanitise(docs: DataFrame, text: str = "text", *, rewrite: bool = True, carry: list[str] | None = None, out: str = "pii", **options) -> DataFrame:
    """The columns of ``docs`` (or those in ``carry``) plus a struct column
    ``out``: ``spans`` (array of start, kind, end, remove; code points, end
    exclusive; by start and then kind) and, if ``rewrite``, ``text``: the text
    with personal data and generalised terms replaced by their kind in brackets
    and removed terms left out.  A term is only touched in texts that hold an entity which it discloses.

    Defined results: a NULL text has no spans and stays NULL; an empty text stays
    empty; texts of any length are read whole.  Repeated rows count once in the estimates and get equal results.
    Entities in every text have nothing to disclose; a term whose information equals the threshold (a tie)
    discloses.  Clashing names: only ``out`` is taken; if it exists, the new column
    gets a leading underscore.  An empty table gives an empty result.
    """
    names = docs.columns if carry is None else carry
    out = free_name(names, out)
    _, both = _disclosing(docs, text, **options)
    own = both.groupBy("h").agg(F.collect_list(F.struct("t", "remove")).alias("own"))
    own = stored(own.select("h", F.col("own.t").alias("terms"), F.col("own.remove").alias("removes")), "terms")
    table = docs.select(packed(docs, names).alias("row"), col(text).alias("t"), F.xxhash64(col(text)).alias("h"))
    table = table.join(broadcast_if_small(own, BROADCAST_TEXTS), "h", "left")
    table = table.select("row", _sanitiser(rewrite)(F.col("t"), F.col("terms"), F.col("removes")).alias("found"))
    fields = [F.col("found.spans").alias("spans")] + ([F.col("found.text").alias("text")] if rewrite else [])
    return table.select(*unpacked(names), F.struct(*fields).alias(out))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
