"""Language ID by Bayesian evidence fusion.

A page's posterior multiplies four pieces of evidence: the likelihood of its
visible text under a byte-trigram model of each language; the language that its
markup declares; the suffix of its host name; and a prior for its host, smoothed
towards its domain's and that towards the corpus's.

The trigram models are counted from at most ``max_per_language`` labelled
documents of each of the ``max_languages`` most frequent languages.  Everything
about declarations, suffixes, hosts and domains comes from grouped aggregations
over all pages of the text-only posteriors (so a hot host is summed map-side); a
page's own share is taken out of its host's and domain's counts before they judge
it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import bounded_batches, broadcast_if_small, col, free_name, packed, stored, unpacked

BUCKETS = 1 << 13
MAX_PER_LANGUAGE = 400
MAX_LANGUAGES = 200
TEXT_WEIGHT = 24.0  # a text's trigrams count as this many independent ones at most
HOST_STRENGTH = 8.0  # pages that the domain's prior weighs as in a host's
DOMAIN_STRENGTH = 32.0
VALUE_STRENGTH = 2.0  # pages that the corpus weighs as in a declaration's or suffix's likelihood
BROADCAST_KEYS = 50_000

_HIDDEN = re.compile(rb"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[^>]*(?:>|\Z)|&#?\w+;", re.DOTALL | re.IGNORECASE)
_DECLARED = re.compile(rb"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", re.IGNORECASE)
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def trigrams(raw: bytes) -> np.ndarray:
    """Counts of the hashed trigrams of bytes, letters folded, all else a space."""
    a = _FOLD[np.frombuffer(b" " + raw + b" ", np.uint8)]
    a = a[np.r_[True, (a[1:] != 32) | (a[:-1] != 32)]]
    h = a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA77) + a[2:] * np.uint32(0xC2B2AE3D) if len(a) > 2 else np.zeros(0, np.uint32)
    h ^= h >> np.uint32(15)
    return np.bincount((h * np.uint32(0x27D4EB2F)) >> np.uint32(19), minlength=BUCKETS)


def visible(html: bytes) -> bytes:
    """The page without comments, scripts, styles, tags and character references."""
    return _HIDDEN.sub(b" ", html)


@dataclass
class TextModel:
    languages: list[str]
    log_p: np.ndarray  # buckets x languages

    def posterior(self, raw: bytes) -> np.ndarray:
        """Of the text alone, with equal priors."""
        n = trigrams(raw)
        at = np.flatnonzero(n)
        total = n[at].sum()
        score = (n[at] @ self.log_p[at]) * min(1.0, TEXT_WEIGHT / total) if total else np.zeros(len(self.languages))
        p = np.exp(score - score.max(initial=0.0 if not len(score) else -np.inf))
        return p / p.sum()


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for lang, texts in pdf.groupby("lang")["text"]:
            n = sum((trigrams(t.encode()) for t in texts if t), np.zeros(BUCKETS, np.int64))
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", *, max_per_language: int = MAX_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> TextModel:
    """Trigram models from labelled documents; rows without language, id or text
    are left out."""
    bounded_batches(docs)
    rows = docs.select(col(doc_id).alias("id"), F.lower(col(lang)).alias("lang"), col(text).alias("text")).filter("id is not null and lang is not null and text is not null")
    languages = sorted(r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect())
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = stored(rows.filter(F.col("lang").isin(languages)).select("id", "lang").withColumn("k", first).filter(F.col("k") <= max_per_language).select("id", "lang").distinct(), "labelled")
    sample = rows.join(F.broadcast(chosen), ["id", "lang"])  # at most max_languages * max_per_language ids
    counts = sample.select("lang", "text").mapInPandas(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    n = np.full((BUCKETS, len(languages)), 0.5)
    place = {x: k for k, x in enumerate(languages)}
    for r in counts:
        n[r["bucket"], place[r["lang"]]] += r["n"]
    return TextModel(languages, np.log(n / n.sum(axis=0)))


_EVIDENCE = T.StructType([T.StructField("p", T.ArrayType(T.DoubleType())), T.StructField("declared", T.StringType())])


def _text_evidence(html: Column, model: TextModel) -> Column:
    @F.pandas_udf(_EVIDENCE)
    def udf(pages: pd.Series) -> pd.DataFrame:
        p, declared = [], []
        for raw in pages:
            raw = bytes(raw) if raw is not None else b""
            m = _DECLARED.search(raw)
            declared.append(m[1].decode().lower() if m else "")
            p.append(model.posterior(visible(raw)).tolist())
        return pd.DataFrame({"p": p, "declared": declared})

    return udf(html.cast("binary"))


def identify(pages: DataFrame, model: TextModel, url: str = "url", html: str = "html", *, carry: list[str] | None = None, out: str = "language") -> DataFrame:
    """The columns of ``pages`` (or those in ``carry``) plus a struct column
    ``out``: ``lang``, ``posterior``, ``text_lang``, ``declared``, ``host``.

    Defined results: a NULL or empty page has no text evidence and declares
    nothing; a NULL or odd URL has no host, and its prior is the corpus's; without
    labelled languages ``lang`` is NULL.  Ties go to the first language by name.
    Repeated rows each count.  If ``pages`` has a column ``out``, the new one gets a
    leading underscore; other names are free.  An empty table gives an empty result.
    """
    bounded_batches(pages)
    names = pages.columns if carry is None else carry
    out = free_name(names, out)
    langs = model.languages
    host = F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    table = pages.select(packed(pages, names).alias("row"), host.alias("host"), col(html).alias("html"))
    if not langs:
        none = F.lit(None).cast("string")
        return table.select(*unpacked(names), F.struct(none.alias("lang"), F.lit(None).cast("double").alias("posterior"), none.alias("text_lang"), none.alias("declared"), "host").alias(out))
    table = table.select("row", "host", F.substring_index("host", ".", -2).alias("domain"), F.substring_index("host", ".", -1).alias("suffix"), _text_evidence(F.col("html"), model).alias("e"))
    table = stored(table.select("row", "host", "domain", "suffix", "e.declared", "e.p"), "evidence")
    sums = F.array(*[F.sum(F.col("p")[k]) for k in range(len(langs))])
    every = table.agg(F.count("*").alias("n"), sums.alias("s")).first()
    total = float(every["n"])
    corpus = [((s or 0.0) + 1.0) / (total + len(langs)) for s in (every["s"] or [])]

    def counts(key: str) -> DataFrame:
        got = table.groupBy(key).agg(F.count("*").cast("double").alias(f"n_{key}"), sums.alias(f"s_{key}"))
        return broadcast_if_small(stored(got, key), BROADCAST_KEYS)

    joined = table
    for key in ("host", "domain", "suffix", "declared"):
        joined = joined.join(counts(key), key)
    known = F.col("host") != ""
    scores = []
    for k in range(len(langs)):
        own = F.col("p")[k]
        of_domain = (F.col("s_domain")[k] - own + DOMAIN_STRENGTH * corpus[k]) / (F.col("n_domain") - 1 + DOMAIN_STRENGTH)
        of_host = (F.col("s_host")[k] - own + HOST_STRENGTH * of_domain) / (F.col("n_host") - 1 + HOST_STRENGTH)
        prior = F.when(known, of_host).otherwise(corpus[k])
        score = F.log(F.greatest(own, F.lit(1e-300))) + F.log(F.greatest(prior, F.lit(1e-12)))
        for key in ("suffix", "declared"):
            # P(value | language), the page itself left out, smoothed by P(value)
            share = (F.col(f"s_{key}")[k] - own + VALUE_STRENGTH * F.col(f"n_{key}") / total) / (corpus[k] * total + VALUE_STRENGTH)
            score = score + F.log(F.greatest(share, F.lit(1e-12)))
        scores.append(score)
    joined = joined.select("row", "host", "declared", "p", F.array(*scores).alias("score"))
    top = F.array_max("score")
    posterior = 1 / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    name = lambda values: F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position(values, F.array_max(values)).cast("int"))
    return joined.select(*unpacked(names), F.struct(name(F.col("score")).alias("lang"), posterior.alias("posterior"), name(F.col("p")).alias("text_lang"), "declared", "host").alias(out))
