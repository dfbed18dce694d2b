"""Periodic runs of words by sparse diagonals.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
equal), of at least ``max(MIN_LENGTH, REPEATS * q)`` words, that no neighbouring word
extends.  On the diagonal of lag ``q`` it is a match of ``length - q`` words: for each
word, its earlier occurrences lengthen the matches of their lags by one, and a
diagonal that ends long enough is a run.

Only lags that can still give a run are followed.  A run of period ``q`` matches at
least ``(REPEATS - 1) * q`` words in a row, so for lags in ``[g, 2g)`` an earlier
occurrence counts only if the ``g`` words from there on occur again, too; ``g`` goes
through the powers of two, and words whose ``g`` words are unique drop out of all
higher lags.  A lag within a run that is already known is a multiple of the run's period: its
diagonal ends where the run does, and its smallest period is the run's, so it
is left out as a whole.  What is left is sparse also in texts of one repeated word.

The diagonals of a batch of texts are followed together: matches (lag, word) in
order, where consecutive words of one lag lengthen one match.  At most about
MATCHES of them are held at once, by ranges of lags.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import WORD_PATTERN, bounded_batches, col, free_name, packed, unpacked

MIN_LENGTH, REPEATS = 6, 4
MATCHES = 4_000_000

_WORD = re.compile(WORD_PATTERN)
_NONE = np.iinfo(np.int64).max


def _renumbered(keys: np.ndarray) -> np.ndarray:
    """Equal keys get equal numbers from 0 on; a key of its own gets -1."""
    order = np.argsort(keys, kind="stable")
    new = np.r_[True, keys[order][1:] != keys[order][:-1]] if len(keys) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    alone = np.bincount(number, minlength=1)[number] == 1 if len(keys) else new
    out = np.empty(len(keys), np.int64)
    out[order] = np.where(alone, -1, number)
    return out


def _known_from(runs: list[tuple[np.ndarray, np.ndarray]], at: np.ndarray, g: int, n: int) -> np.ndarray:
    """For each word of ``at``: the first word of the known runs that hold it and the
    ``g - 1`` words after it; a large number if there is none."""
    least = np.full(n + 1, _NONE)
    for starts, ends in runs:
        order = np.argsort(-starts, kind="stable")  # the earliest start is written last
        for s, e in zip(starts[order].tolist(), ends[order].tolist(), strict=True):
            if e - g >= s:
                view = least[s:e - g + 1]
                np.minimum(view, s, out=view)
    return least[at]


def _ended(lag: np.ndarray, word: np.ndarray, g: int, min_length: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the diagonals that are long enough, from matches of ``g`` words."""
    order = np.lexsort((word, lag))
    lag, word = lag[order], word[order]
    first = np.flatnonzero(np.r_[True, (lag[1:] != lag[:-1]) | (word[1:] != word[:-1] + 1)])
    matched = np.diff(np.r_[first, len(lag)]) + g - 1
    q = lag[first]
    enough = matched + q >= np.maximum(min_length, repeats * q)
    return word[first][enough] - q[enough], (matched + q)[enough], q[enough]


def runs_of(ids: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, repeats: int = REPEATS, most: int = MATCHES) -> np.ndarray:
    """``(runs, 3)``: start, length and period of the runs in each of the texts
    ``ids[bounds[k]:bounds[k + 1]]``, by start and then period.  Words are equal
    where their ``ids`` are; starts count from the first text's first word."""
    if repeats < 2:
        raise ValueError("a run repeats its period at least twice")
    n = len(ids)
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(bounds[1:], sizes)
    known: list[tuple[np.ndarray, np.ndarray]] = []
    found = [np.zeros((0, 3), np.int64)]
    # words that may begin a match of g words, and the number of those g words in their text
    gram = _renumbered(text * (int(ids.max(initial=0)) + 1) + ids) if n else np.zeros(0, np.int64)
    g = 1
    while (at := np.flatnonzero(gram >= 0)).size and repeats * g <= sizes.max(initial=0):
        keys = gram[at] * n + at  # sorted by gram, then by word
        keys.sort()
        limit = np.minimum(at - g, _known_from(known, at, g, n) - 1)
        fresh: list[np.ndarray] = []
        low = g
        while low < 2 * g:
            high, step = 2 * g, g
            while True:  # lags low .. high - 1, fewer of them if their matches are too many
                begin = np.searchsorted(keys, gram[at] * n + np.maximum(at - high + 1, 0), "left")
                stop = np.searchsorted(keys, gram[at] * n + np.minimum(limit, at - low), "right")
                count = np.maximum(stop - begin, 0)
                count[np.minimum(limit, at - low) < 0] = 0
                if count.sum() <= most or high == low + 1:
                    break
                step = max(1, (high - low) // 2)
                high = low + step
            some = np.flatnonzero(count)
            if some.size:
                word = np.repeat(at[some], count[some])
                offset = np.arange(len(word)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
                earlier = keys[np.repeat(begin[some], count[some]) + offset] % n
                start, length, period = _ended(word - earlier, word, g, min_length, repeats)
                fresh.append(np.column_stack([start, length, period]))
            low = high
        if fresh:
            new = np.concatenate(fresh)
            found.append(new)
            known.append((new[:, 0], new[:, 0] + new[:, 1]))
        # twice as long: the g words here and the g words after them
        after = at + g
        fits = after + g <= end[at]
        fits[fits] &= gram[after[fits]] >= 0
        longer = np.full(n, -1, np.int64)
        longer[at[fits]] = _renumbered(gram[at[fits]] * n + gram[after[fits]])
        gram, g = longer, 2 * g
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _ids(texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    words = [_WORD.findall(t) if t else [] for t in texts]
    bounds = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
    ids = np.empty(bounds[-1], np.int64)
    for k, own in enumerate(words):
        numbers: dict[str, int] = {}
        ids[bounds[k]:bounds[k + 1]] = [numbers.setdefault(w, len(numbers)) for w in own]
    return words, ids, bounds


_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_RUNS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())])


def _detector(min_length: int, repeats: int):
    @F.pandas_udf(_RUNS)
    def udf(texts: pd.Series) -> pd.DataFrame:
        pa.default_memory_pool().release_unused()
        words, ids, bounds = _ids(texts.tolist())
        runs = runs_of(ids, bounds, min_length, repeats)
        cut = np.searchsorted(runs[:, 0], bounds)
        again = np.zeros(len(ids) + 1, np.int64)  # +1 where words to drop begin, -1 where they end
        np.add.at(again, runs[:, 0] + runs[:, 2], 1)
        np.add.at(again, runs[:, 0] + runs[:, 1], -1)
        keep = np.cumsum(again[:-1]) == 0
        listed, collapsed = [], []
        for k, own in enumerate(words):
            mine = runs[cut[k]:cut[k + 1]]
            listed.append([{"start": s - int(bounds[k]), "length": n, "period": p} for s, n, p in mine.tolist()])
            collapsed.append(" ".join(own if not len(mine) else [own[i] for i in np.flatnonzero(keep[bounds[k]:bounds[k + 1]])]))
        return pd.DataFrame({"n_words": np.diff(bounds), "runs": pd.Series(listed, dtype=object), "collapsed": pd.Series(collapsed, dtype=object)})

    return udf


def detect(docs: DataFrame, text: str = "text", *, min_length: int = MIN_LENGTH, repeats: int = REPEATS, carry: list[str] | None = None, out: str = "periodic") -> DataFrame:
    """The columns of ``docs`` (or those in ``carry``) plus a struct column ``out``:
    ``n_words``; ``runs``, an array of start (word number from 0), length and period, by start and then
    period; and ``collapsed``, the words joined by one space without those that a
    run holds after its first ``period`` words.

    Defined results: a NULL or empty text has no words, no runs and an empty
    ``collapsed``.  Texts of any length are searched whole, in one task each.  Runs that begin at the same
    word (ties) are all listed, the smaller period first.  Repeated rows get equal
    results.  If ``docs`` has a column ``out``, the new one gets a leading underscore; other
    names are free.  An empty table gives an empty result.
    """
    bounded_batches(docs)
    names = docs.columns if carry is None else carry
    out = free_name(names, out)
    return docs.select(packed(docs, names).alias("row"), _detector(min_length, repeats)(col(text)).alias("r")).select(*unpacked(names), F.col("r").alias(out))


def longest(runs: Column) -> Column:
    """The run of greatest length; ties: the smallest start, then period.  NULL without runs."""
    return F.aggregate(runs, F.lit(None).cast(_RUN), lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
