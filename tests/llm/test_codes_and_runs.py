"""Vector codes, periodic runs and repeated passages: against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import periodic_runs, phrase_automata, queries, slice_codes


def _nearest(book: list, x) -> tuple[int, int]:
    return min((sum((int(a) - int(b)) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))


def _fit(rows: list, parts: int, entries: int, rounds: int):
    n = len(rows[0][1]) // parts
    books = [[list(v[p * n:(p + 1) * n]) for _, v in rows[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for _, v in rows:
                groups.setdefault(_nearest(book, v[p * n:(p + 1) * n])[1], []).append(v[p * n:(p + 1) * n])
            for k, xs in groups.items():
                book[k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    return books


@pytest.mark.parametrize("n,dim,parts,entries,high", [(300, 8, 4, 16, 3), (250, 12, 3, 70, 500), (120, 6, 2, 5, 2**60), (9, 8, 8, 16, 40)])
def test_codes_match_brute_force(spark, n, dim, parts, entries, high):
    rng = np.random.default_rng(n)
    v = rng.integers(-high, high, (n, dim))
    v[n // 2:n // 2 + n // 3] = v[0]  # a third are equal
    rows = [(i, [int(x) for x in r]) for i, r in enumerate(v)]
    extra = [(3, None), (4, [1, None] + [0] * (dim - 2)), (5, [1] * (dim + 1)), rows[7], (None, rows[1][1])]
    df = spark.createDataFrame(rows + extra, "vec_id long, v array<bigint>").withColumn("codes", F.lit("own")).withColumn("row", F.lit(0)).repartition(3)
    books = slice_codes.train(df, parts=parts, entries=entries, rounds=3)
    whole = sorted(rows + [rows[7]]) + [(None, rows[1][1])]
    want = _fit(whole, parts, entries, 3)
    assert [[list(e) for e in b] for b in books.entries] == want
    out = slice_codes.encode(df, books)
    assert out.columns == ["vec_id", "v", "codes", "row", "_codes"]
    width = dim // parts
    for r in out.collect():
        if r["v"] is None or None in r["v"] or len(r["v"]) != dim:
            assert r["_codes"] is None
            continue
        best = [_nearest(want[p], r["v"][p * width:(p + 1) * width]) for p in range(parts)]
        assert r["_codes"]["code"] == [k for _, k in best]
        assert r["_codes"]["error"] == min(sum(d for d, _ in best), 2**63 - 1)
    back = out.filter("_codes is not null").select("_codes.code", slice_codes.decoded(F.col("_codes.code"), books).alias("b")).first()
    assert back["b"] == [x for p, k in enumerate(back["code"]) for x in want[p][k]]


def test_codes_of_odd_tables(spark):
    none = spark.createDataFrame([(1, None)], "vec_id long, v array<bigint>")
    books = slice_codes.train(none)
    assert slice_codes.encode(none, books).first()["codes"] is None
    assert slice_codes.encode(none.limit(0), books).count() == 0
    odd = spark.createDataFrame([(1, [1, 2, 3])], "vec_id long, v array<bigint>")
    assert slice_codes.encode(odd, slice_codes.train(odd)).first()["codes"] is None
    bare = spark.createDataFrame([(1, []), (2, [])], "vec_id long, v array<bigint>")
    assert [r["codes"]["code"] for r in slice_codes.encode(bare, slice_codes.train(bare)).collect()] == [[0] * 8] * 2
    big = spark.createDataFrame([(i, [i * k % 7 for k in range(40_000)]) for i in range(20)], "vec_id long, v array<bigint>")
    assert slice_codes.encode(big, slice_codes.train(big, rounds=1)).filter("size(codes.code) = 8").count() == 20


def test_masks_hold_exactly_the_entries_in_the_cube():
    rng = np.random.default_rng(2)
    s = slice_codes.Slices(rng.integers(-20, 20, (130, 4)))
    x, radius = rng.integers(-25, 25, (200, 4)), rng.integers(0, 30, 200)
    masks = s.candidates(x, radius)
    for row, r, m in zip(x, radius, masks, strict=True):
        got = {64 * w + b for w in range(3) for b in range(64) if int(m[w]) >> b & 1}
        assert got == set(np.flatnonzero((np.abs(s.book - row) <= r).all(axis=1)).tolist())


# --- periodic runs ---------------------------------------------------------

def _runs(words: list) -> list[tuple[int, int, int]]:
    """Runs straight from their definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            part = words[start:start + length]
            if length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def _run_texts() -> list[list[str]]:
    rng = random.Random(4)
    texts = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 400, ["a", "b"] * 3, ["a", "b"] * 4, (["a"] * 30 + ["b"]) * 5, (["a"] * 64 + ["b"]) * 4 + ["a"] * 20]
    for _ in range(250):
        out: list[str] = []
        for _ in range(rng.randint(1, 6)):
            block = [rng.choice("abcdefgh"[:rng.randint(1, 8)]) for _ in range(rng.randint(1, 12))]
            if rng.random() < 0.4:  # periodic blocks within a period
                block = block * rng.randint(2, 6) + [rng.choice("abc")] * rng.randint(0, 5)
            whole = block * rng.randint(1, 7)
            out += whole[:rng.randint(max(0, len(whole) - len(block)), len(whole))]
        texts.append(out[:400])
    return texts


@pytest.mark.parametrize("most", [50, 10**6])
def test_runs_match_brute_force(most):
    texts = _run_texts()
    ids = np.array([ord(w) for t in texts for w in t], np.int64)
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
    got = periodic_runs.runs_of(ids, bounds, most=most)
    want = [(int(b) + s, n, q) for b, t in zip(bounds, texts, strict=False) for s, n, q in _runs(t)]
    assert [tuple(r) for r in got.tolist()] == want and len(want) > 200


def test_runs_of_a_table(spark):
    texts = [*(" ".join(t) for t in _run_texts()[:80]), None, " \t\n", "x y " * 9, "a b " * 9 + "\x1f"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[20])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("periodic", F.lit(1)).withColumn("row", F.lit(2))
    out = periodic_runs.detect(docs)
    assert out.columns == ["doc_id", "text", "periodic", "row", "_periodic"]
    got = out.select("text", "_periodic", periodic_runs.longest(F.col("_periodic.runs")).alias("top")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^ \t\n\v\f\r]+", r["text"] or "")
        want = _runs(words)
        assert r["_periodic"]["n_words"] == len(words) and [tuple(x) for x in r["_periodic"]["runs"]] == want
        drop = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r["_periodic"]["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in drop)
        assert (r["top"] and tuple(r["top"])) == (min(want, key=lambda x: (-x[1], x[0], x[2])) if want else None)
    assert periodic_runs.detect(docs.limit(0)).count() == 0


def test_runs_of_long_texts_stay_sparse():
    for words in (["a"] * 60_000, (["a"] * 9_000 + ["b"]) * 5, ["a", "b", "c"] * 20_000, [str(i % 9_999) for i in range(50_000)]):
        number: dict = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        got = periodic_runs.runs_of(ids, np.array([0, len(ids)]))
        assert len(got) <= 6 and got[:, 1].max() == len(words)


def test_query_alters_and_digests_as_stated(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["ab", "c", "dd", "é", "f,"]) for _ in range(rng.choice([0, 1, 5, 30, 90])))) for i in range(300)] + [(7, None), (None, "a a a a a a a")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    want, altered = collections.Counter(), 0
    for i, t in rows:
        words = (t or "").split()
        n = len(words)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a, altered = g % n, altered + 1
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        runs = _runs(words)
        drop = {k for s, m, q in runs for k in range(s + q, s + m)}
        top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(w for k, w in enumerate(words) if k not in drop))]
        want[(i, len(runs), *top, top[1] and 1000 * top[1] // top[2], *digests)] += 1
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert collections.Counter(tuple(r[c] for c in names) for r in got) == want and altered > 15


# --- repeated passages -----------------------------------------------------

def _kept(rows: list, size: int) -> list[str]:
    """The words left of each row, straight from the definition."""
    split = [re.findall(r"[^ \t\n\v\f\r]+", t or "") for _, t in rows]
    home: dict = {}
    for (i, _), w in zip(rows, split, strict=True):
        for k in range(len(w) - size + 1 if i is not None else 0):
            key = tuple(w[k:k + size])
            home[key] = min(home.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        cut = {k + j for k in range(len(w) - size + 1 if i is not None else 0) if home[tuple(w[k:k + size])] < i for j in range(size)}
        out.append((i, len(w), len(cut), " ".join(x for k, x in enumerate(w) if k not in cut)))
    return out


def _passage_rows(rng: random.Random) -> list:
    def prose(n):
        return [f"{rng.choice('abcdefghij')}{rng.randrange(60)}" for _ in range(n)]

    shared = [prose(n) for n in (13, 14, 20, 60, 200)]
    rows = []
    for i in range(150):
        words = prose(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(shared)
            a = rng.randint(0, max(0, len(part) - 13))
            words += part[a:a + rng.randint(10, len(part))] + prose(rng.randint(0, 15))
        rows.append((1000 - i, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(2000 + i, rows[40][1]) for i in range(40)]  # a large group of copies
    rows += [(2, "a a a " * 30), (3, "a " * 17), (3, "a " * 12), (4, "a " * 12 + "b"), (5, None), (6, " \n"), (None, rows[40][1]), rows[41], (rows[41][0], rows[42][1])]
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_phrases": 7, "shard_documents": 3, "filter_bits": 1 << 15}, {"broadcast_rows": 0, "shard_phrases": 40}, {"words": 5, "anchor": 2}])
def test_repeated_passages_match_brute_force(spark, options):
    rows = _passage_rows(random.Random(5))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("unique", F.lit(1)).withColumn("key", F.lit("own")).withColumn("row", F.lit(3)).repartition(3)
    out = phrase_automata.drop_repeats(docs, **options)
    assert out.columns == ["doc_id", "text", "unique", "key", "row", "_unique"]
    got = collections.Counter((r["doc_id"], *r["_unique"]) for r in out.collect())
    want = collections.Counter(_kept(rows, options.get("words", 13)))
    assert got == want and sum(n for _, _, n, _ in want) > 2000


def test_no_passages_to_remove(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert [tuple(r["unique"]) for r in phrase_automata.drop_repeats(docs).orderBy("doc_id").collect()] == [(2, 0, "a b"), (0, 0, "")]
    assert phrase_automata.drop_repeats(docs.limit(0)).count() == 0
    long = spark.createDataFrame([(1, " ".join(map(str, range(70_000)))), (2, "x " + " ".join(map(str, range(69_990))) + " y")], "doc_id long, text string")
    assert [tuple(r["unique"])[:2] for r in phrase_automata.drop_repeats(long).orderBy("doc_id").collect()] == [(70_000, 0), (69_992, 69_990)]
