"""Encoding, search, sharding, archives, toxicity, language ID: against the public
tokenizer, brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchlake.llm import bpe_rounds, extendible_sharding, fused_langid, kdtree_topk, ordinal_toxicity, warc_split

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- byte-level BPE --------------------------------------------------------

def test_encoding_equals_the_public_tokenizer():
    ours, theirs = bpe_rounds.Codec(bpe_rounds.Vocabulary.read(BPE)), Tokenizer.from_file(BPE)
    rng = random.Random(5)
    pool = [chr(i) for i in (9, 10, 13, 32, 32, 32, 0x85, 0xA0, 0x2003, 0x1C, 39, 115, 65, 97, 48, 33, 0x301, 0x3B1, 0x4E2D, 0x1F600, 0x558, 0x323B0, 0x12550, 0x200B, 0x661, 0)]
    pool += ["<|endoftext|>", "'re", " the", "aaaa", "ization", " "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + ["a" * 100_000, "ab" * 40_000, "".join(rng.choice("abcde") for _ in range(50_000))]
    want = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    got = ours.encode(texts)
    assert got == want
    assert [ours.decode(x) for x in got] == [theirs.decode(x, skip_special_tokens=False) for x in want]
    cut = got[0][:1] + [int(ours.v.first[0xE4])]  # a lone lead byte
    assert ours.decode(cut) == theirs.decode(cut, skip_special_tokens=False)


def test_encoding_of_a_table(spark):
    rows = [(1, None), (2, ""), (3, "Hello  world\n"), (3, "Hello  world\n"), (4, "ä" * 30_000), (None, "x<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("own")).withColumn("tokens", F.lit(1))
    out = bpe_rounds.encode(docs, BPE)
    assert out.columns == ["doc_id", "text", "ids", "tokens", "_tokens"]
    theirs = Tokenizer.from_file(BPE)
    got = out.collect()
    assert len(got) == 6 and all(r["_tokens"]["ids"] == theirs.encode(r["text"] or "", add_special_tokens=False).ids and r["_tokens"]["decoded"] == (r["text"] or "") for r in got)
    back = bpe_rounds.encode(docs, BPE, decode=False, carry=["doc_id"]).select(bpe_rounds.decoded(F.col("tokens.ids"), BPE).alias("t")).collect()
    assert sorted(r["t"] for r in back) == sorted(t or "" for _, t in rows)
    assert bpe_rounds.encode(docs.limit(0), BPE).count() == 0


# --- exact search ----------------------------------------------------------

@pytest.mark.parametrize("dim,n,high,shard,leaf", [(3, 300, 3, 97, 8), (6, 500, 50, 64, 16), (2, 200, 2**40, 50, 8), (4, 60, 9, 1000, 256)])
def test_search_matches_brute_force(spark, dim, n, high, shard, leaf):
    rng = np.random.default_rng(dim)
    v = rng.integers(-high, high, (n, dim))
    v[: n // 3] = v[0]  # a third are equal: ties everywhere
    rows = [(int(i), [int(x) for x in r]) for i, r in enumerate(v)]
    rows += [(n, None), (None, rows[0][1]), rows[20], rows[40], (n + 20, [1])]
    df = spark.createDataFrame(rows, "vec_id long, v array<bigint>").withColumn("shard", F.lit(0))
    got = kdtree_topk.top_k(df, F.col("vec_id") % 20 == 0, shard_rows=shard, leaf_rows=leaf).collect()
    found = collections.Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)
    # 20 and 40 are two rows each: both are queries, and each is a candidate of the other
    ids = [*range(n), 20, 40]
    exact = v.astype(object)[ids]
    want = collections.Counter()
    for a, q in enumerate(ids):
        if q % 20 == 0:
            scores = np.clip(exact @ exact[a], -(2**63), 2**63 - 1)
            best = sorted((-s, ids[b]) for b, s in enumerate(scores) if b != a)[:10]
            want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(best))
    assert found == want
    assert kdtree_topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_scaling(spark):
    df = spark.createDataFrame([(1, [0.5, -0.0001]), (2, [float("nan"), 1.0]), (3, [float("inf")]), (4, [None, 1.0]), (5, None), (6, [])], "i long, e array<float>")
    assert [r[0] for r in df.orderBy("i").select(kdtree_topk.scaled(F.col("e"))).collect()] == [[512, -1], None, None, None, None, []]


# --- sharding --------------------------------------------------------------

@pytest.mark.parametrize("limit", [400, 3000, 10**9])
def test_sharding_matches_brute_force(spark, limit):
    rng = random.Random(limit)
    rows = [(i, "é" * rng.randint(0, 60)) for i in range(400)] + [(400, None), (401, ""), (402, "z" * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit(1)).withColumn("shard", F.lit("own"))
    got = {r["doc_id"]: r["_shard"] for r in extendible_sharding.shard(docs, limit=limit).collect()}
    bits = {i: bin(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16))[2:].zfill(60) for i, _ in rows}
    size = {i: len((t or "").encode()) for i, t in rows}
    for i, _ in rows:
        depth = next((d for d in range(61) if sum(size[j] for j in size if bits[j][:d] == bits[i][:d]) <= limit), 60)
        s = got[i]
        assert s["depth"] == depth and s["id"].split("/")[0] == bits[i][:depth] and s["bytes"] == size[i]
        assert s["shard_bytes"] <= limit or s["shard_bytes"] == s["bytes"]
    assert extendible_sharding.shard(docs.limit(0)).count() == 0


def test_equal_keys_are_paged(spark):
    rows = [(7, "x" * (k % 90)) for k in range(500)] + [(None, "y" * 50)] * 40 + [(k, "z" * 20) for k in range(100, 200)] + [(7, "w" * 1000)]
    out = extendible_sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), limit=300).collect()
    assert len(out) == len(rows)
    sums, count = collections.Counter(), collections.Counter()
    for r in out:
        sums[r["shard"]["id"]] += r["shard"]["bytes"]
        count[r["shard"]["id"]] += 1
    assert all(sums[r["shard"]["id"]] == r["shard"]["shard_bytes"] for r in out)
    assert all(b <= 300 or count[s] == 1 for s, b in sums.items())


# --- archives --------------------------------------------------------------

def test_archives_round_trip_from_any_split(spark):
    rng = random.Random(8)
    big = ["".join(rng.choice("abcdefghé <>\x00") for _ in range(rng.randint(1000, 4000))) for _ in range(30)]
    rows = [(i, f"http://h/{i} x", t) for i, t in enumerate(big)] + [(100 + i, None, big[i % 4]) for i in range(40)] + [(200, "u\r\nWARC-Type: x", None), (201, "u", ""), (202, "u", ""), (None, "u", big[0]), (7, rows_url := "again", big[7]), (300, "u", "y" * 300_000)]
    assert rows_url
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit(1)).repartition(3)
    written = warc_split.write_archives(pages, warc_split.archive_folder(spark))
    whole = warc_split.read_archives(written).collect()
    assert len(whole) == len(rows) == sum(r["records"] for r in written.collect())
    largest = collections.defaultdict(int)
    for i, _, t in rows:
        largest[t or ""] = max(largest[t or ""], -1 if i is None else i)
    texts = {(i, t or "") for i, _, t in rows}
    for r in whole:
        if r["record_type"] == "response":
            t = r["payload"].decode()
            assert (r["page_id"], t) in texts and hashlib.sha1(r["payload"]).hexdigest() == r["digest"] and r["refers_to"] is None
            assert len(t.encode()) < 1000 or r["page_id"] == largest[t]
        else:
            t = next(t for i, _, t in rows if i == r["refers_to"])
            assert (r["page_id"], t) in texts and r["refers_to"] == largest[t] != r["page_id"]
            assert r["payload"] is None and r["payload_bytes"] == len(t.encode()) >= 1000 and hashlib.sha1(t.encode()).hexdigest() == r["digest"]
    for split in (613, 20_011):
        again = warc_split.read_archives(written, split).select("file", "offset").collect()
        assert sorted(map(tuple, again)) == sorted((r["file"], r["offset"]) for r in whole)
    none = warc_split.write_archives(pages.limit(0), warc_split.archive_folder(spark))
    assert none.count() == 0 and warc_split.read_archives(none).count() == 0


def test_damaged_records_are_skipped(tmp_path):
    parts = [warc_split.record(i, "u", bytes([i % 251]) * 5000, None, False) for i in range(6)]
    parts[2] = parts[2][:40] + b"\x00\x00" + parts[2][42:]  # damaged
    junk = b"\x1f\x8b\x08 no member"
    path = tmp_path / "a.warc.gz"
    path.write_bytes(junk + b"".join(parts[:4]) + junk + b"".join(parts[4:]))
    fs, name = warc_split.file_system(f"file://{path}")
    with fs.open_input_file(name) as f:
        size = path.stat().st_size
        whole = [warc_split._row("a", *x)[2] for x in warc_split.records_in(f, 0, size)]
        halves = [warc_split._row("a", *x)[2] for a in range(0, size, 101) for x in warc_split.records_in(f, a, min(size, a + 101))]
    assert whole == halves == [0, 1, 3, 4, 5]


# --- toxicity --------------------------------------------------------------

def toxic_table(spark, n=600, seed=2):
    rng = random.Random(seed)
    bad, plain = ["blarg", "snorf", "glompish"], [f"word{k}" for k in range(60)]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))] + [rng.choice(bad) for _ in range(rng.choice([1, 3, 9]) * toxic)]
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs += [(n, None), (n + 1, ""), docs[0]]
    labels += [(n + 5, 1), (None, 1), (3, None), labels[0]]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_documents(spark):
    docs, labels = toxic_table(spark)
    model = ordinal_toxicity.train(docs, labels.filter("doc_id % 3 > 0"), max_labelled=350)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r["doc_id"]: r for r in ordinal_toxicity.grade(docs.withColumn("toxicity", F.lit(1)), model).collect()}
    held = [(i, r["text"], r["_toxicity"]) for i, r in got.items() if i % 3 == 0 and r["text"]]
    truth = [i % 4 == 0 and i < 600 for i, _, _ in held]
    assert np.mean([(t["grade"] > 0) == y for (_, _, t), y in zip(held, truth, strict=True)]) > 0.97
    count = [sum(w in ("blarg", "snorf", "glompish") for w in t.split()) for _, t, _ in held]
    severity = collections.defaultdict(list)
    for c, (_, _, t) in zip(count, held, strict=True):
        severity[c].append(t["expected_severity"])
    assert np.mean(severity[0]) < np.mean(severity[1]) < np.mean(severity[3]) < np.mean(severity[9])
    assert got[600]["_toxicity"]["grade"] == got[601]["_toxicity"]["grade"] == 0
    none = ordinal_toxicity.train(docs, labels.limit(0))
    assert ordinal_toxicity.grade(docs, none).filter("toxicity.grade > 0").count() == 0
    assert ordinal_toxicity.grade(docs.limit(0), model).count() == 0


def test_ordinal_fit_recovers_thresholds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=4000) * 2
    grades = (1.5 * x[:, None] + rng.logistic(size=(4000, 1)) > np.array([[-1.0, 1.0, 3.0]])).sum(axis=1)
    w, theta = ordinal_toxicity.fit(np.arange(4000), np.zeros(4000, int), x, grades, 1, ridge=0.0)
    assert abs(w[0] - 1.5) < 0.15 and np.abs(theta - [-1, 1, 3]).max() < 0.25


# --- language ID -----------------------------------------------------------

def test_language_of_pages(spark):
    docs, pages = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/pages.parquet")
    model = fused_langid.train(docs.unionByName(docs.limit(2).withColumn("lang", F.lit(None).cast("string"))))
    assert model.languages == sorted(r[0] for r in docs.select("lang").distinct().collect())
    odd = spark.createDataFrame([(900, None, None), (901, "", ""), (902, "no url", "<html lang=de>"), (903, "https://h.example.org/x", "<script>" * 20_000)], "page_id long, url string, html string")
    table = pages.unionByName(odd).withColumn("language", F.lit(1)).withColumn("host", F.lit(2))
    out = fused_langid.identify(table, model)
    assert out.columns == [*table.columns, "_language"]
    got = {r["page_id"]: r for r in out.collect()}
    assert len(got) == table.count()
    own = [r for i, r in got.items() if i < 900]
    assert np.mean([r["_language"]["lang"] == r["url"].split("//")[1].split("/")[1] for r in own]) > 0.95
    assert all(0 < r["_language"]["posterior"] <= 1 + 1e-9 for r in got.values()) and got[902]["_language"]["declared"] == "de"
    assert fused_langid.identify(pages.limit(0), model).count() == 0
    blank = fused_langid.train(docs.limit(0))
    assert fused_langid.identify(pages, blank).filter("language.lang is null").count() == pages.count()


def test_declaration_and_host_decide_unclear_text(spark):
    rows = [(i, f"http://a.example.net/{i}", '<html lang="aa">' + "aba aba aab " * 10) for i in range(60)] + [(100 + i, f"http://b.example.com/{i}", '<html lang="bb">' + "cdc ccd dcd " * 10) for i in range(60)]
    rows += [(500, "http://a.example.net/q", '<html lang="aa">?'), (501, "http://b.example.com/q", "?")]
    docs = spark.createDataFrame([(1, "aba aab aba baa " * 30, "aa"), (2, "cdc dcd ccd dcc " * 30, "bb")], "doc_id long, text string, lang string")
    got = {r["page_id"]: r["language"]["lang"] for r in fused_langid.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), fused_langid.train(docs)).collect()}
    assert got[500] == "aa" and got[501] == "bb"
