"""Quality rules, near-dedup, personal data and mixing against brute force, and
on NULLs, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from matchlake.llm import mcd_quality, pii_sanitise, pivotal_mixing, simhash_ball
from matchlake.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and lorem ipsum dolor sit amet river stone cloud window garden paper light".split()


def make_docs(spark, n=260, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "\n".join(" ".join(rng.choice(WORDS).capitalize() if rng.random() < 0.1 else rng.choice(WORDS) + rng.choice("abcdefgh") for _ in range(rng.randint(8, 20))) + "." for _ in range(rng.randint(1, 6)))
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice(["s1", "s2", "s3"]), len(text)))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "s1", 0), (n + 2, " \t\n", "en", None, 3), (n + 3, "word " * 30000, "en", "s1", 150000), (None, "a b c d e f g h i j k l", "en", "s1", 23)]
    rows += [rows[0], rows[0], (n + 4, rows[1][1], "en", "s2", rows[1][4])]
    return spark.createDataFrame(rows, SCHEMA), rows


# --- quality rules ---------------------------------------------------------

def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_statistics_match_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", " ", " ", "é", "\n", "\t", "#", "|", " ", "\x1c", "\x0b"]) for _ in range(rng.randint(0, 120)))
        assert mcd_quality.text_statistics(text.encode())[:5] == brute_statistics(text), repr(text)


def test_quality_verdicts(spark):
    docs, rows = make_docs(spark)
    out = mcd_quality.assess(docs.withColumn("x0", F.lit("mine")).withColumn("quality", F.lit("own")))
    assert out.columns == [*docs.columns, "x0", "quality", "_quality"]
    got = out.collect()
    assert len(got) == len(rows) and {r["quality"] for r in got} == {"own"}
    for r in got:
        n, chars, symbols, dup, rep = brute_statistics(r["text"])
        q = r["_quality"]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        assert q["base_failed"] == (n < 10 or 100 * rep > 20 * n)
        assert not (q["base_failed"] and q["kept"])
    assert mcd_quality.assess(docs.limit(0)).count() == 0


def test_mcd_rejects_outliers_and_keeps_the_rest(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 7)) * 2 + 10
    x[:60] += 40  # a tenth is far off: a plain covariance would swallow it
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], "grp string, " + ", ".join(f"x{k} double" for k in range(7)))
    fit = mcd_quality.estimates(rows).first()
    white = np.array(fit["white"]).reshape(7, 7)
    d2 = (((x - np.array(fit["mean"])) @ white.T) ** 2).sum(axis=1)
    cut = mcd_quality.chi2_quantile(1 - 1e-6, 7)
    assert (d2[:60] > cut).all() and (d2[60:] < cut).all()
    assert np.abs(np.array(fit["mean"]) - 10).max() < 1


def brute_median(x):
    return np.quantile(x, 0.5, axis=0, method="inverted_cdf")


def brute_estimate(x, rng):
    """Minimum covariance determinant of rows by many random starts, reweighted and sized by the median."""
    n, p = x.shape
    h, best = min(n, (n + p + 1) // 2), None
    for _ in range(60):
        rows = rng.choice(n, size=min(n, p + 3), replace=False)
        last = np.inf
        while True:
            cov = np.cov(x[rows].T, bias=True)
            d2 = brute_distance(x, x[rows].mean(axis=0), cov)
            logdet = np.linalg.slogdet(cov)[1]
            if len(rows) == h and last - logdet < 1e-9:
                break
            rows, last = np.argsort(d2, kind="stable")[:h], logdet
        if best is None or logdet < best[0]:
            best = (logdet, d2)
    d2 = best[1]
    near = x[d2 <= mcd_quality.chi2_quantile(0.975, p) * np.median(d2) / mcd_quality.chi2_quantile(0.5, p)]
    mean, cov = near.mean(axis=0), np.cov(near.T, bias=True)
    return mean, cov * np.median(brute_distance(x, mean, cov)) / mcd_quality.chi2_quantile(0.5, p)


def brute_distance(x, mean, cov):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def test_verdicts_match_a_brute_force_twin(spark):
    """Own statistics, medians and estimates of every (language, source), its language and all rows."""
    rng = random.Random(8)

    def text(junk, capitals):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(30, 120))]
        words = [w.capitalize() if rng.random() < capitals else w for w in words]
        return " ".join(w + rng.choice(["", "", "", "", ".", ",", "!"]) + (rng.choice("#$%|") * 3 if junk else "") for w in words)

    rows = []
    for i in range(500):
        lang, source, junk = rng.choice(["aa", "bb", None]), "hot" if i % 3 else f"s{i % 4}", rng.random() < 0.15
        rows.append((i, text(junk, 0.1 if lang == "aa" else 0.3), lang, source, junk))
    rows.append((500, text(False, 0.1), "cc", "only", False))  # a group of one row
    got = {r["doc_id"]: r["quality"] for r in mcd_quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")).collect()}
    base = [[len(t.split()), sum(map(len, t.split())), sum(c.isupper() for c in t), sum(not c.isalnum() and c != " " for c in t)] for _, t, *_ in rows]
    langs, keys = [r[2] for r in rows], [(r[2], r[3]) for r in rows]
    members = lambda of, v: [i for i, x in enumerate(of) if x == v]
    usual = {v: brute_median([[c / w, u / c, p / c] for w, c, u, p in (base[i] for i in members(langs, v))]) for v in set(langs)}
    x = np.array([[np.log((c + 100 * usual[v][0]) / (w + 100)), *(np.log1p(100 * (n + 600 * usual[v][k]) / (c + 600)) for k, n in ((1, u), (2, p)))] for (w, c, u, p), v in zip(base, langs, strict=True)])
    seeded = np.random.default_rng(2)
    whole, ratios = brute_estimate(x, seeded), []
    for lang, source in set(keys):
        fit = whole
        for rows_of in (members(langs, lang), members(keys, (lang, source))):
            n = len(rows_of)
            mean, cov = brute_estimate(x[rows_of], seeded) if n > 1 else (x[rows_of[0]], np.zeros((3, 3)))
            w, gap = n / (n + 50), mean - fit[0]
            cov = w * cov + (1 - w) * fit[1] + w * (1 - w) * np.outer(gap, gap)
            if n == 1:
                np.fill_diagonal(cov, np.maximum(np.diag(cov), np.diag(fit[1])))
            fit = (fit[0] + w * gap, cov)
        for i, d2 in zip(members(keys, (lang, source)), brute_distance(x[members(keys, (lang, source))], *fit), strict=True):
            ratios.append(got[i]["distance"] / d2)
            assert got[i]["kept"] == (d2 <= mcd_quality.chi2_quantile(1 - 1e-9, 3)) == (not rows[i][4]), i
    # two starts, not sixty: a small group may end in another half
    assert np.median(ratios) == pytest.approx(1, abs=0.05) and np.quantile(np.abs(np.log(ratios)), 0.9) < 0.5


def test_statistics_without_spread_and_repeated_rows(spark):
    """No capitals and no marks anywhere: these have no weight; equal rows get equal verdicts, ties are kept."""
    texts = ["plain words without any mark at all here to read", "other words that have no mark either and go on longer"]
    rows = [(i, texts[i % 2], "aa", "s") for i in range(40)] + [(40, "x " * 200000, "aa", "s"), (41, None, None, None)]
    got = {r["doc_id"]: r["quality"] for r in mcd_quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i]["kept"] for i in range(40)) and len({got[i]["distance"] for i in range(0, 40, 2)}) == 1
    assert got[40]["base_failed"] and got[41]["base_failed"] and got[41]["distance"] is None and not got[41]["kept"]


# --- near-dedup ------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints):
    n, label = len(prints), list(range(len(prints)))
    near = [[j for j in range(n) if (prints[i] ^ prints[j]).bit_count() <= 4] for i in range(n)]
    while True:
        new = [min(label[j] for j in near[i]) for i in range(n)]
        if new == label:
            return label
        label = new


def test_near_dedup_matches_brute_force(spark):
    docs, rows = make_docs(spark)
    got = simhash_ball.groups(docs.withColumn("fp", F.lit(1)), slice_variants=20_000).collect()
    assert len(got) == len(rows)
    prints = [brute_fingerprint(r[1]) for r in rows]
    label = brute_groups(prints)
    least = {}
    for r, g in zip(rows, label, strict=True):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted((str(r[0]), p, least.get(g)) for r, p, g in zip(rows, prints, label, strict=True))
    assert sorted((str(r["doc_id"]), r["near"]["fingerprint"] & (2**64 - 1), r["near"]["component_id"]) for r in got) == want
    kept = simhash_ball.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label))
    assert simhash_ball.groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("slice_variants", [2_000_000, 30_000, 300])
def test_ball_links_connect_all_near_fingerprints(spark, slice_variants):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = set(base)
    for b in base[:5]:  # dense clusters, chains through up to four bits at a time
        for _ in range(60):
            b ^= sum(1 << k for k in rng.sample(range(64), rng.randint(1, 5)))
            prints.add(b)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    stars = {r["a"]: r["b"] for r in components(simhash_ball.links(fps, slice_variants=slice_variants)).collect()}
    label = brute_groups(prints)
    roots = [stars.get(x, x) for x in signed]
    assert len(set(zip(roots, label, strict=True))) == len(set(roots)) == len(set(label))


# --- personal data ---------------------------------------------------------

def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute_spans(x):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_match_brute_force():
    rng = random.Random(2)
    for _ in range(20000):
        x = "".join(rng.choice("a1.@-+ 0()9b_%25é ") for _ in range(rng.randint(0, 40)))
        assert pii_sanitise.base_spans(x) == brute_spans(x), x
    assert pii_sanitise.base_spans("4111 1111-11111111")[0][1] == 2
    for long in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + " " * 200_000, "a@" * 100_000):
        pii_sanitise.base_spans(long)  # linear in the text


def test_disclosing_terms_match_brute_force_and_are_rewritten(spark):
    rng = random.Random(4)
    texts = [f"{rng.choice(WORDS)} {rng.choice(WORDS)} Zebulon{'' if k % 2 else ' '} writes ann@mail.example.org about the {rng.choice(WORDS)}" for k in range(40)]
    texts += [" ".join(rng.choice(WORDS) for _ in range(12)) + f" {k}" for k in range(400)]
    texts += [f"call +1 202 555 0{k:03d} about the river" for k in range(30)] + [None, "", texts[0], texts[0]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["t"]: r["remove"] for r in pii_sanitise.disclosing_terms(docs).collect()}
    distinct = {t for t in texts if t is not None}
    pairs, ents = collections.defaultdict(set), collections.defaultdict(set)
    for t in distinct:
        for e, w in pii_sanitise.contexts(t):
            (pairs[e, w] if w else ents[e]).add(t)
    words = collections.Counter(w for t in distinct for w in {x.lower() for x in pii_sanitise._WORD.findall(t)})
    want = {}
    for (e, w), at in pairs.items():
        ic = np.log(len(distinct) / len(ents[e]))
        pmi = np.log(len(at) * len(distinct) / (len(ents[e]) * words[w]))
        if len(at) >= pii_sanitise.MIN_TEXTS and ic > 0 and pmi >= ic / pii_sanitise.ALPHA - 1e-9:
            want[w] = want.get(w, False) or bool(pmi >= ic / pii_sanitise.ALPHA_REMOVE - 1e-9)
    assert found == want and found["zebulon"] is True and "the" not in found and "river" not in found
    out = pii_sanitise.sanitise(docs.withColumn("pii", F.lit(0)))
    got = {r["doc_id"]: r["_pii"] for r in out.collect()}
    assert out.columns == ["doc_id", "text", "pii", "_pii"] and len(got) == len(texts)
    assert "ulon" not in got[0]["text"] and "[EMAIL]" in got[0]["text"] and "@" not in got[0]["text"]
    assert got[len(texts) - 4]["text"] is None and got[len(texts) - 3]["text"] == ""
    for i, t in enumerate(texts):  # base spans stay
        assert [(s["start"], pii_sanitise.KINDS.index(s["kind"]), s["end"]) for s in got[i]["spans"] if s["kind"] != "term"] == brute_spans(t or "")
    assert pii_sanitise.sanitise(docs.limit(0)).count() == 0


def test_terms_anywhere_in_a_text_disclose_its_entities(spark):
    rng = random.Random(6)
    filler = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    texts = [f"Zebulon {filler(20)} ann@mail.example.org {filler(20)} Quillon" for _ in range(20)] + [filler(20) for _ in range(300)]
    far = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r["t"]: r["remove"] for r in pii_sanitise.disclosing_terms(far).collect()} == {"zebulon": True, "quillon": True}
    # A text full of personal data, whose entities and words are paired once.
    dump = " ".join(f"u{chr(97 + k % 26)}{k}@mail.example.org" for k in range(3000)) + " " + " ".join("wor" + "".join(chr(97 + int(c)) for c in str(k)) for k in range(3000))
    assert pii_sanitise.disclosing_terms(spark.createDataFrame([(t,) for t in [*texts, dump, dump]], "text string"), min_texts=1).count() == 3002


def test_entities_of_one_text_have_terms(spark):
    rng = random.Random(8)
    filler = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    texts = [f"{filler(9)} Zebulon {filler(9)} ann@solo.example.org", f"Quillon {filler(30)} 9.8.7.6"]
    texts += [f"Wexford {filler(9)} u{k}@shared.example.org {filler(9)} {name}" for k, name in enumerate(["Ada", "Bob", "Cyd", "Dan"])]
    texts += [f"Tarn {filler(9)} +1 202 555 01{k}{k} {filler(3)}" for k in range(4)] + [filler(30) for _ in range(400)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r["t"]: r["remove"] for r in pii_sanitise.disclosing_terms(docs).collect()}
    want, distinct = {}, [(set(re.findall("[a-z]{3,}", re.sub(r"\S+@\S+|\+1[ 0-9]+", " ", t.lower()))), t) for t in set(texts)]
    groups = [r"ann@", r"9\.8\.7\.6", r"@shared", r"\+1 202 555 01", *(rf"\bu{k}@" for k in range(4)), *(rf"555 01{k}{k}" for k in range(4))]
    for g in groups:
        at = [w for w, t in distinct if re.search(g, t)]
        p = len(at) / len(distinct)
        for t in set().union(*at):
            pmi = np.log((sum(t in w for w in at) + p) / (sum(t in w for w, _ in distinct) + 1) / p)
            if pmi >= -np.log(p) / 1.25:
                want[t] = want.get(t, False) or bool(pmi >= -np.log(p) / 1.05)
    assert found == want and {"zebulon", "quillon", "wexford", "tarn", "ada", "bob"} <= found.keys() and not found.keys() & set(WORDS)


def test_terms_have_digits_and_any_length(spark):
    rng = random.Random(11)
    odd = ["AB12345", "40217", "user123", "Li", "王明", "é" * 150, "7", "A_b"]
    texts = [f"{' '.join(odd)} {' '.join(rng.choice(WORDS) for _ in range(20))} 4111111111111111x9 ann@mail.example.org"]
    texts += [" ".join(rng.choice(WORDS) for _ in range(20)) for _ in range(300)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r["t"] for r in pii_sanitise.disclosing_terms(docs).collect()} == {t.lower() for t in odd} | {"x9"}
    got = next(r["pii"]["text"] for r in pii_sanitise.sanitise(docs).collect() if "@" in r["text"])
    assert not any(t in got for t in odd) and got.endswith("[CARD][TERM] [EMAIL]")


def test_terms_are_touched_only_where_their_entity_is(spark, monkeypatch):
    rng = random.Random(12)
    filler = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    texts = [f"Zebulon {filler(9)} ann@mail.example.org" for _ in range(6)] + [f"Zebulon {filler(9)}"] + [f"{filler(9)} 9.8.7.6 {filler(2)} Zebulon"] + [filler(20) for _ in range(300)]
    texts += [f"{filler(3)} Tarn ann@mail.example.org " + filler(20_000)]  # a very long text
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", texts[0], texts[0]])], "doc_id long, text string")
    for few in (50_000, 0):  # with and without a broadcast of the texts' terms
        monkeypatch.setattr(pii_sanitise, "BROADCAST_TEXTS", few)
        got = {r["doc_id"]: r["pii"] for r in pii_sanitise.sanitise(docs).collect()}
        assert all("ebulon" not in got[i]["text"] for i in (*range(6), len(texts) + 2, len(texts) + 3))
        assert got[6]["text"] == texts[6] and got[6]["spans"] == []
        assert all(got[i]["text"] == t for i, t in enumerate(texts) if "@" not in t and "9.8" not in t)
        assert "Tarn" not in got[len(texts) - 1]["text"] and "[EMAIL]" in got[len(texts) - 1]["text"]


def test_counting_takes_one_pass_however_many_terms(spark, monkeypatch):
    rng = random.Random(13)
    texts = [f"w{k} v{k} x{k} u{k}@mail.example.org " + " ".join(rng.choice(WORDS) for _ in range(9)) for k in range(200)] + [" ".join(rng.choice(WORDS) for _ in range(9)) for _ in range(300)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    whole = {tuple(r) for r in pii_sanitise.disclosing_terms(docs).collect()}
    monkeypatch.setattr(pii_sanitise, "FILTER_BITS", 1 << 15)  # lets most words through
    assert {tuple(r) for r in pii_sanitise.disclosing_terms(docs).collect()} == whole and len(whole) == 600


def test_rewriting_overlaps():
    spans = [{"start": 2, "kind": "ip", "end": 6, "remove": False}, {"start": 4, "kind": "card", "end": 8, "remove": False}, {"start": 9, "kind": "term", "end": 10, "remove": True}]
    assert pii_sanitise.rewritten("ab123456 xyz", spans) == "ab[IP] yz"


# --- mixing ----------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), share=1.5):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: float(weights[k % 3]) for k, s in enumerate(order)}
    goal, full = share * sum(sizes.values()), set()
    while True:
        rest = sum(w[s] for s in order if s not in full)
        level = (goal - sum(2.0 * sizes[s] for s in full)) / rest if rest else 0.0
        new = {s for s in order if s not in full and level * w[s] > 2 * sizes[s]}
        if not new:
            return {s: 2.0 * sizes[s] if s in full else level * w[s] for s in order}
        full |= new


def test_mixing_meets_targets(spark):
    docs, rows = make_docs(spark)
    out = pivotal_mixing.mix(docs.withColumn("size", F.lit("x")).repartition(5), block=8)
    got = [(r["doc_id"], r["source"], r["text"], r["mix"]) for r in out.collect()]
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = brute_targets(sizes)
    taken, largest = collections.Counter(), collections.Counter()
    assert len(got) == len(rows)
    for _, source, text, m in got:
        assert m["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) and m["source_size"] == sizes[source]
        assert m["taken"] == m["copies"] * m["size"] <= 2 * m["size"]
        assert m["target"] == pytest.approx(want[source])
        taken[source] += m["taken"]
        largest[source] = max(largest[source], m["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6
    again = pivotal_mixing.mix(docs.repartition(3), block=8, carry=["doc_id"]).collect()
    assert sorted((str(r["doc_id"]), r["mix"]["taken"]) for r in again) == sorted((str(i), m["taken"]) for i, _, _, m in got)
    assert pivotal_mixing.mix(docs.limit(0)).count() == 0


def test_rounding_keeps_expectations_and_splits_hot_blocks(spark):
    hot = spark.range(600).select(F.lit("=a").alias("source"), F.lit(5).cast("long").alias("u"), F.col("id").alias("pos"), F.lit(10).cast("long").alias("size"), F.lit(2.5).alias("mass"))
    got = pivotal_mixing.rounded(hot, block=8).collect()
    assert len(got) == len({r["pos"] for r in got}) == 600 and sum(r["up"] for r in got) == 150
    mean = np.zeros(40)
    for seed in range(12):
        items = spark.range(40).select(F.lit("=a").alias("source"), F.xxhash64("id", F.lit(seed)).alias("u"), F.col("id").alias("pos"), (F.col("id") % 7 + 1).alias("size"), ((F.col("id") % 7 + 1) * 0.3).alias("mass"))
        for r in pivotal_mixing.rounded(items, block=8, seed=seed).collect():
            mean[r["pos"]] += r["up"] / 12
    assert 0.2 < mean.mean() < 0.4
