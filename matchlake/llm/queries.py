"""Registered queries of the operators: thin wrappers that read the whole table
and derive the digest columns.  ``QUERIES`` and ``ORACLES`` are merged into the
driver contract by ``__spark_entry__.py``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from matchlake.llm import bpe_rounds, extendible_sharding, fused_langid, kdtree_topk, mcd_quality, ordinal_toxicity, periodic_runs, phrase_automata, pii_sanitise, pivotal_mixing, simhash_ball, slice_codes, warc_split
from matchlake.llm.common import broadcast_if_small, read_table, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@query("op2_mcd_quality")
def op2_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mcd_quality.assess(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    q = F.col("quality")
    return out.select("doc_id", *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
                      F.round(q["distance"], 6).alias("distance"))


@query("op8_simhash_ball")
def op8_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_ball.groups(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    n = F.col("near")
    return out.select("doc_id", F.lower(F.lpad(F.hex(n["fingerprint"]), 16, "0")).alias("fingerprint"), n["component_id"].alias("component_id"))


@query("op3_pii_information")
def op3_pii_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii_sanitise.sanitise(read_table(spark, sf_dir, "documents"), rewrite=False, carry=["doc_id"])
    spans = F.col("pii")["spans"]
    base = F.filter(spans, lambda s: s["kind"] != "term")
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in ("email", "ip", "card", "phone", "term")]
    return out.select("doc_id", *counts, F.sha2(pii_sanitise.joined_spans(base), 256).alias("base_sha256"), pii_sanitise.joined_spans(spans).alias("spans"))


@query("op6_pivotal_mixing")
def op6_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pivotal_mixing.mix(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.copies", "mix.taken")


@query("op9_bpe_rounds")
def op9_bpe_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_rounds.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), carry=["doc_id"])
    t = F.col("tokens")
    return out.select("doc_id", F.size(t["ids"]).cast("long").alias("n_tokens"), F.sha2(F.array_join(t["ids"].cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2(t["decoded"], 256).alias("decoded_sha256"))


@query("op4_extendible_sharding", f"""
with r as (
  select doc_id, strlen(coalesce(text, ''))::bigint as bytes,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint as h
  from documents),
s as (
  select doc_id, h, bytes, d::integer as depth, sum(bytes) over (partition by d, h >> (60 - d))::bigint as shard_bytes
  from r, range(0, 61) t(d))
select doc_id, substr(lpad(bin(h), 60, '0'), 1, min(depth)) as shard, min(depth) as depth, bytes, max(shard_bytes) as shard_bytes
from s where shard_bytes <= {extendible_sharding.LIMIT}
group by doc_id, h, bytes""")
def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extendible_sharding.shard(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", F.col("shard.id").alias("shard"), "shard.depth", "shard.bytes", "shard.shard_bytes")


@query("op7_kdtree_topk", """
with v as (
  select row_number() over () as row, vec_id, [floor(1024 * x::double) for x in embedding] as e
  from embeddings
  where embedding is not null and vec_id is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select q.row, q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on c.row <> q.row where q.vec_id % 100 = 0)
select query_id, row_number() over (partition by row order by score desc, vec_id)::integer as rank, vec_id, score
from s qualify rank <= 10""")
def op7_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    rows = rows.select("vec_id", kdtree_topk.scaled(F.col("embedding")).alias("v"))
    return kdtree_topk.top_k(rows, F.col("vec_id") % 100 == 0)


@query("op10_warc_split", """
with p as (select page_id, coalesce(html, '') as html, max(page_id) over (partition by coalesce(html, '')) as first from pages),
r as (select *, strlen(html)::bigint as payload_bytes, strlen(html) >= 1000 and page_id <> first as again from p)
select page_id, payload_bytes, sha1(html) as payload_digest, case when again then 'revisit' else 'response' end as record_type,
       case when again then first end as refers_to
from r""")
def op10_warc_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc_split.write_archives(read_table(spark, sf_dir, "pages"), warc_split.archive_folder(spark))
    records = warc_split.read_archives(written)
    own = F.col("payload").isNotNull()
    return records.select("page_id", F.when(own, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
                          F.when(own, F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"), "record_type", "refers_to")


@query("op1_ordinal_toxicity")
def op1_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = ordinal_toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    t = F.col("toxicity")
    return ordinal_toxicity.grade(docs, model, carry=["doc_id"]).select(
        "doc_id", F.round(t["expected_severity"], 4).alias("expected_severity"), F.round(t["p_toxic"], 4).alias("p_toxic"), t["grade"].alias("grade"), (t["grade"] > 0).alias("toxic"))


@query("op5_fused_langid")
def op5_fused_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fused_langid.train(read_table(spark, sf_dir, "documents"))
    out = fused_langid.identify(read_table(spark, sf_dir, "pages"), model, carry=["page_id"])
    return out.select("page_id", "language.lang", F.round("language.posterior", 6).alias("posterior"), "language.text_lang", "language.declared", "language.host")


def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    """The rounds written out; sums and distances of these integers are exact in double."""
    sql = f"""
with v as (
  select row_number() over () as row, vec_id, label, [floor(4096 * x::double) for x in embedding] as e
  from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
w as (select row, p::integer as p, e[p * (len(e) // {parts}) + 1 : (p + 1) * (len(e) // {parts})] as x from v, range({parts}) t(p)),
x as (select *, list_inner_product(x, x) as xx from w),
f as (select row, row_number() over (order by vec_id, e) - 1 as k from v qualify k < {entries}),
c0 as (select p, k, x as c, xx as cc from x join f using (row))"""
    near = "select row, x.p, min((xx - 2 * list_inner_product(x, c) + cc) * {n} + k) as m, any_value(x) as x from x join c{r} c on c.p = x.p group by all"
    for r in range(rounds):
        sql += f""",
a{r} as ({near.format(n=entries, r=r)}),
i{r} as (select p, m % {entries} as k, i, floor(sum(x[i]) / count(*)) as s from a{r}, range(1, len(x) + 1) t(i) group by all),
u{r} as (select p, k, list(s order by i) as c from i{r} group by all),
c{r + 1} as (select p, k, coalesce(u.c, o.c) as c, list_inner_product(coalesce(u.c, o.c), coalesce(u.c, o.c)) as cc from c{r} o left join u{r} u using (p, k))"""
    return sql + f""",
a as ({near.format(n=entries, r=rounds)}),
d as (select row, string_agg(lpad(to_hex((m % {entries})::bigint), 2, '0'), '' order by p) as code, sum((m - m % {entries}) / {entries})::bigint as error from a group by row),
h as (select sha256(string_agg(c[i]::bigint::varchar, ',' order by p, k, i)) as codebooks_sha256 from c{rounds}, range(1, len(c) + 1) t(i))
select vec_id, lower(code) as code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from v join d using (row), h"""


@query("op11_slice_codes", _codes_sql(slice_codes.PARTS, slice_codes.ENTRIES, slice_codes.ROUNDS))
def op11_slice_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", slice_codes.scaled(F.col("embedding")).alias("v")).filter("v is not null")
    books = slice_codes.train(rows)
    digest = hashlib.sha256(",".join(map(str, books.flat())).encode()).hexdigest()
    codes = slice_codes.encode(rows, books, carry=["vec_id", "label"])
    digits = F.transform("codes.code", lambda k: F.lower(F.lpad(F.hex(k), 2, "0")))
    codes = stored(codes.select("vec_id", "label", F.array_join(digits, "").alias("code"), F.col("codes.error").alias("error")), "codes")
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(broadcast_if_small(sums, 1_000_000), F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """The query's stated input: the words of a tenth of the documents, by CRC of the
    id, repeat with some period from some word on.  Texts of NULL ids stay."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w")).withColumn("n", F.size("w"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    altered = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int"))))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(altered, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.detect(_with_planted_periods(read_table(spark, sf_dir, "documents")), carry=["doc_id"])
    runs = F.col("periodic.runs")
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = out.withColumn("top", periodic_runs.longest(runs))
    return out.select("doc_id", F.size(runs).cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
                      F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                      F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"))


@query("op13_phrase_automata", f"""
with d as (select row_number() over () as row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
p as (select row, doc_id, i, array_to_string(w[i : i + {phrase_automata.WORDS - 1}], ' ') as phrase from d, range(1, len(w) - {phrase_automata.WORDS - 2}) t(i)),
h as (select phrase, min(doc_id) as home from p group by phrase having min(doc_id) < max(doc_id)),
c as (select distinct row, i + k as i from p join h using (phrase), range({phrase_automata.WORDS}) t(k) where doc_id > home),
k as (select row, string_agg(w[i], ' ' order by i) as kept from d, range(1, len(w) + 1) t(i) where not exists (select 1 from c where c.row = d.row and c.i = t.i) group by row),
n as (select row, count(*) as n from c group by row)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (row) left join n using (row)""")
def op13_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrase_automata.drop_repeats(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", "unique.n_words", "unique.n_removed", F.sha2("unique.text", 256).alias("kept_sha256"))
