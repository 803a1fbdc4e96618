"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload.llm import bitminhash, bradley_terry, containment, hilbert_pack, hypergeometric, kneser_ney, licences, merkle, repeats, rule_ledger, setjoin, token_store, warc
from dimload.session import scratch_path

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as rANS blocks in doc_id order and read back."""
    path = scratch_path(spark, "token-store")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=1)
    return token_store.read_tokens(spark, path, digests=True)


def op2_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and near-duplicate group."""
    return setjoin.groups(table(spark, sf_dir, "documents"))


def remainder(modulus: int):
    """crc32 of doc_id as text, modulo ``modulus``: the fold of a document."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by models learned from the documents of the other folds."""
    docs = table(spark, sf_dir, "documents")
    models = kneser_ney.fit(docs.where((remainder(5) != 0) & F.col("lang").isNotNull()))
    out = kneser_ney.predict(docs, models, (remainder(5) != 0) & F.col("lang").isNotNull())
    return out.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op4_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids along a Hilbert curve."""
    return hilbert_pack.pack(table(spark, sf_dir, "documents"), tokenizer_path(), size=4096, end_id=2).drop("tokens")


def op5_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements, failure bits and verdict."""
    rows = rule_ledger.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", *rule_ledger.MEASURES, "failed", (~rule_ledger.passes(1)).alias("base_failed"), rule_ledger.passes(rule_ledger.VERSION).alias("kept")
    )


_OP5_SQL = r"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents
), windows as (
  select rid, i, list_slice(w, i, i + 4) as g from (select rid, w, unnest(range(1, len(w) - 3)) as i from d)
), twice as (
  select rid, g from windows group by rid, g having count(*) > 1
), covered as (
  select rid, count(distinct i + k) as n from (select rid, i, unnest(range(5)) as k from windows semi join twice using (rid, g)) group by rid
), m as (
  select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::bigint as n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g'))::bigint as n_letters,
    length(regexp_replace(t, '[^!?]', '', 'g'))::bigint as n_marks
  from d left join covered using (rid)
), f as (
  select *, ((n_words < 10)::bigint + 2 * (100 * n_repeat_words > 20 * n_words)::bigint + 4 * (100 * n_symbols > 8 * word_chars)::bigint
    + 8 * (100 * n_dup_lines > 50 * n_lines)::bigint + 16 * (100 * n_upper > 60 * n_letters)::bigint
    + 32 * (100 * n_marks > 10 * word_chars)::bigint + 64 * (word_chars > 30 * n_words)::bigint) as failed
  from m
)
select *, failed & 3 != 0 as base_failed, failed = 0 as kept from f
"""


def op6_licence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence phrases and labels."""
    return licences.scan(table(spark, sf_dir, "documents")).drop("spans")


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, then read back through the index."""
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path, min_bytes=0)
    records = warc.read_archive(warc.read_index(spark, path), path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_OP7_SQL = f"""
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), g as (
  select html, max(page_id) as first_id from p group by html
)
select p.page_id, strlen(p.html)::bigint as payload_bytes,
  list_aggregate([substr('{_ALPHABET}', ((('0x' || substr(p.h, 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8))) & 31)::int + 1, 1)
    for i in range(32)], 'string_agg', '') as payload_digest,
  case when p.page_id = g.first_id then 'response' else 'revisit' end as record_type,
  case when p.page_id = g.first_id then null else g.first_id end as refers_to
from p join g on p.html = g.html
"""


def op8_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return containment.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP8_SQL = rf"""
with iw as (
  select item_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from benchmark where item_id is not null
), ig as (
  select distinct item_id, least(len(w), 5) as k, list_slice(w, i, i + least(len(w), 5) - 1) as g
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) as i from iw where len(w) > 0)
), size as (
  select item_id, count(*) as n from ig group by item_id
), dw as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents where doc_id is not null
), dg as (
  select distinct doc_id, k, list_slice(w, i, i + k - 1) as g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from dw, (select distinct k from ig) where len(w) >= k)
)
select doc_id, item_id, n::bigint as n_shingles, count(*)::bigint as n_found, count(*) / n as containment
from dg join ig using (k, g) join size using (item_id)
group by doc_id, item_id, n having count(*) * 100 >= n * 80
"""


def op9_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, ranked by labels of the other folds."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = bradley_terry.rank(docs, labels.where(remainder(3) != 1))
    return out.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled uniformly into 16 shards of equal row counts."""
    docs = hypergeometric.shuffle_into_shards(table(spark, sf_dir, "documents"), shards=16)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In a tenth of the documents, the words from some place on repeat with some period."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, left = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if left:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs of repeated words, and its text without the repetitions."""
    return repeats.scan(table(spark, sf_dir, "documents"), planted_repeats)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and the root folded from it, a seventh of them tampered with."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return merkle.manifest(table(spark, sf_dir, "documents"), remainder(7) == 0, {"n_chars": more})


_OP12_FIELDS = "concat({})".format(", ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "chars", "text")))
_OP12_SQL = f"""
with recursive d as (
  select doc_id, coalesce('+' || lang, '') as tree, source, lang, n_chars, text,
    xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384)))) % 7 = 0 as tampered
  from documents
), h as (
  select doc_id, tree, sha256({_OP12_FIELDS.replace("chars", "n_chars")}) as leaf,
    sha256({_OP12_FIELDS.replace("chars", "(n_chars::hugeint + case when tampered then 1 else 0 end)")}) as changed
  from d
), f as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by tree) as n from h
), t(level, tree, i, h, n) as (
  select 0, tree, i, leaf, n from f
  union all
  select level + 1, tree, i // 2, sha256(string_agg(h, '' order by i)), (any_value(n) + 1) // 2 from t where n > 1 group by level, tree, i // 2
), s as (
  select tree, h as subroot, row_number() over (order by tree) - 1 as i, count(*) over () as n from t where n = 1
), u(level, i, h, n) as (
  select 0, i, subroot, n from s
  union all
  select level + 1, i // 2, sha256(string_agg(h, '' order by i)), (any_value(n) + 1) // 2 from u where n > 1 group by level, i // 2
), ways as (
  select tree, i, 0 as part, unnest(range((select max(level) from t where t.tree = f.tree))) as level from f
  union all
  select f.tree, f.i, 1, unnest(range((select max(level) from u))) from f
), steps as (
  select w.*, case when x.h is null then 'N' when w.at % 2 = 1 then 'L' || x.h else 'R' || x.h end as step
  from (select *, i >> level as at from ways where part = 0) w left join t x on x.tree = w.tree and x.level = w.level and x.i = xor(w.at, 1)
  union all
  select w.*, case when x.h is null then 'N' when w.at % 2 = 1 then 'L' || x.h else 'R' || x.h end
  from (select w.*, s.i >> level as at from ways w join s using (tree) where part = 1) w left join u x on x.level = w.level and x.i = xor(w.at, 1)
), paths as (
  select tree, i, list(step order by part, level) as steps, sha256(string_agg(substr(step, 2), '' order by part, level)) as proof from steps group by tree, i
)
select f.doc_id, f.leaf, s.subroot, r.h as root, coalesce(p.proof, sha256('')) as proof_sha256,
  coalesce(list_reduce(list_prepend(f.changed, p.steps),
    lambda x, y: sha256(case y[1] when 'L' then substr(y, 2) || x when 'R' then x || substr(y, 2) else x end)), f.changed) as folded_root,
  folded_root = r.h as verified
from f join s using (tree) left join paths p on p.tree = f.tree and p.i = f.i cross join (select h from u where n = 1) r
"""


def op13_bit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count, near-duplicate group, and whether it stays."""
    return bitminhash.groups(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_jaccard_groups": op2_jaccard_groups,
    "op3_language_id": op3_language_id,
    "op4_hilbert_packing": op4_hilbert_packing,
    "op5_rule_ledger": op5_rule_ledger,
    "op6_licence_spans": op6_licence_spans,
    "op7_warc_index": op7_warc_index,
    "op8_minhash_containment": op8_minhash_containment,
    "op9_bradley_terry": op9_bradley_terry,
    "op10_hypergeometric_shards": op10_hypergeometric_shards,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_bit_minhash": op13_bit_minhash,
}

ORACLES = {"op5_rule_ledger": _OP5_SQL, "op7_warc_index": _OP7_SQL, "op8_minhash_containment": _OP8_SQL, "op12_merkle_manifest": _OP12_SQL}
