"""Thin queries over the operators, with production parameters, and their DuckDB texts where SQL can say them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landtiles.llm import audit, chosenpath, grace, interpolation, language, merkle, packing, pieces, quality, rules, sharding, suffixes, toxicity
from landtiles.llm.common import documents, fold
from landtiles.session import cut

QUERIES = {}
ORACLES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query
def op4_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = toxicity.toxicity(docs, toxicity.fit_toxicity(docs, labels(spark, sf_dir)))
    return found.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op5_quality_rules(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return rules.apply_rules(docs, rules.fit_rules(docs, labels(spark, sf_dir)))


@query
def op9_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = quality.rank(docs, quality.fit_quality(docs, labels(spark, sf_dir)))
    return found.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= quality.KEEP_SCORE).cast("int").alias("predicted")
    )


@query
def op10_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = language.identify(docs, language.fit_languages(docs))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query
def op1_exact_dedup(spark, sf_dir):
    found = grace.exact_groups(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


ORACLES["op1_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       row_number() over (partition by content order by doc_id desc) = 1 as kept, sha256(content) as text_sha256
from (select doc_id, coalesce(text, '') as content from documents) window same as (partition by content)
"""


@query
def op2_packing(spark, sf_dir):
    docs = documents(spark, sf_dir)
    pieces = packing.token_pieces(docs)
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.assign_sequences(digests, packing.group_count(docs))


@query
def op3_sharding(spark, sf_dir):
    crc = F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    rows = sharding.keyed(documents(spark, sf_dir)).select("doc_id", "size", crc, "high", "low")
    rows = cut(rows, "order")
    placed = sharding.numbered(rows, sharding.find_splitters(rows, sharding.SHARDS))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op6_near_dedup(spark, sf_dir):
    return chosenpath.near_groups(documents(spark, sf_dir))


@query
def op7_lm_scoring(spark, sf_dir):
    return interpolation.scores(documents(spark, sf_dir))


@query
def op8_sentencepiece(spark, sf_dir):
    rows = pieces.encoded(documents(spark, sf_dir), decode=True)
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.crc32(text).alias("text_crc32"),
        F.crc32("decoded").alias("decoded_crc32"),
        (F.col("decoded") == text).alias("lossless"),
    )


@query
def op11_filter_audit(spark, sf_dir):
    return audit.audit(documents(spark, sf_dir), labels(spark, sf_dir))


ORACLES["op11_filter_audit"] = r"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
masks as (
  select doc_id, part,
         (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int
         + 8 * regexp_matches(t, '[#$%&*|]')::int
         + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as mask
  from texts),
cells as (
  select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from masks left join marks using (doc_id) group by part, mask),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l, unnest([1, 2, 4, 8, 16]) as own),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order, [a.own, b.own, c.own, d.own, e.own] as bits
  from letters a, letters b, letters c, letters d, letters e
  where a.own | b.own | c.own | d.own | e.own = 31),
steps as (
  select filter_order, step::int as step, bits[step] as own, coalesce(list_sum(bits[1:step - 1]), 0)::int as before
  from orders, range(1, 6) r(step)),
counts as (
  select part, filter_order, step, own,
         sum(case when mask & (own | before) = 0 then n else 0 end)::bigint as kept,
         sum(case when mask & before = 0 and mask & own != 0 then n else 0 end)::bigint as removed,
         sum(case when mask & before != 0 and mask & own != 0 then n else 0 end)::bigint as redundant,
         sum(case when mask = own then n else 0 end)::bigint as unique_fails,
         sum(case when mask & before = 0 and mask & own != 0 then good else 0 end)::bigint as good_lost,
         sum(case when mask & before = 0 and mask & own != 0 then toxic else 0 end)::bigint as toxic_lost
  from cells, steps group by part, filter_order, step, own)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) over (partition by part, own)::bigint as shapley
from counts
"""


@query
def op12_merkle_manifest(spark, sf_dir):
    """Rows whose id has a CRC-32 that 7 divides claim one character more than they have."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    made = merkle.manifest(documents(spark, sf_dir), {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, more)})
    root = F.lit(made.root.hex() if made.root else None).cast("string")

    def text(digest):
        return F.lower(F.hex(digest))

    return merkle.proofs(made).select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), root.alias("root"),
        F.sha2(text("proof").cast("binary"), 256).alias("proof_sha256"), text("folded").alias("folded_root"),
        (text("folded") == root).alias("verified"),
    )


def _told(value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


_LEAF = "sha256(" + " || ".join(_told(c) for c in merkle.COLUMNS) + ")"

ORACLES["op12_merkle_manifest"] = f"""
with recursive checked as (
  select *, xor(4294967295::ubigint, list_reduce(
           list_prepend(4294967295::ubigint, [ascii(c)::ubigint for c in string_split(doc_id::varchar, '')]),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)::ubigint[]),
             lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end))) as crc
  from documents),
leaves as (
  select doc_id, lang, leaf, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
         case when crc % 7 = 0 then claim else leaf end as claim
  from (select doc_id, lang, crc, {_LEAF} as leaf, {_LEAF.replace("n_chars::varchar", "(n_chars + 1)::varchar")} as claim from checked)),
tree as (
  select lang, 0 as level, pos as idx, leaf as h, count(*) over (partition by lang) as n from leaves
  union all
  select lang, level + 1, idx // 2, sha256(string_agg(h, '' order by idx)), (any_value(n) + 1) // 2
  from tree where n > 1 group by lang, level, idx // 2),
tops as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as place from tree where n = 1),
top as (
  select 0 as level, place as idx, subroot as h, count(*) over () as n from tops
  union all
  select level + 1, idx // 2, sha256(string_agg(h, '' order by idx)), (any_value(n) + 1) // 2
  from top where n > 1 group by level, idx // 2),
sides as (
  select l.doc_id, 0 as tier, s.level, case when t.h is null then 0 when (l.pos >> s.level) & 1 = 1 then 2 else 1 end as side, t.h
  from leaves l join (select distinct lang, level from tree where n > 1) s on l.lang is not distinct from s.lang
  left join tree t on t.lang is not distinct from l.lang and t.level = s.level and t.idx = xor(l.pos >> s.level, 1)
  union all
  select l.doc_id, 1, s.level, case when t.h is null then 0 when (p.place >> s.level) & 1 = 1 then 2 else 1 end, t.h
  from leaves l join tops p on l.lang is not distinct from p.lang cross join (select distinct level from top where n > 1) s
  left join top t on t.level = s.level and t.idx = xor(p.place >> s.level, 1)),
paths as (
  select doc_id, string_agg(h, '' order by tier, level) as proof,
         list({{'side': side, 'h': coalesce(h, '')}} order by tier, level) as path
  from sides group by doc_id),
ends as (
  select l.doc_id, leaf, subroot, (select h from top where n = 1) as root, sha256(coalesce(proof, '')) as proof_sha256,
         list_reduce(list_prepend({{'side': 0, 'h': claim}}, coalesce(path, [])),
           lambda a, x: {{'side': 0, 'h': case x.side when 0 then sha256(a.h) when 1 then sha256(a.h || x.h) else sha256(x.h || a.h) end}}).h as folded_root
  from leaves l join tops p on l.lang is not distinct from p.lang left join paths using (doc_id))
select *, folded_root = root as verified from ends
"""


@query
def op13_suffix_dedup(spark, sf_dir):
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda total, n: total + n)
    return suffixes.without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
