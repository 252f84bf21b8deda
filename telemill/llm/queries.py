"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..queries.base import Registry
from ..queries.base import table as read_table
from ..session import new_path
from . import audit, codes, decontam, jaccard, language, lines, mixing, packing, quality, sharding, substring, toxicity, vectors
from .tables import ship_package

register = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return read_table(spark, sf_dir, name)


@register("op1_virtual_slots")
def op1_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = sharding.shard_documents(docs, 16, path=new_path(spark, "slot-map"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )


MIX_SQL = r"""
with q as (select doc_id, max(quality) quality from labels group by doc_id),
rows_ as (
  select d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) as size,
    -ln((('0x' || substr(md5('mix|' || coalesce(d.doc_id::varchar, md5(coalesce(d.text, '')))), 1, 13))::bigint::double + 0.5::double)
      / 4503599627370496.0::double)
      / (case when q.quality > 0 then 1.0 when q.quality <= 0 then 0.25 else 0.5 end)::double as k
  from documents d left join q on d.doc_id = q.doc_id),
src as (select source, sum(size)::bigint as source_size from rows_ group by source),
rated as (
  select *, 3::double * source_size as cap,
    (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from src),
stepped as (
  select *, (sum(source_size) over ()
      - coalesce(sum(cap) over (order by cap / weight, source nulls last
          rows between unbounded preceding and 1 preceding), 0))
    / (sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, source nulls last
          rows between unbounded preceding and 1 preceding), 0)) as level
  from rated),
targets as (
  select source, source_size, coalesce(weight * first_value(
      case when level * weight <= cap then level end ignore nulls) over (
        order by cap / weight, source nulls last rows between unbounded preceding and current row), cap) as target
  from stepped),
plan as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from targets),
ordered as (
  select r.doc_id, r.size, r.source, p.source_size, p.target, p.epochs,
    round(p.target - p.epochs * p.source_size)::bigint - coalesce(sum(r.size) over (
      partition by r.source order by r.k, r.doc_id, r.size rows between unbounded preceding and 1 preceding), 0) as room
  from rows_ r join plan p on r.source is not distinct from p.source)
select doc_id, size::bigint as size, source, source_size, target, epochs,
  (epochs * size + least(size, greatest(0, room)))::bigint as taken
from ordered"""


@register("op3_weighted_mixing", MIX_SQL)
def op3_weighted_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_block_anchors")
def op2_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", "repeat_starts", "repeat_ends")


@register("op10_shingle_jaccard")
def op10_shingle_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


@register("op7_recurrent_toxicity")
def op7_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op5_rank_order_language")
def op5_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


@register("op9_projection_forest")
def op9_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@register("op6_template_decontamination")
def op6_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and item; documents without a row hold no item."""
    return decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_segment_edit_lines")
def op4_segment_edit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_lines(table(spark, sf_dir, "documents"))


@register("op8_cotrained_quality")
def op8_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


CODES_PARTS = ",\n".join(
    f"""a{r} as materialized (select vec_id, p, x, arg_min(e, (d, e)) as e, min(d) as d from (
    select v.vec_id, v.p, v.x, b.e, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
    from parts v join b{r} b on v.p = b.p) group by vec_id, p, x),
b{r + 1} as materialized (select b.p, b.e, coalesce(m.x, b.x) as x from b{r} b left join (
    select p, e, list(y order by i) as x from (
      select p, e, i, floor(sum(y)::double / count(*))::bigint as y
      from (select p, e, unnest(x) as y, generate_subscripts(x, 1) as i from a{r}) group by p, e, i) group by p, e) m
  on m.p = b.p and m.e = b.e)"""
    for r in range(6)
)
CODES_SQL = f"""
with kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select vec_id, p, x[p * (len(x) // 8) + 1 : (p + 1) * (len(x) // 8)] as x from kept, range(8) as r(p)),
b0 as materialized (
  select p, row_number() over (partition by p order by vec_id) - 1 as e, x from parts
  where vec_id in (select vec_id from kept order by vec_id limit 16)),
{CODES_PARTS},
last as materialized (select vec_id, p, arg_min(e, (d, e)) as e, min(d) as d from (
    select v.vec_id, v.p, b.e, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
    from parts v join b6 b on v.p = b.p) group by vec_id, p),
coded as (select vec_id, string_agg(printf('%02x', e::int), '' order by p) as code, sum(d)::bigint as error from last group by vec_id),
digest as (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as h from b6)
select c.vec_id, c.code, c.error, (sum(c.error) over (partition by k.label))::bigint as label_error, d.h as codebooks_sha256
from coded c join kept k on c.vec_id = k.vec_id, digest d"""


@register("op11_ball_codes", CODES_SQL)
def op11_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.vector_codes(table(spark, sf_dir, "embeddings"))


AUDIT_SQL = r"""
with texts as materialized (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
firsts as (select t, min(doc_id) as least from texts group by t),
known as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
masked as materialized (
  select part, case when len(w) < 200 then 'A' else '' end
      || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
      || case when 100 * length(regexp_replace(x.t, '[^A-Z]', '', 'g')) > 3 * length(x.t) then 'C' else '' end
      || case when regexp_matches(x.t, '[#$%&*|]') then 'D' else '' end
      || case when x.doc_id > f.least then 'E' else '' end as mask,
    coalesce(k.good, 0) as good, coalesce(k.toxic, 0) as toxic
  from texts x join firsts f on x.t = f.t left join known k on x.doc_id = k.doc_id),
counted as materialized (
  select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from masked group by part, mask),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (select filter_order, s::int as step, substr(filter_order, s::int, 1) as f,
  substr(filter_order, 1, s::int - 1) as before from orders, range(1, 6) as r(s)),
told as materialized (
  select c.part, s.filter_order, s.step, s.f,
    sum(case when c.mask <> '' and regexp_matches(c.mask, '[' || s.before || s.f || ']') then 0 else n end) as kept,
    sum(case when contains(c.mask, s.f) and translate(c.mask, s.before, '') = c.mask then n else 0 end) as removed,
    sum(case when contains(c.mask, s.f) and translate(c.mask, s.before, '') <> c.mask then n else 0 end) as redundant,
    sum(case when c.mask = s.f then n else 0 end) as unique_fails,
    sum(case when contains(c.mask, s.f) and translate(c.mask, s.before, '') = c.mask then good else 0 end) as good_lost,
    sum(case when contains(c.mask, s.f) and translate(c.mask, s.before, '') = c.mask then toxic else 0 end) as toxic_lost
  from counted c, steps s group by c.part, s.filter_order, s.step, s.f)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley
from told"""


@register("op12_packed_audit", AUDIT_SQL)
def op12_packed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op13_certified_packing")
def op13_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))
