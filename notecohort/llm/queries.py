"""The dealt operators as registered queries, with their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, ann, bpe, embdedup, html_extract, langid, linededup, mixing, resample, sharding, simhash, toxicity, wavelet


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.bounded_ring(_table(spark, sf_dir, "documents"), shards=16)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    return bpe.read_vocabulary(public_tokenizers.path(name))


def op2_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = bpe.encode(_table(spark, sf_dir, "documents"), vocabulary(), decoded=True)
    return texts.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = wavelet.write_shards(_table(spark, sf_dir, "documents"), vocabulary())
    return wavelet.read_shards(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=3)


def op5_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linededup.repeated_lines(_table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op7_block_matrix_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdedup.near_duplicates(_table(spark, sf_dir, "embeddings"), min_cosine=0.95)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.3)


def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(_table(spark, sf_dir, "pages"))


def op11_kneser_ney_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs, ~toxicity.held_out(F.col("doc_id")))
    return langid.identify(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op12_anchor_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    piece_model = align.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    rows = align.align(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), piece_model)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.encode("groups", "UTF-8"), 256)).otherwise("")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=5, min_words=20, seed=42)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bounded_ring, op2_tree_bpe, op3_wavelet_tokens, op4_simhash, op5_systematic_mix, op6_line_dedup,
                               op7_block_matrix_ann, op8_projection_dedup, op9_toxicity, op10_html_main_text,
                               op11_kneser_ney_langid, op12_anchor_alignment, op13_importance_resampling)}

ORACLE_SQL: dict[str, str] = {
    "op5_systematic_mix": r"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, text from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w from s),
r as (select *, source_size * 3 / w as ratio, sum(source_size) over () as total, sum(w) over () as w_all from w),
h as (select *, coalesce(sum(source_size) over b, 0) as held, coalesce(sum(w) over b, 0) as w_held from r
  window b as (order by ratio, source nulls last rows between unbounded preceding and 1 preceding)),
l as (select *, (total - held * 3)::double / (w_all - w_held)::double as lv from h),
t as (select source, source_size, w, first_value(case when ratio >= lv then lv end ignore nulls)
  over (order by ratio, source nulls last rows between unbounded preceding and current row) as lv from l),
p as (select source, source_size, coalesce(lv * w, (source_size * 3)::double) as target,
  ('0x' || substr(md5('0:' || coalesce('=' || source, '')), 1, 8))::bigint::double / 4294967296.0 as u from t),
k as (select d.doc_id, d.size, p.source_size, p.target, p.u,
  case when p.source_size > 0 then p.target / p.source_size else 0.0 end as e,
  (row_number() over (partition by d.source order by d.size, d.doc_id) - 1)::double as i
  from d join p on d.source is not distinct from p.source)
select doc_id, size, source_size, target,
 (least(greatest(floor(u + e * (i + 1)) - floor(u + e * i), 0), 3)::bigint * size)::bigint as taken from k
""",
    "op6_line_dedup": r"""
with l as (select doc_id, i, line, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents)),
w as (select key, max(doc_id) as winner from l where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
j as (select l.*, (w.key is not null and w.winner <> l.doc_id) as gone from l left join w on l.key = w.key)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where gone))::bigint as n_dropped,
 sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from j group by doc_id
""",
}
