"""The registered queries of this package, and the SQL they are checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import documents
from tillhouse.llm.fingerprints import fingerprint_documents
from tillhouse.llm.licenses import scan_licenses
from tillhouse.llm.linededup import dedup_lines, dedup_passages
from tillhouse.llm.lm import score_texts
from tillhouse.llm.mixing import mix
from tillhouse.llm.neighbours import nearest
from tillhouse.llm.packing import pack
from tillhouse.llm.quality import judge
from tillhouse.llm.resampling import resample
from tillhouse.llm.sharding import shard
from tillhouse.llm.simhash import near_duplicates
from tillhouse.llm.tokenalign import align_tokenizers
from tillhouse.llm.toxicity import score_toxicity


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dedup_lines(documents(spark, sf_dir))
            .select("doc_id", "text", F.col("removed.chunks").alias("n_removed_chunks"),
                    F.col("removed.lines").alias("n_removed_lines"), F.array_join(F.transform(
                        "removed.spans", lambda s: F.concat(s.line.cast("string"), F.lit("+"), s.n_lines.cast("string"))),
                        ",").alias("removed_spans")))


def op5_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dedup_passages(documents(spark, sf_dir))
            .select("doc_id", "text", F.col("removed.lines").alias("n_removed_lines"), F.array_join(F.transform(
                "removed.spans", lambda s: F.concat(s.line.cast("string"), F.lit("+"), s.n_lines.cast("string"))),
                ",").alias("removed_spans")))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_toxicity": op3_toxicity,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_line_dedup": op5_line_dedup,
    "op5_passage_dedup": op5_passage_dedup,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_sharding": op9_sharding,
    "op10_license_scan": op10_license_scan,
    "op11_align_tokenizers": op11_align_tokenizers,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": r"""
        with d as (
          select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
                 substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15) as h
          from documents),
        s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
        w as (
          select *, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight,
                 2 * source_size as full_size from s),
        f as (
          select *, row_number() over (order by cast(full_size as double) / weight, source nulls last) as nth from w),
        l as (
          select nth, (cast(1.5 as double) * (select cast(sum(source_size) as double) from f)
                  - (select coalesce(sum(b.full_size), 0)::double from f b where b.nth < a.nth))
                 / (select sum(b.weight)::double from f b where b.nth >= a.nth) as level from f a),
        lev as (
          select level from f join l using (nth) where level * weight < full_size order by nth limit 1),
        t as (
          select source, source_size,
                 coalesce(least(full_size::double, (select level from lev) * weight), full_size::double) as target
          from f),
        p as (
          select *, case when source_size > 0 then floor(target / source_size) else 0 end as passes from t),
        c as (
          select source, h, sum(size) as words,
                 sum(sum(size)) over (partition by source order by h) as upto from d group by source, h)
        select d.doc_id, d.size, p.source_size, p.target,
               cast(k.copies * d.size as bigint) as taken, d.source, k.copies
        from d join p on d.source is not distinct from p.source
        join c on c.source is not distinct from d.source and c.h = d.h,
        lateral (select cast(least(2, p.passes + case when c.upto - c.words + c.words / 2
                                   <= p.target - p.passes * p.source_size then 1 else 0 end) as integer) as copies) k
    """,
    "op5_line_dedup": r"""
        with l as (
          select doc_id, text, string_split(coalesce(text, ''), chr(10)) as lines from documents),
        h as (select *, list_transform(lines, lambda x: md5(x)) as h from l),
        r as (
          select *, list_transform(range(1, len(h) + 1), lambda i: md5(coalesce(h[i - 1], '') || h[i])) as r from h),
        s as (
          select *, list_filter(range(1, len(h) + 1), lambda i: i = 1 or (i > 2 and r[i - 1] < r[i - 2] and r[i - 1] <= r[i]))
                 as starts from r),
        c as (
          select doc_id, unnest(range(1, len(starts) + 1)) as nth, starts, lines from s),
        k as (
          select doc_id, nth, starts[nth] - 1 as line,
                 coalesce(starts[nth + 1], len(lines) + 1) - starts[nth] as n_lines,
                 array_to_string(list_slice(lines, starts[nth], coalesce(starts[nth + 1], len(lines) + 1) - 1), chr(10))
                 as chunk from c),
        g as (
          select *, n_lines >= 2 and regexp_matches(chunk, '[^\x20\x09-\x0D]')
                    and row_number() over (partition by chunk, n_lines >= 2 order by doc_id nulls last, nth) > 1 as gone
          from k),
        t as (
          select doc_id, count(*) filter (gone) as n,
                 string_agg(chunk, chr(10) order by nth) filter (not gone) as kept,
                 coalesce(sum(n_lines) filter (gone), 0) as n_lines,
                 coalesce(string_agg(line || '+' || n_lines, ',' order by nth) filter (gone), '') as spans
          from g group by doc_id)
        select d.doc_id, case when t.n > 0 then coalesce(t.kept, '') else d.text end as text,
               cast(t.n as integer) as n_removed_chunks, cast(t.n_lines as integer) as n_removed_lines,
               t.spans as removed_spans
        from documents d join t on d.doc_id is not distinct from t.doc_id
    """,
    "op13_nearest_neighbours": r"""
        with v as (
          select row_number() over () as nth, vec_id, list_transform(embedding, lambda x: cast(x as double)) as e
          from embeddings
          where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        n as (select *, sqrt(list_dot_product(e, e)) as norm from v),
        s as (
          select q.nth, q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e) / (q.norm * c.norm) as score
          from n q join n c on q.vec_id % 50 = 0 and c.nth <> q.nth and len(c.e) = len(q.e)),
        r as (
          select *, cast(row_number() over (partition by nth order by score desc, vec_id nulls last) as integer) as rank
          from s)
        select query_id, rank, vec_id, score from r where rank <= 5
    """,
}
