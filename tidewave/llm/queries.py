"""The thin queries over the operators, and the SQL that some of them can be held against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewave.llm import (
    decontaminate, embed_dedup, filter_audit, importance, language_id, license_scan, line_crf, lm_score, ngram_join, packing, piece_codec, toxicity, url_filter,
)
from tidewave.llm.common import documents, fold_of
from tidewave.session import ship_package, table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.shingle_classes(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"), fold_of("doc_id", 3) != 1)
    return found.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.lm_scores(documents(spark, sf_dir), fold_of("doc_id", 7) != 2)
    return found.withColumn("held_out", fold_of("doc_id", 7) == 2)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), str(public_tokenizers.path("word_bpe_49k.json")))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), 0.9)


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: directories of a thousand, a hundred and ten ids, with files at every level.

    Ids that end in 00 stand in the directory of their thousand, others that end in 0 in that of their hundred, so that
    licence files there speak for the directories below.
    """
    docs = documents(spark, sf_dir)
    part = lambda n: F.expr(f"doc_id div {n}").cast("string")
    folder = F.concat_ws("/", part(1000), F.when(F.col("doc_id") % 100 != 0, part(100)), F.when(F.col("doc_id") % 10 != 0, part(10)))
    path = F.concat_ws("/", folder, F.col("doc_id").cast("string"))
    return license_scan.license_scan(docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")).withColumnRenamed("file_id", "doc_id")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_crf.quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"), fold_of("doc_id", 5) != 0)
    return found.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language_id.languages(docs, fold_of("doc_id", 4) != 2)
    return found.withColumn("held_out", fold_of("doc_id", 4) == 2).select("doc_id", "held_out", "lang_pred", "score")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op11_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = piece_codec.coded(documents(spark, sf_dir), str(public_tokenizers.path("piece_bpe_32k.model")))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_ngram_jaccard_join, op2_toxicity, op3_lm_scoring, op4_best_fit_packing, op5_embedding_near_dedup, op6_license_scans,
            op7_quality_classifier, op8_url_filters, op9_language_id, op10_benchmark_decontamination, op11_sentencepiece_codec,
            op12_filter_audit, op13_importance_resampling,
        )
    }


def _op8_sql() -> str:
    fits = "\n".join(
        f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h + p}'"
        for _, h, p in sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    )
    blocked = ", ".join(f"'{h + p}'" for a, h, p in url_filter.RULES if a == "block")
    return rf"""
with page as (
  select page_id, url, html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
ruled as (select *, case {fits} end as rule from page),
linked as (select count(*) as n from pages
  where regexp_matches(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b') or regexp_matches(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b'))
-- These tables hold no canonical or refresh links; with one, this SQL gives no verdict instead of a wrong one.
select page_id, host, path, rule,
  case when rule in ({blocked}) then 'block' when rule is not null then 'allow' when (select n from linked) = 0 then 'allow' end as verdict
from ruled"""


OP12_SQL = r"""
with text as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
  from documents),
failed as (
  select doc_id, part,
    (case when len(words) < 200 then 1 else 0 end) + (case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end)
    + (case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) then 4 else 0 end)
    + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
    + (case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end) as mask
  from text),
told as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id),
counts as (
  select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from failed left join told using (doc_id) group by part, mask),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from letter a, letter b, letter c, letter d, letter e
  where a.x not in (b.x, c.x, d.x, e.x) and b.x not in (c.x, d.x, e.x) and c.x not in (d.x, e.x) and d.x <> e.x),
steps as (
  select filter_order, step, substr(filter_order, step, 1) as f, 1 << (ascii(substr(filter_order, step, 1)) - 65) as bit,
    list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(substr(filter_order, k, 1)) - 65))) as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
acted as (
  select part, filter_order, step, f,
    sum(case when mask & (coalesce(before, 0)::bigint | bit) = 0 then n else 0 end) as kept,
    sum(case when mask & bit <> 0 and mask & coalesce(before, 0)::bigint = 0 then n else 0 end) as removed,
    sum(case when mask & bit <> 0 and mask & coalesce(before, 0)::bigint <> 0 then n else 0 end) as redundant,
    sum(case when mask = bit then n else 0 end) as unique_fails,
    sum(case when mask & bit <> 0 and mask & coalesce(before, 0)::bigint = 0 then good else 0 end) as good_lost,
    sum(case when mask & bit <> 0 and mask & coalesce(before, 0)::bigint = 0 then toxic else 0 end) as toxic_lost
  from counts, steps group by part, filter_order, step, f)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley
from acted"""


#: A byte takes eight steps of the CRC's polynomial; features are hashed once each.
OP13_SQL = r"""
with shared as (select doc_id, true as doc, text from documents union all select null, false, text from benchmark),
numbered as (
  select row_number() over () as row, doc_id, doc,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from shared),
feature as (
  select row, doc, unnest(words) as f from numbered
  union all
  select row, doc, unnest(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) from numbered where len(words) > 1),
grouped as (select row, doc, f, count(*) as n from feature group by row, doc, f),
kind as (
  select f, xor(4294967295, list_reduce(list_transform(range(0, length(hex(encode(f))) // 2),
      lambda k: ((strpos('0123456789ABCDEF', substr(hex(encode(f)), 2 * k::int + 1, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(hex(encode(f)), 2 * k::int + 2, 1)) - 1)::bigint),
    lambda state, byte: list_reduce(range(0, 8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, xor(state, byte)), 4294967295::bigint)) % 10000 as bucket
  from (select distinct f from grouped)),
hit as (select row, doc, bucket, sum(n)::bigint as n from grouped join kind using (f) group by row, doc, bucket),
bucketed as (
  select bucket, sum(case when doc then n else 0 end)::double as s, sum(case when doc then 0 else n end)::double as t from hit group by bucket),
total as (select coalesce(sum(s), 0) as s_all, coalesce(sum(t), 0) as t_all from bucketed),
gain as (select bucket, floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000))))::bigint as g from bucketed, total),
sums as (select row, sum(n)::bigint as n_features, sum(n * g)::bigint as total from hit join gain using (bucket) where doc group by row),
weighed as (
  select doc_id, len(words) as n_words, coalesce(n_features, 0) as n_features,
    case when n_features > 0 then ((total - ((total % n_features) + n_features) % n_features) // n_features)::bigint else 0 end as weight,
    list_reduce(list_transform(range(1, 9), lambda k: (strpos('0123456789abcdef', substr(sha256('7:' || doc_id::varchar), k::int, 1)) - 1)::bigint), lambda a, b: a * 16 + b) as h
  from numbered left join sums using (row) where doc),
scored as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from weighed),
ranked as (
  select *, n_words >= 20 and score is not null as may, row_number() over (partition by n_words >= 20 and score is not null order by score desc, doc_id) as place from scored)
select doc_id, n_features, weight, score,
  case when may and place <= 25 * (select count(*) from ranked where may) // 100 then place end as rank
from ranked"""


def oracle_sql() -> dict[str, str]:
    return {"op8_url_filters": _op8_sql(), "op12_filter_audit": OP12_SQL, "op13_importance_resampling": OP13_SQL}
