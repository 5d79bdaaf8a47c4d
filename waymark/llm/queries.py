"""The operators of this package as queries over the whole tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.quality import classify

    return classify(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.warc import archive_pages

    index = archive_pages(table(spark, sf_dir, "pages"), least=0)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position")


def op3_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from waymark.llm.bpe import encoding_digests

    return encoding_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.toxicity import classify, fold

    found = classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", (fold(found.doc_id) == 0).alias("held_out"), "score", "predicted")


def op5_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.graph_search import search

    return search(table(spark, sf_dir, "embeddings"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.substring import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.hamming import search, sign_codes

    return search(sign_codes(table(spark, sf_dir, "embeddings")))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from waymark.llm.align import align

    files = (vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, vocabulary("piece_bpe_32k.model"))
    return align(table(spark, sf_dir, "documents"), *files)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from waymark.llm.phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_warc_index": op2_warc_index,
    "op3_bpe_chunks": op3_bpe_chunks,
    "op4_toxicity": op4_toxicity,
    "op5_graph_search": op5_graph_search,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_substring": op8_substring,
    "op9_hamming": op9_hamming,
    "op10_minhash": op10_minhash,
    "op11_mixing": op11_mixing,
    "op12_alignment": op12_alignment,
    "op13_phrases": op13_phrases,
}
OP9 = """
with codes as (
  select vec_id, array_to_string([case when x > 0 then '1' else '0' end for x in embedding], '')::bit as code
  from embeddings where embedding is not null and len(embedding) > 0 and vec_id is not null
), found as (
  select q.vec_id as query_id, c.vec_id, bit_count(xor(q.code, c.code))::bigint as distance
  from codes q join codes c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
), placed as (
  select *, row_number() over (partition by query_id order by distance, vec_id) as place from found
)
select query_id, place::int as rank, vec_id, distance from placed where place <= 20
"""

OP13 = r"""
with texts as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
), pieces as (
  select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from texts
), lists as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), totals as (
  select lang, sum(len(w))::bigint as n from lists group by lang
), grams as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from lists, (values (1), (2), (3), (4)) as sizes(k) where len(w) >= k)
), f as (
  select lang, k, phrase, count(*)::bigint as a from grams group by all having count(*) >= 30
), parts as (
  select lang, k, phrase, a, string_split(phrase, ' ') as w, unnest(range(1, k)) as c from f where k > 1
), cuts as (
  select p.lang, p.k, p.phrase, p.a, p.c, x.a as l, y.a as r, (2000000 * p.a::hugeint // (x.a::hugeint + y.a::hugeint))::bigint as score
  from parts p
  join f x on x.lang = p.lang and x.phrase = array_to_string(p.w[1:p.c], ' ')
  join f y on y.lang = p.lang and y.phrase = array_to_string(p.w[p.c + 1:], ' ')
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, c) = 1
), inner_parts as (
  select lang, a, k, string_split(phrase, ' ') as w, unnest(range(2, k)) as size from f where k > 2
), held as (
  select lang, array_to_string(w[i:i + size - 1], ' ') as phrase, max(a) as longer
  from (select *, unnest(range(1, k - size + 2)) as i from inner_parts) group by all
), kept as (
  select x.* from lowest x left join held h using (lang, phrase) where h.longer is null or 100 * h.longer::hugeint < 80 * x.a::hugeint
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

SQL: dict[str, str] = {"op9_hamming": OP9, "op13_phrases": OP13}
