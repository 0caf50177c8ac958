"""Registered queries of the operators over the given tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.llm import licenses, secrets, toxicity, url_filter
from vanewright.llm.decontamination import find_leaks
from vanewright.llm.line_quality import line_quality
from vanewright.llm.near_dedup import NearDup, near_groups
from vanewright.llm.packing import harmonic, token_pieces
from vanewright.llm.prefix_trie import prefix_trie, share_heads, turn_units
from vanewright.llm.sharding import shard
from vanewright.llm.simhash import simhash_groups
from vanewright.llm.spelling import spelling_variants
from vanewright.llm.substrings import Repeats, repeats
from vanewright.llm.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: First labels of hosts whose pages are listed.
LISTED_HOSTS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = harmonic(token_pieces(table(spark, sf_dir, "documents"), TOKENIZER))
    return placed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents")).drop("frequent")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), NearDup(shingle=2))


def op5_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))
    return found.withColumn("line_licenses", F.array_join("line_licenses", ","))


def listed_urls(pages: DataFrame) -> DataFrame:
    """The list of the registered query: the pages of the listed hosts."""
    label = F.regexp_extract(url_filter.host_of(F.col("url")), r"^(?:www\.|m\.|blog\.)?([^.]*)", 1)
    return pages.where(label.isin(LISTED_HOSTS)).select("url")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, listed_urls(pages))


def op7_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "n_tokens")


def fold_of(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def toxic_lexicon(spark: SparkSession, sf_dir: str) -> toxicity.Lexicon:
    """Learned from the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(fold_of() != 0).select("doc_id", "toxic")
    return toxicity.learn(table(spark, sf_dir, "documents"), labels)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxic_lexicon(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(fold_of() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats(table(spark, sf_dir, "documents"), Repeats(length=35), kept=lambda words: F.sha2(words, 256))
    return found.select("doc_id", "n_words", "n_removed",
                        F.coalesce("kept", F.lower(F.hex("whole"))).alias("kept_sha256"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(secrets.samples(docs)))
    base = F.col("base")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k, *_ in secrets.BASE], F.sha2(secrets.listed(base), 256).alias("base_sha256"),
                        secrets.listed(F.col("spans")).alias("spans"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(share_heads(turn_units(table(spark, sf_dir, "conversations"))))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {f.__name__: f for f in (
    op1_harmonic_packing, op2_line_frequency, op3_benchmark_decontamination, op4_minhash_near_dedup, op5_license_digests,
    op6_url_filter, op7_vector_sharding, op8_toxicity, op9_substring_dedup, op10_secret_scan,
    op11_prefix_trie, op12_spelling_variants, op13_simhash_near_dedup)}

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

SQL = {
    "op2_line_frequency": rf"""
with d as (select row_number() over () r, doc_id, coalesce(source, '') host, coalesce(text, '') t from documents),
w as (select *, regexp_extract_all(t, '{WORD}') ws from d),
grams as (select r, i, array_to_string(ws[i:i + 4], ' ') g from (select r, ws, unnest(range(1, len(ws) - 3)) i from w)),
twice as (select r, i from (select r, i, count(*) over (partition by r, g) c from grams) where c > 1),
covered as (select r, count(distinct i + k) n from twice, range(5) s(k) group by r),
lines as (select r, host, t, unnest(string_split(t, chr(10))) line from w),
l as (select r, host, t, line, len(regexp_extract_all(line, '{WORD}')) n,
             trim(regexp_replace(lower(line), '{WHITE}', ' ', 'g'), ' ') norm from lines
      where regexp_matches(line, '[^\x20\x09-\x0D]')),
dup as (select r, count(*) - count(distinct line) n from l group by r),
hosts as (select host, count(distinct t) n from d group by host),
frequent as (select host, norm from (select host, norm, count(distinct t) c from l group by host, norm) join hosts using (host)
             where c > 10 and c > 0.005 * n),
gone as (select r, count(*) lines, sum(n) words from l join frequent using (host, norm) group by r),
m as (select doc_id, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
             coalesce(dup.n, 0)::bigint n_dup_lines, coalesce(covered.n, 0)::bigint n_repeat_words,
             coalesce(gone.lines, 0)::bigint n_frequent_lines, (len(ws) - coalesce(gone.words, 0))::bigint n_words_left
      from w left join dup using (r) left join covered using (r) left join gone using (r)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and n_words_left >= 10 and n_words_left >= 0.5 * n_words kept, n_frequent_lines, n_words_left from b""",
    "op6_url_filter": r"""
with p as (select page_id, url, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
                  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') path,
                  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*[^?#]*[?]([^#]*)', 1), '') query from pages),
q as (select *, array_to_string(list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref)='))), '&') kept from p),
c as (select *, case when host <> '' then regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '') || case when kept <> '' then '?' || kept else '' end end canon,
      regexp_extract(host, '^(?:www[.]|m[.]|blog[.])?([^.]*)', 1) label from q),
listed as (select distinct canon from c where label in ('ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm') and canon is not null),
r as (select *, case when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
                     when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
                     when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
                     when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end rule from c)
select page_id, host, path, rule, case when rule in ('example.com/de/', 'net/') then 'block' when rule is not null then 'allow'
       when canon in (select canon from listed) then 'block' else 'allow' end verdict from r""",
}


def _spelled_sql(words: str) -> str:
    out = f"regexp_replace(replace({words}, ' licence', ' license'), ' v([0-9])', ' \\1', 'g')"
    for phrase, spelling in licenses.SPELLINGS:
        out = f"replace({out}, '{licenses.spaced(phrase)}', '{licenses.spaced(spelling)}')"
    return out


def _own_sql(text: str) -> str:
    return f"regexp_replace(lower(coalesce({text}, '')), '{licenses.COPYRIGHT}', '\\1', 'g')"


def _canonical_sql(text: str) -> str:
    words = rf"regexp_replace({_own_sql(text)}, '[^\p{{L}}\p{{N}}]+', '  ', 'g')"
    return f"trim({_spelled_sql(f"' ' || {words} || ' '")}, ' ')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KNOWN = " union all ".join(f"select {_quoted(k)} license, {_quoted(t)} notice" for k, t in licenses.LICENSES)
SQL["op5_license_digests"] = f"""
with known as (select sha256(canon) digest, min(license) license from (select {_canonical_sql('notice')} canon, license from ({_KNOWN})) group by 1),
d as (select row_number() over () r, doc_id, text t from documents),
lines as (select distinct r, sha256({_canonical_sql('line')}) digest from (select r, unnest(string_split(coalesce(t, ''), chr(10))) line from d)),
found as (select r, array_to_string(list_sort(list(distinct license)), ',') ls from lines join known using (digest) group by r)
select doc_id, digest, license, coalesce(ls, '') line_licenses
from (select r, doc_id, sha256({_canonical_sql('t')}) digest from d) left join known using (digest) left join found using (r)"""
