"""The registered queries of this package: name -> (spark, sf_dir) -> DataFrame.

Each applies its operator, with the parameters meant for production, to the
whole table; ``SQL`` has DuckDB's equivalent where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm import (alignment, bpe, chat_format, classifier_chain, golay_dedup, importance, licenses, packing,
                        rule_ensemble, simhash_tables, spelling, suffix_dedup, wrapper)
from tabula.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return keep


@registered("op1_rule_ensemble")
def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    return rule_ensemble.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered("op2_wrapper_induction")
def op2_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return wrapper.main_text(table(spark, sf_dir, "pages"))


@registered("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents and the bytes they decode to, as hashes."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


#: Every 200-byte string with its places, and what is left when all bytes of
#: strings that start twice or more are gone; hex digits stand for bytes.
SUFFIX_SQL = """
with docs as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
strings as (
  select doc_id, p, hash(substr(h, (2 * p + 1)::int, 400)) as a, md5_number_lower(substr(h, (2 * p + 1)::int, 400)) as b
  from (select doc_id, h, unnest(range((length(h) / 2)::bigint - 199)) as p from docs)),
twice as (
  select doc_id, p from strings
  qualify count(*) over (partition by a, b) > 1),
begun as (
  select doc_id, p, case when p <= lag(p) over w + 200 then 0 else 1 end as fresh
  from twice window w as (partition by doc_id order by p)),
spans as (
  select doc_id, min(p) as lo, max(p) + 200 as hi from (
    select doc_id, p, sum(fresh) over (partition by doc_id order by p) as run from begun)
  group by doc_id, run),
gaps as (
  select doc_id, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as lo, lo as hi from spans
  union all
  select d.doc_id, coalesce(max(s.hi), 0), length(any_value(d.h)) // 2
  from docs d left join spans s using (doc_id) group by d.doc_id),
kept as (
  select doc_id, string_agg(substr(h, (2 * lo + 1)::int, (2 * (hi - lo))::int), '' order by lo) as k
  from gaps join docs using (doc_id) group by doc_id)
select d.doc_id, (length(d.h) // 2)::bigint as n_bytes, ((length(d.h) - length(k.k)) // 2)::bigint as n_removed,
  (select count(*) from spans s where s.doc_id = d.doc_id)::bigint as n_spans,
  sha256(unhex(k.k)) as kept_sha256
from docs d join kept k using (doc_id)
"""


@registered("op4_suffix_dedup", SUFFIX_SQL)
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 200-byte strings over all documents."""
    return suffix_dedup.digest_columns(suffix_dedup.repeats(table(spark, sf_dir, "documents")))


@registered("op5_simhash_tables")
def op5_simhash_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    found = simhash_tables.with_edits(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256",
                        simhash_tables.as_hex(F.col("fp")).alias("fingerprint"),
                        simhash_tables.as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
                        "near_edited", "near_next", "n_near")


@registered("op6_importance_rules")
def op6_importance_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, score and verdict of all documents."""
    found = importance.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "score", "kept")


@registered("op7_classifier_chain")
def op7_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity probabilities of all documents."""
    return classifier_chain.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License matches in all documents."""
    return licenses.scanned(table(spark, sf_dir, "documents"))


@registered("op9_bin_slack_packing")
def op9_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with end id 1, in windows of 2048 ids."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer, end=1)


@registered("op10_golay_simhash")
def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by fingerprints at most three bits apart."""
    groups = golay_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


@registered("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their forms and roots."""
    return spelling.variants(table(spark, sf_dir, "documents"))


#: Turns as they are in the table; markers in texts are lengthened as the template's escape does.
CHAT_SQL = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked as (
  select *, coalesce(lag(role) over w = role, false) as goes_on, coalesce(lead(role) over w = role, false) as held,
    length(regexp_replace(regexp_replace(text, '(<\\*)(s>|/s>)', '\1\\\2', 'g'),
      '(\[\\*)(INST\]|/INST\]|SYS\]|ROLE\]|/ROLE\]|\+\])', '\1\\\2', 'g')) as n_chars
  from said window w as (partition by conv_id order by turn, role, text))
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  (3 + sum(n_chars + case when goes_on then 3 else case role when 'system' then 5 when 'user' then 6
             when 'assistant' then 7 else 13 + length(role) end end
           + case when role = 'assistant' and not held then 4 else 0 end))::bigint as formatted_chars
from marked group by conv_id
"""


@registered("op12_chat_format", CHAT_SQL)
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that quotes the template's markers, formatted and read back."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoting = spark.createDataFrame(
        [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id bigint, turn bigint, role string, text string")
    return chat_format.digests(chat_format.formatted(said.unionByName(quoting)))


@registered("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' tokens of all documents."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        first = file.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        second = file.read()
    return alignment.link_statistics(table(spark, sf_dir, "documents"), first, second)
