"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import (ann, binary, fingerprint, html_text, lexical, line_dedup, mixture, periodic, quality,
                           sharding, simhash, sp_encode, url_filter)
from pricelens.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict; the list holds the canonical URLs of spam hosts."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.spam_urls(pages)).select("page_id", "host", "path", "rule", "verdict")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op4_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_report(table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_encode.token_report(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary.id_report(table(spark, sf_dir, "documents"), WORD_MODEL)


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(periodic.edited(table(spark, sf_dir, "documents")))


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {q.__name__: _prepared(q) for q in (
    op1_url_filter, op2_simhash, op3_line_dedup, op4_mixture, op5_nearest, op6_fingerprint, op7_quality,
    op8_sentencepiece, op9_sharding, op10_token_files, op11_html_text, op12_lexical_search, op13_periodic_runs)}


def _rule_cases(column: int) -> str:
    """CASE over the rules, longest first."""
    cases = []
    for rule in sorted(url_filter.RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])):
        what = (rule[0] + rule[1], rule[2])[column]
        cases.append(f"when (host = '{rule[0]}' or host like '%.{rule[0]}') and starts_with(path, '{rule[1]}') then '{what}'")
    return "case " + " ".join(cases) + " end"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE: dict[str, str] = {
    "op1_url_filter": f"""
        with rest as (
            select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages),
        raw as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from rest),
        parts as (
            select page_id, coalesce({_LOWER.format('raw')}, '') as host,
                   coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') as path
            from raw),
        keyed as (
            select *, case when host <> '' then
                regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
                end as key
            from parts),
        listed as (select distinct key from keyed
                   where key is not null and regexp_matches(host, '{'|'.join(url_filter.SPAM_WORDS)}'))
        select k.page_id, k.host, k.path, {_rule_cases(0)} as rule,
               coalesce({_rule_cases(1)}, case when l.key is not null then 'block' else 'allow' end) as verdict
        from keyed k left join listed l on k.key = l.key""",
    "op3_line_dedup": f"""
        with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
        numbered as (select row_number() over () as row_id, * from split),
        lines as (select row_id, doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos from numbered),
        keyed as (select *, {_LOWER.format(f"trim(line, {_SPACES})")} as key from lines),
        frequent as (
            select key, max(doc_id) as last from keyed where length(key) >= {line_dedup.MIN_CHARS}
            group by key having count(distinct doc_id) >= {line_dedup.MIN_DOCS}),
        marked as (
            select k.*, f.key is not null and k.doc_id <> f.last as lost
            from keyed k left join frequent f on k.key = f.key)
        select doc_id, count(*) as n_lines, cast(count(*) filter (lost) as bigint) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not coalesce(lost, false)), '')) as kept_sha256
        from marked group by row_id, doc_id""",
    "op12_lexical_search": f"""
        with docs as (
            select row_number() over () as d, doc_id, list_filter(regexp_split_to_array({_LOWER.format('text')}, '{lexical.BETWEEN}'),
                   lambda t: t <> '') as terms
            from documents),
        counted as (select d, doc_id, len(terms) as n, unnest(terms) as term from docs),
        tfs as (select d, doc_id, n, term, count(*) as tf from counted group by all),
        sums as (select count(*) as n_docs, cast(sum(len(terms)) as bigint) as n_terms from docs where len(terms) > 0),
        dfs as (select term, count(*) as df from tfs group by term),
        items as (
            select row_number() over () as i, item_id, unnest(list_distinct(list_filter(
                   regexp_split_to_array({_LOWER.format('text')}, '{lexical.BETWEEN}'), lambda t: t <> ''))) as term
            from benchmark),
        scores as (
            select i, item_id, d, doc_id, cast(sum(cast(floor(1000 * ln((2.0 * n_docs + 2) / (2 * df + 1))) as bigint)
                   * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) as bigint) as score
            from items join tfs using (term) join dfs using (term) cross join sums group by i, item_id, d, doc_id)
        select item_id, cast(row_number() over (partition by i order by score desc, doc_id) as integer) as rank, doc_id, score
        from scores where score > 0
        qualify rank <= {lexical.K}""",
}
