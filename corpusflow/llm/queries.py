"""Registered queries of this folder, with the DuckDB text of the same result where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import (
    decontaminate, fill_middle, html_text, language_id, lexical_search, mixing, quality_model, quality_rules, secret_scan, simhash, token_count, toxicity,
    url_filter,
)
from corpusflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


MIX_SQL = r"""
with units as (
  select row_number() over () as tie, doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
sizes as (select source, cast(sum(size) as bigint) as source_size from units group by source),
ranked as (
  select source, source_size, 3 * source_size as most, cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as bigint) as weight,
    row_number() over (order by source nulls last) as rank from sizes),
total as (select cast(sum(source_size) as bigint) as t, cast(sum(weight) as bigint) as w from ranked),
filled as (
  select r.*, cast(coalesce(sum(most) over (order by most / weight, rank rows between unbounded preceding and 1 preceding), 0) as bigint) as used,
    cast(coalesce(sum(weight) over (order by most / weight, rank rows between unbounded preceding and 1 preceding), 0) as bigint) as gone
  from ranked r),
flagged as (select f.*, t, most / weight <= (t - used) / (w - gone) as "full" from filled f, total),
rest as (
  select cast(coalesce(sum(most) filter (where "full"), 0) as bigint) as used, cast(coalesce(sum(weight) filter (where not "full"), 1) as bigint) as left_w
  from flagged),
goals as (
  select source, source_size, t, case when "full" then cast(most as double)
    else cast(weight * (t - rest.used) as double) / left_w end as target from flagged, rest),
queued as (
  select u.tie, u.doc_id, u.source, u.size, g.source_size, g.target, g.t, substr(md5(coalesce(cast(u.doc_id as varchar), '')), 1, 16) as mark
  from units u join goals g on u.source is not distinct from g.source),
placed as (
  select *, cast(coalesce(sum(size) over (partition by source order by mark, doc_id nulls first, size, tie
    rows between unbounded preceding and 1 preceding), 0) as bigint) as begin from queued),
copies as (
  select p.*, r.round, cast(round * source_size + begin + size as double) / target as finish
  from placed p, (values (0), (1), (2)) r(round) where size > 0 and round * source_size + begin < target),
reached as (
  select *, sum(size) over (order by finish, source is null, source nulls first, round, begin rows unbounded preceding) as upto from copies),
taken as (select tie, count(*) as copies from reached where upto <= t group by all)
select p.doc_id, p.size, p.source_size, p.target, cast(p.size * coalesce(k.copies, 0) as bigint) as taken from placed p left join taken k using (tie)
"""


@query("op1_mix_sources", MIX_SQL)
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes of each; one row per row of ``documents``."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op2_url_filter")
def filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page; a page is labelled by the quality of the document whose number its URL ends with."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.expr("try_cast(nullif(regexp_extract(url, '/([0-9]{1,18})(?:[./?#]|$)', 1), '') as bigint)")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = pages.withColumn("doc_id", number).join(labels, "doc_id").select("url", (1 - F.col("quality")).alias("bad"))
    return url_filter.judge(pages, labelled)


@query("op5_scan_secrets")
def scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by fixed patterns and by the models trained on what these find."""
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


@query("op9_extract_html")
def extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query("op3_decontaminate")
def decontaminate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which items of the benchmark every document holds."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_near_duplicates")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document over fingerprints that differ in at most four bits."""
    found = simhash.grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), F.col("rep.doc_id").alias("component_id"))


def _risk_sql() -> str:
    """The text of op8: the rules and grids are those of the operator."""
    scores = {
        "symbols": "n_symbols / greatest(n_words, 1)", "dup_lines": "10 * n_dup_lines / greatest(n_words, 1)",
        "repeats": "n_repeat_words / greatest(n_words, 1)", "upper": "n_upper / greatest(word_chars, 1)",
        "long_words": "word_chars / greatest(n_words, 1)",
    }
    share = quality_rules.RISK / len(quality_rules.GRIDS)
    grid = ", ".join(f"('{r}', {c})" for r, cuts in quality_rules.GRIDS for c in cuts)
    score = " ".join(f"when '{r}' then {e}" for r, e in scores.items())
    return rf"""
with texts as (select row_number() over () as row, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t from documents),
split as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from texts),
windows as (
  select row, unnest(range(1, len(w) - 3)) as i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) as g
  from split where len(w) >= 5),
twins as (select row, i, count(*) over (partition by row, g) as n from windows),
covered as (select row, count(distinct i + k) as n from twins, range(5) r(k) where n > 1 group by row),
found as (
  select row, doc_id, stratum, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols, cast(len(regexp_extract_all(t, '[A-Z]')) as bigint) as n_upper,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(coalesce(c.n, 0) as bigint) as n_repeat_words
  from split left join covered c using (row)),
based as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from found),
good as (select f.* from based f join (select doc_id, max(quality) as good from labels where quality is not null group by doc_id) k using (doc_id)
  where k.good = 1 and not base_failed),
grid(rule, cut) as (values {grid}),
sizes as (select stratum, count(*) as n from good group by stratum),
counts as (
  select g.stratum, rule, cut, count(*) filter (where case rule {score} end > cut) as k from good g, grid group by all),
tested as (
  select c.stratum, rule, cut, case when k > n * {share!r} then 1.0 else
    (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share!r}) + (n - i) * ln(1 - {share!r}))) from range(k + 1) r(i)) end as p
  from counts c join sizes using (stratum)),
cuts as (
  select stratum, rule, min(cut) as cut from tested
  where p <= {quality_rules.LEVEL!r} / ((select count(*) from sizes) * {len(quality_rules.GRIDS)}) group by stratum, rule),
failing as (select distinct b.row from based b join cuts c using (stratum) where case rule {score} end > cut)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and f.row is null as kept from based left join failing f using (row)
"""


@query("op8_quality_rules", _risk_sql())
def quality_rules_with_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of every document and whether it stays, at thresholds controlled on the labelled ones."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"))
    return quality_rules.judge(table(spark, sf_dir, "documents"), labels).drop("failed")


VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@query("op4_count_tokens")
def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the pieces and scores of a public vocabulary."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), token_count.read_vocabulary(VOCABULARY))


@query("op6_quality_classifier")
def classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document and whether it stays."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"))
    return quality_model.classify(table(spark, sf_dir, "documents"), labels)


@query("op7_identify_language")
def identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


FILL_SQL = r"""
with hashed as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
drawn as (
  select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as w, cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
    cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from hashed),
cut as (
  select *, len(w) as n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) as a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form from drawn),
parts as (
  select *, coalesce(array_to_string(w[1:a], ''), '') as p, coalesce(array_to_string(w[a + 1:b], ''), '') as m,
    coalesce(array_to_string(w[b + 1:], ''), '') as s from cut)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts
"""


@query("op13_fill_middle", FILL_SQL)
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for filling in the middle, with digests of the output and of the text taken back from it."""
    made = fill_middle.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


SEARCH_SQL = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
asked as (
  select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
tf as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, cast(sum(tf) as bigint) as n from tf group by doc_id),
whole as (select count(*) as big_n, cast(sum(n) as bigint) as l from lengths),
weights as (select term, cast(floor(1000 * ln((2 * max(big_n) + 2) / (2 * count(*) + 1))) as bigint) as w from tf, whole group by term),
asked_n as (select item_id, term, count(*) as times from asked group by all),
scores as (
  select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // l)))) as bigint) as score
  from asked_n join weights using (term) join tf using (term) join lengths using (doc_id), whole group by all),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 20
"""


@query("op11_lexical_search", SEARCH_SQL)
def rank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every item of the benchmark."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_toxicity")
def score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of those that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.predict(docs, toxicity.train(docs, labels))
