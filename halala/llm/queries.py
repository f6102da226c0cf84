"""Registered queries of the corpus operators, and the SQL that must give the same rows where SQL can."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.llm import debruijn, eliasfano, feast, forest, gru, mixing, ngramtrie, passages, stringkernel, stripes, urlrules, weighted, wumanber
from halala.llm.shared import given

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_file(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer's file; the folder can be set by HALALA_TOKENIZERS."""
    folder = os.environ.get("HALALA_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(name: str, sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
with d as (select doc_id, regexp_extract_all(coalesce({LOWERED}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select item_id, regexp_extract_all(coalesce({LOWERED}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
p as (
  select distinct item_id, least(len(w), 10) n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') s
  from b, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(i) where len(w) > 0),
sizes as (select distinct n from p),
x as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') s from d, sizes, unnest(range(1, len(w) - n + 2)) t(i)),
m as (select doc_id, i, x.n, item_id from x join p on x.n = p.n and x.s = p.s),
h as (select doc_id, count(distinct j) n_hit from m, unnest(range(i, i + n)) t(j) group by doc_id),
k as (select doc_id, count(*) n_items, string_agg(s, ',' order by s) names from (select distinct doc_id, cast(item_id as varchar) s from m) group by doc_id)
select d.doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(names, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join h on d.doc_id = h.doc_id left join k on d.doc_id = k.doc_id
"""

OP4_SQL = rf"""
with recursive d as (select doc_id, regexp_extract_all(coalesce({LOWERED}, ''), '[^\x20\x09-\x0D]+') w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') g from d, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) t(i)),
z as (select doc_id, count(*) n from s group by doc_id),
c as (select a.doc_id x, b.doc_id y, count(*) n from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
e as (select x, y from c join z p on x = p.doc_id join z q on y = q.doc_id where 100 * c.n >= 85 * (p.n + q.n - c.n)),
u as (select x, y from e union all select y, x from e),
r as (select doc_id a, doc_id b from documents union select r.a, u.y from r join u on r.b = u.x)
select d.doc_id, coalesce(z.n, 0) n_shingles, m.b component_id, d.doc_id = m.b kept
from documents d left join z on d.doc_id = z.doc_id join (select a, min(b) b from r group by a) m on d.doc_id = m.a
"""

OP10_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
x as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) s from d, unnest(range(1, len(w) - 48)) t(i)),
f as (select s, min(doc_id) first from x group by s),
g as (select distinct doc_id, j from x join f on x.s = f.s, unnest(range(i, i + 50)) t(j) where first < doc_id),
k as (
  select a.doc_id, string_agg(a.v, ' ' order by a.j) kept, count(*) n
  from (select doc_id, generate_subscripts(w, 1) j, unnest(w) v from d) a anti join g on a.doc_id = g.doc_id and a.j = g.j group by a.doc_id)
select d.doc_id, len(w) n_words, len(w) - coalesce(k.n, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256
from d left join k on d.doc_id = k.doc_id
"""


OP13_SQL = rf"""
with p as (
  select coalesce(lang, 'und') lang, unnest(string_split_regex(coalesce({LOWERED}, ''), '[.,;:!?\x0A-\x0D]')) piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from p),
t as (select lang, sum(len(w)) n from w group by lang),
g as (select lang, k, w[i:i + k - 1] v from w, (select unnest([1, 2, 3]) k) s, unnest(range(1, len(w) - k + 2)) u(i)),
f as (select lang, k, v, count(*) f from g group by lang, k, v),
c as (select * from f where k > 1 and f >= 10),
cut as (
  select c.lang, c.k, c.v, c.f, x.f l, y.f r, len(x.v) cut, (1000000::hugeint * c.f * c.f) // (x.f::hugeint * y.f) score
  from c, unnest(range(1, c.k)) z(i) join f x on x.lang = c.lang and x.v = c.v[1:i] join f y on y.lang = c.lang and y.v = c.v[i + 1:]),
best as (select * from cut qualify row_number() over (partition by lang, v order by score, cut) = 1),
inner_of as (select lang, v[1:2] v, f from c where k = 3 union all select lang, v[2:3] v, f from c where k = 3),
most as (select lang, v, max(f) f from inner_of group by lang, v),
kept as (
  select best.*, array_to_string(best.v, ' ') phrase
  from best left join most on best.lang = most.lang and best.v = most.v where most.f is null or 100 * most.f < 50 * best.f),
ranked as (select *, row_number() over (partition by lang order by score desc, f desc, phrase) place from kept)
select ranked.lang, place "rank", phrase, f a, l, r, cast(n as bigint) n, cast(score as bigint) score
from ranked join t on ranked.lang = t.lang where place <= 2000
"""


@query("op1_wu_manber_decontamination", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Words of benchmark windows in every document."""
    return wumanber.contamination(given(spark, folder, "documents"), given(spark, folder, "benchmark"))


@query("op2_string_kernel_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    return stringkernel.toxicity(given(spark, folder, "documents"), given(spark, folder, "labels"))


# Shares of words that op3 and the pipeline aim at.
TARGETS = {"en": 0.52, "fr": 0.17, "de": 0.17, "es": 0.14}


def labelled_domains(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, domain): the language of the documents listed in the labelled table."""
    listed = given(spark, folder, "labels").select("doc_id").distinct()
    return given(spark, folder, "documents").select("doc_id", F.col("lang").alias("domain")).join(listed, "doc_id", "left_semi")


@query("op3_soft_membership_mixing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """How often every document is to be seen, so that words per language have the target shares."""
    rated = mixing.rates(given(spark, folder, "documents"), labelled_domains(spark, folder), TARGETS)
    copies = mixing.copies(F.col("rate"), "doc_id", "rank").alias("copies")
    return rated.select("doc_id", "n_words", "domain", "probability", "rate", copies)


@query("op4_minhash_lsh_forest", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return forest.near_duplicates(given(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


URL_RULES = [
    urlrules.Rule("org", "/", "allow"),
    urlrules.Rule("example.org", "/es/", "block"),
    urlrules.Rule("example.org", "/en/1", "block"),
    urlrules.Rule("com", "/fr/", "allow"),
    urlrules.Rule("com", "/de/", "block"),
]


@query("op5_association_rule_urls")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the url of every page."""
    return urlrules.verdicts(given(spark, folder, "pages"), URL_RULES)


@query("op6_elias_fano_tokens")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as token ids, read back from their files."""
    return eliasfano.encoded(given(spark, folder, "documents"), tokenizer_file())


@query("op7_consistent_weighted_sampling")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return weighted.fingerprints(given(spark, folder, "documents"))


@query("op8_attention_passage_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    return passages.quality(given(spark, folder, "documents"), given(spark, folder, "labels"))


@query("op9_byte_gru_language")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    return gru.languages(given(spark, folder, "documents"))


@query("op10_de_bruijn_repeats", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without passages that an earlier one has."""
    kept = debruijn.without_repeats(given(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op11_feast_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable embedding on the first 16 components, whitened."""
    return feast.whitened(given(spark, folder, "embeddings"))


@query("op12_elias_fano_ngram_trie")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Language-model scores of every document."""
    return ngramtrie.language_scores(given(spark, folder, "documents"))


@query("op13_stripe_collocations", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The first phrases of every language."""
    return stripes.collocations(given(spark, folder, "documents"))
