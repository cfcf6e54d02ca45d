"""Queries on repeated records and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions import codes, ids, text
from weft.operators import dedup
from weft.operators.components import connected_components
from weft.plans.tables import table


def dup_buckets_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by length within a language (as codes), folded text and raw text."""
    docs = table(spark, sf_dir, "documents")
    keys = {"code": F.concat_ws(":", "lang", F.col("n_chars").cast("string")), "description_text": F.sha2(text.document_key(F.col("text")), 256), "source_text": F.md5(F.col("text").cast("binary"))}
    got = dedup.duplicate_buckets(docs, keys, "doc_id", type=F.col("source"), example=F.substring(F.md5(F.col("text").cast("binary")), 1, 8))
    return got.select("kind", "bucket_key", "strength", "n", *[F.array_join(c, ",").alias(c) for c in ("ids", "types", "examples")])


def bucket_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ids of the same buckets, in long form: how many distinct keys each document has a kind of."""
    docs = table(spark, sf_dir, "documents")
    got = dedup.bucket_members(docs, {"code": F.col("lang"), "source_text": F.md5(F.col("text").cast("binary"))}, "doc_id")
    return got.groupBy("kind", "bucket_key").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


def dup_buckets_by_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5")).agg(F.count("*").alias("n"), F.count_distinct("source").alias("n_sources"), F.min("doc_id").alias("first_id")).where("n >= 2")


def corpus_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.frequent_tokens(table(spark, sf_dir, "documents"), text.words(F.coalesce("text", F.lit(""))), 0.15)


def near_dup_pairs_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names of one brand that a blocking rule pairs."""
    return dedup.blocked_pairs(table(spark, sf_dir, "part"), "p_brand", "p_name", stop_share=1.0)


def near_dup_pairs_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with the exact overlap of their trigrams, for all pairs of similarity 0.3 or more."""
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), text.grams(F.lower("p_name")).alias("g")).distinct()
    both = dedup.similar_pairs(names, "name", "g", 0.3)
    return both.select("item_a", "item_b", "n_common", "n_total", F.round(F.col("n_common") / F.col("n_total"), 9).alias("jaccard"))


def canonical_elect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the canonical form of each language's texts that fold to the same, with its group's size."""
    docs = table(spark, sf_dir, "documents").withColumn("form", F.coalesce("text", F.lit("")))
    got = dedup.canonical(docs.withColumn("skill", F.md5(text.skill_key(F.col("form")).cast("binary"))), ["lang", "skill"], F.col("form"))
    return got.select("lang", "skill", F.md5(F.col("canonical").cast("binary")).alias("canonical_md5"), F.col("n").cast("long").alias("n"), "forms")


def mode_surface_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent spelling of each word of the conversations, in each role: words that differ in case only are one."""
    turns = table(spark, sf_dir, "conversations").select("role", F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z]+"), F.lit(0))).alias("form"))
    got = dedup.canonical(turns.withColumn("word", F.lower("form")), ["role", "word"], F.col("form"))
    return got.select("role", "word", F.col("canonical").alias("form"), F.col("n").cast("long").alias("n"), "forms")


def dup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that ship a part in the same month connect, over all lines."""
    lines = table(spark, sf_dir, "lineitem").select(F.concat_ws(":", "l_partkey", F.date_format("l_shipdate", "yyyy-MM")).alias("edge"), F.col("l_suppkey").alias("supplier"))
    return dedup.hyperedge_components(lines, "edge", "supplier").select(F.col("node").alias("supplier"), "component")


def dup_clusters_constrained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names that share their last word within a type: SAME if also of one size, DISTINCT if brands differ too."""
    p = table(spark, sf_dir, "part").select("p_type", "p_name", "p_brand", "p_size").dropDuplicates(["p_type", "p_name"])
    last = F.element_at(F.split("p_name", " "), -1)
    p = p.withColumn("w", last)
    both = p.alias("a").join(p.alias("b"), ["p_type", "w"]).where("a.p_name < b.p_name")
    near = F.abs(F.col("a.p_size") - F.col("b.p_size")) <= 2
    links = both.select("p_type", F.col("a.p_name").alias("text_a"), F.col("b.p_name").alias("text_b"), near.alias("same")).where(near | (F.col("a.p_brand") != F.col("b.p_brand")))
    return dedup.constrained_clusters(links, "p_type").withColumnRenamed("scope", "p_type")


def code_across_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands and sizes that occur with more than one type."""
    p = table(spark, sf_dir, "part")
    return dedup.content_disagreements(p, ["p_brand", "p_size"], F.col("p_type"))


def uuid5_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").where("p_partkey > 1")
    a, b = F.col("p_partkey"), F.col("p_partkey") - 1
    return p.select("p_partkey", ids.pair_id(a, b).alias("pair_id"), ids.uuid5(F.concat_ws(":", F.lit("part"), F.col("p_name"))).alias("name_id"), ids.short_hash(F.col("p_name")).alias("short"), ids.bucket_id("brand", F.col("p_brand")).alias("bucket"))


def canonical_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the digest of their sorted properties."""
    e = table(spark, sf_dir, "events").where("props is not null")
    return e.groupBy(ids.content_hash(F.col("props")).alias("hash")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


def join_text_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation's turns folded into one text."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    folded = text.join_units(F.transform("t", lambda x: x["text"]))
    return turns.select("conv_id", F.length(folded).cast("long").alias("n_chars"), F.md5(folded.cast("binary")).alias("text_md5"))


def caption_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels made from parts, parsed again."""
    p = table(spark, sf_dir, "part")
    label = F.concat(F.element_at(F.array(*map(F.lit, ["Table", "Fig.", "Tableau no", "figure", "Chapter"])), (F.col("p_partkey") % 5 + 1).cast("int")), F.lit(" "), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 3 == 0, F.lit(".2: ")).otherwise(F.lit(" - ")), F.col("p_name"))
    c = codes.parse_caption(label)
    return p.select("p_partkey", c["kind"].alias("kind"), c["prefix"].alias("prefix"), c["identifier"].alias("identifier"), c["rest"].alias("rest")).where("kind is not null")


def code_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of three code families in whole documents: total, distinct, documents; families without any have 0."""
    families = {"number": "[0-9]{3,}", "upper": "[A-Z]{4,}", "missing": "ZZZ-[0-9]{9}"}
    hits = codes.code_matches(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", families)
    got = hits.groupBy("family").agg(F.count("*").alias("total"), F.count_distinct("code").alias("codes"), F.count_distinct("doc_id").alias("docs"), F.sum("start").alias("starts"))
    every = spark.createDataFrame([(f,) for f in families], "family string")
    return every.join(got, "family", "left").fillna(0)


def bag_of_words_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that occur more often in a document than in a page of the same number: doc_id, n_words."""
    bag = lambda df, i, t: df.select(F.col(i).alias("id"), F.explode(text.words(F.coalesce(t, F.lit("")))).alias("word")).groupBy("id", "word").agg(F.count("*").alias("n"))
    d, p = bag(table(spark, sf_dir, "documents"), "doc_id", F.col("text")), bag(table(spark, sf_dir, "pages"), "page_id", F.regexp_replace("html", "<[^>]*>", " "))
    over = d.join(p.withColumnRenamed("n", "m"), ["id", "word"], "left").where(F.col("n") > F.coalesce("m", F.lit(0)))
    return over.groupBy(F.col("id").alias("doc_id")).agg(F.count("*").alias("n_words"), F.sum("n").alias("n_over"))


def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of part names by each normaliser, grouped: how many names share them."""
    p = table(spark, sf_dir, "part").withColumn("raw", F.concat(F.lit("  "), F.initcap("p_name"), F.lit(" ..  "), F.col("p_brand"), F.lit(".")))
    keyed = p.select(text.document_key(F.col("raw")).alias("document"), text.graph_key(F.col("raw")).alias("graph"), text.code_key(F.col("p_brand")).alias("code"), text.controlled_key(F.col("raw")).alias("controlled"), text.skill_key(F.col("raw")).alias("skill"))
    return keyed.groupBy("document", "graph", "code", "controlled", "skill").agg(F.count("*").alias("n"))


def connected_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and nations of one region, as components of the plain edges."""
    from weft.plans.tables import hierarchy

    return connected_components(hierarchy(spark, sf_dir).select(F.col("child").alias("a"), F.col("parent").alias("b")))


QUERIES = {f.__name__: f for f in (dup_buckets_exact, bucket_members, dup_buckets_by_scope, corpus_stopwords, near_dup_pairs_tokens, near_dup_pairs_trigrams, canonical_elect, mode_surface_form, dup_components, dup_clusters_constrained, code_across_types, uuid5_ids, canonical_props, join_text_fold, caption_codes, code_matches, bag_of_words_guard, text_keys, connected_pairs)}

_GRAMS = "list_distinct(list_transform(range(1, greatest(length({0}) - 2, 1) + 1), lambda i: substr({0}, i, 3)))"
_UUID = "substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-5' || substr({0}, 14, 3) || '-' || substr('89ab', (('0x' || substr({0}, 17, 1))::integer & 3) + 1, 1) || substr({0}, 18, 3) || '-' || substr({0}, 21, 12)"
_NS = r"'\x6B\xA7\xB8\x11\x9D\xAD\x11\xD1\x80\xB4\x00\xC0\x4F\xD4\x30\xC8'::blob"

SQL = {
    "dup_buckets_exact": r"""
with k as (select doc_id, source, substr(md5(text), 1, 8) e, unnest([{'kind': 'code', 'key': lang || ':' || n_chars, 's': 'strong_signal'},
    {'kind': 'description_text', 'key': sha256(lower(trim(regexp_replace(coalesce(nfc_normalize(text), ''), '\s+', ' ', 'g')))), 's': 'medium_signal'},
    {'kind': 'source_text', 'key': md5(text), 's': 'weak_signal'}]) b from documents),
r as (select b.kind kind, b.key bucket_key, b.s strength, doc_id, source, e from k where b.key is not null),
x as (select kind, bucket_key, e, min(doc_id) d from r where e is not null group by all),
f as (select kind, bucket_key, array_to_string(list(e order by d, e)[:5], ',') examples from x group by all)
select kind, bucket_key, strength, count(*) n, array_to_string(list(doc_id order by doc_id)[:5], ',') ids, array_to_string(list_sort(list(distinct source)), ',') types, coalesce(any_value(examples), '') examples
from r left join f using (kind, bucket_key) group by 1, 2, 3 having count(*) >= 2""",
    "bucket_members": """
select 'code' kind, lang bucket_key, count(*) n, sum(doc_id)::bigint ids from documents where lang is not null group by 2
union all select 'source_text', md5(text), count(*), sum(doc_id)::bigint from documents where text is not null group by 2""",
    "dup_buckets_by_scope": "select lang, md5(coalesce(text, '')) text_md5, count(*) n, count(distinct source) n_sources, min(doc_id) first_id from documents group by 1, 2 having count(*) >= 2",
    "corpus_stopwords": r"""
with t as (select doc_id, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}_]+'))) token from documents)
select token, count(*) n from t group by 1 having count(*) > 0.15 * (select count(*) from documents)""",
    "near_dup_pairs_tokens": rf"""
with t as (select distinct p_brand scope, p_name text from part),
b as (select *, list_distinct(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) tokens, trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) s from t),
g as (select *, {_GRAMS.format("s")} grams from b),
p as (select a.scope, a.text text_a, b.text text_b, len(list_intersect(a.tokens, b.tokens)) c, len(a.tokens) na, len(b.tokens) nb,
  len(list_intersect(a.grams, b.grams)) gc, len(a.grams) ga, len(b.grams) gb from g a join g b on a.scope = b.scope and a.text < b.text),
r as (select scope, text_a, text_b, list_filter([case when c >= 0.75 * least(na, nb) and c >= 2 then 'containment' end, case when c = na and c = nb then 'token_identical' end,
  case when c / (na + nb - c) >= 0.55 then 'token_jaccard' end, case when gc / (ga + gb - gc) >= 0.6 then 'trigram_jaccard' end], lambda x: x is not null) rules from p)
select scope, text_a, text_b, array_to_string(rules, ',') rules from r where len(rules) > 0""",
    "near_dup_pairs_trigrams": f"""
with n as (select distinct p_name t from part), g as (select t, {_GRAMS.format("lower(t)")} g from n),
p as (select a.t item_a, b.t item_b, len(list_intersect(a.g, b.g))::bigint n_common, len(list_distinct(list_concat(a.g, b.g)))::bigint n_total from g a join g b on a.t < b.t)
select *, round(n_common / n_total, 9) jaccard from p where 10 * n_common >= 3 * n_total""",
    "canonical_elect": r"""
with l as (select lang, coalesce(text, '') line from documents),
s as (select lang, line, md5(trim(regexp_replace(regexp_replace(lower(trim(line)), '\s+', ' ', 'g'), '\.+$', ''))) skill from l),
f as (select lang, skill, line, count(*) n from s group by 1, 2, 3),
r as (select *, row_number() over (partition by lang, skill order by n desc, length(line), line) k, sum(n) over (partition by lang, skill) total, count(*) over (partition by lang, skill) forms from f)
select lang, skill, md5(line) canonical_md5, total::bigint n, forms from r where k = 1""",
    "mode_surface_form": r"""
with w as (select role, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+')) form from conversations), f as (select role, lower(form) word, form, count(*) n from w group by 1, 2, 3),
r as (select *, row_number() over (partition by role, word order by n desc, form) k, sum(n) over (partition by role, word) total, count(*) over (partition by role, word) forms from f)
select role, word, form, total::bigint n, forms from r where k = 1""",
    "dup_components": r"""
with recursive m as (select distinct l_partkey || ':' || strftime(l_shipdate, '%Y-%m') edge, l_suppkey s from lineitem),
h as (select edge, min(s) hub from m group by 1), e as (select distinct m.s a, h.hub b from m join h using (edge) where m.s <> h.hub),
two as (select a, b from e union select b, a from e), reach(node, label) as (select a, a from two union select two.b, reach.label from reach join two on reach.node = two.a)
select node supplier, min(label) component from reach group by 1""",
    "code_across_types": "select p_brand, p_size, count(*) n_rows, count(distinct p_type) n_contents from part group by 1, 2 having count(distinct p_type) > 1",
    "uuid5_ids": f"""
with x as (select p_partkey, p_name, p_brand, sha1({_NS} || ('pair:' || least(p_partkey::varchar, (p_partkey - 1)::varchar) || ':' || greatest(p_partkey::varchar, (p_partkey - 1)::varchar))::blob) h,
  sha1({_NS} || ('part:' || p_name)::blob) g from part where p_partkey > 1)
select p_partkey, {_UUID.format("h")} pair_id, {_UUID.format("g")} name_id, substr(sha256(p_name), 1, 16) short, 'brand:' || substr(sha256(p_brand), 1, 16) bucket from x""",
    "canonical_props": """select sha256('{"k":' || (props::json ->> 'k') || '}') hash, count(*) n, min(event_id) first_id from events where props is not null group by 1""",
    "text_keys": r"""
with x as (select '  ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' ..  ' || p_brand || '.' raw, p_brand from part),
k as (select lower(trim(regexp_replace(raw, '\s+', ' ', 'g'))) d, lower(regexp_replace(regexp_replace(p_brand, '\s+', '', 'g'), '^\p{P}+|\p{P}+$', '', 'g')) code, trim(regexp_replace(lower(raw), '[^\p{L}\p{N}\p{M}]+', ' ', 'g')) c from x)
select d document, d graph, code, c controlled, trim(regexp_replace(d, '\.+$', '')) skill, count(*) n from k group by all""",
    "caption_codes": """
with x as (select *, ['Table', 'Fig.', 'Tableau no', 'figure', 'Chapter'][p_partkey % 5 + 1] w from part)
select p_partkey, case when w in ('Fig.', 'figure') then 'figure' else 'table' end kind, case w when 'Tableau no' then 'Tableau' else w end as prefix, p_size || case when p_partkey % 3 = 0 then '.2' else '' end identifier, p_name rest from x where w <> 'Chapter'""",
    "code_matches": r"""
with f(family, pattern) as (values ('number', '[0-9]{3,}'), ('upper', '[A-Z]{4,}'), ('missing', 'ZZZ-[0-9]{9}')),
m as (select family, doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), pattern) hits, string_split_regex(coalesce(text, ''), pattern) gaps from documents, f),
u as (select family, doc_id, unnest(hits) code, unnest(range(1, len(hits) + 1)) i, hits, gaps from m where len(hits) > 0),
s as (select family, doc_id, code, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) start from u)
select family, coalesce(count(code), 0) total, count(distinct code) codes, count(distinct doc_id) docs, coalesce(sum(start), 0)::bigint starts from f left join s using (family) group by 1""",
    "bag_of_words_guard": r"""
with d as (select doc_id id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}_]+')) word from documents),
p as (select page_id id, unnest(regexp_extract_all(lower(regexp_replace(coalesce(html, ''), '<[^>]*>', ' ', 'g')), '[\p{L}\p{M}\p{N}_]+')) word from pages),
dn as (select id, word, count(*) n from d group by 1, 2), pn as (select id, word, count(*) m from p group by 1, 2)
select id doc_id, count(*) n_words, sum(n)::bigint n_over from dn left join pn using (id, word) where n > coalesce(m, 0) group by 1""",
    "connected_pairs": r"""
with recursive x as (select n_nationkey n, n_regionkey r from nation), e as (
  select 'n' || n a, 'r' || r b from x union select 's' || s_suppkey, 'n' || s_nationkey from supplier union select 'c' || c_custkey, 'n' || c_nationkey from customer),
two as (select a, b from e union select b, a from e), top as (select distinct b r from two where b like 'r%'),
down(node, r) as (select r, r from top union select e.a, down.r from down join e on e.b = down.node)
select d.node, (select min(d2.node) from down d2 where d2.r = d.r) component from down d""",
}
