"""Benchmark passages in documents: a positional inverted index, with DataFrame functions only.

A phrase of the benchmark is a run of WINDOW words of an item; an item of fewer words is one phrase. The index holds
the postings (term, document, position) of each phrase's two rarest terms, counted over all documents. A phrase
is searched from its rarest term: each posting gives one place where the phrase could start, and it stays
if the posting list of the second rarest term, shifted by the two offsets, has that place as well. What is left
is compared word by word with the words stored around the rarest term's posting, which makes a match exact.

Proximity matches use the same index: an item is near in a document if the item's three rarest terms all occur within
SLOP words of an occurrence of the rarest, in any order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylake.llm.common import bounded, packed, row_key
from skylake.session import settle

WINDOW = 10
SLOP = 20
NEAR_TERMS = 3
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    split = F.split(F.translate(text, _UPPER, _UPPER.lower()), _SEPARATOR)
    return F.array_remove(F.coalesce(split, F.array().cast("array<string>")), "")


@dataclass
class Phrases:
    """`phrases`: (phrase id, words, n); `items`: (phrase id, item); `item_terms`: (item, term)."""

    phrases: DataFrame
    items: DataFrame
    item_terms: DataFrame


def phrases(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> Phrases:
    """Phrases of all items; an id that occurs twice is one item with the phrases of both rows."""
    items = benchmark.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    cut = F.transform(starts, lambda i: F.slice(F.col("w"), i + 1, F.least(F.lit(window), F.size("w"))))
    each = settle(items.select("item", F.explode(cut).alias("words")).withColumn("phrase", F.xxhash64(F.to_json("words"))), "phrases")
    distinct = each.groupBy("phrase").agg(F.first("words").alias("words")).withColumn("n", F.size("words"))
    item_terms = items.select("item", F.explode("w").alias("term")).distinct()
    return Phrases(distinct, each.select("phrase", "item").distinct(), item_terms)


@dataclass
class Index:
    """`postings`: (`__id`, `__th`, term, pos, around, before) of the search terms, `around` the words near a rarest term and
    `before` how many of them precede it; `plan`: a row per phrase with its two rarest terms and their offsets;
    `near`: (item, term, rank) of the terms that proximity looks for."""

    postings: DataFrame
    plan: DataFrame
    near: DataFrame


def _counts(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    found = docs.select(F.explode(words(F.col(text_col))).alias("term"))
    return found.join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("freq"))


def build_index(docs: DataFrame, asked: Phrases, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Count the benchmark's terms over all documents, choose the search terms and store their postings.

    Phrases with a term that no document has cannot occur and are left out of the plan.
    """
    terms = bounded(asked.item_terms.select("term").distinct(), "terms", F.octet_length("term"))
    freq = settle(_counts(docs, text_col, terms), "term_counts")
    placed = asked.phrases.select("phrase", "n", F.posexplode("words").alias("offset", "term"))
    ranked = placed.join(freq, "term", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    listed = ranked.groupBy("phrase", "n").agg(
        F.array_sort(F.collect_list(F.struct("freq", "term", "offset"))).alias("by"), F.min("freq").alias("least"))
    other = F.filter("by", lambda x: x["term"] != F.col("by")[0]["term"])
    second = F.coalesce(F.try_element_at(other, F.lit(1)), F.element_at("by", -1))
    plan = settle(listed.where("least > 0").select(
        "phrase", "n", F.col("by")[0]["term"].alias("term"), F.col("by")[0]["offset"].alias("offset"),
        second["term"].alias("term2"), second["offset"].alias("offset2")), "search_plan")
    order = Window.partitionBy("item").orderBy("freq", "term")
    near = asked.item_terms.join(freq, "term").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEAR_TERMS)
    near = settle(near.select("item", "term", "rank"), "near_terms")
    wanted = plan.select("term", F.lit(1).alias("lead")).union(plan.select("term2", F.lit(0))).union(
        near.select("term", F.lit(0))).groupBy("term").agg(F.max("lead").alias("lead"))
    wanted = bounded(wanted, "search_terms", F.octet_length("term"))
    w = docs.select(*row_key(id_col, text_col), words(F.col(text_col)).alias("w"))
    each = w.select("__id", "__th", "w", F.posexplode("w").alias("pos", "term")).join(wanted, "term")
    first = F.greatest(F.col("pos") - (WINDOW - 1), F.lit(0))
    around = F.when(F.col("lead") == 1, F.slice(F.col("w"), first + 1, F.col("pos") - first + WINDOW))
    postings = each.select("__id", "__th", "term", "pos", around.alias("around"), (F.col("pos") - first).alias("before"))
    return Index(settle(postings.distinct(), "postings"), plan, near)


def matches(index: Index, asked: Phrases) -> DataFrame:
    """Exact occurrences: (`__id`, `__th`, phrase, start, n), each once."""
    rows = index.postings
    lead = rows.where("around is not null").select("__id", "__th", "term", "pos")
    plan = bounded(index.plan, "plan", F.octet_length("term") + F.octet_length("term2"))
    places = lead.join(plan, "term").withColumn("start", F.col("pos") - F.col("offset")).where("start >= 0")
    wanted = places.select("__id", "__th", "phrase", "n", "start", F.col("term").alias("lead"), F.col("pos").alias("lead_pos"),
                           "offset", F.col("term2").alias("term"), (F.col("start") + F.col("offset2")).alias("pos"))
    both = wanted.join(rows.select("__id", "__th", "term", "pos"), ["__id", "__th", "term", "pos"], "left_semi")
    context = rows.where("around is not null").select(
        "__id", "__th", F.col("term").alias("lead"), F.col("pos").alias("lead_pos"), "around", "before")
    seen = both.drop("term", "pos").join(context, ["__id", "__th", "lead", "lead_pos"])
    spelled = bounded(asked.phrases.select("phrase", "words"), "phrase_words", F.octet_length(F.to_json("words")))
    cut = F.when(F.col("before") >= F.col("offset"), F.slice("around", F.col("before") - F.col("offset") + 1, F.col("n")))
    return seen.join(spelled, "phrase").where(cut == F.col("words")).select("__id", "__th", "phrase", "start", "n")


def near_items(index: Index, slop: int = SLOP) -> DataFrame:
    """Proximity matches: (`__id`, `__th`, item) where all of the item's (up to three) rarest terms occur within `slop`
    words of an occurrence of the rarest. Places are met by equal blocks of `slop` words, so no pair further
    than two blocks apart is formed."""
    near = bounded(index.near, "near", F.octet_length("term"))
    need = index.near.groupBy("item").agg(F.max("rank").alias("need"))
    found = index.postings.select("__id", "__th", "term", "pos").join(near, "term")
    at = found.where("rank = 1").select("__id", "__th", "item", F.col("pos").alias("at"), F.floor(F.col("pos") / slop).alias("own"))
    at = at.withColumn("block", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)))
    rest = found.where("rank > 1").select("__id", "__th", "item", "pos", "rank", F.floor(F.col("pos") / slop).alias("block"))
    close = at.join(rest, ["__id", "__th", "item", "block"]).where(F.abs(F.col("pos") - F.col("at")) <= slop)
    ranks = close.groupBy("__id", "__th", "item", "at").agg(F.countDistinct("rank").alias("others"))
    alone = found.where("rank = 1").join(need.where("need = 1"), "item", "left_semi").select("__id", "__th", "item")
    full = ranks.join(need, "item").where("others = need - 1").select("__id", "__th", "item")
    return full.union(alone).distinct()


def covered(found: DataFrame) -> DataFrame:
    """(`__id`, `__th`, n_hit): words inside any occurrence, each counted once."""
    runs = found.select("__id", "__th", "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    runs = runs.groupBy("__id", "__th", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("__id", "__th").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    new = runs.withColumn("new", F.greatest(F.col("end") - F.greatest("start", reached), F.lit(0)))
    return new.groupBy("__id", "__th").agg(F.sum("new").alias("n_hit"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a match: `__id`, `__th`, n_hit, items (their ids as sorted strings).

    Documents without words, null texts and empty tables give nothing; equal rows share one result.
    """
    asked = phrases(benchmark)
    found = settle(matches(build_index(docs, asked, id_col, text_col), asked), "matches")
    return _by_document(found, asked)


def _by_document(found: DataFrame, asked: Phrases) -> DataFrame:
    items = found.select("__id", "__th", "phrase").distinct().join(asked.items, "phrase").groupBy("__id", "__th").agg(
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    return covered(found).join(items, ["__id", "__th"])


def op4_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    asked = phrases(benchmark)
    index = build_index(docs, asked)
    found = settle(matches(index, asked), "matches")
    near = near_items(index).groupBy("__id", "__th").agg(F.count("item").alias("n_near"))
    hits = settle(_by_document(found, asked).join(near, ["__id", "__th"], "full"), "hits")
    rows = docs.select("doc_id", *row_key("doc_id", "text"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(hits, ["__id", "__th"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the rows in which a benchmark phrase occurs."""
    hits = contamination(docs, benchmark)
    marked = docs.select(packed(docs), *row_key("doc_id", "text"))
    return marked.join(hits.select("__id", "__th"), ["__id", "__th"], "left_anti").select("__row.*")


SQL = r"""
with d as (
  select doc_id, row_number() over () as r, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from documents),
b as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from benchmark),
bw as (
  select distinct item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as g, least(10, len(w)) as n
  from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(i) where len(w) > 0),
dw as (
  select r, n, i, array_to_string(w[i:i + n - 1], ' ') as g
  from d, (select distinct n from bw), unnest(range(1, len(w) - n + 2)) as t(i) where len(w) >= n),
h as (select distinct dw.r, dw.i, dw.n, dw.g from dw where g in (select g from bw)),
hw as (select r, count(distinct p) as n_hit from h, unnest(range(i, i + n)) as t(p) group by r),
hi as (
  select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as items
  from h join bw on h.g = bw.g and h.n = bw.n group by r),
df as (select t, count(*) as freq from (select unnest(w) as t from d) group by t),
it as (select distinct item_id, t from (select item_id, unnest(w) as t from b)),
nt as (
  select item_id, t, row_number() over (partition by item_id order by freq, t) as rank
  from it join df using (t) qualify rank <= 3),
need as (select item_id, max(rank) as need from nt group by item_id),
po as (select r, t, i as pos from (select r, unnest(w) as t, generate_subscripts(w, 1) as i from d) where t in (select t from nt)),
pr as (select r, item_id, rank, pos from po join nt using (t)),
nr as (
  select a.r, a.item_id, a.pos, count(distinct c.rank) as others
  from (select * from pr where rank = 1) a left join (select * from pr where rank > 1) c
    on a.r = c.r and a.item_id = c.item_id and abs(a.pos - c.pos) <= 20 group by all),
nn as (select r, count(distinct item_id) as n_near from nr join need using (item_id) where others = need - 1 group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near, 0) as n_near
from d left join hw using (r) left join hi using (r) left join nn using (r)
"""
