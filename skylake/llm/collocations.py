"""Collocations from a weighted de Bruijn graph of words.

Nodes are the two-word runs of a language, an edge joins the two overlapping nodes of a three-word run and weighs its
occurrences. Only these longest grams are counted, with the ends of pieces: the last two words of each piece, and the last one. Shorter
counts follow from the flow: a node occurs as often as its edges leave it and pieces end in it; a word as often as the nodes that start
with it occur and pieces end in it.

A node is unary if one edge brings all its occurrences and one edge takes them all away. Runs of edges through unary nodes are
compacted to paths, a row each with its words and its one weight. As every occurrence of an inner node goes along the whole path,
a path is no longer than the longest piece; so its edges are found in about log2 of that many rounds of pointer doubling, and gathering
them holds no more than a piece. Phrases are then read off: three-word phrases along the paths, two-word phrases inside the paths and, at
junctions, from the flow.

Grams are counted in the tasks, COUNTED at a time, before they are shuffled by their node; edges below the least count are kept in
the flow of their node only. Everything after that works on frequent nodes and edges.

Cases: null and empty texts have no words, a null language is `und`. Rows are counted as often as they occur. Texts are read whole, a block
of words at a time. An empty table gives no phrases.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylake.llm.common import settle_counted
from skylake.session import release, settle

LEAST = 10
TOP = 2000
SHARE = 50  # per cent of a phrase's occurrences inside a longer one, from which on it is dropped
COUNTED = 1_000_000
BLOCK = 50_000
SLICE = 1_000_000
BITS = 21  # of a word's number; COUNTED and a BLOCK are fewer words than these hold
_PIECES = bytes.maketrans(b",;:!?\n\r\x0b\x0c\t", b"." * 9 + b" ")
MAX_ROUNDS = 40


def blocks(text: bytes, block: int, size: int) -> Iterator[list[bytes]]:
    """The words of a text, `block` at a time, each time with the two that follow; a point stands for the end of a piece. The text is split
    `size` bytes at a time, so that a long one is never held as words."""
    text = (text.lower().translate(_PIECES) + b".").replace(b".", b" . ")
    words, at = [], 0
    while at < len(text):
        end = text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        words += text[at:end].split()
        at = end
        while len(words) > block + 2 or (words and at == len(text)):
            yield words[:block + 2]
            del words[:block]


def grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(run, n): occurrences of three-word runs as the third word, a tab and their node; with nothing before the tab those of the two words,
    and of the one word, that end a piece. A node is its words, a tab and the language. A run is one text, as two would take a quarter more
    of the shuffle. The same run can have several rows, at most one for each block of about COUNTED words; a block is sorted by node, so that
    a shuffle compresses it better.

    In a block words are numbers, the end of a piece is 0, and each word starts one run: with the two numbers after it, up to an end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            words = pa.array([None, *islice(numbers, 1, None)], pa.binary()).cast(pa.string())
            order = pc.array_sort_indices(words, null_placement="at_start")
            words, rank = words.take(order), np.empty(len(words), np.int64)
            rank[order.to_numpy()] = np.arange(len(words))
            for lang, parts in held.items():
                at = np.concatenate([*parts, np.zeros(2, np.int32)])
                starts = np.flatnonzero(at > 0)
                second = rank[np.abs(at[starts + 1])]
                third = np.where(second > 0, rank[np.abs(at[starts + 2])], 0)
                keys, counts = np.unique(rank[at[starts]] << 2 * BITS | second << BITS | third, return_counts=True)
                for i in range(0, len(keys), BLOCK):
                    some = keys[i:i + BLOCK]
                    first, second, third = (words.take(pa.array(some >> k & (1 << BITS) - 1)) for k in (2 * BITS, BITS, 0))
                    node = pc.binary_join_element_wise(first, second, " ", null_handling="skip")
                    joined = pc.binary_join_element_wise(pc.fill_null(third, ""), node, pa.scalar(lang), "\t")
                    yield pa.RecordBatch.from_arrays([joined, pa.array(counts[i:i + BLOCK], pa.int64())], names=["run", "n"])
            held.clear()
            numbers.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for some in blocks(text.as_py() or b"", BLOCK, SLICE):
                    numbers[b"."]  # 0
                    part = np.fromiter(map(numbers.__getitem__, some), np.int32, len(some))
                    part[BLOCK:] *= -1  # these start their runs in the next part
                    held.setdefault(lang, []).append(part)
                    size += len(part)
                    if size > COUNTED:
                        yield from rows()
                        size = 0
        yield from rows()

    wanted = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")), F.col(f"`{text_col}`").cast("binary"))
    return wanted.mapInArrow(run, "run string, n bigint")


def flows(counted: DataFrame, least: int = LEAST) -> DataFrame:
    """(node, next, n), written: with next null the flow of each node, of two words or one; else an edge of `least` or more.

    One shuffle by node serves both: edges are summed, and their sums again by node. Of a node below `least` the first word is written
    only: its flow counts for that word and for nothing else.
    """
    tab = F.instr("run", "\t")
    node, following = F.col("run").substr(tab + 1, F.length("run")), F.nullif(F.col("run").substr(F.lit(1), tab - 1), F.lit(""))
    edges = counted.repartition(node).groupBy(node.alias("node"), following.alias("next")).agg(F.sum("n").alias("n"))
    frequent = F.col("next").isNotNull() & (F.col("n") >= least)
    both = F.when(frequent, F.array(F.lit(None).cast("string"), F.col("next"))).otherwise(F.array(F.lit(None).cast("string")))
    each = edges.select("node", F.explode(both).alias("to"), "n")
    summed = each.groupBy("node", "to").agg(F.sum("n").alias("n"))
    rare = F.col("to").isNull() & (F.col("n") < least)
    tab = F.instr("node", "\t")
    first = F.substring_index(F.substring("node", F.lit(1), tab - 1), " ", 1)
    node = F.when(rare, F.concat(first, F.col("node").substr(tab, F.length("node")))).otherwise(F.col("node"))
    found = settle(summed.select(node.alias("node"), F.col("to").alias("next"), "n"), "flows")
    release(counted.sparkSession)
    return found


def word(column: Column | str, at: int) -> Column:
    return F.split_part(column, F.lit(" "), F.lit(at))


class Graph:
    """`words`: (lang, word, n) of all words; `nodes`: (lang, node, n) and `edges`: (lang, edge, tail, head, n) of `least` or more."""

    def __init__(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST):
        tab = F.instr("node", "\t")
        found = flows(grams(docs, text_col, lang_col), least).select(
            F.col("node").substr(tab + 1, F.length("node")).alias("lang"), F.col("node").substr(F.lit(1), tab - 1).alias("node"), "next", "n")
        flow = found.where("next is null").select("lang", "node", "n")
        self.words = settle(flow.groupBy("lang", word("node", 1).alias("word")).agg(F.sum("n").alias("n")), "words")
        self.nodes = flow.where((F.col("n") >= least) & F.contains("node", F.lit(" ")))
        edge = F.concat_ws(" ", "node", "next")
        head = F.concat_ws(" ", word("node", 2), "next")
        self.edges = found.where("next is not null").select("lang", edge.alias("edge"), F.col("node").alias("tail"), head.alias("head"), "n")

    def unary(self) -> DataFrame:
        """(lang, node, into, out): the inner nodes of paths with the edge that brings and the one that takes all their occurrences."""
        into = self.edges.select("lang", F.col("head").alias("node"), "n", F.col("edge").alias("into"))
        out = self.edges.select("lang", F.col("tail").alias("node"), "n", F.col("edge").alias("out"))
        # An edge that weighs as much as its node is the only one there, so keys are met once.
        return settle(self.nodes.join(into, ["lang", "node", "n"]).join(out, ["lang", "node", "n"]).select("lang", "node", "into", "out"), "unary")

    def paths(self) -> DataFrame:
        """(lang, words, n): the compacted paths, edges between two junctions as paths of their own. Each edge is in one path."""
        before = self.unary().select("lang", F.col("out").alias("edge"), F.col("into").alias("at"))
        known = F.col("at").isNotNull().cast("int")
        start = self.edges.join(before, ["lang", "edge"], "left").select("lang", "edge", F.coalesce("at", "edge").alias("at"), known.alias("steps"), known.alias("moved"), "n")
        now, seen = settle_counted(start, "chains", moved=F.sum("moved"))
        # `at` is an edge `steps` before on the same path; doubled until it is the first.
        for _ in range(MAX_ROUNDS):
            if not seen["moved"]:
                break
            far = now.where("steps > 0").select("lang", F.col("edge").alias("at"), F.col("at").alias("further"), F.col("steps").alias("more"))
            more = F.coalesce("more", F.lit(0))
            now, seen = settle_counted(now.drop("moved").join(far, ["lang", "at"], "left").select(
                "lang", "edge", F.coalesce("further", "at").alias("at"), (F.col("steps") + more).alias("steps"), (more > 0).cast("int").alias("moved"), "n"),
                "chains", moved=F.sum("moved"))
        else:
            raise RuntimeError(f"paths did not settle in {MAX_ROUNDS} rounds")
        last = F.struct("steps", word("edge", 3).alias("word"))
        whole = now.groupBy("lang", F.col("at").alias("first")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(last)).alias("rest"))
        return settle(whole.select("lang", F.concat(F.slice(F.split("first", " "), 1, 2), F.col("rest.word")).alias("words"), "n"), "paths")


def phrases(graph: Graph) -> DataFrame:
    """(lang, w, f, longer): phrases of two and three words with their count, and for two words the greatest count of a
    three-word phrase they are part of (0 without one)."""
    paths = graph.paths()
    place = lambda first, last: F.sequence(F.lit(first), F.size("words") - last)
    three = paths.select("lang", F.explode(F.transform(place(1, 2), lambda i: F.slice(F.col("words"), i, 3))).alias("w"), F.col("n").alias("f"))
    # Two words inside a path occur as often as the path; those at its ends are junctions.
    inner = paths.where("size(words) > 3").select(
        "lang", F.explode(F.transform(place(2, 2), lambda i: F.slice(F.col("words"), i, 2))).alias("w"), F.col("n").alias("f"), F.col("n").alias("longer"))
    ends = paths.select("lang", F.explode(F.array(F.slice("words", 1, 2), F.slice("words", -2, 2))).alias("w"), "n")
    ends = ends.groupBy("lang", "w").agg(F.max("n").alias("longer"))
    junctions = graph.nodes.select("lang", F.split("node", " ").alias("w"), F.col("n").alias("f")).join(inner.select("lang", "w"), ["lang", "w"], "left_anti")
    junctions = junctions.join(ends, ["lang", "w"], "left").select("lang", "w", "f", F.coalesce("longer", F.lit(0)).alias("longer"))
    return settle(three.withColumn("longer", F.lit(0).cast("bigint")).unionByName(inner).unionByName(junctions), "phrases")


def scored(graph: Graph, found: DataFrame, least: int = LEAST) -> DataFrame:
    """`found` with l, r and score of the lowest-scoring cut, the first of equal ones.

    Parts are looked up among the words and the two-word phrases; both are as frequent as the phrase at least.
    """
    counts = graph.words.where(F.col("n") >= least).select("lang", F.col("word").alias("part"), F.col("n").alias("f"))
    twos = found.where("size(w) = 2").select("lang", F.array_join("w", " ").alias("part"), "f")
    counts = counts.unionByName(twos)
    cuts = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(F.col("w"), 1, k), " ").alias("head"), F.array_join(F.slice(F.col("w"), k + 1, 2), " ").alias("tail")))
    each = found.select("lang", "w", "f", F.explode(cuts).alias("cut")).select("lang", "w", "f", "cut.*")
    each = each.join(counts.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    each = each.join(counts.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    square = F.lit(1_000_000).cast("decimal(7,0)") * (F.col("f").cast("decimal(15,0)") * F.col("f").cast("decimal(15,0)"))
    each = each.withColumn("__top", square).withColumn("__under", F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)"))
    score = F.expr("__top div __under")
    lowest = each.groupBy("lang", "w").agg(F.first("f").alias("f"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "w", "f", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """The `top` phrases of each language: (lang, rank, phrase, a, l, r, n, score)."""
    graph = Graph(docs, text_col, lang_col, least)
    found = phrases(graph)
    kept = found.where((F.size("w") == 3) | (100 * F.col("longer") < SHARE * F.col("f")))
    ranked = scored(graph, found, least).join(kept.select("lang", "w"), ["lang", "w"], "left_semi").withColumn("phrase", F.array_join("w", " "))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("f").desc(), "phrase")
    first = ranked.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    totals = graph.words.groupBy("lang").agg(F.sum("n").alias("n"))
    return first.join(totals, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def op13_collocations(docs: DataFrame) -> DataFrame:
    return collocations(docs)


SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, 'und') as lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as p
  from documents),
p as (select lang, list_filter(regexp_split_to_array(unnest(p), '[\x20\x09]+'), lambda x: x <> '') as w from d),
t as (select lang, len(w) as m, w, unnest(range(1, len(w) + 1)) as i from p),
f1 as (select lang, w[i] as g, count(*) as f from t group by all),
f2 as (select lang, w[i] as a, w[i + 1] as b, count(*) as f from t where i < m group by all having count(*) >= 10),
f3 as (select lang, w[i] as a, w[i + 1] as b, w[i + 2] as c, count(*) as f from t where i < m - 1 group by all having count(*) >= 10),
tot as (select lang, cast(sum(f) as bigint) as n from f1 group by lang),
cuts as (
  select f2.lang, f2.a || ' ' || f2.b as phrase, f2.f as f, 1 as k, x.f as l, y.f as r
  from f2 join f1 x on x.lang = f2.lang and x.g = f2.a join f1 y on y.lang = f2.lang and y.g = f2.b
  union all
  select f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 1, x.f, y.f
  from f3 join f1 x on x.lang = f3.lang and x.g = f3.a join f2 y on y.lang = f3.lang and y.a = f3.b and y.b = f3.c
  union all
  select f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 2, x.f, y.f
  from f3 join f2 x on x.lang = f3.lang and x.a = f3.a and x.b = f3.b join f1 y on y.lang = f3.lang and y.g = f3.c),
s as (select *, cast((1000000::hugeint * f * f) // (l::hugeint * r) as bigint) as score from cuts),
low as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select lang, a || ' ' || b as phrase, f from f3 union all select lang, b || ' ' || c, f from f3),
longer as (select lang, phrase, max(f) as longer from inside group by all),
kept as (
  select low.* from low left join longer on low.lang = longer.lang and low.phrase = longer.phrase
  where longer is null or 100 * longer < 50 * f),
ranked as (select *, row_number() over (partition by lang order by score desc, f desc, phrase) as rank from kept)
select ranked.lang, rank, phrase, f as a, l, r, n, score from ranked join tot on ranked.lang = tot.lang where rank <= 2000
"""
