import random
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylake.operators import chunks, fuzzy, lookup, quality
from skylake.operators.averages import Average, attach_averages, group_sums, with_group_averages
from skylake.operators.latest import latest_version
from skylake.operators.topk import top_k


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- lookup joins ---

@pytest.fixture
def hot_fact(spark):
    """A third of the rows share one key, and those are copies of one row."""
    keys = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    return spark.range(0, 3000, 1, 6).select(keys.alias("k"), F.when(keys == "hot", 0).otherwise(F.col("id")).alias("v"))


def table_of_keys(spark):
    return spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", None), (None, 9)], "k string, x int")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, hot_fact, how):
    expected = rows(hot_fact.join(table_of_keys(spark), "k", how).select("k", "v", "x"))
    assert rows(lookup.spread_join(hot_fact, table_of_keys(spark), "k", how).select("k", "v", "x")) == expected
    assert rows(lookup.lookup_join(hot_fact, table_of_keys(spark), "k", how).select("k", "v", "x")) == expected
    assert rows(lookup.lookup_join(hot_fact, table_of_keys(spark), "k", how, small=False).select("k", "v", "x")) == expected


def test_only_hot_keys_are_copied(spark, hot_fact):
    assert [r["__hot"] for r in lookup.hot_keys(hot_fact, F.col("k"), 0.1).collect()] == ["hot"]
    big = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("x"))
    few = spark.range(0, 5000, 1, 4).select(F.col("id").cast("string").alias("k"))
    assert lookup.spread_join(few, big, "k").count() == 5000


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("small", [True, False])
def test_semi_and_anti_joins(spark, hot_fact, how, small):
    expected = rows(hot_fact.join(table_of_keys(spark), "k", how))
    assert rows(lookup.lookup_join(hot_fact, table_of_keys(spark), "k", how, small=small)) == expected


@pytest.mark.parametrize("how", ["right", "full", "outer", "cross"])
def test_joins_that_keep_lookup_rows_are_refused(spark, hot_fact, how):
    with pytest.raises(ValueError, match="how must be"):
        lookup.lookup_join(hot_fact, table_of_keys(spark), "k", how)


def test_rows_without_a_key_are_dealt_out(spark):
    fact = spark.range(0, 3000, 1, 3).select(F.when(F.col("id") % 3 == 0, F.lit("k1")).alias("k"), F.col("id").alias("v"))
    got = lookup.spread_join(fact, table_of_keys(spark), "k", "left")
    assert rows(got.select("k", "v", "x")) == rows(fact.join(table_of_keys(spark), "k", "left").select("k", "v", "x"))


def test_small_lookup_is_broadcast_and_large_is_not(spark, hot_fact, plan):
    big = spark.range(20).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 1000).alias("text"))
    assert lookup.fits_in_broadcast(big)
    assert not lookup.fits_in_broadcast(big, max_rows=19)
    assert not lookup.fits_in_broadcast(big, max_bytes=20_000)
    assert "BroadcastHashJoin" in plan(lookup.lookup_join(hot_fact, big, "k"))
    spread = lookup.lookup_join(hot_fact, big, "k", small=False)
    assert "salt" in spread._jdf.queryExecution().optimizedPlan().toString()


def test_nested_columns_are_measured(spark):
    nested = spark.range(3).select("id", F.array(F.lit("abc")).alias("a"), F.struct(F.lit("x" * 500).alias("s")).alias("b"))
    assert lookup.fits_in_broadcast(nested)
    assert not lookup.fits_in_broadcast(nested, max_bytes=1500)


def test_copies_spread_over_salts_and_stay_stable(hot_fact):
    salted = hot_fact.withColumn("s", lookup.row_salt(hot_fact, 16))
    hot = salted.where("k = 'hot'")
    assert hot.select("s").distinct().count() > 1
    assert rows(salted) == rows(salted)


# --- averages ---

AVERAGES = [Average("v", 1, "avg_v"), Average("w", 2, "avg_w")]


@pytest.fixture
def grouped(spark):
    return spark.createDataFrame(
        [("a", 1.25, 1.0), ("a", 1.25, None), ("b", None, None), (None, 3.0, 2.0), (None, 4.5, 2.0)],
        "k string, v double, w double").repartition(3)


@pytest.mark.parametrize("max_rows", [10, 2, 0])
def test_group_averages(grouped, max_rows, monkeypatch):
    """All groups broadcast, only some, none."""
    monkeypatch.setattr(lookup, "MAX_ROWS", max_rows)
    by_key = {}
    for r in grouped.collect():
        by_key.setdefault(r.k, []).append(r)

    def avg(values, digits):
        values = [x for x in values if x is not None]
        return round(sum(values) / len(values), digits) if values else None

    want = sorted(((r.k, r.v, r.w, avg([x.v for x in by_key[r.k]], 1), avg([x.w for x in by_key[r.k]], 2))
                   for r in grouped.collect()), key=repr)
    assert rows(with_group_averages(grouped, {"k": AVERAGES})) == want


def test_two_groupings_take_one_pass_and_no_window(grouped, plan):
    both = with_group_averages(grouped, {"k": [Average("v", 1, "by_k")], "w": [Average("v", 1, "by_w")]})
    assert "Window" not in plan(both)
    assert {(r.k, r.w): (r.by_k, r.by_w) for r in both.collect()} == {
        ("a", 1.0): (1.2, 1.2), ("a", None): (1.2, 1.2), ("b", None): (None, 1.2), (None, 2.0): (3.8, 3.8)}


def test_unread_averages_are_dropped(grouped, plan):
    sums, small = group_sums(grouped, ["k"], ["v", "w"])
    assert small
    assert "Join" in plan(attach_averages(grouped, sums, "k", AVERAGES, small=True))
    assert "Join" not in plan(attach_averages(grouped, sums, "k", AVERAGES, small=True).select("k", "v"))


# --- near names ---

def edit_distance(a, b):
    previous = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        current = [i]
        for j, y in enumerate(b, 1):
            current.append(min(previous[j] + 1, current[-1] + 1, previous[j - 1] + (x != y)))
        previous = current
    return previous[-1]


def brute(left, right):
    return sorted((a, b, edit_distance(a, b)) for a in set(left) for b in set(right) if edit_distance(a, b) <= 1)


def near(spark, left, right):
    a = spark.createDataFrame([(x,) for x in set(left)], "a string")
    b = spark.createDataFrame([(x,) for x in set(right)], "b string")
    return sorted(tuple(r) for r in fuzzy.near_pairs(a, b, "a", "b").collect())


def test_near_pairs_on_awkward_names(spark):
    names = ["", "a", "aa", "aaa", "ab", "ba", "aab", "aude", "aube", "loire", "loiret", "corse", "corse0", "é", "ée", "日本", "日"]
    assert near(spark, names, names) == brute(names, names)


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    left, right = ([("".join(rng.choice("abc") for _ in range(rng.randint(0, 6)))) for _ in range(150)] for _ in range(2))
    assert near(spark, left, right) == brute(left, right)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(string.ascii_lowercase[:3] + "é", max_size=5), min_size=1, max_size=12),
       st.lists(st.text(string.ascii_lowercase[:3] + "é", max_size=5), min_size=1, max_size=12))
def test_near_pairs_property(spark, left, right):
    assert near(spark, left, right) == brute(left, right)


@pytest.mark.parametrize("length", [62, 63, 64, 65, 66, 67, 130])
def test_near_pairs_of_long_names(spark, length):
    """Around the length at which names are met by halves."""
    rng = random.Random(length)
    base = "".join(rng.choice("ab") for _ in range(length))
    names = {base, base[1:], base[:-1], base + "a", "b" + base, base[:30] + "x" + base[31:], base[:30] + base[31:], base[:30] + "x" + base[30:],
             base[:-1] + "x", "x" + base[1:], "x" + base[1:-1] + "y", base[:10] + base[12:], base[length // 2:], base[:length // 2]}
    names |= {base[:i] + "z" + base[i + 1:] for i in range(length // 2 - 2, length // 2 + 3)}
    assert near(spark, names, names) == brute(names, names)


def test_very_long_names_take_little_time(spark):
    import time

    name = "ab" * 10_000
    near(spark, [name], ["x"])
    start = time.time()
    assert near(spark, [name, name + "c"], [name[:-1]]) == [(name, name[:-1], 1)]
    assert time.time() - start < 10  # most of it starts jobs


def test_probes_beyond_the_bound_are_shuffled(spark, monkeypatch, plan):
    monkeypatch.setattr(lookup, "MAX_ROWS", 0)
    names = ["aude", "aube", "loire", "", "audé"]
    assert near(spark, names, names) == brute(names, names)


def test_near_pairs_is_an_equi_join(spark, plan):
    words = spark.createDataFrame([("aude",), ("aube",)], "a string")
    text = plan(fuzzy.near_pairs(words, words.withColumnRenamed("a", "b"), "a", "b"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_near_lookup_repeats_and_best(spark):
    names = spark.createDataFrame([("Aude", "aude"), ("AUDE", "aude"), ("x", "zzz"), ("n", None)], "name string, k string")
    table = spark.createDataFrame([("aude", 1), ("aube", 2), ("aude", 3), (None, 4)], "k string, code int")
    got = rows(fuzzy.near_lookup(names, table, "k", "d").select("name", "code", "d"))
    assert got == sorted([(n, c, d) for n in ("Aude", "AUDE") for c, d in ((1, 0), (2, 1), (3, 0))], key=repr)
    best = rows(fuzzy.near_lookup(names, table, "k", "d", best_only=True).select("name", "code", "d"))
    assert best == sorted([(n, c, 0) for n in ("Aude", "AUDE") for c in (1, 3)], key=repr)


# --- latest, top-k, chunks ---

def test_latest_version_reduces_before_the_shuffle(spark, plan):
    df = spark.range(0, 300, 1, 4).select((F.col("id") % 3).alias("k"), F.col("id").alias("version"))
    newest = latest_version(df, ["k"], [F.col("version").desc()])
    assert rows(newest) == [(0, 297), (1, 298), (2, 299)]
    assert "WindowGroupLimit" in plan(newest) and "Partial" in plan(newest)


def test_top_k(spark, plan):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 1.0), ("d", 3.0), ("e", 2.0)], "k string, v double")
    assert [r.k for r in top_k(df, "v", ascending=True).collect()] == ["a", "c", "e"]
    assert [r.k for r in top_k(df, "v", ascending=False, k=5).collect()] == ["d", "e", "a", "c", "b"]
    assert "TakeOrderedAndProject" in plan(top_k(df, "v", ascending=True))


def test_rows_are_numbered_with_one_shuffle(spark):
    df = spark.range(0, 1000, 1, 5).select((F.col("id") * 7919 % 10007).alias("o"))
    ordered = sorted(r.o for r in df.collect())
    numbered = chunks.number_rows(df, ["o"])
    assert sorted((r.position, r.o) for r in numbered.collect()) == list(enumerate(ordered, 1))
    assert "Window" not in numbered.select("o", "position").drop("position")._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("n, size", [(1, 5), (23, 5), (20, 5), (7, 1), (5, 100)])
def test_chunks(spark, n, size):
    df = spark.range(n).select(((F.col("id") * 7919) % 10007).alias("o"), F.concat(F.lit("n"), "id").alias("name")).repartition(3)
    ordered = [r.name for r in sorted(df.collect(), key=lambda r: r.o)]
    want = [(i // size + 1, " | ".join(ordered[i:i + size])) for i in range(0, n, size)]
    assert sorted(tuple(r) for r in chunks.join_in_chunks(df, "name", ["o"], size).collect()) == want


def test_chunk_arguments(spark):
    df = spark.range(12).select("id", F.col("id").cast("string").alias("name"))
    assert chunks.join_in_chunks(df, "name", ["id"], 5, first=2).count() == 2
    with pytest.raises(ValueError):
        chunks.join_in_chunks(df, "name", ["id"], 5, first=4)
    with pytest.raises(ValueError):
        chunks.join_in_chunks(df, "name", ["id"], 0)


# --- quality ---

def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "id int, t string")
    assert rows(quality.duplicates(df, "id")) == [(1, 2)]
    assert rows(quality.primary_key_violations(df, "id")) == sorted([(1, 2), (None, 1)], key=repr)
    assert rows(quality.missing(df, "t")) == [(1, None)]
    assert rows(quality.completeness(df)) == [("id", 0.75), ("t", 0.75)]
    assert rows(quality.columns_with_nulls(df)) == [("id", True), ("t", True)]
    assert rows(quality.columns_with_nulls(df.where("id = 2"))) == [("id", False), ("t", False)]
    quality.require_columns(df, ["id", "t"])
    with pytest.raises(ValueError):
        quality.require_columns(df, ["t", "id"])
    assert rows(quality.column_mismatches(df, ["id", "x", "y"])) == [(1, "t", "x"), (2, None, "y")]
    assert quality.column_mismatches(df, ["id", "t"]).count() == 0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3), (2.0, 4)], "v double, n int")
    assert rows(quality.completeness(df)) == [("n", 1.0), ("v", 0.5)]
    assert rows(quality.columns_with_nulls(df.where("n = 2"))) == [("n", False), ("v", True)]
    assert sorted(r.n for r in quality.missing(df, "v").collect()) == [2, 3]
