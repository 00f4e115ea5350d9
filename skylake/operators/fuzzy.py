"""Names within one edit of each other, found by equi-joins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylake.operators.lookup import lookup_join, settle_and_measure

# Pairs whose shorter name has up to this many characters are met by the names without one character, longer
# ones by equal halves: a half of a long name says as much, and costs one pass instead of one per character.
SHORT = 64


def _without(name: Column, position: Column) -> Column:
    return F.concat(F.substring(name, 1, position - 1), F.substring(name, position + 1, F.length(name)))


# What a probe says of its text: the whole name, the name without the character at a position, the
# left name without some character, the right name without some character, a first half, a second half.
EQUAL, SUBSTITUTED, LEFT_SHORTER, RIGHT_SHORTER, FIRST, SECOND = range(6)


def _probe(text: Column, position: Column | int, kind: int) -> Column:
    place = F.lit(position) if isinstance(position, int) else position
    return F.xxhash64(text, place.cast("int"), F.lit(kind))


def _tagged(probes: Column, equal: bool) -> Column:
    return F.transform(probes, lambda p: F.struct(p.alias("__probe"), F.lit(equal).alias("__equal")))


def _short_probes(name: Column, whole: int, shorter: int) -> Column:
    """Probes of a name that may pair with one of `SHORT` characters or fewer; they meet every pair exactly once, an equal one by
    the probe that is tagged so."""
    positions = F.when(F.length(name) > 0, F.sequence(F.lit(1), F.length(name))).otherwise(F.array().cast("array<int>"))
    substituted = F.transform(positions, lambda i: _probe(_without(name, i), i, SUBSTITUTED))
    cut = F.array_distinct(F.transform(positions, lambda i: _probe(_without(name, i), 0, shorter)))
    rest = F.concat(F.array(_probe(name, 0, whole)), substituted, cut)
    return F.concat(_tagged(F.array(_probe(name, 0, EQUAL)), True), _tagged(rest, False))


def _long_probes(name: Column) -> Column:
    """Probes of a name that may pair with one of more than `SHORT` characters: for either length that the shorter
    of the two can have, its first half and the rest of it. One edit leaves one of them whole in both names."""
    def halves(least: Column) -> Column:
        half = F.floor(least / 2).cast("int")
        return F.when(least > SHORT, F.array(
            _probe(F.substring(name, 1, half), least, FIRST),
            _probe(F.substring(name, F.length(name) - (least - half) + 1, least - half), least, SECOND),
        )).otherwise(F.array().cast("array<bigint>"))

    return _tagged(F.concat(halves(F.length(name)), halves(F.length(name) - 1)), False)


def _probed(names: DataFrame, name: str, whole: int, shorter: int) -> DataFrame:
    """(name, `__probe`, `__equal`, `__long`) of all probes of the names."""
    size = F.length(name)
    short = names.where(size <= SHORT + 1).select(name, F.inline(_short_probes(F.col(name), whole, shorter)), F.lit(False).alias("__long"))
    long = names.where(size > SHORT).select(name, F.inline(_long_probes(F.col(name))), F.lit(True).alias("__long"))
    return short.union(long)


def near_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """All pairs (left, right, distance) of names at edit distance 0 or 1, each pair once.

    `left` and `right` hold distinct names. Two names are one edit apart when they agree after
    dropping the character at the same position of both (substitution), or when one equals the
    other with one character dropped; long names are met by halves instead. Each case is an equality of
    64-bit probes, so the join is an equi-join, and every pair that it meets is verified. The probes of the right
    side are written and measured first, and broadcast only if they fit. Only pairs of long names can be met more than
    once and are made distinct.
    """
    a = _probed(left, left_name, RIGHT_SHORTER, LEFT_SHORTER)
    b, small = settle_and_measure(_probed(right, right_name, LEFT_SHORTER, RIGHT_SHORTER).drop("__equal"), "probes")

    def met(long: bool) -> DataFrame:
        of = F.col("__long") == F.lit(long)
        probes = b.where(of).drop("__long")
        return a.where(of).drop("__long").join(F.broadcast(probes) if small else probes, "__probe")

    # From 65 characters on a name has probes of both sorts; the shorter name of a pair says which of them count.
    short = F.least(F.length(left_name), F.length(right_name)) <= SHORT
    same = F.col(left_name) == F.col(right_name)
    pairs = met(False).where(short & (F.col("__equal") == same)).select(left_name, right_name)
    pairs = pairs.union(met(True).where(~short).select(left_name, right_name).distinct())
    return pairs.withColumn("distance", F.levenshtein(left_name, right_name, 1)).where(F.col("distance") >= 0)


def near_lookup(
    names: DataFrame, lookup: DataFrame, on: str, distance: str, best_only: bool = False, small: bool | None = None
) -> DataFrame:
    """Inner join of `names` and `lookup` on `on` texts at edit distance 0 or 1.

    Distinct texts are compared, then both sides are joined to the pairs found. `best_only` keeps
    the closest lookup texts of each name.
    """
    left = names.select(F.col(on).alias("__name")).where("__name is not null").distinct()
    right = lookup.select(F.col(on).alias("__target")).where("__target is not null").distinct()
    pairs = near_pairs(left, right, "__name", "__target").withColumnRenamed("distance", distance)
    if best_only:
        best = pairs.groupBy("__name").agg(F.min(distance).alias(distance))
        pairs = pairs.join(best, ["__name", distance])
    pairs = lookup_join(pairs, lookup.withColumnRenamed(on, "__target"), "__target", small=small)
    return lookup_join(names, pairs.drop("__target").withColumnRenamed("__name", on), on)
