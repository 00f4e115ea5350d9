"""Join a fact table with a lookup table of unknown size, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylake.session import settle

# A lookup side is broadcast only below both bounds.
MAX_ROWS = 1_000_000
MAX_BYTES = 64 * 1024 * 1024
SALTS = 64
# A key is hot if it holds more than this share of the rows; there are at most 1 / HOT_SHARE such keys.
HOT_SHARE = 0.01
KINDS = ("inner", "left", "left_semi", "left_anti")

_VARIABLE = (T.StringType, T.BinaryType)
_NESTED = (T.ArrayType, T.StructType, T.MapType)


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(16 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, _NESTED):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        elif isinstance(field.dataType, _VARIABLE):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
    return total


def _size(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("n_bytes")]


def _within(n_rows: int, n_bytes: int, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    return n_rows <= (MAX_ROWS if max_rows is None else max_rows) and n_bytes <= (
        MAX_BYTES if max_bytes is None else max_bytes
    )


def fits_in_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Count the rows and bytes of `df` (one distributed aggregate) against the broadcast bounds."""
    return _within(*df.agg(*_size(df)).first(), max_rows, max_bytes)


def settle_and_measure(df: DataFrame, label: str) -> tuple[DataFrame, bool]:
    """Write `df` to the shared folder and say whether it fits a broadcast, counted while writing.

    A task that is run twice can only make the count too high, which errs on the safe side.
    """
    seen = Observation()
    table = settle(df.observe(seen, *_size(df)), label)
    return table, _within(seen.get["n_rows"], seen.get["n_bytes"])


def row_salt(df: DataFrame, salts: int = SALTS) -> Column:
    """A salt that a re-run task computes again: row content, plus the partition so that exact
    copies of one row still spread over as many salts as they have input splits."""
    hashable = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *hashable), F.lit(salts)).cast("int")


def _join(fact: DataFrame, lookup: DataFrame, on: str, how: str, key: Column | None, extra: Column | None = None):
    right = lookup.withColumnRenamed(on, "__key")
    condition = (F.col(on) if key is None else key) == F.col("__key")
    if extra is not None:
        condition = condition & extra
    return fact.join(right, condition, how).drop("__key")


def hot_keys(fact: DataFrame, key: Column, share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than `share` of the rows, as `__hot`: 1 / `share` rows at most, from one aggregate."""
    counts = settle(fact.groupBy(key.alias("__hot")).agg(F.count(F.lit(1)).alias("__n")), "key_counts")
    least = counts.agg(F.sum("__n") * F.lit(share)).first()[0] or 0
    return counts.where((F.col("__n") > F.lit(least)) & F.col("__hot").isNotNull()).select("__hot")


def spread_join(
    fact: DataFrame, lookup: DataFrame, on: str, how: str = "inner", key: Column | None = None, salts: int = SALTS
) -> DataFrame:
    """Shuffled join whose fact rows of a hot key go to `salts` tasks instead of one.

    Only the lookup rows of the measured hot keys are repeated, once per salt, so each fact row still
    meets all its partners; all other rows move once. Rows without a key meet nothing and are dealt out too.
    """
    value = F.col(on) if key is None else key
    hot = hot_keys(fact, value)
    is_hot = F.col("__hot").isNotNull()
    marked = fact.withColumn("__on", value).join(F.broadcast(hot), F.col("__on") == F.col("__hot"), "left")
    salted_fact = marked.withColumn("__salt", F.when(is_hot | F.col("__on").isNull(), row_salt(fact, salts)).otherwise(0)).drop("__hot")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_lookup = lookup.join(F.broadcast(hot), F.col(on) == F.col("__hot"), "left") \
        .withColumn("__salt_r", F.explode(copies)).drop("__hot")
    same_salt = F.col("__salt") == F.col("__salt_r")
    return _join(salted_fact, salted_lookup, on, how, F.col("__on"), same_salt).drop("__salt", "__salt_r", "__on")


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    key: Column | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join column `on` of the lookup with `key` (by default the fact column of the same name).

    The lookup is broadcast when it is proven small, else the join is shuffled with its hot keys salted.
    `small` is the outcome of a check the caller already made; otherwise it is made here. `how` is one
    that keeps or drops fact rows; joins that also keep unmatched lookup rows are not served.
    """
    if how not in KINDS:
        raise ValueError(f"how must be one of {', '.join(KINDS)}")
    if fits_in_broadcast(lookup) if small is None else small:
        return _join(fact, F.broadcast(lookup), on, how, key)
    return spread_join(fact, lookup, on, how, key)
