"""Join shapes.

No broadcast hints: Spark broadcasts a side only while its known size is under
``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges beyond it. Hot keys of
large joins are split at run time by AQE, or ahead of it with ``hot_key_join``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def harmonised(c: str) -> Column:
    """Key as trimmed text, for inputs that disagree on its type."""
    return F.trim(F.col(c).cast("string"))


def snapshot_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    day: str = "dt",
    how: str = "left",
    hot_share: float | None = None,
) -> DataFrame:
    """Attributes of the same day's snapshot: the day is always part of the key.

    With ``hot_share`` the facts of keys above that share are spread before the join,
    for sessions where AQE may not split them.
    """
    snapshot = dim.select(day, *keys, *attributes)
    if hot_share is not None:
        return hot_key_join(fact, snapshot, [day, *keys], how, hot_share)
    return fact.join(snapshot, [day, *keys], how)


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and so would fan facts out."""
    counts = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def fallback_key_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    candidates: Sequence[str],
    on: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Join on the first non-null candidate; the computed key stays as ``key``."""
    return fact.withColumn(key, F.coalesce(*candidates)).join(dim, [*on, key], how)


def declarative_merge(pool: dict[str, DataFrame], spec: dict) -> DataFrame:
    """Merge two named inputs as a spec says.

    ``{left, right, how, on | left_on + right_on, suffixes}``. Columns both sides
    have, other than the join keys, get the suffixes. Keys match nulls with nulls.
    """
    if not spec.get("left") or not spec.get("right"):
        raise ValueError("a merge names 'left' and 'right'")
    how = spec.get("how", "left")
    if how not in ("left", "right", "inner", "outer", "cross"):
        raise ValueError(f"unknown merge type {how!r}")
    for side in ("left", "right"):
        if spec[side] not in pool:
            raise KeyError(f"{spec[side]!r} not found, available: {sorted(pool)}")
    left, right = pool[spec["left"]], pool[spec["right"]]
    as_list = lambda v: [v] if isinstance(v, str) else list(v)
    if "on" in spec:
        left_on = right_on = as_list(spec["on"])
    elif "left_on" in spec and "right_on" in spec:
        left_on, right_on = as_list(spec["left_on"]), as_list(spec["right_on"])
    elif how == "cross":
        left_on = right_on = []
    else:
        raise ValueError("a merge needs 'on', or 'left_on' and 'right_on'")
    same_key = left_on == right_on
    merged_keys = set(left_on) if same_key else set()
    suffix_l, suffix_r = spec.get("suffixes", ("_left", "_right"))
    clash = (set(left.columns) & set(right.columns)) - merged_keys
    name_l = {c: c + suffix_l if c in clash else c for c in left.columns}
    name_r = {c: c + suffix_r if c in clash else c for c in right.columns}
    if how == "cross":
        return grid_product(left.withColumnsRenamed(name_l), right.withColumnsRenamed(name_r))

    tagged = right.select(*[F.col(c).alias(f"__r_{c}") for c in right.columns])
    cond = reduce(
        lambda a, b: a & b,
        [F.col(l).eqNullSafe(F.col(f"__r_{r}")) for l, r in zip(left_on, right_on)],
    )
    joined = left.join(tagged, cond, how)
    out = []
    for c in left.columns:
        value = F.col(c)
        if c in merged_keys:
            value = F.coalesce(F.col(c), F.col(f"__r_{c}"))
        out.append(value.alias(name_l[c]))
    out += [F.col(f"__r_{c}").alias(name_r[c]) for c in right.columns if c not in merged_keys]
    return joined.select(*out)


def override_rate(overrides_json: Column, key: Column, default: Column) -> Column:
    """The key's own rate from a JSON map, else the default; a malformed map has none."""
    parsed = F.from_json(overrides_json, "map<string,double>")
    return F.coalesce(F.try_element_at(parsed, key.cast("string")), default)


def content_hash(df: DataFrame) -> Column:
    """Hash over the columns that can be hashed: maps, and what holds them, cannot."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*[F.col(c) for c in plain], F.lit(0)), F.lit(1 << 31))


def grid_product(left: DataFrame, right: DataFrame, blocks: int | None = None) -> DataFrame:
    """Every left row with every right row, as an equi-join on a block number.

    For configuration grids whose product is the wanted result; ``left`` is the shorter
    side. The right side is spread over the blocks by its content and its input split, and
    the left side copied once per block, so the work splits into as many joinable parts as
    there are shuffle partitions instead of a cartesian pairing. While the copies stay
    under the broadcast threshold, the right side is not shuffled at all.
    """
    if blocks is None:
        blocks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(content_hash(right) + F.spark_partition_id(), F.lit(blocks)).cast("int")
    spread = right.withColumn("__block", block)
    copied = left.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return copied.join(spread, "__block").drop("__block")


def hot_key_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot_share: float = 0.01,
    parts: int = 32,
) -> DataFrame:
    """Join with the facts of hot keys spread over ``parts`` tasks.

    A key is hot when it holds more than ``hot_share`` of the fact rows, so there are
    fewer than ``1 / hot_share`` of them: a proven bound, which is why their list may
    be broadcast. Only their dimension rows are copied, ``parts`` times; all other
    keys join as they are. The result equals the plain join.
    """
    if how not in ("left", "inner"):
        raise ValueError("hot keys can be spread for left and inner joins")
    keys = list(keys)
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.select(F.sum("__n").alias("n")).scalar()
    hot = F.broadcast(
        counts.where(F.col("__n") > total * F.lit(hot_share)).select(*keys, F.lit(True).alias("__hot"))
    )
    # Content and input split decide the part, never the order of rows, so a task that
    # runs again sends every row where it went before; exact copies spread as well.
    spread = F.pmod(content_hash(fact) + F.spark_partition_id(), F.lit(parts))
    salted = join_null_safe(fact, hot, keys).withColumn(
        "__salt", F.when(F.col("__hot"), spread).otherwise(F.lit(0)).cast("int")
    )
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    copied = dim.join(hot, keys, "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    return salted.drop("__hot").join(copied, [*keys, "__salt"], how).drop("__salt")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which a null key matches a null key."""
    tagged = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(tagged, cond, how).drop(*[f"__r_{k}" for k in keys])
