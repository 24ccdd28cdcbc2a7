"""Join building blocks with explicit size and skew handling.

* ``broadcast_if_small`` broadcasts a side only after proving its rows and bytes.
* ``lookup_join`` is a many-to-one join that refuses duplicate lookup keys (a left
  join must not multiply fact rows). A lookup above the limit goes through
  ``skewed_lookup_join``: hot fact keys, found by one partial count, meet their lookup
  rows by broadcast, and only the rest is shuffled.
* ``join_group_values`` attaches per-group values (counts, quartiles...) back to
  every row of a large table. A group table of proven small size is broadcast
  whole (the large table is not shuffled). Otherwise groups holding a large
  share of the rows are broadcast (their number is bounded by construction);
  rows of hot or null keys get their values there and never enter the shuffle
  join of the remaining groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.session import materialize, session_key

# Lookups up to this many rows are broadcast; bigger ones take a shuffle join.
DEFAULT_BROADCAST_ROWS = 1_000_000
# What is broadcast has at most this many bytes, measured, whatever its row count.
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
# At most this many groups count as hot (a group is hot above total / MAX_HOT rows).
DEFAULT_MAX_HOT_GROUPS = 10_000
# A per-group table up to this many rows is broadcast whole: the large side is
# then not shuffled at all.
DEFAULT_GROUP_BROADCAST_ROWS = 2_000_000


# Proofs already established in this process, for frames that read nothing but files: a
# lookup reused by many queries is checked once, a rewritten one is checked again. The key
# holds the session, the plan's hash, a digest of the scans' own file listings (path,
# length and time of each file, as listed when the frame was made: no call to the file
# system) and the check; a hit counts only if the kept frame has the same plan. Frames made
# in memory are checked every time: their plans do not tell their rows apart.
_PROOFS: dict[tuple, list[tuple[DataFrame, object]]] = {}


def _listing(df: DataFrame) -> str | None:
    """Digest of the file listings under ``df``; None if any of its inputs is not a listed file scan."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    seen = hashlib.sha256()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
            return None
        files = leaf.relation().location()
        if files.getClass().getSimpleName() != "InMemoryFileIndex":
            return None
        seen.update(files.allFiles().toString().encode())
    return seen.hexdigest()


def _proven(df: DataFrame, check: tuple, prove):
    """``prove()``, kept for equal frames over the same files."""
    listing = _listing(df)
    if listing is None:
        return prove()
    kept = _PROOFS.setdefault((session_key(df.sparkSession), df.semanticHash(), listing, check), [])
    for frame, proof in kept:
        if frame.sameSemantics(df):
            return proof
    proof = prove()
    kept.append((df, proof))
    return proof


def _width(f: T.StructField) -> Column:
    """Bytes of one cell, about."""
    cell = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(cell), F.lit(0)) + F.lit(16)
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(cell.cast("string")), F.lit(0)) * F.lit(2) + F.lit(32)
    return F.lit(16)


def _bytes(df: DataFrame) -> Column:
    return F.coalesce(F.sum(reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields])), F.lit(0))


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1)."""
    return _proven(df, ("rows", max_rows), lambda: df.limit(max_rows + 1).count() <= max_rows)


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes (reads at most max_rows + 1 rows)."""
    if max_rows <= 0:
        return False

    def prove() -> bool:
        size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), _bytes(df).alias("b")).first()
        return size["n"] <= max_rows and size["b"] <= max_bytes
    return _proven(df, ("fits", max_rows, max_bytes), prove)


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for ``df`` only when its rows and bytes are proven small."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def assert_unique_keys(lookup: DataFrame, keys: Sequence[str]) -> None:
    unique = _proven(lookup, ("unique", tuple(keys)), lambda: lookup.groupBy(*keys).count().where(F.col("count") > 1).isEmpty())
    if not unique:
        raise ValueError(f"lookup keys {list(keys)} are not unique; a left join would duplicate rows")


def _small_and_unique(lookup: DataFrame, keys: Sequence[str], max_rows: int) -> tuple[bool, bool | None]:
    """One job over at most ``max_rows + 1`` rows: (rows and bytes within the limits, keys unique
    among those rows). Uniqueness is only conclusive when the lookup is small."""
    def prove() -> tuple[bool, bool | None]:
        r = (lookup.limit(max_rows + 1).groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), _bytes(lookup).alias("b"))
             .agg(F.coalesce(F.sum("c"), F.lit(0)).alias("rows"), F.coalesce(F.max("c"), F.lit(0)).alias("most"),
                  F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")).first())
        all_seen = r["rows"] <= max_rows
        return all_seen and r["bytes"] <= DEFAULT_BROADCAST_BYTES and max_rows > 0, (r["most"] <= 1 if all_seen else None)
    return _proven(lookup, ("small-unique", tuple(keys), max_rows), prove)


def lookup_join(fact: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left",
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, check_unique: bool = True,
                max_hot_groups: int = DEFAULT_MAX_HOT_GROUPS) -> DataFrame:
    """Many-to-one join (``left`` or ``inner``) of a fact table to a dimension on ``keys``."""
    small, unique = _small_and_unique(lookup, keys, max_broadcast_rows)
    if check_unique:
        if unique is None:  # too big to decide from the bounded read: full check
            assert_unique_keys(lookup, keys)
        elif not unique:
            raise ValueError(f"lookup keys {list(keys)} are not unique; a left join would duplicate rows")
    if small:
        return fact.join(F.broadcast(lookup), list(keys), how)
    return skewed_lookup_join(fact, lookup, keys, how, max_hot_groups)


def hot_keys(fact: DataFrame, keys: Sequence[str], max_hot_groups: int = DEFAULT_MAX_HOT_GROUPS) -> DataFrame:
    """The keys that hold more than 1 / ``max_hot_groups`` of the rows of ``fact``, hence fewer than that many, with
    their row counts ``__w``. One partial count; written, as it is read more than once."""
    counts = materialize(fact.where(all_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__w")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("__w"), F.lit(0)).alias("t")).first()["t"]
    return counts.where(F.col("__w") * F.lit(max_hot_groups) > F.lit(total))


def skewed_lookup_join(fact: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left",
                       max_hot_groups: int = DEFAULT_MAX_HOT_GROUPS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``fact.join(lookup, keys, how)`` for a lookup with unique keys that is too big to broadcast.

    Rows of hot keys meet their lookup rows by broadcast where they are, rows with a null key need
    none, and only the others are shuffled: no task gets a key that holds more than
    1 / ``max_hot_groups`` of the rows. Hot lookup rows beyond ``max_bytes`` in sum stay with the others,
    the most frequent keys first.
    """
    keys = list(keys)
    if how not in ("left", "inner"):
        raise ValueError(f"many-to-one joins are left or inner, not {how}")
    added = [c for c in lookup.columns if c not in keys]
    columns = [*keys, *[c for c in fact.columns if c not in keys], *added]
    hot = hot_keys(fact, keys, max_hot_groups)
    rows = materialize(lookup.join(F.broadcast(hot), keys), "hot-lookup-rows")  # fewer than max_hot_groups
    while rows.agg(_bytes(rows).alias("b")).first()["b"] > max_bytes:
        rows = materialize(rows.orderBy(F.desc("__w"), *keys).limit(rows.count() // 2), "hot-lookup-rows")
    side = rows.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"__h{i}") for i, c in enumerate(added)], F.lit(True).alias("__hot"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)])
    step = fact.join(F.broadcast(side), on, "left")
    is_hot = F.col("__hot").isNotNull()
    missing = ~all_not_null(keys)
    settled = is_hot | missing if how == "left" else is_hot
    done = step.where(settled).select(*[F.col(c) for c in columns[:len(columns) - len(added)]], *[F.col(f"__h{i}").alias(c) for i, c in enumerate(added)])
    rest = step.where(~is_hot & ~missing).select(*fact.columns)
    return done.unionByName(rest.join(lookup, keys, how).select(*columns))


def semi_join(fact: DataFrame, fact_key: str, keys: DataFrame, key: str,
              anti: bool = False, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
              max_hot_groups: int = DEFAULT_MAX_HOT_GROUPS) -> DataFrame:
    """Rows of ``fact`` whose ``fact_key`` is (or with ``anti``, is not) in ``keys[key]``."""
    side = keys.select(F.col(key).alias("__k"))
    if fits_broadcast(side, max_broadcast_rows):
        return fact.join(F.broadcast(side), fact[fact_key] == F.col("__k"), "left_anti" if anti else "left_semi")
    known = side.where(F.col("__k").isNotNull()).distinct().select(F.col("__k").alias(fact_key), F.lit(True).alias("__in"))
    marked = skewed_lookup_join(fact, known, [fact_key], "left", max_hot_groups)
    return marked.where(F.col("__in").isNull() if anti else F.col("__in").isNotNull()).select(*fact.columns)


def all_not_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def join_group_values(df: DataFrame, keys: Sequence[str], groups: DataFrame, weight: str,
                      values: Sequence[str], *, null_safe: bool = False,
                      max_hot_groups: int = DEFAULT_MAX_HOT_GROUPS,
                      broadcast_max_rows: int = DEFAULT_GROUP_BROADCAST_ROWS,
                      persist_groups: bool = True, unread: bool = False) -> DataFrame:
    """Left-join per-group ``values`` from ``groups`` (one row per key) onto ``df``.

    ``weight`` is the number of ``df`` rows in each group. Keys with a null part
    get null values unless ``null_safe`` (then null matches null).

    The group table is aggregated once and persisted (it is read up to three
    times below). When it has at most ``broadcast_max_rows`` rows (and the bytes that
    ``fits_broadcast`` allows) it is broadcast whole and ``df`` is not shuffled; otherwise hot groups are broadcast, and only
    rows of the other groups are shuffled. A query that reads none of ``values`` is planned without the join of the other
    groups (and without any, where no group is hot).

    ``unread``: the caller reads none of ``values``. Nothing is written or proven while the join is planned; a query that
    reads them all the same gets them by a plain join.
    """
    keys = list(keys)
    values = list(values)
    gk = [f"__gk{i}" for i in range(len(keys))]
    g = groups.select(*[F.col(k).alias(a) for k, a in zip(keys, gk)], F.col(weight).alias("__w"), *[F.col(v) for v in values])
    if persist_groups and not unread:
        g = materialize(g, "group-values")

    # by name: the group columns have names of their own, and ``df`` may already hold earlier joins of this kind
    pairs = list(zip(keys, gk, strict=True))
    cond: list[Column] = [F.col(k).eqNullSafe(F.col(a)) if null_safe else F.col(k) == F.col(a) for k, a in pairs]

    def one_per_key(rows: DataFrame) -> DataFrame:
        """Grouped by the keys again, where joined: so the plan shows that the join adds no rows, and a query that reads none
        of ``values`` is planned without it."""
        return rows.drop("__w") if null_safe else rows.groupBy(*gk).agg(*[F.first(v).alias(v) for v in values])

    if unread:
        return df.join(one_per_key(g), cond, "left").select(*df.columns, *values)
    if fits_broadcast(g, broadcast_max_rows):
        small = F.broadcast(one_per_key(g))
        return df.join(small, cond, "left").select(*df.columns, *values)

    # Hot groups: more than total/max_hot rows each, hence at most max_hot of them.
    total = g.select(F.sum("__w")).scalar()
    is_hot = F.col("__w") * F.lit(max_hot_groups) > total
    hot = g.where(is_hot).select(*gk, F.lit(True).alias("__is_hot"),
                                 *[F.col(v).alias(f"__h_{v}") for v in values])
    cold = one_per_key(g.where(~is_hot))
    if not null_safe and hot.isEmpty():
        # No group is hot: ``df`` is read once. Rows with a null key match nothing; adaptive execution splits them.
        return df.join(cold, cond, "left").select(*df.columns, *values)

    # 1) hot keys: broadcast hash join, no shuffle of df
    hot_b = F.broadcast(hot)
    step = df.join(hot_b, cond, "left").drop(*gk)
    hot_hit = F.col("__is_hot").isNotNull()
    key_ok = F.lit(True) if null_safe else all_not_null(keys)
    settled = hot_hit | ~key_ok
    done = step.where(settled).select(*df.columns, *[F.col(f"__h_{v}").alias(v) for v in values])

    # 2) other keys: rows that can match no cold group are not shuffled at all
    rest = step.where(~settled).select(*df.columns)
    joined = rest.join(cold, cond, "left").select(*df.columns, *values)
    return done.unionByName(joined)


def attach_group_count(df: DataFrame, keys: Sequence[str], name: str, *, null_safe: bool = False,
                       max_hot_groups: int = DEFAULT_MAX_HOT_GROUPS,
                        broadcast_max_rows: int = DEFAULT_GROUP_BROADCAST_ROWS) -> DataFrame:
    """Add ``name`` = number of rows sharing this row's ``keys`` (a group transform-count).

    Counting is a partial (map-side) aggregation, so hot keys cost nothing there;
    the join back is skew-safe (see ``join_group_values``). A row with a null key
    part gets null unless ``null_safe``.
    """
    keys = list(keys)
    src = df if null_safe else df.where(all_not_null(keys))
    counts = src.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return join_group_values(df, keys, counts, name, [name], null_safe=null_safe,
                             max_hot_groups=max_hot_groups,
                             broadcast_max_rows=broadcast_max_rows)
