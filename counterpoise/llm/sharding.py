"""Sharding by a k-d tree over document metadata (DataFrame functions only).

Units are groups of equal texts, so copies stay together.  The tree is grown from
the root: a node that must become ``n`` shards is cut along its widest metadata
dimension at the weighted median (weight = bytes) of its ``n // 2 : n - n // 2``
share, until each leaf is one shard, i.e. about ``total / shards`` bytes.

Medians are distributed: one aggregation sums the bytes of 4096 bins of the cut
dimension for all nodes of a level, the bin that holds the median is refined the
same way, and only these sums (at most ``shards * 4096`` rows) reach the driver.
Equal coordinates are ordered by a hash, so ties can be cut anywhere.

Hot groups: a group heavier than ``1 / 64`` of a shard is "heavy" (there are at
most ``64 * shards``); each is placed whole on the side of its coordinate as far as
that side has room, and the median of the rest makes up the difference.  A group
heavier than three quarters of a shard cannot stay whole without unbalancing the shards: its
rows are dealt out as light units by a hash of their id.

Defined cases: null text has size 1 (no bytes plus 1) and counts as the empty text;
null metadata or a missing metadata column has coordinate 0; repeated rows get
slots of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterpoise.llm.common import gapless, staged

DIMENSIONS = ("doc_id", "size", "lang", "source")
_BITS = 12  # bins of one refinement step: 2 ** 12
_LEVELS = 4  # refinement steps of a 48-bit coordinate (20 bits of value, 28 of tie hash)
_HEAVY = 64


def _coordinates(units: DataFrame, dims: list[str]) -> list[str]:
    """Per dimension a value in [0, 1): ranks of numbers by range, of strings by hash."""
    lo_hi = units.agg(*[F.min(F.col(d).cast("double")).alias(f"lo_{d}") for d in ("doc_id", "size")],
                      *[F.max(F.col(d).cast("double")).alias(f"hi_{d}") for d in ("doc_id", "size")]).first()
    out = []
    for d in dims:
        if d in ("doc_id", "size"):
            lo, hi = lo_hi[f"lo_{d}"] or 0.0, lo_hi[f"hi_{d}"] or 0.0
            if d == "size":
                x = f"ln(size / {max(lo, 1.0)!r}D) / {_ln(max(hi, 1.0) / max(lo, 1.0))!r}D"
            else:
                x = f"(cast({d} as double) - {lo!r}D) / {max(hi - lo, 1.0)!r}D"
        else:
            x = f"cast(pmod(xxhash64({d}), 1048576) as double) / 1048576D"
        # 20 bits of the coordinate, then 28 bits of tie hash.
        out.append(f"(least(cast(greatest(coalesce({x}, 0D), 0D) * 1048576 as bigint), 1048575) * 268435456 + tie)")
    return out


def _ln(x: float) -> float:
    import math

    return max(math.log(x), 1e-9)


def _node_expr(cuts: dict[int, tuple[str, int]], nodes: list[int], base: str) -> str:
    """SQL for a light unit's node one level down: cut nodes split, finished ones go left."""
    cases = " ".join(
        f"WHEN {n} THEN CASE WHEN {cuts[n][0]} < {cuts[n][1]} THEN {2 * n} ELSE {2 * n + 1} END" if n in cuts else f"WHEN {n} THEN {2 * n}"
        for n in nodes)
    return f"CASE {base} {cases} END"


def kd_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
              metadata: tuple[str, ...] = ("lang", "source"), whole_share: float = 0.75) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row of ``docs``.

    Groups of equal texts stay together up to ``whole_share`` of a shard's bytes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("g"),
        *[(F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c) for c in metadata],
    )
    rows = staged(rows, "shard-rows")
    n_rows, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    target = total / shards
    whole = max(whole_share * target, 1.0)
    group = ["g", "text_crc32", "size"]
    big = rows.groupBy(*group).agg(F.sum("size").alias("w")).where(F.col("w") > whole).select(*group)
    # Groups over that share of a shard (a bounded number: fewer than shards / whole_share): their rows become units of their own.
    big_keys = [r["g"] for r in big.collect()]
    salt: Column = F.lit(0).cast("long")
    if big_keys:
        salt = F.when(F.col("g").isin(big_keys), F.pmod(F.xxhash64("doc_id"), F.lit(64 * 64 * shards))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("salt", salt)
    unit = [*group, "salt"]
    first = F.min(F.struct("doc_id", *metadata)).alias("m")
    units = rows.groupBy(*unit).agg(F.sum("size").alias("w"), first)
    units = units.select(*unit, "w", "m.*", F.pmod(F.xxhash64("g", "text_crc32", "size", "salt"), F.lit(268435456)).alias("tie"))
    units = staged(units, "shard-units")

    dims = [("doc_id"), "size", *metadata]
    keys = _coordinates(units, dims)
    heavy_over = target / _HEAVY
    heavy = [(r["g"], r["salt"], r["w"], [r[f"k{i}"] for i in range(len(keys))]) for r in
             units.where(F.col("w") > heavy_over).select("g", "salt", "w", *[F.expr(k).alias(f"k{i}") for i, k in enumerate(keys)]).collect()]
    heavy_node = {(g, s): 0 for g, s, _, _ in heavy}
    light = units.where(F.col("w") <= heavy_over).select(*unit, "w", *[F.expr(k).alias(f"k{i}") for i, k in enumerate(keys)])
    spans = {0: shards}  # node -> shards it becomes
    base = "0"
    full = 1 << (_BITS * _LEVELS)
    while any(n > 1 for n in spans.values()):
        nodes = light.withColumn("node", F.expr(base))
        stats = {r["node"]: r for r in nodes.groupBy("node").agg(
            F.sum("w").alias("w"), *[F.min(f"k{i}").alias(f"lo{i}") for i in range(len(keys))],
            *[F.max(f"k{i}").alias(f"hi{i}") for i in range(len(keys))]).collect()}
        cuts: dict[int, tuple[str, int]] = {}
        goal: dict[int, float] = {}
        dim_of: dict[int, int] = {}
        for node, n in spans.items():
            if n < 2:
                continue
            s = stats.get(node)
            dim = max(range(len(keys)), key=lambda i: (s[f"hi{i}"] - s[f"lo{i}"], -i)) if s else 0
            mine = sorted((h for h in heavy if heavy_node[h[0], h[1]] == node), key=lambda h: h[3][dim])
            weight = (s["w"] if s else 0) + sum(h[2] for h in mine)
            left = weight * (n // 2) / n
            # Heavy units fill the left side in coordinate order, then the right, each within its room.
            room = {0: left, 1: weight - left}
            middle = ((s[f"lo{dim}"] + s[f"hi{dim}"]) // 2) if s else 0
            for h in sorted(mine, key=lambda h: -h[2]):
                side = 0 if h[3][dim] < middle else 1
                if room[side] < h[2] and room[1 - side] > room[side]:
                    side = 1 - side
                room[side] -= h[2]
                heavy_node[h[0], h[1]] = (node, side)  # type: ignore[assignment]
            goal[node] = max(0.0, room[0])
            dim_of[node] = dim
        lower = {node: 0 for node in goal}
        done: dict[int, int] = {}
        for step in range(_LEVELS):
            todo = [n for n in goal if n not in done]
            if not todo:
                break
            shift = _BITS * (_LEVELS - 1 - step)
            key = "CASE " + " ".join(f"WHEN node = {n} THEN k{dim_of[n]} - {lower[n]}" for n in todo) + " END"
            span = 1 << (shift + _BITS)
            binned = (nodes.where(F.col("node").isin(todo)).withColumn("rel", F.expr(key))
                      .where((F.col("rel") >= 0) & (F.col("rel") < span))
                      .groupBy("node", F.shiftright("rel", shift).alias("bin")).agg(F.sum("w").alias("w")).collect())
            for n in todo:
                acc, found = 0, None
                for b, w in sorted((r["bin"], r["w"]) for r in binned if r["node"] == n):
                    if acc + w > goal[n]:
                        found = (b, w)
                        break
                    acc += w
                if found is None:  # everything fits left
                    done[n] = lower[n] + span
                    continue
                goal[n] -= acc
                lower[n] += found[0] << shift
                if step == _LEVELS - 1 or found[1] <= heavy_over / 64:
                    done[n] = lower[n] + ((1 << shift) if goal[n] * 2 >= found[1] else 0)
        for n in goal:
            cuts[n] = (f"k{dim_of[n]}", min(done.get(n, lower[n]), full))
        base = _node_expr(cuts, list(spans), base)
        heavy_node = {k: (v[0] * 2 + v[1] if isinstance(v, tuple) else v * 2) for k, v in heavy_node.items()}
        spans = {m: k for n, size in spans.items() for m, k in
                 (((2 * n, size // 2), (2 * n + 1, size - size // 2)) if size > 1 else ((2 * n, 1),))}
    shard_of = {n: i for i, n in enumerate(sorted(spans))}
    leaf = F.expr("CASE " + " ".join(f"WHEN n = {n} THEN {i}" for n, i in shard_of.items()) + " END").cast("int")
    placed = light.withColumn("n", F.expr(base)).select(*unit, leaf.alias("shard"))
    if heavy:
        names = "CASE " + " ".join(f"WHEN g = {g} AND salt = {s} THEN {shard_of[heavy_node[g, s]]}" for g, s, _, _ in heavy) + " END"
        placed = placed.unionByName(units.where(F.col("w") > heavy_over).select(*unit, F.expr(names).cast("int").alias("shard")))
    out = staged(rows.join(placed, unit).select("doc_id", "size", "text_crc32", "shard"), "shard-placed")
    return gapless(out, ["shard"], ["doc_id", "text_crc32"], "slot", n_rows).select("doc_id", "size", "text_crc32", "shard", "slot")
