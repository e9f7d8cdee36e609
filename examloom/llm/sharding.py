"""Shards of even row counts by balanced label propagation over links between equal texts.

Documents start dealt evenly over the shards.  In each round every group of equal texts asks
to move to the shard where most of it already is (each member has all others as neighbours, so
their counts per shard are its neighbours' votes).  Moves are granted in exchange for each
other, around circles of shards, or for unlinked documents, so the sizes never change.  When none is
granted, groups turn to their best shard with unlinked documents.  In the end the groups
still split are laid one after the other over the places they hold, which splits one per
border of shards at most, and the rounds go on from there.  The rounds work on one row per group
and shard with a count; documents are placed at the end, by their number within their group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from examloom.llm.common import attach, running, staged

SHARDS = 24
SEED = 11


def _described(docs: DataFrame, seed: int) -> DataFrame:
    text = F.coalesce(F.col("`text`").cast("string"), F.lit(""))
    rows = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select(
        "doc_id", (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.sha2("text", 256).alias("text_id"),
        F.xxhash64("doc_id", F.lit(seed)).alias("place"))


def _moves(cells: DataFrame, blocked: set[int], seed: int, n_round: int) -> DataFrame:
    """text_id, shard, to, n, order: the moves that would bring each group together.

    A group's target is its fullest shard that is not blocked; its smaller cells go there."""
    group = W.partitionBy("text_id")
    key = F.struct("n", F.xxhash64("text_id", "shard", F.lit(seed + n_round)).alias("h"), "shard")
    target = F.max(F.when(~F.col("shard").isin(sorted(blocked)), key) if blocked else key).over(group)
    wished = cells.withColumn("_key", key).withColumn("_to", target)
    return wished.filter(F.col("_to").isNotNull() & (F.col("_key") < F.col("_to"))).select(
        "text_id", "shard", F.col("_to.shard").alias("to"), "n",
        F.xxhash64("text_id", "shard", F.lit(seed + n_round)).alias("order"))


def _circle(flows: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Flows around a circle of shards, if there is one: of two shards, else of any number."""
    for s, t in flows:
        if (t, s) in flows:
            return [(s, t), (t, s)]
    after: dict[int, list[int]] = {}
    for s, t in flows:
        after.setdefault(s, []).append(t)
    over: set[int] = set()

    def walk(path: list[int]) -> list[int]:
        for t in after.get(path[-1], ()):
            if t in path:
                return path[path.index(t):] + [t]
            if t not in over and (found := walk(path + [t])):
                return found
        over.add(path[-1])
        return []

    for s in list(after):
        if s not in over and (circle := walk([s])):
            return list(zip(circle, circle[1:]))
    return []


def _balanced(wished: dict[tuple[int, int], int], room: dict[int, int]) -> dict[tuple[int, int], int]:
    """What of the wished flows between shards can happen: around circles, then into free places."""
    left, granted, room = {k: n for k, n in wished.items() if n > 0}, {}, dict(room)

    def grant(flow, n):
        granted[flow] = granted.get(flow, 0) + n
        left[flow] -= n
        if not left[flow]:
            del left[flow]

    while circle := _circle(left):
        n = min(left[flow] for flow in circle)
        for flow in circle:
            grant(flow, n)
    while free := [(s, t) for s, t in left if room[t] > 0]:
        s, t = free[0]
        n = min(left[s, t], room[t])
        grant((s, t), n)
        room[t] -= n
        room[s] += n
    return granted


def _exchanged(wishes: DataFrame, granted: dict[tuple[int, int], int], n: int, shards: int) -> DataFrame:
    """text_id, shard, to, n: the granted part of the moves."""
    most = F.create_map(*[F.lit(x).cast("long") for (s, t), k in granted.items() for x in (s * shards + t, k)])
    flow = (F.col("shard") * shards + F.col("to")).cast("long")
    queued = running(wishes, ["shard", "to"], "order", F.col("n"), "before", int(n ** 0.5) + 1, ["text_id"])
    free = F.coalesce(F.try_element_at(most, flow), F.lit(0).cast("long"))
    return staged(queued.withColumn("n", F.least("n", F.greatest(F.lit(0).cast("long"), free - F.col("before"))))
                  .filter("n > 0").select("text_id", "shard", "to", "n"), "moves")


def _with_parts(cells: DataFrame) -> DataFrame:
    """text_id, shard, n, and parts: the number of the group's cells."""
    return staged(cells.withColumn("parts", F.count("*").over(W.partitionBy("text_id"))), "cells")


def _exchange(cells: DataFrame, room: dict[int, int], seed: int) -> tuple[list[DataFrame], DataFrame]:
    """Cells of groups that came together, and of those still split when no move is granted any more.

    Every granted move raises the number of linked pairs that share a shard, so the rounds end."""
    whole, n_round, any_shard = [], 0, True
    cells = _with_parts(cells)
    while True:
        whole.append(cells.filter("parts = 1").drop("parts"))
        cells = cells.filter("parts > 1").drop("parts")
        granted = {}
        while not granted:
            # Later only shards with free places, as then every one of them grants what it can.
            blocked = set() if any_shard else {s for s, free in room.items() if free <= 0}
            if len(blocked) == len(room):
                return whole, cells
            wishes = staged(_moves(cells, blocked, seed, n_round), "wishes")
            n_round += 1
            flows = wishes.groupBy("shard", "to").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
            granted = _balanced({(r["shard"], r["to"]): r["n"] for r in flows}, room)  # at most shards * shards
            if not granted and not any_shard:
                return whole, cells
            any_shard = any_shard and bool(granted)
        moved = _exchanged(wishes, granted, sum(r["k"] for r in flows), len(room))
        for (s, t), n in granted.items():  # who comes takes a free place, who leaves frees one
            room[t] -= n
            room[s] += n
        changes = cells.unionByName(moved.select("text_id", F.col("to").alias("shard"), "n")).unionByName(
            moved.select("text_id", "shard", (-F.col("n")).alias("n")))
        cells = _with_parts(changes.groupBy("text_id", "shard").agg(F.sum("n").alias("n")).filter("n > 0"))


def _laid(cells: DataFrame, seed: int) -> DataFrame | None:
    """The cells when their groups lie one after the other over the places they hold, if that gains.

    Groups larger than any shard's places come first, so that they fill whole shards."""
    held = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    if len(held) < 2:
        return None
    square = F.sum(F.col("n").cast("double") * F.col("n"))
    groups = staged(cells.groupBy("text_id").agg(F.sum("n").alias("m")), "split-groups")
    # Fewer than there are shards.
    large = groups.filter(F.col("m") > max(held.values())).orderBy(F.desc("m"), "text_id").collect()
    begins, end = [], 0
    for r in large:
        begins.append((r["text_id"], end))
        end += r["m"]
    known = F.lit(None).cast("long")
    for text_id, begin in begins:
        known = F.coalesce(known, F.when(F.col("text_id") == text_id, F.lit(begin).cast("long")))
    line = groups.withColumn("order", F.xxhash64("text_id", F.lit(seed))).withColumn("known", known)
    weight = F.when(F.col("known").isNull(), F.col("m")).otherwise(F.lit(0))
    line = running(line, [], "order", weight, "begin", int(groups.count() ** 0.5) + 1, ["text_id"])
    begin = F.coalesce("known", F.col("begin") + end)
    pieces, low = [], 0
    for s, n in sorted(held.items(), key=lambda x: (-x[1], x[0])):
        pieces.append(F.struct(F.lit(s).cast("int").alias("shard"), (
            F.least(begin + F.col("m"), F.lit(low + n).cast("long"))
            - F.greatest(begin, F.lit(low).cast("long"))).alias("n")))
        low += n
    laid = staged(line.select("text_id", F.explode(F.array(*pieces)).alias("p")).select("text_id", "p.shard", "p.n")
                  .filter("n > 0"), "cells")
    return laid if laid.agg(square).first()[0] > cells.agg(square).first()[0] else None


def propagate(cells: DataFrame, room: dict[int, int], seed: int = SEED):
    """Cells (text_id, shard, n) and free places per shard after the rounds.

    The room and the flows between shards, shards * shards numbers, are all that comes to the
    driver.  The number of linked pairs that share a shard only rises; it ends when none can be gained.
    """
    whole = []
    while True:
        done, cells = _exchange(cells, room, seed)
        whole += done
        laid = _laid(cells, seed)
        if laid is None:
            break
        cells = laid
    for part in whole:
        cells = cells.unionByName(part)
    return cells, room


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law `rows`, shard, slot, grown_shard (null).

    The shards' row counts differ by one at most, whatever the groups' sizes: a group larger than a
    shard fills several.  Slots are numbered from 0 without gaps.  Null texts are equal to
    empty ones; rows may repeat, ids may be null; an empty table gives no rows.
    """
    rows = staged(_described(docs, seed), "shard-rows")
    groups = staged(rows.groupBy("text_id").agg(F.count("*").alias("m")), "text-groups")
    total = groups.agg(F.sum("m")).first()[0] or 0
    buckets = int(total ** 0.5) + 1
    ties = ["doc_id", "text_id"]
    sized = attach(rows, groups, "text_id", "m")
    dealt = running(sized, [], "place", F.lit(1), "number", buckets, ties)
    dealt = staged(dealt.withColumn("shard", (F.col("number") % shards).cast("int")).drop("number"), "dealt")
    linked, single = dealt.filter("m > 1"), dealt.filter("m = 1")
    cells = staged(linked.groupBy("text_id", "shard").agg(F.count("*").alias("n")), "cells")
    held = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    room = {s: total // shards + (s < total % shards) - held.get(s, 0) for s in range(shards)}
    cells, room = propagate(cells, room, seed)

    # Members of a group are numbered and take the places of its cells, at most one per shard.
    ends = W.partitionBy("text_id").orderBy("shard")
    places = cells.withColumn("end", F.sum("n").over(ends)).groupBy("text_id").agg(
        F.sum("n").alias("_m"), F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("cells"))
    numbered = running(linked, ["text_id"], "place", F.lit(1), "number", buckets, ties).drop("shard")
    placed = attach(numbered, staged(places, "places"), "text_id", "_m").withColumn("shard", F.get(F.filter(
        "cells", lambda c: F.col("number") < c["end"]), F.lit(0))["shard"]).drop("cells")
    steps, end = F.lit(None).cast("int"), 0
    for s in range(shards):
        end += room[s]
        steps = F.coalesce(steps, F.when(F.col("number") < end, F.lit(s)))
    fillers = running(single.drop("shard"), [], "place", F.lit(1), "number", buckets, ties).withColumn("shard", steps)
    final = staged(placed.unionByName(fillers).drop("m", "number"), "placed")
    return running(final, ["shard"], "place", F.lit(1), "slot", buckets, ties).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
