"""Balanced label propagation over groups of equal texts, in DataFrame functions only.

Law `rows`: shard counts differ by one row at most. Documents start on shards by a hash of their doc_id. The
linked ones, those whose text occurs twice or more, are counted by (text, shard): all copies of a text see the
same neighbours, so a row of that table stands for all its documents. Each round joins every text with the
shards of its copies, proposes to move copies to the shard that holds most of them, and accepts
proposals in a hashed order up to the quota of each (from, to) pair of shards: as many as go the other way, and what
the shard has room for. In even rounds copies on shards with room propose shards with room only, so that a group larger
than a shard gathers on few others; full shards give and take by exchange. Unlinked documents cut no edge
wherever they lie, so only linked ones count against a shard's capacity while labels move. Afterwards the
documents of each text are dealt to its shards by rank, and a last exact step gives surplus rows, unlinked ones
first, to shards that lack rows.

No key meets in one task: copies of a text with at least 1/HOT_SHARE of the rows are ranked in blocks.

Defined cases: null text has no bytes and size 1, and equals empty text; repeated rows each get a slot; rows
with a null doc_id are placed like others; an empty table gives an empty result; columns besides doc_id and text
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressrun.llm._base import HOT_SHARE, join_hot, materialize, shuffle_parts, text_or_empty

#: Blocks in which the copies of one hot text are ranked.
BLOCKS = 64
#: Rows that one ranking task takes on average, at most.
RANKED_ROWS = 200_000


def _unit(*cols: Column) -> Column:
    """A number in [0, 1) from the hash of cols."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _pick(values: list, key: Column) -> Column:
    """values[key] of a small list of literals."""
    return F.get(F.array(*[F.lit(v) for v in values]), key)


def _by_shard(links: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in links.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # one row a shard
    return [found.get(s, 0) for s in range(shards)]


def propagate(links: DataFrame, total: int, shards: int, rounds: int) -> DataFrame:
    """links: digest, shard, n of linked documents. The same after `rounds` rounds at most; total counts all rows."""
    capacity, least = total // shards, max(2, -(-total // HOT_SHARE))
    idle = 0
    for turn in range(rounds):
        loads = _by_shard(links, shards)
        room = [max(0, capacity - x) for x in loads]
        is_open = _pick([x > capacity // 100 for x in room], F.col("shard"))
        rank, copies = F.struct("n", F.pmod(F.xxhash64("digest", "shard", F.lit(turn)), F.lit(1 << 20)).alias("tie")), Window.partitionBy("digest")
        to = F.max_by("shard", rank).over(copies)
        if turn % 2 == 0:
            to = F.when(is_open, F.max_by("shard", F.when(is_open, rank)).over(copies)).otherwise(to)
        moves = links.withColumn("to", to)
        asked = {(r["shard"], r["to"]): r["n"] for r in moves.where("shard <> to").groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}  # a row for each pair of shards
        idle = 0 if asked else idle + 1
        if idle == 2:
            break
        if not asked:
            continue
        into = [sum(n for (_, b), n in asked.items() if b == s) for s in range(shards)]
        part = [0.0] * (shards * shards)
        for (a, b), n in asked.items():
            swapped = min(n, asked.get((b, a), 0))
            part[a * shards + b] = min(n, swapped + n * min(1.0, room[b] / into[b])) / n
        share = _pick(part, F.col("shard") * shards + F.col("to"))
        moved = F.when(F.col("shard") == F.col("to"), 0).when(F.col("n") >= least, F.floor(F.col("n") * share)).when(_unit(F.col("digest"), F.col("shard"), F.lit(turn)) < share, F.col("n")).otherwise(0).cast("long")
        halves = F.array(F.struct("shard", (F.col("n") - F.col("moved")).alias("n")), F.struct(F.col("to").alias("shard"), F.col("moved").alias("n")))
        split = moves.withColumn("moved", moved).select("digest", F.inline(halves)).where("n > 0")
        links = materialize(split.groupBy("digest", "shard").agg(F.sum("n").alias("n")), "links")
    return links


def shard(docs: DataFrame, shards: int = 8, rounds: int = 6) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row."""
    spark = docs.sparkSession
    text = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    rows = materialize(
        text.select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32("text").alias("text_crc32"), F.unhex(F.sha2("text", 256)).alias("digest"), F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard")),
        "shard-rows",
    )
    counts = rows.groupBy("digest", "shard").agg(F.count("*").alias("n"))
    links = materialize(counts.withColumn("all", F.sum("n").over(Window.partitionBy("digest"))).where("all > 1").drop("all"), "links")
    total = rows.count()
    links = propagate(links, total, shards, rounds)

    # Each linked text: the shard that takes its copies up to rank `hi`, shard after shard.
    till = F.sum("n").over(Window.partitionBy("digest").orderBy("shard"))
    plans = materialize(links.withColumn("hi", till).groupBy("digest").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("hi", "shard"))).alias("plan")), "plans")
    hot = F.col("n") >= max(2, -(-total // HOT_SHARE))
    linked = join_hot(rows.drop("shard"), plans, "digest", "n", total).withColumn("block", F.when(hot, F.pmod(F.xxhash64("doc_id"), F.lit(BLOCKS))).otherwise(0).cast("int"))
    before = (
        linked.where(hot).groupBy("digest", "block").agg(F.count("*").alias("c"))
        .withColumn("before", F.sum("c").over(Window.partitionBy("digest").orderBy("block")) - F.col("c")).drop("c")
    )  # HOT_SHARE * BLOCKS rows at most
    rank = F.row_number().over(Window.partitionBy("digest", "block").orderBy("doc_id", "size")) + F.coalesce("before", F.lit(0))
    dealt = (
        linked.join(F.broadcast(before), ["digest", "block"], "left").withColumn("rank", rank)
        .withColumn("shard", F.get(F.filter("plan", lambda x: x["hi"] >= F.col("rank")), F.lit(0))["shard"])
    )
    names = plans.select("digest", "n")
    alone = rows.join(F.broadcast(names.where(hot)), "digest", "left_anti").join(names.where(~hot), "digest", "left_anti")
    columns = ["doc_id", "size", "text_crc32", "shard"]
    placed = materialize(dealt.select(*columns, F.lit(0).alias("unlinked")).unionByName(alone.select(*columns, F.lit(1).alias("unlinked"))), "placed")
    return _level(placed, total, shards, max(shuffle_parts(spark), total // RANKED_ROWS + 1))


def _level(placed: DataFrame, total: int, shards: int, buckets: int) -> DataFrame:
    """Exact law `rows`: the last rows of a shard above its count, unlinked ones, fill the shards below theirs."""
    cells = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    key = ["shard", "unlinked", "cell"]
    sizes = cells.groupBy(*key).agg(F.count("*").alias("c"))
    offsets = sizes.withColumn("before", F.sum("c").over(Window.partitionBy("shard").orderBy("unlinked", "cell")) - F.col("c")).drop("c")
    ranked = cells.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", "size", "text_crc32")))
    held = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # one row a shard
    due = [total // shards + (s < total % shards) for s in range(shards)]
    over_from, ends, starts, done, taken = [], [], [], 0, 0
    for s in range(shards):
        over_from.append(done)
        done += max(0, held.get(s, 0) - due[s])
        lack = max(0, due[s] - held.get(s, 0))
        starts.append(held.get(s, 0) - taken)  # slot of a surplus row = its number + this
        taken += lack
        ends.append(taken)
    slot = F.col("rank") - 1 + F.col("before")
    spare = slot - _pick(due, F.col("shard")) + _pick(over_from, F.col("shard"))
    to = F.size(F.filter(F.array(*[F.lit(x) for x in ends]), lambda x: x <= F.col("spare")))
    numbered = ranked.join(offsets, key).select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"), F.when(slot >= _pick(due, F.col("shard")), spare).alias("spare"))
    final = numbered.withColumn("to", F.when(F.col("spare").isNull(), F.col("shard")).otherwise(to))
    return final.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("to").cast("int").alias("shard"),
        F.when(F.col("spare").isNull(), F.col("slot")).otherwise(F.col("spare") + _pick(starts, F.col("to"))).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
