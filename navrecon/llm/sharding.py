"""Sharding by balanced label propagation.

Documents with equal texts are linked through their text. All are dealt to the shards
by a hash of the row, whatever their links; only groups larger than a shard, which no move can
bring together, fill whole shards, and what is left of them goes where it has room.
Each round, a linked document wants to go to the shard where most of its text's copies
are. Quotas hold the numbers of rows: wishes between shards cancel out, and what is left
over is paid back with unlinked documents, so that row counts never differ by more than
one. When a round has little left to move, the quotas being what keeps groups apart,
the groups that are still cut are laid one after the other into the places that they
and the unlinked documents hold, so that only those over a border stay cut.
Rounds are joins and folded counts over a narrow table of (row, link, shard); only
the numbers of wishes between shards, shards squared, reach the driver.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navrecon.llm.common import running, staged, text_of, with_rows


def quotas(wishes: list[list[int]], free: list[int]) -> tuple[list[list[int]], list[tuple[int, int, int]]]:
    """(moves allowed from shard to shard, free rows to pay back as (from, to, number)).

    A shard may gain as many linked rows as it loses, plus its free rows, which then
    leave for the shards that lost rows.
    """
    n = len(free)
    allowed = [row[:] for row in wishes]
    while True:
        gain = [sum(allowed[a][s] for a in range(n)) - sum(allowed[s]) for s in range(n)]
        over = [s for s in range(n) if gain[s] > free[s]]
        if not over:
            break
        for s in over:  # each pass only lowers moves, so this ends
            entering, cut = sum(allowed[a][s] for a in range(n)), gain[s] - free[s]
            for a in range(n):
                less = min(allowed[a][s], -(-allowed[a][s] * cut // entering) if entering else 0)
                allowed[a][s] -= less
    back, lacking = [], [[s, -g] for s, g in enumerate(gain) if g < 0]
    for s, g in enumerate(gain):
        while g > 0:
            to, need = lacking[-1]
            step = min(g, need)
            back.append((s, to, step))
            g -= step
            lacking[-1][1] -= step
            if lacking[-1][1] == 0:
                lacking.pop()
    return allowed, back


def matrix(rows, n: int) -> list[list[int]]:
    out = [[0] * n for _ in range(n)]
    for a, b, count in rows:
        out[a][b] = count
    return out


def chosen(keys: list[str], bounds: list[tuple]) -> F.Column:
    """The last value of the bounds (key values..., low, high, value) that the row's rank lies in, else null."""
    out = F.lit(None).cast("int")
    for *values, low, high, value in bounds:
        hit = (F.col("rank") >= low) & (F.col("rank") < high)
        for k, v in zip(keys, values, strict=True):
            hit &= F.col(k) == v
        out = F.when(hit, F.lit(value)).otherwise(out)
    return out


def reserved(sizes: list[int], groups: list[int]) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """(bounds (group, low, high, shard) of groups larger than a shard, rows that the shards have left).

    Each group takes whole shards, then what is left of it, largest first, the
    smallest room that holds it, or the largest rooms.
    """
    room, left, at, bounds = sizes[:], groups[:], [0] * len(groups), []

    def take(g: int, s: int) -> None:
        step = min(room[s], left[g])
        bounds.append((g, at[g], at[g] + step, s))
        room[s], left[g], at[g] = room[s] - step, left[g] - step, at[g] + step

    for g in range(len(groups)):
        for s, size in enumerate(sizes):
            if 0 < size == room[s] <= left[g]:
                take(g, s)
    for g in sorted(range(len(groups)), key=lambda g: -left[g]):
        while left[g]:
            fits = [s for s in range(len(room)) if room[s] >= left[g]]
            take(g, min(fits, key=room.__getitem__) if fits else max(range(len(room)), key=room.__getitem__))
    return bounds, room


def filled(room: list[int], number: int) -> list[int]:
    """number rows put into the largest rooms first, so that they lie in as few shards as can be."""
    out = [0] * len(room)
    for s in sorted(range(len(room)), key=lambda s: -room[s]):
        out[s] = min(room[s], number)
        number -= out[s]
    return out


def in_row(numbers: list[int], part: int) -> list[tuple[int, int, int, int]]:
    """Bounds (part, low, high, shard) that give the first ranks to shard 0, the next to shard 1 and so on."""
    ends = [sum(numbers[:s + 1]) for s in range(len(numbers))]
    return [(part, end - n, end, s) for s, (n, end) in enumerate(zip(numbers, ends, strict=True)) if n]


FREE, SMALL = -2, -1


def started(base: DataFrame, shards: int) -> DataFrame:
    """(__row, link or null, part, shard) of base (__row, __text): part is FREE, SMALL or the number of a large group.

    Rows that are FREE or SMALL are dealt by a hash, in the numbers that the large groups leave.
    """
    groups = staged(base.groupBy("__text").agg(F.count("*").alias("n")).where("n > 1").withColumnRenamed("__text", "link"), "links")
    total = base.count()
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    # Fewer than there are shards.
    large = groups.where(F.col("n") > max(sizes)).orderBy(F.desc("n"), "link").collect()
    bounds, room = reserved(sizes, [r.n for r in large])
    part = F.when(F.col("link").isNull(), FREE)
    for g, r in enumerate(large):
        part = part.when(F.col("link") == F.lit(bytes(r.link)), g)
    rows = staged(base.select("__row", "__text").join(groups.select("link", F.col("link").alias("__text")), "__text", "left")
                      .select("__row", "link", part.otherwise(SMALL).alias("part"))
                      .withColumn("pool", F.greatest("part", F.lit(SMALL))), "linked-rows")
    ranked = running(rows, ["pool"], ["__row"], "rank")
    return ranked.select("__row", "link", "part", chosen(["pool"], bounds + in_row(room, SMALL)).alias("shard"))


def laid(state: DataFrame, shards: int) -> DataFrame:
    """state (__row, link or null, shard) with the groups that are still cut laid in runs, if that lessens the cut.

    Rows of cut groups and unlinked rows change places among themselves; whole groups
    and counts by shard stay.
    """
    votes = state.where("link is not null").groupBy("link", "shard").agg(F.count("*").alias("n"))
    cut = staged(votes.groupBy("link").agg(F.sum("n").alias("n"), F.count("*").alias("shards")).where("shards > 1")
                      .select("link", "n"), "cut-groups")
    if cut.isEmpty():
        return state
    first = staged(running(cut, [], ["link"], "first", F.col("n")).select("link", "first"), "first-ranks")
    told = staged(state.join(first, "link", "left"), "told-rows")
    counts = (told.where("first is not null or link is null").groupBy("shard", F.col("link").isNull().alias("free"))
                  .agg(F.count("*").alias("n")).collect())
    room = [sum(r.n for r in counts if r.shard == s) for s in range(shards)]
    runs = filled(room, sum(r.n for r in counts if not r.free))
    bounds = in_row(runs, SMALL) + in_row([r - n for r, n in zip(room, runs, strict=True)], FREE)
    inner = running(staged(told.where("first is not null"), "cut-rows"), ["link"], ["__row"], "inner").select(
        "__row", "link", F.lit(SMALL).alias("part"), (F.col("first") + F.col("inner")).alias("rank"))
    free = running(told.where("link is null").withColumn("part", F.lit(FREE)), ["part"], ["__row"], "rank").select(
        "__row", "link", "part", "rank")
    after = staged(inner.unionByName(free).select("__row", "link", chosen(["part"], bounds).alias("shard"))
                        .unionByName(told.where("link is not null and first is null").select("__row", "link", "shard")), "laid")
    return after if cut_rows(after) < cut_rows(state) else state


def propagate(state: DataFrame, shards: int, rounds: int | None = None, least: float = 0.001,
              trace: list[int] | None = None) -> DataFrame:
    """state (__row, link or null, shard) with shards moved; counts by shard stay as they are.

    A row moves only to where most of its group is, so that the rows at their
    group's shard grow with every round: without rounds it ends when no more than the
    share least of the linked rows may move. trace gets, for each round and the end, the
    number of linked rows that are not at their group's shard (the cut).
    """
    for number in count() if rounds is None else range(rounds):
        votes = state.where("link is not null").groupBy("link", "shard").agg(F.count("*").alias("n"))
        # A shard's own turn decides ties, so that small groups spread over all shards.
        turn = F.pmod(F.xxhash64("link") + F.col("shard"), F.lit(shards))
        # Staged: the join then has plain shuffles on both sides, whose hot partitions Spark can split.
        wanted = staged(votes.groupBy("link").agg(
            F.max(F.struct("n", turn.alias("turn"), "shard"))["shard"].alias("wanted")), "shard-votes")
        asked = staged(state.join(wanted, "link", "left").withColumn(
            "wanted", F.when(F.col("wanted") != F.col("shard"), F.col("wanted"))), "shard-wishes")
        counts = (asked.groupBy("shard", "wanted", F.col("link").isNull().alias("free"))
                       .agg(F.count("*").alias("n")).collect())
        wishes = matrix([(r.shard, r.wanted, r.n) for r in counts if r.wanted is not None], shards)
        free = [sum(r.n for r in counts if r.free and r.shard == s) for s in range(shards)]
        if trace is not None:
            trace.append(sum(map(sum, wishes)))
        allowed, back = quotas(wishes, free)
        if sum(map(sum, allowed)) <= least * sum(r.n for r in counts if not r.free):
            break
        movers = asked.where("wanted is not null")
        movers = (running(movers, ["shard", "wanted"], ["__row"], "rank").withColumn("to", chosen(
            ["shard", "wanted"], [(a, b, 0, allowed[a][b], b) for a in range(shards) for b in range(shards)
                                  if allowed[a][b]])))
        bounds, at = [], [0] * shards
        for a, b, n in back:
            bounds.append((a, at[a], at[a] + n, b))
            at[a] += n
        payers = running(asked.where("link is null"), ["shard"], ["__row"], "rank").withColumn(
            "to", chosen(["shard"], bounds))
        still = asked.where("link is not null and wanted is null").withColumn("to", F.lit(None).cast("int"))
        columns = ["__row", "link", F.coalesce("to", "shard").alias("shard")]
        state = staged(movers.select(*columns).unionByName(payers.select(*columns))
                       .unionByName(still.select(*columns)), f"shards-{number}")
    return state


def assign_shards(docs: DataFrame, shards: int = 8, rounds: int | None = None, id_col: str = "doc_id",
                  text_col: str = "text", trace: list[int] | None = None) -> DataFrame:
    """One row for each row of docs: id_col, size, text_crc32, linked, shard, slot (gapless in the shard).

    size is the text's bytes in UTF-8 plus 1; a null text has none and counts as an
    empty one. linked: another row has the same text. Rows by shard differ by one at
    most. A group that is larger than a shard fills whole shards; what is left of it is
    in as few others as have room. rounds ends the moves early. Repeated rows are rows of their own; a
    null id is kept. Other columns are ignored. An empty table gives an empty table.
    """
    text = text_of(text_col)
    base = with_rows(docs.select(
        F.col(f"`{id_col}`").alias("__id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("__text")), "sizes")
    start = staged(started(base, shards), "shards")
    moved = propagate(start.where(F.col("part") < 0).select("__row", "link", "shard"), shards, rounds, trace=trace)
    moved = laid(moved, shards)
    if trace is not None:
        trace.append(cut_rows(moved))
    state = staged(moved.unionByName(start.where(F.col("part") >= 0).select("__row", "link", "shard")), "placed")
    placed = running(state, ["shard"], ["__row"], "slot")
    return base.join(placed, "__row").select(
        F.col("__id").alias(id_col), "size", "text_crc32", F.col("link").isNotNull().alias("linked"), "shard", "slot")


def cut_share(shards: DataFrame, group: str = "text_crc32") -> DataFrame:
    """(linked, together): linked rows, and how many of them are in the shard that holds most of their group."""
    votes = shards.where("linked").groupBy(group, "shard").agg(F.count("*").alias("n"))
    best = votes.groupBy(group).agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    return best.agg(F.sum("n").alias("linked"), F.sum("most").alias("together"))


def cut_rows(state: DataFrame) -> int:
    """Linked rows of state (link or null, shard) that are not in the shard that holds most of their group."""
    facts = cut_share(state.select("link", "shard", F.col("link").isNotNull().alias("linked")), "link").first()
    return (facts.linked or 0) - (facts.together or 0)


def shard_rows(placed: DataFrame) -> DataFrame:
    """Rows and bytes by shard."""
    w = Window.partitionBy("shard")
    return placed.select("shard", F.count("*").over(w).alias("rows"), F.sum("size").over(w).alias("bytes")).distinct()
