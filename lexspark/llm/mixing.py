r"""Problem 7: mixing sources to target weights.

Method: Pfair scheduling. A source's records, in an order drawn by hash, are its blocks; a source that has to repeat goes
through its records again in another order. On a time axis of tokens, the block of source i that begins when s tokens of
the source have gone before is released at s / w and due at (s + size) / w, w being the source's weight. At any time the
blocks that are released are eligible, and of these the one due earliest comes next: no block starts before its release,
and up to any time each source has had w times that time but for less than one block (the largest there is). Some block is
always eligible, as the source that has had least for its weight is. The schedule ends at the total; the last block of a
source is taken when at least half of it lies before the end, so that at the very end the clock may have to wait for the
release of what is left.

The total is, unless given, the largest for which every source that has documents keeps its share within its repeats.
With a larger total, sources that run out give all they can and the others keep their proportions to one another and
fill the total as far as their repeats allow. Sources without documents can't contribute; the report says so.

Plan. Running sums within a source don't pass through one task: records fall into bins by their order hash, bins are
summed, sums of bins run over a small table, and only within a bin rows are ordered. The number of bins follows from the
number of rows, so a source with a third of all rows spreads over as many tasks as its rows need. The schedule itself is
made slot by slot of the time axis, all slots at once, each of about BIN_ROWS blocks: a slot starts an eighth of a slot
early, from the state that plain order by due time would have there, and by the time its own part begins it has settled
into the one schedule, as what is eligible and due depends on the time alone. Each slot writes down the state it began
its part with and the state it ended in. Where the end of one isn't the beginning of the next, the slots are made again
from the ends found, until all of them agree; then they are the schedule that a single pass would give.

Edge cases: records without source, of sources not listed, with NULL or zero size or a NULL id are never selected; NULL or
negative weights count as 0, NULL repeats as 1; repeated rows are records of their own; ties in due time go by source,
id and round; empty tables give empty results and a report of what was asked for.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.session import drop, written

BIN_ROWS, MAX_TASKS = 20_000, 20_000


def _bounded(df: DataFrame, n: int, what: str) -> list:
    rows = df.limit(n + 1).collect()
    if len(rows) > n:
        raise ValueError(f"{what} is meant to be a short list")
    return rows


def plan(have: dict[str, int], weight: dict[str, float], repeats: dict[str, int], total: float | None = None) -> dict[str, float]:
    """Tokens that each source is to give."""
    most = {s: have.get(s, 0) * repeats[s] for s in weight}
    live = {s: w for s, w in weight.items() if w > 0 and most[s] > 0}
    if not live:
        return {s: 0.0 for s in weight}
    all_w = sum(live.values())
    top = min(most[s] * all_w / w for s, w in live.items())
    if total is None:
        total = top
    out, left, rest = {s: 0.0 for s in weight}, float(total), dict(live)
    while rest and left > 0:  # sources that run out first
        w = sum(rest.values())
        short = [s for s in rest if most[s] < left * rest[s] / w]
        if not short:
            for s in rest:
                out[s] = left * rest[s] / w
            break
        for s in short:
            out[s] = float(most[s])
            left -= most[s]
            del rest[s]
    return out


def earliest(blocks: dict[str, list[tuple]], at: dict[str, int], clock: float, end: float):
    """Blocks in order: of those released, the one due earliest. blocks: by source, (begin, release, due, size, ...) in
    order of begin; at: how many of them are done, counted on in place. Yields (start, source, block) until the clock has
    reached end."""
    ready, waiting = [], []
    for s, b in blocks.items():
        if at[s] < len(b):
            heapq.heappush(waiting, (b[at[s]][1], s))
    while (ready or waiting) and clock < end:
        if not ready and waiting[0][0] > clock:
            clock = waiting[0][0]
            continue
        while waiting and waiting[0][0] <= clock:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (blocks[s][at[s]][2], s))
        s = heapq.heappop(ready)[1]
        start, block = clock, blocks[s][at[s]]
        clock += block[3]
        at[s] += 1
        if at[s] < len(blocks[s]):
            heapq.heappush(waiting, (blocks[s][at[s]][1], s))
        yield start, s, block


_SLOT = "slot long, place int, source string, item long, round int, size long, release double, due double, start double, clock double, begun long, ended long"


def _slot(width: float, slots: int, finals: dict[str, int]):
    """Blocks of a slot in order (place from 0), and for each source, with place -1, how many tokens of it were done when
    the slot's part began and ended, with the clock at either time in start and clock."""

    def run(key: tuple, rows: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        k, names = int(key[0]), [c.split()[0] for c in _SLOT.split(", ")]
        if not len(rows):
            return pd.DataFrame(columns=names)
        rows = rows.sort_values(["begin", "item", "round"], kind="stable")
        blocks = {s: list(zip(f["begin"].tolist(), f["release"].tolist(), f["due"].tolist(), f["size"].tolist(), f["item"].tolist(), f["round"].tolist())) for s, f in rows.groupby("source")}
        first, end = k * width, (k + 1) * width if k + 1 < slots else math.inf

        def done() -> dict[str, int]:
            return {s: b[at[s]][0] if at[s] < len(b) else b[-1][0] + b[-1][3] for s, b in blocks.items()}

        if len(given):
            was = dict(zip(given["source"], given["begun"]))
            at = {s: sum(x[0] < was.get(s, 0) for x in b) for s, b in blocks.items()}
            clock = float(given["clock"].iloc[0])
        else:
            early = 0.0 if k == 0 else first - width / 8
            at = {s: sum(x[2] <= early for x in b) for s, b in blocks.items()}
            clock = float(sum((finals | done()).values())) if k else 0.0
        begun, opened, out = None, clock, []
        schedule = earliest(blocks, at, clock, end)
        while True:
            now = done() if begun is None else None
            step = next(schedule, None)
            if step is None:
                break
            start, s, x = step
            if start >= first:
                if begun is None:
                    begun, opened = now, start
                out.append((k, len(out), s, x[4], x[5], x[3], x[1], x[2], start, None, None, None))
            clock = start + x[3]
        ended = done()
        begun, opened = (ended, clock) if begun is None else (begun, opened)
        out += [(k, -1, s, None, None, None, None, None, opened, clock, begun[s], ended[s]) for s in blocks]
        whole = {"place": "Int32", "item": "Int64", "round": "Int32", "size": "Int64", "begun": "Int64", "ended": "Int64"}
        return pd.DataFrame(out, columns=names).astype(whole | dict.fromkeys(("release", "due", "start", "clock"), "float64"))

    return run


def _schedule(taken: DataFrame, total: float, bin_rows: int) -> DataFrame:
    """position, source, item, round, size, release, due, start of blocks (source, item, round, size, begin, release, due)."""
    facts = taken.groupBy("source").agg(F.max(F.col("begin") + F.col("size")).alias("final"), F.max("size").alias("most"), F.count("*").alias("n")).collect()  # a row per listed source
    finals, rows = {r.source: r.final for r in facts}, sum(r.n for r in facts)
    width = max(total / max(1, -(-rows // bin_rows)), 16.0 * max([r.most for r in facts], default=1))
    slots = max(1, math.ceil(total / width))
    # A block lies in every slot in which it may be open: released before the slot ends, due after its early start.
    lo, hi = F.floor(F.col("release") / width).cast("long"), F.floor(F.col("due") / width + F.lit(1 / 8)).cast("long")
    top = F.lit(slots - 1).cast("long")
    spread = taken.withColumn("slot", F.explode(F.sequence(F.least(lo, top), F.least(hi, top))))
    given = taken.sparkSession.createDataFrame([], "slot long, source string, clock double, begun long")
    while True:
        # A number of partitions that is asked for isn't coalesced: the slots' work lies in Python, not in bytes.
        tasks = min(slots, MAX_TASKS)
        pairs = spread.repartition(tasks, "slot").groupBy("slot").cogroup(given.repartition(tasks, "slot").groupBy("slot"))
        made = written(pairs.applyInPandas(_slot(width, slots, finals), _SLOT), "slots")
        state = made.where("place = -1")
        ends = state.select((F.col("slot") + 1).alias("slot"), "source", "clock", F.col("ended").alias("begun"))
        starts = state.select("slot", "source", F.col("start").alias("c"), F.col("begun").alias("b"))
        if starts.join(ends.hint("merge"), ["slot", "source"]).where("b <> begun OR c <> clock").isEmpty():
            break
        given = written(ends, "ends")
        drop(made)
    blocks = made.where("place >= 0")
    counts = blocks.groupBy("slot").agg(F.count("*").alias("c"))
    counts = counts.select("slot", (F.sum("c").over(Window.orderBy("slot")) - F.col("c")).alias("before"))  # one row a slot
    return blocks.join(counts, "slot").select((F.col("before") + F.col("place")).alias("position"), "source", "item", "round", "size", "release", "due", "start")


def mix(docs: DataFrame, weights: DataFrame, total: float | None = None, seed: int = 7, bin_rows: int = BIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """(schedule, report). schedule: position, source, item, round, size, release, due, start of
    docs (item, size, source); times are in tokens.
    report: source, target_share, actual_share, tokens, records, most_used, available, short."""
    spark: SparkSession = docs.sparkSession
    asked = _bounded(weights.where("source IS NOT NULL"), 10_000, "source_weights")
    weight = {r.source: max(r.target_share or 0.0, 0.0) for r in asked}
    repeats = {r.source: max(1 if r.max_repeats is None else r.max_repeats, 0) for r in asked}
    wanted = F.col("source").isin(list(weight)) if weight else F.lit(False)
    rows = docs.select(F.col("item").cast("long").alias("item"), F.col("size").cast("long").alias("size"), F.col("source").cast("string").alias("source"))
    rows = rows.where(wanted & (F.col("size") > 0) & F.col("item").isNotNull())
    sums = {r.source: (r.t, r.n) for r in rows.groupBy("source").agg(F.sum("size").alias("t"), F.count("*").alias("n")).collect()}
    give = plan({s: t for s, (t, _) in sums.items()}, weight, repeats, total)
    all_given = sum(give.values())
    facts = [(s, give[s] / all_given, float(give[s]), sums[s][0], min(repeats[s], int(give[s] // sums[s][0]) + 1), max(1, -(-sums[s][1] // bin_rows))) for s in weight if give.get(s, 0) > 0]
    fact = spark.createDataFrame(facts, "source string, w double, give double, have long, rounds int, bins long")
    known = rows.join(F.broadcast(fact), "source")  # one row per listed source
    turn = known.select("*", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("round"))
    turn = turn.withColumn("h", F.xxhash64("item", "size", "round", F.lit(seed))).withColumn("bin", F.pmod("h", F.col("bins")))
    bins = turn.groupBy("source", "round", "bin").agg(F.sum("size").alias("b"))
    upto = bins.withColumn("before", F.sum("b").over(Window.partitionBy("source", "round").orderBy("bin")) - F.col("b")).drop("b")
    turn = turn.join(upto, ["source", "round", "bin"])
    inside = Window.partitionBy("source", "round", "bin").orderBy("h", "item", "size").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.col("round") * F.col("have") + F.col("before") + F.sum("size").over(inside) - F.col("size")
    taken = turn.withColumn("begin", begin).where(F.col("begin") + F.col("size") / 2 <= F.col("give"))
    taken = taken.select("source", "item", "round", "size", F.col("begin").cast("long").alias("begin"), (F.col("begin") / F.col("w")).alias("release"), ((F.col("begin") + F.col("size")) / F.col("w")).alias("due"))
    taken = written(taken, "taken")
    schedule = _schedule(taken, all_given, bin_rows)
    used = taken.groupBy("source").agg(F.sum("size").alias("tokens"), F.count("*").alias("records"), (F.max("round") + 1).alias("most_used"))
    target = spark.createDataFrame([(s, w, sums.get(s, (0, 0))[0]) for s, w in weight.items()], "source string, target_share double, available long")
    tokens = F.coalesce("tokens", F.lit(0))
    share = tokens / F.nullif(F.sum(tokens).over(Window.partitionBy()), F.lit(0))  # one row per listed source
    report = target.join(used, "source", "left").select(
        "source", "target_share", F.coalesce(share, F.lit(0.0)).alias("actual_share"), tokens.alias("tokens"), F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("most_used", F.lit(0)).alias("most_used"), "available", (F.coalesce(share, F.lit(0.0)) < F.col("target_share") * 0.99).alias("short"),
    )
    return schedule, report
