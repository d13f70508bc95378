r"""Problem 6: filling containers of fixed capacity.

Method: mixture-controlled packing by deficit round-robin. Every source has a queue and a deficit: what it should have
contributed so far, by its target share of all tokens, less what it has. A container is a window: it adds its capacity
times the target share to every deficit, and while there is room the source with the largest deficit gives its largest
item that fits, which is taken from its deficit; deficits are carried from window to window. In the last eighth of a
window (TAIL, in proportion to the capacity) filling comes before order: the item of any source that leaves least room is
taken, the one with the larger deficit on a tie. Targets are the sources' shares of all tokens, so that all queues run
dry together.

Plan. Items (id, size, source) without texts are spread over groups of about GROUP_ROWS by hash, whatever their source,
so that a source with a third of all rows spreads like any other; repeated rows are counted first and spread as well.
Running sums of tokens by source over the groups before a group give the deficits that the group starts with: they are
carried across partitions without the groups waiting for each other. A group's containers that are less than FULL full
are packed again together with those of the other groups, in as many groups as their rows need, never in one larger than
that. When that sets free less than half of the rows (no two items fit together, say), only containers less than half
full are, any two of which can be joined; a group has one or two of those, so each round leaves a small part of the groups, until
one is left or nothing shrinks any more.

Guarantees: every item is in exactly one container, whole unless it exceeds the capacity (then in pieces of the full
capacity and a rest); no container holds more than the capacity. Edge cases: NULL or negative sizes count the tokens of
the text (0 where there is no text column); items of size 0 are placed like others; a NULL source is a queue of its own; repeated rows are separate items;
an empty table gives an empty result; order within ties is by id, so equal input gives equal containers.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexspark.session import written

GROUP_ROWS, TAIL, FULL, MAX_TASKS, MAX_SOURCES = 20_000, 1 / 8, 0.98, 20_000, 10_000
COPIES = 4096
RESULT = "container string, slot int, item long, piece long, start long, size long, source string"


def _counted(df: DataFrame, n) -> DataFrame:
    """n rows for each row of df, numbered by `copy`, in two steps, so that no array gets long."""
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / COPIES)))
    df = df.withColumn("_n", n).withColumn("_b", block)
    each = F.sequence(F.col("_b") * COPIES, F.least(F.col("_n") - 1, F.col("_b") * COPIES + COPIES - 1))
    return df.withColumn("copy", F.explode(each)).drop("_b", "_n")


def _items(docs: DataFrame, capacity: int) -> DataFrame:
    """item, copy, piece, start, size, queue: a row per item, or per piece of an oversized one. queue is the source with a
    sign before it, empty for NULL. Texts are read only where the size is lacking."""
    cols = [F.col("item").cast("long").alias("item"), F.col("source").cast("string").alias("source")]
    size = F.col("size").cast("long")
    sized = docs.where("size >= 0").select(*cols, size.alias("n"))
    tokens = F.regexp_count("text", F.lit(r"(?U)\w+|[^\w\s]+")) if "text" in docs.columns else F.lit(0)
    rest = docs.where("size IS NULL OR size < 0").select(*cols, F.coalesce(tokens, F.lit(0)).cast("long").alias("n"))
    rows = sized.unionAll(rest).groupBy("item", "source", "n").agg(F.count("*").alias("k"))
    rows = _counted(rows, F.col("k")).withColumnRenamed("copy", "c")
    rows = _counted(rows, F.greatest(F.ceil(F.col("n") / capacity), F.lit(1))).withColumnRenamed("copy", "piece").withColumnRenamed("c", "copy")
    start = F.col("piece") * capacity
    queue = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    return rows.select("item", "copy", "piece", start.alias("start"), F.least(F.lit(capacity), F.col("n") - start).alias("size"), queue.alias("queue"))


class _Queue:
    """Items of a source by size; the sizes present are the bits of one integer."""

    def __init__(self) -> None:
        self.present, self.by_size = 0, {}

    def put(self, size: int, row: int) -> None:
        self.by_size.setdefault(size, []).append(row)
        self.present |= 1 << size

    def largest(self, room: int) -> int:
        """The largest size of at most room, or -1."""
        return (self.present & ((1 << (room + 1)) - 1)).bit_length() - 1

    def take(self, size: int) -> int:
        rows = self.by_size[size]
        row = rows.pop()
        if not rows:
            self.present &= ~(1 << size)
        return row


def pack(sizes: list[int], sources: list, capacity: int, target: dict, deficit: dict | None = None) -> list[list[int]]:
    """Containers as lists of rows; deficit is what the sources start with and is carried on in place."""
    queues: dict = {}
    for row in range(len(sizes) - 1, -1, -1):  # the first row of a size is taken first
        queues.setdefault(sources[row], _Queue()).put(sizes[row], row)
    names = sorted(queues, key=lambda s: (s is None, s))
    deficit = {} if deficit is None else deficit
    for s in names:
        deficit.setdefault(s, 0.0)
    out, left = [], len(sizes)
    while left:
        room, box = capacity, []
        for s in names:
            deficit[s] += capacity * target.get(s, 0.0)
        while left:
            best = None
            for s in names:
                size = queues[s].largest(room)
                if size < 0:
                    continue
                rank = (deficit[s], size) if room > TAIL * capacity else (size, deficit[s])
                if best is None or rank > best[0]:
                    best = (rank, s, size)
            if best is None:
                break
            _, s, size = best
            box.append(queues[s].take(size))
            deficit[s] -= size
            room -= size
            left -= 1
        out.append(box)
    return out


def _pack_group(capacity: int, tag: str, most: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["item", "piece", "copy"], kind="stable").reset_index(drop=True)
        state = list(frame["before"].iloc[0])
        deficit, target, out = {r["queue"]: r["deficit"] for r in state}, {r["queue"]: r["share"] for r in state}, []
        for k in range(0, len(frame), most):  # a group that came out somewhat large is packed in parts
            part = frame.iloc[k : k + most]
            boxes = pack(part["size"].tolist(), part["queue"].tolist(), capacity, target, deficit)
            rows = [(f"{tag}-{key[0]}-{k}-{i}", j, r) for i, box in enumerate(boxes) for j, r in enumerate(box)]
            got = part.iloc[[r for *_, r in rows]][["item", "copy", "piece", "start", "size", "queue"]].reset_index(drop=True)
            got.insert(0, "container", [c for c, *_ in rows])
            got.insert(1, "slot", pd.Series([j for _, j, _ in rows], dtype="int32"))
            out.append(got)
        return pd.concat(out)

    return run


def _starts(placed: DataFrame, shares: DataFrame) -> DataFrame:
    """g, before: the deficits and shares of the queues in each group, from sums by group and queue. Windows run over
    these sums, one row a group (of GROUP_ROWS items) and queue."""
    sums = placed.groupBy("g", "queue").agg(F.sum("size").alias("t"))
    everything = sums.groupBy("g").agg(F.sum("t").alias("gt"))
    everything = everything.select("g", F.sum("gt").over(Window.orderBy("g")).alias("upto"), "gt").select("g", (F.col("upto") - F.col("gt")).alias("all"))
    own = sums.select("g", "queue", (F.sum("t").over(Window.partitionBy("queue").orderBy("g")) - F.col("t")).alias("had"))
    state = own.join(shares, "queue").join(everything, "g")
    state = state.select("g", F.struct("queue", (F.col("share") * F.col("all") - F.col("had")).alias("deficit"), "share").alias("s"))
    return state.groupBy("g").agg(F.sort_array(F.collect_list("s")).alias("before"))


def pack_containers(docs: DataFrame, capacity: int, target: dict | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """RESULT for docs (item, size, source and, where sizes lack, text): one row per item or piece. target: share of tokens
    by source (0 for others; by default what they have)."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = docs.sparkSession
    items = written(_items(docs, capacity), "items")
    total = items.agg(F.count("*").alias("n"), F.sum("size").alias("t"), F.count_distinct("queue").alias("q")).first()
    if total.q > MAX_SOURCES:
        raise ValueError("too many sources for a queue each")
    shares = items.groupBy("queue").agg((F.sum("size") / F.lit(float(total.t or 1))).alias("share"))
    if target is not None:
        asked = spark.createDataFrame([("" if s is None else f"={s}", float(x)) for s, x in target.items()], "queue string, share double")
        shares = shares.select("queue").join(asked, "queue", "left").select("queue", F.coalesce("share", F.lit(0.0)).alias("share"))
    shares = written(shares, "shares")
    rest, n, full, tag, parts = items, total.n, FULL, 0, []
    while True:
        groups = max(1, -(-n // group_rows))
        placed = rest.withColumn("g", F.pmod(F.xxhash64("item", "copy", "piece", F.lit(tag)), F.lit(groups)))
        # A number of partitions that is asked for isn't coalesced: the groups' work lies in Python, not in bytes.
        ready = placed.join(_starts(placed, shares), "g").repartition(min(groups, MAX_TASKS), "g")
        run = _pack_group(capacity, str(tag), group_rows)
        packed = written(ready.groupBy("g").applyInPandas(run, "container string, slot int, item long, copy long, piece long, start long, size long, queue string"), "packed")
        if groups == 1:
            return _result(parts + [packed])
        fill = packed.groupBy("container").agg(F.sum("size").alias("fill"), F.count("*").alias("rows"))
        loose = {x: F.sum(F.when(F.col("fill") < x * capacity, F.col("rows")).otherwise(0)).alias(str(x)) for x in (FULL, 0.5)}
        left = fill.agg(*loose.values()).first().asDict()
        if full == FULL and left[str(FULL)] > n / 2:
            full = 0.5
        again = left[str(full)]
        if again == 0 or again > n / 2:
            return _result(parts + [packed])
        open_ = fill.where(F.col("fill") < full * capacity).select("container").hint("merge")
        parts.append(packed.join(open_, "container", "left_anti"))
        rest, n, tag = packed.join(open_, "container", "left_semi").drop("container", "slot"), again, tag + 1


def _result(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    source = F.when(F.col("queue") != "", F.substr("queue", F.lit(2)))
    return out.select("container", "slot", "item", "piece", "start", "size", source.alias("source"))
