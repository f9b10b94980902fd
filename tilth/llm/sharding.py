"""Minimax contiguous partition of atomic groups into shards.

Rows are put in the order of their group's hash by one range sort, which parts a large group over
tasks like any other rows; running sums of sizes then give every row its place, without a shuffle by
group.  No group is parted.  A group larger than an equal share of what is left gets a shard to itself
and is taken out of the line; all other shards are contiguous in it.

Their capacity is the smallest that suffices: it is found by binary search, and
greedy cutting tells whether a capacity suffices.  Search and greedy cuts run on
the driver over a bounded number of group ends: where a cut lies between known ends the greedy
cutter takes both, the undecided stretches are read again more finely from the written table, and so on until the answer
is exact.  Cuts are then set nearest to equal shares among those the capacity allows.

Defined results: a null text is an empty one and of its group; rows that repeat are sized and
placed each; a null key is carried; with fewer groups than shards some shards stay empty; an
empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm.text import range_shard
from tilth.scratch import materialize

#: Group ends that one reading brings to the driver.
ENDS = 20_000

Span = tuple[int, int]


@dataclass
class Ends:
    """Known ends of groups: sizes and groups before each, ascending, from (0, 0) to the totals."""

    at: list[int]
    nth: list[int]

    def gap(self, x: int) -> int:
        """The number of the last known end up to ``x``."""
        return bisect_right(self.at, x) - 1

    def closed(self, i: int) -> bool:
        """No group ends between this known end and the next."""
        return i + 1 >= len(self.at) or self.nth[i + 1] - self.nth[i] <= 1

    def cut(self, start: int, capacity: int) -> Span:
        """Least and greatest place of the cut after a shard from ``start``."""
        x = min(start + capacity, self.at[-1])
        i = self.gap(x)
        return max(self.at[i], start), max(self.at[i], start) if self.closed(i) else x

    def cuts(self, capacity: int, shards: int) -> list[Span]:
        """Least and greatest places of the greedy cuts."""
        out, low, high = [], 0, 0
        for _ in range(shards):
            low, high = self.cut(low, capacity)[0], self.cut(high, capacity)[1]
            out.append((low, high))
        return out

    def mirrored(self) -> Ends:
        return Ends([self.at[-1] - x for x in reversed(self.at)], [self.nth[-1] - x for x in reversed(self.nth)])

    def open_in(self, spans: Sequence[Span]) -> list[Span]:
        """The gaps that meet the spans and hide ends."""
        found = {i for low, high in spans for i in range(self.gap(low), min(self.gap(high), len(self.at) - 2) + 1)}
        return [(self.at[i], self.at[i + 1]) for i in sorted(found) if not self.closed(i)]

    def wider(self, size: float) -> list[int]:
        """The gaps of more than this size."""
        return [i for i, (a, b) in enumerate(zip(self.at, self.at[1:], strict=False)) if b - a > size]


def _least(good: Callable[[int], bool], low: int, high: int) -> int:
    """Binary search of the least good number in (low, high]; ``high`` is good."""
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if good(middle) else (middle, high)
    return high


def capacity_span(ends: Ends, shards: int) -> tuple[int, int]:
    """The smallest sufficient capacity is above the first number and at most the second."""
    total = ends.at[-1]
    sure = _least(lambda c: ends.cuts(c, shards)[-1][0] >= total, -1, total)
    perhaps = _least(lambda c: ends.cuts(c, shards)[-1][1] >= total, -1, sure)
    return perhaps - 1, sure


def decide(ends: Ends, shards: int) -> tuple[int, list[int]] | list[Span]:
    """Capacity and cuts, or the gaps that must be known more finely."""
    low, high = capacity_span(ends, shards)
    if high - low > 1:
        return ends.open_in([(a[0], b[1]) for a, b in zip(ends.cuts(low + 1, shards), ends.cuts(high, shards), strict=True)])
    back = [(ends.at[-1] - b, ends.at[-1] - a) for a, b in ends.mirrored().cuts(high, shards)]
    if unsure := ends.open_in([(a, b) for a, b in back if a < b]):
        return unsure
    return high, balanced(ends, shards, high, [a for a, _ in back])


def balanced(ends: Ends, shards: int, capacity: int, first: Sequence[int]) -> list[int]:
    """Cuts at known ends nearest to equal shares of what is left, all shards within the capacity.

    ``first[k - 1]`` is the least place from which k shards suffice.
    """
    start, out = 0, []
    for left in range(shards, 1, -1):
        want = start + (ends.at[-1] - start) / left
        i, j = bisect_left(ends.at, max(start, first[left - 2])), ends.gap(min(start + capacity, ends.at[-1]))
        k = min(max(bisect_left(ends.at, want), i), j)
        start = ends.at[k - 1 if k > i and want - ends.at[k - 1] <= ends.at[k] - want else k]
        out.append(start)
    return out


Read = Callable[[list[Span], int], list[Span]]


class Line:
    """The known ends of a line of groups, and the reader that makes more known.

    ``read(spans, step)`` gives (size, groups) before every ``step``-th group inside the spans.
    """

    def __init__(self, total: int, groups: int, read: Read, at_once: int = ENDS):
        self.read, self.at_once, self.step = read, at_once, groups + 1
        self.ends = Ends([0, total], [0, groups])

    def refine(self, gaps: Sequence[Span]) -> None:
        """At most about ``at_once`` more ends inside the gaps; each call reads them more finely."""
        ends = self.ends
        hidden = sum(ends.nth[ends.gap(b)] - ends.nth[ends.gap(a)] - 1 for a, b in gaps)
        self.step = max(1, min(self.step - 1, -(-hidden // self.at_once)))
        if hidden:
            known = {*zip(ends.at, ends.nth, strict=True), *self.read(_joined(gaps), self.step)}
            self.ends = Ends(*map(list, zip(*sorted(known), strict=True)))

    def large(self, shards: int) -> list[Span]:
        """The groups that are larger than an equal share of what they leave to the other shards."""
        self.refine(self.ends.open_in([(0, self.ends.at[-1])]))
        found: list[int] = []
        while True:
            ends = self.ends
            taken = sum(ends.at[i + 1] - ends.at[i] for i in found)
            wide = ends.wider((ends.at[-1] - taken) / (shards - len(found)))
            if hidden := [(ends.at[i], ends.at[i + 1]) for i in wide if not ends.closed(i)]:
                self.refine(hidden)
                found = []
            elif len(wide) == len(found):
                return [(ends.at[i], ends.at[i + 1]) for i in wide]
            else:
                found = wide

    def without(self, spans: Sequence[Span]) -> Line:
        """The line without these groups."""

        def shortened(x: int) -> int:
            return x - sum(b - a for a, b in spans if b <= x)

        def lengthened(x: int) -> int:
            for a, b in spans:
                x += b - a if a <= x else 0
            return x

        def fewer(x: int, n: int) -> Span:
            return shortened(x), n - sum(b <= x for _, b in spans)

        def read(asked: list[Span], step: int) -> list[Span]:
            return [fewer(x, n) for x, n in self.read([(lengthened(a), lengthened(b)) for a, b in asked], step) if not any(a < x < b for a, b in spans)]

        own = [fewer(x, n) for x, n in zip(self.ends.at, self.ends.nth, strict=True)]
        out = Line(*own[-1], read, self.at_once)
        out.ends, out.step = Ends(*map(list, zip(*sorted(set(own)), strict=True))), self.step + 1
        return out

    def partition(self, shards: int) -> tuple[int, list[int]]:
        """The least capacity, and where to cut."""
        while isinstance(found := decide(self.ends, shards), list):
            self.refine(found)
        return found


def _joined(spans: Sequence[Span]) -> list[Span]:
    """Spans that touch, as one; at most a few for each cut remain."""
    out: list[Span] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, bytes and group starts before each row, within its sorted task."""
    part, row, before, nth, last = TaskContext.get().partitionId(), 0, 0, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        size = batch.column("size").to_numpy()
        halves = np.frombuffer(b"".join(batch.column("group").to_pylist()), ">u8").reshape(-1, 2)
        # the driver knows what came before the first row
        fresh = (halves != np.concatenate([halves[:1] if last is None else last, halves[:-1]])).any(axis=1)
        starts, upto = nth + np.cumsum(fresh), before + np.cumsum(size)
        made = [pa.array(np.full(len(size), part), pa.int32()), *(pa.array(x, pa.int64()) for x in (row + np.arange(len(size)), upto - size, starts)), pa.array(fresh)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "part", "at_row", "at_byte", "nth", "fresh"])
        row, before, nth, last = row + len(size), int(upto[-1]), int(starts[-1]), halves[-1:]


@dataclass
class Sharding:
    """``rows``: ``row``, size, group, ``shard`` and ``slot``; the capacity of the shards that are not one large group."""

    rows: DataFrame
    capacity: int


def shard_documents(docs: DataFrame, *, shards: int, size: Column, group: Column, columns: Sequence[str] = ("doc_id",), key: str = "doc_id", ends_at_once: int = ENDS) -> Sharding:
    """Every row with its ``shard`` and, gapless from 0, its ``slot`` there.

    ``size`` is a positive number; rows of equal ``group`` (16 bytes, such as a hash) stay together.  ``columns`` travel along in the
    struct ``row``.  ``ends_at_once`` bounds what the driver holds, besides a row per task.
    """
    spark = docs.sparkSession
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{key}`").alias("key"), size.cast("long").alias("size"), group.alias("group"))
    dealt = slim.repartitionByRange("group", "key").sortWithinPartitions("group", "key")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + ", part int, at_row long, at_byte long, nth long, fresh boolean"
    placed = materialize(dealt.mapInArrow(_placed, schema), "sharding-places")
    tasks = placed.groupBy("part").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.max("nth").alias("starts"), F.min("group").alias("first"), F.max("group").alias("last"))
    rows, total, groups, last, offsets = 0, 0, 0, None, []
    for t in tasks.orderBy("part").collect():  # one row per task
        opens = t["first"] != last
        offsets.append((t["part"], rows, total, groups + opens - 1, bool(opens)))
        rows, total, groups, last = rows + t["rows"], total + t["bytes"], groups + opens + t["starts"], t["last"]
    if not rows:
        return Sharding(placed.select("row", "size", "group", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")), 0)
    placed = placed.join(F.broadcast(spark.createDataFrame(offsets, "part int, row0 long, byte0 long, nth0 long, opens boolean")), "part")
    at, nth = F.col("at_byte") + F.col("byte0"), F.col("nth") + F.col("nth0")
    starts = placed.filter("fresh or at_row = 0 and opens").select(at.alias("at"), nth.alias("nth"))

    def read(spans: list[Span], step: int) -> list[Span]:
        inside = F.lit(False)
        for a, b in spans:
            inside |= (F.col("at") > a) & (F.col("at") < b)
        return [(r["at"], r["nth"]) for r in starts.filter(inside & (F.col("nth") % step == 0)).collect()]

    line = Line(total, groups, read, ends_at_once)
    large = line.large(shards)  # fewer than shards
    rest = line.without(large)
    capacity, cuts = rest.partition(shards - len(large))
    # a row is in a large group where more of them have begun than ended; the others move up
    begun, ended = range_shard(at, [a for a, _ in large]), range_shard(at, [b for _, b in large])
    gone = F.get(F.array(*[F.lit(sum(b - a for a, b in large[:i])).cast("long") for i in range(len(large) + 1)]), ended)
    shard = F.when(begun > ended, ended).otherwise(range_shard(at - gone, [c for c in cuts if c < rest.ends.at[-1]]) + len(large))
    out = placed.select("row", "size", "group", (F.col("at_row") + F.col("row0")).alias("place"), (F.when(begun > ended, 0).otherwise(ended)).alias("passed"), shard.cast("int").alias("shard"))
    # places of a shard that holds both sides of a large group: its rows are left out of the count
    seen = {(r["shard"], r["passed"]): (r["place"], r["n"]) for r in out.groupBy("shard", "passed").agg(F.min("place").alias("place"), F.count("*").alias("n")).collect()}  # a row per shard and large group
    begin: dict[int, dict[int, int]] = {}
    for (s, p), (place, _) in sorted(seen.items()):
        held = sum(n for (s2, p2), (_, n) in seen.items() if s2 == s and p2 < p)
        begin.setdefault(s, {})[p] = place - held
    keys = [f"{s}:{p}" for s in begin for p in begin[s]]
    starts = F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*[F.lit(begin[s][p]).cast("long") for s in begin for p in begin[s]]))
    slot = F.col("place") - F.element_at(starts, F.concat_ws(":", F.col("shard"), F.col("passed")))
    return Sharding(out.select("row", "size", "group", "shard", slot.alias("slot")), capacity)
