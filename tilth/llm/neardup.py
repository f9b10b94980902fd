"""MinHash near-duplicates by an inverted join on signature coordinates.

Texts with equal shingle sets form a class, and one representative stands for
it.  Representatives carry a signature of ``COORDINATES`` MinHash values.  Two
of them match in about the share of coordinates that is their similarity, so a
pair is a candidate from ``MATCHES`` equal coordinates on.

Prefix merging: only representatives that collide in the first ``LEADING``
coordinates go on; a pair at 0.75 shares none of them with a chance of
0.25 ** ``LEADING``.  Those are posted under all coordinate-value pairs; a
representative with fewer than ``MATCHES`` shared values is skipped.

Posting lists are cut into blocks of bounded rows and bytes.  Inside a block
collisions are counted on the signatures and candidates are confirmed on the full
shingle sets; members that are already joined are skipped, so a block returns at most
one link per member.  Lists larger than a block are first merged through blocks
of members and then of delegates, a linear number of rows.  Representatives that
still share ``MATCHES`` values with other components are then posted under the
rarest of their values in the first ``SPREAD`` coordinates, as many as a pair with
``SPREAD_MATCHES`` of them must meet in, and these lists are compared block against
block, which leaves no pair out; a pair that meets in several lists is confirmed in the
rarest.  There is no cap on partners, candidates or the length of a list.

At a similarity of 0.75 a pair is lost by these counts with a chance of 8 in a million,
and with less above it.

Defined results: a text without words (or null) is linked with nothing; rows with
the same key are judged each by its own text; a row without a key joins nothing
and stays, with a null component; of a component one row stays, also where rows share
its key; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm import shingles as S
from tilth.llm.text import bound_batches, hold_worker
from tilth.operators.components import connected_components
from tilth.scratch import materialize

COORDINATES = 64
MATCHES = 32
LEADING = 12
SPREAD, SPREAD_MATCHES = 16, 4
#: Similarity as a fraction, compared in integers.
NUMERATOR, DENOMINATOR = 75, 100
BLOCK_ROWS = 1024
BLOCK_BYTES = 16 << 20
#: Delegates are compared again while they give this share of links.
DELEGATE_GAIN = 0.2
_A, _B = S.seeds(COORDINATES, 101) | np.uint64(1), S.seeds(COORDINATES, 102)
_C = S.seeds(COORDINATES, 103)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hold_worker("neardup")
    for batch in batches:
        n, keys, sigs = [], [], []
        for text in batch.column("text").to_pylist():
            s = S.shingle_set(text)
            n.append(len(s))
            keys.append(_key(s) if len(s) else None)
            # the coordinate is mixed into its value: one number names the posting list
            sigs.append(S.mixed(S.signature(s, _A, _B) ^ _C).view(np.int64) if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.list_(pa.int64()))], ["node", "n", "set_key", "signature"])


def _key(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle set of each class, from the row that stands for it."""
    last = None
    for batch in batches:
        ids, sets = [], []
        for i, key, text in zip(*[batch.column(c).to_pylist() for c in ("id", "set_key", "text")], strict=True):
            if i == last:
                continue
            s = S.shingle_set(text)
            if _key(s) == key:  # else another row with the same document key
                ids.append(i)
                sets.append(s.tobytes())
                last = i
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["id", "shingles"])


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = sorted((len(a), len(b)))
    if DENOMINATOR * small < NUMERATOR * large:
        return False
    both = S.common(a, b)
    return DENOMINATOR * both >= NUMERATOR * (small + large - both)


def _group_links(ids: np.ndarray, comps: np.ndarray, sides: np.ndarray | None, sigs: np.ndarray, sets: list[memoryview], parent: dict[int, int], token: int, posted: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """Links inside one block, or between its two sides, that join components.

    ``comps`` is what is known before and is brought up to date here; a candidate
    is confirmed only if its ends are not joined yet.  ``posted`` has the length of each
    one's list in the first coordinates, 0 where it is not posted: of the lists that two
    share, the shortest and then the least token confirms them.
    """
    sizes = np.array([len(x) // 8 for x in sets])
    if posted is not None:
        lengths = np.where(posted > 0, posted, np.iinfo(np.int64).max)
    for i in range(1, len(ids)):
        near = np.minimum(sizes[:i], sizes[i]) * DENOMINATOR >= np.maximum(sizes[:i], sizes[i]) * NUMERATOR
        near &= comps[:i] != comps[i]
        if sides is not None:
            near &= sides[:i] != sides[i]
        at = np.flatnonzero(near)
        if not len(at):
            continue
        equal = sigs[at] == sigs[i]
        hits = equal.sum(axis=1)
        if posted is not None:
            some = hits >= MATCHES
            at, hits, equal = at[some], hits[some], equal[some, :SPREAD] & (posted[at[some]] > 0) & (posted[i] > 0)
            if not len(at):
                continue
            shortest = np.where(equal, lengths[i], np.iinfo(np.int64).max).min(axis=1)
            first = np.where(equal & (lengths[i] == shortest[:, None]), sigs[i, :SPREAD], np.iinfo(np.int64).max).min(axis=1)
            at, hits = at[first == token], hits[first == token]
        own = None
        for j in at[np.argsort(-hits, kind="stable")][: int((hits >= MATCHES).sum())]:
            if comps[j] == comps[i]:
                continue
            own = np.frombuffer(sets[i], np.uint64) if own is None else own
            if _similar(own, np.frombuffer(sets[j], np.uint64)):
                yield int(ids[j]), int(ids[i])
                low, high = sorted((int(comps[i]), int(comps[j])))
                parent[high] = low
                comps[comps == high] = low


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each (token, i, j) of a partition that is sorted by them, then by id."""
    hold_worker("neardup")
    parent: dict[int, int] = {}  # components that this task has joined

    def root(c: int) -> int:
        while c in parent:
            c = parent[c]
        return c

    def found(t: pa.Table, last: bool) -> tuple[list[tuple[int, int]], pa.Table]:
        key = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("token", "i", "j")])
        ends = [*(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1), *([t.num_rows] if last else [])]
        ids, comps, sides = (t.column(c).to_numpy().astype(np.int64) for c in ("id", "comp", "side"))
        out: list[tuple[int, int]] = []
        start = 0
        for end in ends:
            at = start + np.flatnonzero(np.diff(ids[start:end], prepend=-1))  # a repeated row of a document is left out
            own = np.array([root(c) for c in comps[at].tolist()])
            if (own != own[0]).any():
                part = t.take(at)
                sigs = part.column("signature").combine_chunks().flatten().to_numpy().reshape(len(at), COORDINATES)
                sets = [memoryview(x.as_buffer()) for x in part.column("shingles")]
                posted = part.column("posted").combine_chunks()
                posted = None if posted.null_count else posted.flatten().to_numpy().reshape(len(at), SPREAD)
                out += _group_links(ids[at], own, sides[at] if key[1, start] != key[2, start] else None, sigs, sets, parent, int(key[0, start]), posted)
            start = end
        return out, t.slice(start)

    def batch_of(links: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["src", "dst"])

    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = (pa.concat_tables([held, t]) if held is not None else t).combine_chunks()
        if t.num_rows:
            links, held = found(t, False)
            yield batch_of(links)
    if held is not None and held.num_rows:
        yield batch_of(found(held, True)[0])


def _label(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Adds ``comp``, the component known so far."""
    if comps is None:
        return rows.withColumn("comp", F.col("id"))
    return rows.join(comps.withColumnRenamed("node", "id"), "id", "left").select(*rows.columns, F.coalesce("component", "id").alias("comp"))


def _dealt(rows: DataFrame, seed: int) -> DataFrame:
    """Deals each posting list that holds different components into blocks ``i``."""
    lists = rows.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("members"), F.sum("bytes").alias("total"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_BYTES)).cast("int")
    lists = lists.filter("low <> high").select("token", blocks.alias("blocks"))
    return rows.join(lists, "token").withColumn("i", F.pmod(F.xxhash64("id", F.lit(seed)), "blocks").cast("int"))


def _compare(rows: DataFrame, full: DataFrame) -> DataFrame:
    """rows: token, i, j, side, id, comp, posted -> links inside each (token, i, j)."""
    dealt = rows.join(full, "id").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "id")
    return dealt.select("token", "i", "j", "side", "id", "comp", "posted", "signature", "shingles").mapInArrow(_links, "src long, dst long")


def _judged(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(node, n, set_key, comp, grp) for every row of ``docs``.

    comp is null without a key.  Components whose least keys are equal differ in grp.
    """
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{key}`").cast("long").alias("node"), F.col(f"`{text}`").alias("text"))
    signed = materialize(slim.mapInArrow(_signed, "node long, n long, set_key binary, signature array<long>"), "neardup-signed")
    usable = signed.filter("node is not null and n > 0")
    reps = usable.groupBy("set_key").agg(F.min("node").alias("rep"), F.any_value("signature").alias("signature"))
    reps = materialize(reps.withColumn("id", F.monotonically_increasing_id()), "neardup-classes")

    # prefix: who collides in the leading coordinates at all
    lead = reps.select("id", F.explode(F.slice("signature", 1, LEADING)).alias("token"))
    shared = lead.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("token")
    met = materialize(lead.join(shared, "token").select("id").distinct(), "neardup-met")
    # skip: who shares enough values
    every = reps.join(met, "id", "left_semi").select("id", F.posexplode("signature").alias("at", "token"))
    counts = every.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    own = every.join(counts, "token").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("k", "token", "at"))).alias("tokens"))  # at most COORDINATES each
    own = materialize(own.filter(F.size("tokens") >= MATCHES), "neardup-tokens")

    live = reps.join(own, "id", "left_semi").select("id", "set_key", "signature", "rep")
    read = slim.join(live.select("id", "set_key", F.col("rep").alias("node")), "node").select("id", "set_key", "text")
    full = read.mapInArrow(_sets, "id long, shingles binary").join(live.select("id", "signature"), "id")
    full = materialize(full, "neardup-sets")

    size = full.groupBy("id").agg(F.max(F.length("shingles") + 8 * COORDINATES).alias("bytes"))
    central = F.aggregate("tokens", F.lit(0.0), lambda acc, t: acc + F.log(t["k"].cast("double")))
    tokens = materialize(own.withColumn("central", central).join(size, "id"), "neardup-posts")
    comps: DataFrame | None = None
    turn = 0

    def new_links(rows: DataFrame) -> int:
        nonlocal comps, turn
        found = materialize(_compare(rows, full), "neardup-links")
        n, turn = found.count(), turn + 1
        if n:
            # components known so far are stars already, so only new links take rounds
            known = found if comps is None else found.unionByName(comps.select(F.col("node").alias("src"), F.col("component").alias("dst")))
            comps = materialize(connected_components(known), "neardup-components")
        return n

    # blocks of members under a few of each one's values, the most frequent first
    def one_side(rows: DataFrame, seed: int) -> DataFrame:
        return _dealt(rows, seed).select("token", "blocks", "i", F.col("i").alias("j"), F.lit(0).alias("side"), "id", "comp", F.lit(None).cast("array<long>").alias("posted"))

    def under(*places: Column) -> DataFrame:
        return tokens.select("id", "bytes", "central", F.explode(F.array_distinct(F.array(*[F.get("tokens", p)["token"] for p in places]))).alias("token"))

    n = F.size("tokens")
    top = under(n - 1)
    dealt = one_side(_label(under(n - 1, F.lit(0)), comps), 0)
    large = materialize(dealt.filter("blocks > 1").select("token").distinct(), "neardup-large")
    new_links(dealt.drop("blocks"))
    new_links(one_side(_label(under((n / 3).cast("int"), (2 * n / 3).cast("int")), comps), 1).drop("blocks"))
    # lists of several blocks: blocks of one delegate per component, while that joins many of them
    while not large.isEmpty():
        rows = _label(top.join(large, "token", "left_semi"), comps).groupBy("token", "comp").agg(F.max(F.struct("central", "id", "bytes")).alias("d"))
        rows = materialize(rows.select("token", "comp", "d.id", "d.bytes"), "neardup-delegates")
        if new_links(one_side(rows, turn + 1).drop("blocks")) < DELEGATE_GAIN * rows.count():
            break

    # skip again: ends that are not joined yet meet in lists of different components only, so
    # who has fewer than MATCHES of those is done
    posts = _label(tokens, comps).select("id", "comp", F.explode("tokens").alias("t")).select("id", "comp", "t.*")
    mixed = posts.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("token")
    still = posts.join(mixed, "token").groupBy("id").agg(F.count(F.lit(1)).alias("shared"), F.sort_array(F.collect_list(F.when(F.col("at") < SPREAD, F.struct("k", "token", "at")))).alias("tokens"))  # at most SPREAD each
    still = still.filter((F.col("shared") >= MATCHES) & (F.size("tokens") >= SPREAD_MATCHES))
    # under the rarest values that are left, block against block
    prefix = F.slice("tokens", F.lit(1), F.size("tokens") - SPREAD_MATCHES + 1)
    length = lambda c: F.coalesce(F.get(F.filter("prefix", lambda t: t["at"] == c), F.lit(0))["k"], F.lit(0))
    still = still.withColumn("prefix", prefix).select("id", F.col("prefix.token").alias("tokens"), F.transform(F.sequence(F.lit(0), F.lit(SPREAD - 1)), length).alias("posted"))
    still = materialize(still.join(tokens.select("id", "bytes"), "id"), "neardup-still")
    rows = _dealt(_label(still.select("id", "bytes", "posted", F.explode("tokens").alias("token")), comps), 0)
    turns = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("i", j).alias("i"), F.greatest("i", j).alias("j"), F.when(F.col("i") <= j, 0).otherwise(1).alias("side")))
    new_links(rows.select("token", "id", "comp", "posted", F.explode(turns).alias("b")).select("token", "b.i", "b.j", "b.side", "id", "comp", "posted"))

    classes = _label(reps.select("id", "set_key", "rep"), comps)
    least = classes.groupBy("comp").agg(F.min("rep").alias("component"))
    named = classes.join(least, "comp").select("set_key", "component", F.col("comp").alias("grp"))
    out = signed.select("node", "n", "set_key").join(named, "set_key", "left")
    comp = F.when(F.col("node").isNotNull(), F.coalesce("component", "node"))
    return out.select("node", "n", "set_key", comp.alias("comp"), "grp")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``."""
    out = _judged(docs, key, text)
    return out.select(F.col("node").alias(key), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), F.coalesce(F.col("node") == F.col("comp"), F.lit(True)).alias("kept"))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the text by the key of its shingle set, null without shingles."""
    for batch in batches:
        sets = [S.shingle_set(t) for t in batch.column("text").to_pylist()]
        yield batch.drop_columns(["text"]).append_column("set_key", pa.array([_key(s) if len(s) else None for s in sets], pa.binary()))


def without_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept, one of each component, with the columns of ``docs``.

    A key that occurs once names its row.  Rows that share a key are told apart by
    their shingle sets, and equal ones by a hash of all columns.
    """
    judged = materialize(_judged(docs, key, text).filter("node is not null"), "neardup-judged")
    shared = materialize(judged.groupBy("node").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("node"), "neardup-shared")
    gone = judged.filter("node <> comp").select("node").union(shared).distinct()
    by_key = F.col(f"`{key}`").cast("long")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.struct(*columns)
    single = docs.select(row.alias("row"), by_key.alias("node")).join(gone, "node", "left_anti").select("row")

    # a component's row: its least key, then its least shingle set, then the least hash
    kept = judged.join(shared, "node", "left_semi").filter("n > 0 and node = comp").groupBy("grp").agg(F.min(F.struct("node", "set_key")).alias("least")).select("least.node", "least.set_key")
    rows = docs.select(row.alias("row"), by_key.alias("node"), F.col(f"`{text}`").alias("text"), F.xxhash64(*columns).alias("order"))
    rows = rows.join(shared, "node", "left_semi").select("row", "node", "order", "text")
    rows = rows.mapInArrow(_keyed, rows.drop("text").schema.add("set_key", "binary"))
    wordless = rows.filter("set_key is null").select("row")
    chosen = rows.join(kept, ["node", "set_key"]).groupBy("node", "set_key").agg(F.min_by("row", "order").alias("row")).select("row")
    return single.union(wordless).union(chosen).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
