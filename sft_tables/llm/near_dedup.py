"""MinHash near-dedup with tensored banding.

A banding scheme with m * m tables needs m * m band keys. Here each table's key joins one of m left and one of m right
sub-keys, so 2 m sub-keys of ROWS minima each serve m * m tables: hash work falls to about a square root. Candidates
that meet in a table are verified on their full shingle sets.

Documents with the same shingle set are one node from the start. Tables with the same members count once. In each
table the member whose sub-keys are most widely shared is compared with all others; tables whose members are then not
all connected are searched further, pairs of connected members left out, and tables that overlap much as one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sft_tables.llm.common import ROLL, give_back, mixed, pack, read_table, stored, text_bytes, text_rows, unpack, word_hashes

#: Minima per sub-key; and how often a pair right at the similarity asked for may be missed.
ROWS = 2
MISSED = 3e-4
#: Most members of a table, or edges of one node, that one group of the verification holds.
GROUP = 512
LAST_ID = 2**63 - 1
#: Shingles are compared by 56 bits of their hashes.
SHINGLE_BITS = np.uint64(2**56 - 1)


def sub_keys_needed(percent: int) -> int:
    """Smallest m for which 1 - (1 - (1 - s**ROWS)**m)**2 is at most MISSED at similarity s."""
    miss = 1 - (percent / 100) ** ROWS
    return max(1, math.ceil(math.log(1 - math.sqrt(1 - MISSED)) / math.log(miss))) if miss else 1


def shingles(hashes: np.ndarray, first: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, ascending, and where each row's begin (one more than rows).

    Rows with fewer words than a shingle have the whole sequence as their only one; rows without words have none.
    """
    n = np.diff(first)
    value = np.zeros(len(hashes), np.uint64)
    for i in range(words):
        value = mixed(value * ROLL + np.append(hashes, np.zeros(words, np.uint64))[i:i + len(hashes)])
    row = np.repeat(np.arange(len(n)), n)
    whole = np.arange(len(hashes)) + words <= first[1:][row]
    value, owner = value[whole], row[whole]
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        tail = np.full(len(short), np.uint64(0x51ED270B7A3F39C5))
        for i in range(words - 1):
            has = n[short] > i
            tail[has] = mixed(tail[has] * ROLL + hashes[first[:-1][short[has]] + i])
        value, owner = np.concatenate([value, tail]), np.concatenate([owner, short])
    value &= SHINGLE_BITS
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]) if len(value) else np.zeros(0, bool)
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(n) + 1))


def reduced(ufunc: np.ufunc, values: np.ndarray, cuts: np.ndarray, filled: np.ndarray, empty: int) -> np.ndarray:
    out = np.full(len(cuts) - 1, np.uint64(empty))
    if filled.any():
        out[filled] = ufunc.reduceat(values, cuts[:-1][filled])
    return out


def digests(value: np.ndarray, cuts: np.ndarray) -> list[bytes | None]:
    """128 bits of each row's set, whatever the order; null for an empty set."""
    filled = np.diff(cuts) > 0
    size = np.diff(cuts).astype(np.uint64)
    parts = [mixed(reduced(np.add, mixed(value + np.uint64(salt)), cuts, filled, 0) + size) for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)]
    raw = np.stack(parts, 1).view(np.uint8).reshape(len(filled), 16)
    return [r.tobytes() if f else None for r, f in zip(raw, filled)]


def sub_keys(value: np.ndarray, cuts: np.ndarray, m: int) -> np.ndarray:
    """The 2 m sub-keys of each row (rows x 2 m): hashes of ROWS minima each."""
    filled = np.diff(cuts) > 0
    out = np.empty((len(filled), 2 * m), np.uint64)
    rng = np.random.default_rng(20240229)
    salts = rng.integers(1, 2**63, (2 * m, ROWS, 2), dtype=np.uint64) | np.uint64(1)
    for k in range(2 * m):
        key = np.full(len(filled), np.uint64(k))
        for salt, factor in salts[k]:
            x = (value ^ salt) * factor
            key = mixed(key * ROLL + reduced(np.minimum, x ^ (x >> np.uint64(32)), cuts, filled, 0))
        out[:, k] = key
    return out


FEATURES = "doc_id bigint, n_shingles bigint, node binary, keys array<bigint>"


def features(docs: DataFrame, words: int, m: int) -> DataFrame:
    """(doc_id, n_shingles, node, keys): a null id becomes LAST_ID; node: digest of the shingle set, null if empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, hashes, first in text_rows(batches):
            value, cuts = shingles(hashes, first, words)
            keys = sub_keys(value, cuts, m).view(np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * 2 * m, pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(cuts), pa.int64()), pa.array(digests(value, cuts), pa.binary()), flat],
                                             ["doc_id", "n_shingles", "node", "keys"])
        give_back()

    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc_id"), "text").mapInArrow(run, FEATURES)


def tables(nodes: DataFrame, m: int) -> DataFrame:
    """(table, size, hub, node): members of the tables in which nodes meet, equal tables once; hub: the table's centre.

    Sub-keys that a node shares with no other cannot make it meet one, so only shared ones are paired.
    """
    single = nodes.select("node", F.posexplode("keys").alias("place", "key"))
    shared = single.groupBy("key", "place").agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1").select("key", "uses")
    # grouped by key and place, joined by key alone: both sides are exchanges, which adaptive execution can split
    kept = single.join(shared, "key").groupBy("node").agg(
        F.collect_list(F.when(F.col("place") < m, F.col("key"))).alias("left"), F.collect_list(F.when(F.col("place") >= m, F.col("key"))).alias("right"),
        F.sum("uses").alias("popular"))
    key = F.flatten(F.transform("left", lambda a: F.transform("right", lambda b: F.xxhash64(a, b))))
    members = stored(kept.select("node", "popular", F.explode(key).alias("table")), "near-tables")
    centre = F.struct("popular", "node")
    found = members.groupBy("table").agg(F.count(F.lit(1)).alias("size"), F.max(centre).alias("centre"), F.bit_xor(F.xxhash64("node")).alias("sum"),
                                         F.bit_xor(F.xxhash64("node", F.lit(1))).alias("sum2")).filter("size > 1")
    once = found.groupBy("size", "centre", "sum", "sum2").agg(F.min("table").alias("table"))
    return members.join(once.select("table", "size", F.col("centre.node").alias("hub")), "table").select("table", "size", "hub", "node")


def sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles): full packed sets of the wanted (doc_id, node)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, hashes, first in text_rows(batches):
            value, cuts = shingles(hashes, first, words)
            found = digests(value, cuts)
            rows = [i for i, node in enumerate(batch.column(1).to_pylist()) if node == found[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([found[i] for i in rows], pa.binary()), pa.array([pack(np.diff(value[cuts[i]:cuts[i + 1]], prepend=np.uint64(0))) for i in rows],
                                                                           pa.binary())], ["node", "shingles"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc_id"), "text")
    # rows that share an id are told apart by their sets; equal rows are left once by the grouping below
    chosen = rows.join(wanted, "doc_id").select("doc_id", "node", "text").mapInArrow(run, "node binary, shingles binary")
    return chosen.groupBy("node").agg(F.min("shingles").alias("shingles"))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def spread(count: Column, group: int) -> Column:
    """How many groups of about ``group``."""
    return F.ceil(count / group).cast("int")


def verified_hubs(found: DataFrame, full: DataFrame, percent: int, group: int) -> DataFrame:
    """Links (left, right) among distinct (hub, node), on full sets.

    Each hub's nodes are dealt out to groups of about ``group``, with the hub's set in front of each group; sets are read
    as a sorted stream, one at a time.
    """
    edges = found.filter("hub != node").select("hub", "node").distinct()
    parts = per_key(edges, "hub", F.count(F.lit(1)).alias("n")).select("hub", spread(F.col("n"), group).alias("parts"))
    dealt = edges.join(parts, "hub").select("hub", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), "node")
    nodes = dealt.join(full, "node").select("hub", "part", F.lit(1).alias("kind"), "node", "shingles")
    heads = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(
        full.withColumnRenamed("node", "hub"), "hub").select("hub", "part", F.lit(0).alias("kind"), F.col("hub").alias("node"), "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for h, kind, node, data in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if kind == 0:
                    hub, own = h, unpacked(data)
                elif linked(own, unpacked(data), percent):
                    out.append((hub, node))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.binary()) for i in (0, 1)], ["left", "right"])

    return nodes.unionByName(heads).repartition("hub", "part").sortWithinPartitions("hub", "part", "kind").mapInArrow(run, "left binary, right binary")


def per_key(rows: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """Aggregates by a key, to be joined back to rows of that key.

    Grouped by the key and its hash, so the result is not laid out by the key alone: both sides of the join are then
    exchanges, which adaptive execution can split where a key is hot.
    """
    return rows.groupBy(key, F.xxhash64(key).alias("_h")).agg(*aggregates).drop("_h")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the links: root is the smallest node connected with it.

    Large and small stars by turns: every round joins each node's neighbours to the smallest of them, until nothing
    changes. Rounds are written to the shared folder.
    """
    edges = stored(links.select(F.greatest("left", "right").alias("a"), F.least("left", "right").alias("b")).filter("a != b").distinct(), "near-links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours of a go to the smallest node around a
        least = per_key(both, "a", F.min(F.least("a", "b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = stored(large, "near-large")
        # small star: a and its smaller neighbours go to the smallest of them
        low = per_key(large, "a", F.min("b").alias("m"))
        small = large.join(low, "a").select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))))
        edges = stored(small.filter("a != b").distinct(), "near-small")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def units(placed: DataFrame) -> DataFrame:
    """(unit, node, root, inside, tables): members of the unresolved tables, a node once per unit.

    A unit is a table, or all tables around one connected part (the largest of each) where they overlap so much that
    comparing their members once is less work than comparing them table by table. ``tables``: those of the unit in which
    the node was not the centre, for a centre has been compared with all others; at most one per pair of sub-keys.
    """
    parts = placed.groupBy("table", "root").agg(F.count(F.lit(1)).alias("n"))
    main = per_key(parts, "table", F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts"))
    main = main.filter("parts > 1").select("table", F.col("main.root").alias("main"), ((F.col("size") - F.col("main.n")) * F.col("size")).alias("pairs"))
    rows = stored(placed.join(main, "table").select(
        "table", "main", "pairs", "node", "root", (F.col("root") == F.col("main")).alias("inside"), F.when(F.col("hub") != F.col("node"), F.col("table")).alias("open")), "near-rows")
    alone = rows.groupBy("main", "table").agg(F.first("pairs").alias("pairs")).groupBy("main").agg(F.sum("pairs").alias("by_table"))
    once = rows.groupBy("main", "node").agg(F.first("inside").alias("inside")).groupBy("main").agg(
        F.count_if(~F.col("inside")).alias("outside"), F.count(F.lit(1)).alias("size"))
    joined = once.join(alone, "main").filter(F.col("outside") * F.col("size") < F.col("by_table")).select("main", F.lit(True).alias("together"))
    # written, so that rows of a hot part are not brought together for it
    joined = stored(joined, "near-together")
    unit = F.when(F.col("together"), F.xxhash64("main", F.lit(3))).otherwise(F.col("table"))
    return rows.join(joined, "main", "left").withColumn("unit", unit).groupBy("unit", "node").agg(
        F.first("root").alias("root"), F.first("inside").alias("inside"), F.collect_set("open").alias("tables"))


def unresolved(found: DataFrame, roots: DataFrame, full: DataFrame, percent: int, group: int) -> DataFrame:
    """Links (left, right) inside tables of three or more whose members are not yet all connected.

    Members of the largest connected part of a unit are compared with those outside it, and these among each other, if
    they share a table. Large units are cut: the largest part is dealt out to groups, those outside meet every group, and
    each other in groups of two of their shares.
    """
    placed = found.filter("size > 2").join(roots, "node", "left").select("table", "hub", "node", F.coalesce("root", "node").alias("root"))
    members = stored(units(stored(placed, "near-placed")), "near-units")
    sizes = per_key(members, "unit", F.count_if("inside").alias("_in"), F.count_if(~F.col("inside")).alias("_out"))
    rows = members.join(sizes, "unit").select(
        "unit", "node", "root", "inside", "tables", F.greatest(spread(F.col("_in"), group), F.lit(1)).alias("deals"), spread(F.col("_out"), group).alias("shares"))
    deal, share = F.pmod(F.xxhash64("node"), "deals").cast("int"), F.pmod(F.xxhash64("node", F.lit(7)), "shares").cast("int")
    # inside: one deal against every share; outside: every deal, and every other share
    other = F.sequence(F.lit(0), F.col("shares") - 1)
    inside = F.transform(other, lambda s: F.struct(deal.alias("x"), s.alias("y")))
    outside = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("deals") - 1), lambda d: F.struct(d.alias("x"), share.alias("y"))),
        F.transform(other, lambda s: F.struct((-1 - F.least(s, share)).alias("x"), F.greatest(s, share).alias("y"))))
    groups = rows.join(full, "node").select("unit", "node", "root", "inside", "tables", "shingles", F.inline(F.when(F.col("inside"), inside).otherwise(outside)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        key = None
        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            for i in range(0, batch.num_rows, 256):
                for row in batch.slice(i, 256).to_pylist():
                    now = (row["unit"], row["x"], row["y"])
                    if now != key:
                        out += links_within(held, percent)
                        held, key = [], now
                    held.append(row)
            yield pairs_batch(out)
        yield pairs_batch(links_within(held, percent))

    return groups.repartition("unit", "x", "y").sortWithinPartitions("unit", "x", "y").mapInArrow(run, "left binary, right binary")


def pairs_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["left", "right"])


def links_within(rows: list[dict], percent: int) -> list[tuple[bytes, bytes]]:
    """Links that connect members of different parts that share a table; pairs that are connected meanwhile are not compared."""
    outside = [r for r in rows if not r["inside"]]
    if not outside or len(rows) < 2:
        return []
    top = {r["root"]: r["root"] for r in rows}

    def find(x: bytes) -> bytes:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    shared = {r["node"]: frozenset(r["tables"]) for r in rows}
    full = {r["node"]: unpacked(r["shingles"]) for r in rows}
    inside = [r for r in rows if r["inside"]]
    out = []
    for i, a in enumerate(outside):
        mine = shared[a["node"]]
        # those outside that came before a have been compared with it
        for b in inside + outside[i + 1:]:
            if mine.isdisjoint(shared[b["node"]]):
                continue
            x, y = find(a["root"]), find(b["root"])
            if x != y and linked(full[a["node"]], full[b["node"]], percent):
                top[max(x, y)] = min(x, y)
                out.append((a["node"], b["node"]))
    return out


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, group: int = GROUP) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Words are runs of other than ASCII white space, A-Z lower-cased. Documents are linked when 100 * common shingles >=
    ``percent`` * all shingles of the two; component_id is the smallest id reachable. Documents without words, null
    texts too, are linked with nothing: their component is themselves. Rows with equal sets, repeated rows too, are one
    node. A null id counts as larger than all others, and is given back as null. An empty table gives no rows;
    further columns are ignored.

    A pair at exactly ``percent`` is missed as a candidate with probability at most MISSED, a closer one less often.
    """
    m = sub_keys_needed(percent)
    kind = docs.schema["doc_id"].dataType
    rows = stored(features(docs, words, m), "near-features")
    nodes = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), *[
        F.min(F.col("keys")[i]).alias(f"k{i}") for i in range(2 * m)])
    nodes = nodes.select("node", "doc_id", F.array(*[f"k{i}" for i in range(2 * m)]).alias("keys"))
    found = stored(tables(nodes, m), "near-found")
    wanted = found.select("node").distinct().join(nodes.select("node", "doc_id"), "node").select("doc_id", "node")
    full = stored(sets(docs, wanted, words), "near-sets")

    links = stored(verified_hubs(found, full, percent, group), "near-links")
    more = stored(unresolved(found, components(links), full, percent, group), "near-more")
    roots = components(links.unionByName(more))

    grouped = nodes.select("node", F.col("doc_id").alias("_least")).join(roots, "node")
    least = per_key(grouped, "root", F.min("_least").alias("component_id"))
    named = roots.join(least, "root").select("node", "component_id")
    alone = nodes.select("node", F.col("doc_id").alias("_least")).join(named, "node", "left").select(
        "node", F.coalesce("component_id", "_least").alias("component_id"))
    alone = stored(alone, "near-components")
    out = rows.filter("node is not null").join(alone, "node").select("doc_id", "n_shingles", "component_id").unionByName(
        rows.filter("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))

    def back(c: str) -> Column:
        return F.when(F.col(c) != LAST_ID, F.col(c)).cast(kind).alias(c)

    return out.select(back("doc_id"), "n_shingles", back("component_id"), (F.col("doc_id") == F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, as given, whose id is the smallest of their group; of rows that share such an id, all.

    Documents without words are alone in their group and stay, null texts too; a null id stays only where its group has
    no other. An empty table gives no rows; columns of any name are kept.
    """
    kept = near_groups(docs, words, percent).filter("kept").select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("id")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("id"))
    return rows.join(kept, "id", "left_semi").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return near_groups(read_table(spark, sf_dir, "documents"), words=3, percent=85)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
                                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * p.c >= 85 * (nx.n + ny.n - p.c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
e AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM e LEFT JOIN n USING (doc_id)
"""
