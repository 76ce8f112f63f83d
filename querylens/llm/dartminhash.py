"""Near-duplicate groups by DartMinHash signatures and banded joining.

A text is the weighted set of its five-word shingles, a shingle's weight being
how often it occurs. Darts fall on the plane of (shingle, weight) at hashed
places and ranks, the same for every text. A text owns the darts inside its
regions; each dart belongs to a hashed coordinate, and the earliest of each
coordinate is the signature. Two texts agree in a coordinate with the
probability of their weighted Jaccard similarity. The work is that of the
shingles plus that of some k log k darts, however large k is.

Texts with equal signatures in a band of coordinates are candidates. They are
joined through the first text of their bucket, verified by their shingles,
and only the members that are not connected by that are compared further.
Texts with the same weighted set are one node from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from querylens.llm.common import byte_words, give_back, keep_nothing, limit_batches, text_chunks
from querylens.operators.joins import BROADCAST_BYTES, lookup_join, measured_bytes
from querylens.sources.scratch import materialize

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 shares a band with probability 0.99993.
BANDS = 24
ROWS = 5
# Bits that mark which parts of the hash range a set's regions fall in; they tell most for sets up to about as many regions.
MARKS = 1024
# Pairs of one node that a single task may compare: each brings a set.
HOT_PAIRS = 100_000

_U = np.uint64
_BLANK = 32


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_STEP = 0x9E3779B97F4A7C15  # odd, with bits as irregular as those of the golden ratio


def _offset(n: int) -> np.uint64:
    return _U(n * _STEP % (1 << 64))


def _unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def _runs(new: np.ndarray) -> np.ndarray:
    """For each place, the place where its run began; ``new`` marks the beginnings."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word of several texts that lie one after the other in ``data``."""
    low = np.frombuffer(byte_words(), np.uint8)[data]
    inside = low != _BLANK
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = inside[edges]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, _U), np.empty(0, np.int64)
    first = begins[at]
    starts = at[first]
    place = at - at[_runs(first)]
    powers = np.full(int(place.max()) + 1, 0x100000001B3, _U)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    terms = (low[at].astype(_U) + _U(1)) * powers[place]
    hashes = _mix(np.add.reduceat(terms, np.flatnonzero(first)))
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each shingle; a text with fewer words than ``size`` has one of all its words."""
    hashes, doc = _word_hashes(data, offsets)
    n = len(hashes)
    if not n:
        return hashes, doc
    more, other = np.concatenate([hashes, np.zeros(size, _U)]), np.concatenate([doc, np.full(size, -1)])
    total = hashes * _offset(1)
    for i in range(1, size):
        total = total + np.where(other[i : n + i] == doc, more[i : n + i], _U(0)) * _offset(i + 1)
    full = other[size - 1 : n + size - 1] == doc
    begins = np.concatenate([[True], doc[1:] != doc[:-1]])
    kept = full | begins & ~full
    return _mix(total[kept]), doc[kept]


def regions(shingle: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit regions of each text's weighted set: its shingles' first, second, ... occurrence; sorted within a text."""
    order = np.lexsort((shingle, doc))
    shingle, doc = shingle[order], doc[order]
    new = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])]) if len(doc) else np.empty(0, bool)
    copy = (np.arange(len(doc)) - _runs(new)).astype(_U)
    return _mix(shingle + copy * _U(_STEP)), doc


def dart_signatures(region: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates for each text, as (n_docs, k) hashes; 0 for texts without regions.

    Darts of a unit region come at the arrival times of a Poisson process of
    rate one, drawn from the region's hash. Darts up to time ``limit`` are
    thrown, some k ln k + 2 k per text. If a coordinate got none, the text's
    limit is doubled, which leaves the darts thrown before as they are.
    """
    weight = np.bincount(doc, minlength=n_docs).astype(np.float64)
    limit = (k * np.log(k) + 2 * k) / np.maximum(weight, 1)
    found = np.zeros((n_docs, k), _U)
    todo = weight > 0
    while todo.any():
        alive = np.flatnonzero(todo[doc])
        time = np.zeros(len(alive))
        earliest = np.full(n_docs * k, np.inf)
        thrown = []
        step = 0
        while len(alive):
            step += 1
            draw = _mix(region[alive] + _offset(2 * step))
            time = time - np.log(_unit(draw))
            hit = time <= limit[doc[alive]]
            alive, time = alive[hit], time[hit]
            dart = _mix(region[alive] + _offset(2 * step + 1))
            slot = doc[alive] * k + (dart >> _U(33)).astype(np.int64) % k
            np.minimum.at(earliest, slot, time)
            thrown.append((slot, time, dart))
        for slot, at, dart in thrown:
            first = earliest[slot] == at
            found.reshape(-1)[slot[first]] = dart[first]
        todo &= np.isinf(earliest).reshape(n_docs, k).any(axis=1)
        limit[todo] *= 2
    return found


def _set_ids(region: np.ndarray, doc: np.ndarray, n_docs: int) -> list[bytes | None]:
    """A 128-bit hash of each text's weighted set; None for a text without words."""
    size = np.bincount(doc, minlength=n_docs)
    sums = np.zeros((n_docs, 2), _U)
    if len(region):
        starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        for i in (0, 1):
            sums[doc[starts], i] = np.add.reduceat(_mix(region + _offset(1000 + i)), starts)
    raw = (sums + size.astype(_U)[:, None] * _U(_STEP)).astype(">u8").tobytes()
    return [raw[16 * i : 16 * i + 16] if size[i] else None for i in range(n_docs)]


def _bands(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    hashes = np.zeros((len(signature), bands), _U)
    for i in range(bands):
        value = np.full(len(signature), _offset(i + 1), _U)
        for j in range(rows):
            value = _mix(value ^ signature[:, i * rows + j]) + _offset(j + 1)
        hashes[:, i] = _mix(value)
    return hashes.view(np.int64)


def _marks(region: np.ndarray, doc: np.ndarray, n_docs: int) -> pa.Array:
    """``MARKS`` bits for each text, as a list of 64-bit numbers: the parts of the hash range with regions of the text."""
    bits = np.zeros((n_docs, MARKS), bool)
    bits[doc, (region >> _U(32)) * _U(MARKS) >> _U(32)] = True
    longs = np.packbits(bits, axis=1).reshape(-1).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(n_docs + 1) * (MARKS // 64), pa.int32()), pa.array(longs))


def _with_arrow(df: DataFrame, text: str, fields: list[T.StructField], make) -> DataFrame:
    limit_batches(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*kept, *fields])

    def run(batches):
        keep_nothing()
        for batch in batches:
            index = {f.name: i for i, f in enumerate(batch.schema)}
            at = 0
            for data, offsets in text_chunks(batch.column(index[text])):
                part = batch.slice(at, len(offsets) - 1)
                at += len(offsets) - 1
                columns = [part.column(index[f.name]) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, *make(data, offsets)], names=schema.names)
        give_back()

    return df.mapInArrow(run, schema)


def signatures(docs: DataFrame, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs`` with ``node``, the hash of its weighted set, ``n``, its weight, and a hash of each of its ``bands``, without the text."""
    fields = [
        T.StructField("node", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]

    def make(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        n = len(offsets) - 1
        region, doc = regions(*shingles(data, offsets))
        hashes = _bands(dart_signatures(region, doc, n, bands * rows), bands, rows)
        ends = pa.array(np.arange(n + 1) * bands, pa.int32())
        found = pa.ListArray.from_arrays(ends, pa.array(hashes.reshape(-1)))
        size = pa.array(np.bincount(doc, minlength=n), pa.int64())
        return [pa.array(_set_ids(region, doc, n), pa.binary()), size, found]

    return _with_arrow(docs, text, fields, make)


def weighted_sets(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``node``, ``regions``, 32-bit hashes of its weighted set, and its ``marks`` in place of the text."""
    fields = [
        T.StructField("node", T.BinaryType()),
        T.StructField("regions", T.ArrayType(T.IntegerType())),
        T.StructField("marks", T.ArrayType(T.LongType())),
    ]

    def make(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        n = len(offsets) - 1
        region, doc = regions(*shingles(data, offsets))
        ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
        short = pa.array((region >> _U(32)).astype(np.uint32).view(np.int32))
        found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), short)
        return [pa.array(_set_ids(region, doc, n), pa.binary()), found, _marks(region, doc, n)]

    return _with_arrow(docs, text, fields, make)


def _similar(a: Column, b: Column, least: float) -> Column:
    """Whether the part two weighted sets have in common reaches ``least``: weighted Jaccard, as copies are regions."""
    common = F.size(F.array_intersect(a, b))
    return common >= least * (F.size(a) + F.size(b) - common)


def _sizes_fit(a: str, b: str, least: float) -> Column:
    """Sets that differ more in size can't be similar enough."""
    return (F.col(a) >= F.col(b) * least) & (F.col(b) >= F.col(a) * least)


def _marks_fit(a: str, b: str, marks_a: str, marks_b: str, least: float) -> Column:
    """False only for sets that can't be similar enough.

    Each part of the hash range in which one set has regions and the other has
    none is a region that isn't common.
    """

    def common(n: str, have: str, other: str) -> Column:
        at = range(MARKS // 64)
        alone = [F.bit_count(F.get(have, F.lit(i)).bitwiseAND(F.bitwise_not(F.get(other, F.lit(i))))) for i in at]
        return F.col(n) - sum(alone[1:], alone[0])

    needed = (F.col(a) + F.col(b)) * (least / (1 + least)) - 1e-9
    return (common(a, marks_a, marks_b) >= needed) & (common(b, marks_b, marks_a) >= needed)


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The stored ``pairs`` (a, b, root_a, root_b) whose sets are similar enough.

    The pair's own columns are narrow when they meet the set of ``a``, which
    may be the leader of a large bucket; then ``b``, which has few leaders.
    """
    left = sets.select(F.col("id").alias("a"), F.col("regions").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("regions").alias("of_b"))
    both = lookup_join(pairs, left, ["a"], "inner", hot_rows=HOT_PAIRS).join(right, "b")
    return both.where(_similar(F.col("of_a"), F.col("of_b"), least)).select("root_a", "root_b")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of stored ``edges`` (a, b) is connected with.

    Each round gives every node the smallest root around it and then its
    root's root, so paths shorten by more than half. Rounds go on until
    nothing changes. A hub's edges meet in a minimum, which is combined before
    the shuffle.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = materialize(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))), "edges")
    roots = both.groupBy("node").agg(F.min("other").alias("root"))
    roots = materialize(roots.select("node", F.least("node", "root").alias("root")), "roots")
    while True:
        of_other = roots.select(F.col("node").alias("other"), F.col("root").alias("near"))
        near = both.join(of_other, "other").groupBy("node").agg(F.min("near").alias("near"))
        # A root takes over the smallest root that any of its nodes saw.
        seen = materialize(roots.join(near, "node").select("node", "root", F.least("root", "near").alias("near")), "seen")
        lifted = seen.groupBy("root").agg(F.min("near").alias("lifted"))
        moved = seen.join(lifted, "root").select("node", "root", F.least("near", "lifted").alias("new"))
        moved = materialize(moved, "moved")
        if moved.where("new < root").isEmpty():
            return roots
        jump = moved.select(F.col("node").alias("new"), F.col("new").alias("next"))
        roots = materialize(moved.join(jump, "new").select("node", F.least("new", "next").alias("root")), "roots")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame | None:
    """Stored ``roots`` (id, root) after joining the groups between which there are ``links``; None without links.

    Only one link of each two groups goes on, and the groups are single nodes
    to what connects them, so the graph shrinks with each call.
    """
    ends = [F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")]
    edges = materialize(links.select(*ends).distinct(), "links")
    if edges.isEmpty():
        return None
    new = connected(edges).select(F.col("node").alias("root"), F.col("root").alias("new"))
    known = lookup_join(roots, new, ["root"])
    return materialize(known.select("id", F.coalesce("new", "root").alias("root")), "groups")


def _with_leaders(shared: DataFrame, similarity: float) -> DataFrame:
    """(a, b, root_a, root_b): each leader and member of a bucket that may be similar, once; each is its own root."""
    far = shared.where((F.col("id") != F.col("leader")) & _sizes_fit("n", "leader_n", similarity))
    pairs = far.select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    return pairs.select("a", "b", F.col("a").alias("root_a"), F.col("b").alias("root_b"))


def _strangers(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(id): all members of the buckets of which some member is not in the group of the leader, as a stored table."""
    of_leader = roots.select(F.col("id").alias("leader"), F.col("root").alias("leader_root"))
    known = lookup_join(shared.join(roots, "id"), of_leader, ["leader"])
    mixed = materialize(known.where("root != leader_root").select("bucket").distinct(), "mixed-buckets")
    return materialize(lookup_join(shared, mixed, ["bucket"], "inner").select("id").distinct(), "strangers")


def _prefixes(strangers: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(id, n, marks, alone, prefix): the regions by which ``strangers`` may meet, as a stored table of one row for each.

    Many texts may share a passage, and so a bucket, without being similar. So
    the pairs of a bucket are not written out. Regions are put in order, rare
    ones first: similar sets have a region in common among the first ones, the
    prefix of each. Regions that only one set has, ``alone``, come before all
    others and are left out.
    """
    members = sets.join(strangers, "id").select("id", F.size("regions").cast("long").alias("n"), "marks", "regions")
    members = materialize(members, "members")
    each = members.select("id", F.explode("regions").alias("region"))
    often = each.groupBy("region").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    ordered = each.join(often, "region").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("often", "region"))).alias("ordered")  # as long as the set itself
    )
    ordered = members.select("id", "n", "marks").join(ordered, "id")
    alone = F.col("n") - F.size("ordered")
    prefix = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1
    first = F.greatest(prefix - alone, F.lit(0)).cast("int")
    regions = F.slice(F.col("ordered.region"), F.lit(1), first)
    return materialize(ordered.select("id", "n", "marks", alone.alias("alone"), regions.alias("prefix")), "prefixes")


def _meeting(prefixes: DataFrame, roots: DataFrame) -> DataFrame:
    """A row for each node and region of its prefix in which several groups meet, as a stored table.

    ``left`` is the part of the node's set from the region on, and ``top`` the
    root of most members of the region. Roots are looked up by node before the
    prefixes are laid out, so a long text is one row there.
    """
    rows = prefixes.join(roots, "id").select("id", "root", "n", "marks", "alone", F.posexplode("prefix").alias("place", "region"))
    left = F.col("n") - F.col("alone") - F.col("place")
    rows = materialize(rows.select("id", "root", "n", "marks", left.alias("left"), "region"), "prefix-roots")
    groups = rows.groupBy("region", "root").agg(F.count(F.lit(1)).alias("members"))
    largest = groups.groupBy("region").agg(F.max_by("root", "members").alias("top"), F.count(F.lit(1)).alias("groups"))
    return materialize(rows.join(largest.where("groups > 1").select("region", "top"), "region"), "meeting")


def _may_be_similar(similarity: float) -> Column:
    needed = (F.col("n") + F.col("o_n")) * (similarity / (1 + similarity)) - 1e-9
    enough = (F.col("left") >= needed) & (F.col("o_left") >= needed)
    fit = _sizes_fit("n", "o_n", similarity) & enough & _marks_fit("n", "o_n", "marks", "o_marks", similarity)
    return (F.col("root") != F.col("o_root")) & fit


_OTHER = ("region", "o_id", "o_root", "o_n", "o_marks", "o_left")


def _each_once(both: DataFrame) -> DataFrame:
    first = F.col("id") < F.col("o_id")

    def ordered(name: str, other: str) -> list[Column]:
        return [F.when(first, F.col(name)).otherwise(F.col(other)), F.when(first, F.col(other)).otherwise(F.col(name))]

    (a, b), (root_a, root_b) = ordered("id", "o_id"), ordered("root", "o_root")
    return both.select(a.alias("a"), b.alias("b"), root_a.alias("root_a"), root_b.alias("root_b")).distinct()


def _with_one_of_each_region(meeting: DataFrame, similarity: float) -> DataFrame:
    """Pairs of each node with one other of each of its regions."""
    drawn = meeting.groupBy("region").agg(F.min_by("id", F.xxhash64("id", "region")).alias("id"))
    drawn = meeting.join(drawn, ["region", "id"]).select("region", "id", "root", "n", "marks", "left").toDF(*_OTHER)
    return _each_once(meeting.join(drawn, "region").where(_may_be_similar(similarity)))


def _with_all_of_each_region(meeting: DataFrame, similarity: float) -> DataFrame:
    """Pairs of all that may be similar; one of the two is outside its region's largest group."""
    others = meeting.where("root != top").select("region", "id", "root", "n", "marks", "left").toDF(*_OTHER)
    return _each_once(meeting.join(others, "region").where(_may_be_similar(similarity)))


def _candidate_sets(rows: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(id, regions, marks) of the nodes ``members``, as a stored table.

    The texts are read once more, only those of each node's smallest document id.
    """
    candidates = materialize(nodes.join(members, "id").select("id", "node", "doc_id"), "candidates")
    wanted = materialize(candidates.select("doc_id").distinct(), "candidate-ids")
    if measured_bytes(wanted) <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    wanted = wanted.select(F.col("doc_id").alias("wanted"))
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    sets = weighted_sets(texts, "text").join(candidates.select("id", "node"), "node")
    return materialize(sets.select("id", "regions", "marks").dropDuplicates(["id"]), "sets")


def links(nodes: DataFrame, rows: DataFrame, similarity: float) -> DataFrame | None:
    """(id, root) of all nodes that share a bucket, None if there are none; linked nodes have the same root.

    Each node is compared with the leaders of its buckets, then with one node
    of each rare region it shares, and at last with all that may be similar
    still. Pairs that are connected already are not compared from the second
    step on, so little is left for the last, which makes the result exact
    whatever the steps before it found.
    """
    bucket = nodes.select("id", "n", F.explode("bands").alias("bucket"))
    first = [F.min("id").alias("leader"), F.min_by("n", "id").alias("leader_n")]
    leaders = bucket.groupBy("bucket").agg(*first, F.count(F.lit(1)).alias("members")).where("members > 1")
    leaders = materialize(leaders.select("bucket", "leader", "leader_n"), "leaders")
    if leaders.isEmpty():
        return None
    shared = materialize(lookup_join(bucket, leaders, ["bucket"], "inner"), "buckets")
    members = materialize(shared.select("id").distinct(), "members")
    sets = _candidate_sets(rows, nodes, members)
    roots = members.select("id", F.col("id").alias("root"))

    def compare(pairs: DataFrame) -> None:
        nonlocal roots
        found = _joined(roots, _verified(materialize(pairs, "pairs"), sets, similarity))
        roots = roots if found is None else found

    compare(_with_leaders(shared, similarity))
    prefixes = _prefixes(_strangers(shared, roots), sets, similarity)
    compare(_with_one_of_each_region(_meeting(prefixes, roots), similarity))
    compare(_with_all_of_each_region(_meeting(prefixes, roots), similarity))
    return roots


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, class_id), the smallest id of the group it belongs to.

    Two documents are linked if the weighted Jaccard similarity of their
    shingles is at least ``similarity``; a group is what links connect. Texts
    of fewer than five words have one shingle, all their words. Texts
    without words, NULL and empty ones included, are groups of their own, each
    with its own id. A NULL id has the class of its text, NULL only if no
    document there has an id. Rows with the same text are one group, whatever
    their ids. An empty table gives an empty one.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed = materialize(signatures(texts, "text", bands, rows), "signatures")
    # One row per weighted set: copies go no further than this aggregate, which is combined before the shuffle.
    same = signed.where("node is not null").groupBy("node")
    nodes = same.agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    # Stored, so each node keeps its number; 64 bits are enough for numbers, while hashes of so many could meet.
    nodes = materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    roots = links(nodes, texts, similarity)
    classes = nodes.select("id", "node", F.col("doc_id").alias("class_id"))
    if roots is not None:
        smallest = classes.join(roots, "id").groupBy("root").agg(F.min("class_id").alias("smallest"))
        smallest = lookup_join(roots, materialize(smallest, "smallest"), ["root"]).select("id", "smallest")
        classes = classes.join(smallest, "id", "left")
        classes = classes.select("node", F.coalesce("smallest", "class_id").alias("class_id"))
    rows_out = signed.select("doc_id", "node").join(classes, "node", "left")
    alone = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return rows_out.select("doc_id", alone.alias("class_id"))
