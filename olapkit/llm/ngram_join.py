"""N-gram Jaccard self-join of documents by vertical partitioning, and the components of its links.

A document is its set of five-word shingles (64-bit hashes). Two documents link when
``100 * |x & y| >= 80 * |x | y|``. With ``S = |x| + |y|`` and ``d = |x ^ y|`` that is ``9 * d <= S``.

1. All shingles are counted, as sorted numbers of ``SLOT`` bits that are shuffled by their differences. A sketch keeps the
   count of the most frequent shingle of every cell, so rare shingles add nothing to a cell, however many there are; it
   orders the shingles, rare before frequent (then by hash). Its cells grow with the texts.
2. Equal sets form a class (SHA digest), joined once. A class is a node; its number puts often copied classes first.
3. The leading fragment of every set in the global order (its prefix) must share a shingle with every partner's.
   Shingles in two or more prefixes are buckets. A bucket of at most ``SMALL`` nodes gives its pairs, and a pair
   needs so many common prefix shingles that the rest can still reach the bound. A larger bucket does not: its members
   join the group of its first node.
4. Pairs are verified by fragments: the global order is cut into ``FRAGMENTS`` parts of about equal mass, each
   fragment's overlap is counted by its own row, and the partial counts are summed per pair.
5. A group gets a reference set C, the shingles that most of some ``VOTERS`` of its members hold. With ``X = x ^ C`` and
   ``b(x) = 9 |X| - |x|``, x and y link if and only if ``18 |X & Y| >= b(x) + b(y)``, whatever C is. Let c be the member
   of the smallest b, the centre. If ``b(x) + b(c) <= 0``, x links with c; these pairs are verified, and so such members
   are in one component, whatever their links among each other. For any other member z, ``b(z) + b(y) > 0`` for all y, so
   Z and Y share an element; with ``|y| <= 5/4 |z|`` at least ``s(z) = max(1, (b(z) + b(c)) / 18, |Z| - |z| / 4)`` of
   them, and from y's side ``s(y) = max(1, (b(y) - b(c) + 1) / 18, |Y| - |y| / 4)``. So they meet among the first
   ``|Z| - s(z) + 1`` of Z and ``|Y| - s(y) + 1`` of Y, in any order that all members use: shingles that several voters
   differ in come last. At their first common element both must have enough elements left. What a template shares is
   in C and in no difference; and of differences, (group, element) with at most ``CROWD`` members gives its pairs, while
   a larger one makes a group of its own in the next of at most ``LEVELS`` rounds (the last gives pairs for all).
6. Links give components by alternating stars; labels go back to the documents by their digest.

``links`` gives enough links for the components of all links, not all of them: two members that are both linked to a
centre are not compared. No component is lost, there are no caps, and a group of n near copies, or of n pages of one
template that do not link, costs about n rows, not n^2. Voters choose C and the order, on which only the work depends.

Defined results: null and empty texts, and texts without words, have an empty set and link with nothing; they are their
own component. Rows with a null id take no part in links and have a null component. Repeated rows are copies of each
other. An empty table gives an empty result. Only the id and text columns are read; other columns are dropped
(``report``) or passed through (``distinct_documents``).
"""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, stored
from .components import components
from .hashing import shingles, text_words

WORDS, SMALL, FRAGMENTS = 5, 9, 8
#: Sketch: 2^22 cells, and more (at most 2^26, a byte each) for texts of over 4 GB: a cell for about 1 KB.
SLOT_BITS, MOST_BITS, CELL_BYTES = 22, 26, 1024
#: Shingles are counted as numbers of so many bits, of which the first BLOCK_BITS say where; so many at a time in a task.
SLOT, BLOCK_BITS, FLUSH = 36, 13, 1 << 21
STEP_BYTES = -(-(SLOT - BLOCK_BITS) // 8)
#: A shingle is frequent above this many times the mean count of a number plus a constant.
FREQUENT_MEANS, FREQUENT_MORE = 8, 64
#: Members of a group that meet its reference set in one task; members that vote for it, on average.
GROUP, VOTERS = 256, 15
#: Members of a group that share an element of their differences and give pairs at once; rounds of groups made of more.
CROWD, LEVELS = 100, 3
#: Bits of the filter of wanted documents (fixed; when it is full it lets all pass, and the join decides). Its table of
#: 2^18 words at most is broadcast.
FILTER_BITS = 23


def _slots(h: np.ndarray, bits: int = SLOT_BITS) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _levels(h: np.ndarray, level: np.ndarray) -> np.ndarray:
    return level[_slots(h, len(level).bit_length() - 1)]


def _sets(batch: pa.RecordBatch, column: int, n: int):
    for row, words in text_words(batch.column(column)):
        yield row, shingles(words, n)


def _slices(batches, rows: int = 512):
    """Batches of at most ``rows`` rows, so that what is made of a batch stays small."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in sorted ``x``."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def _packed(sets: list[np.ndarray]) -> pa.RecordBatch:
    """(block, slots, repeats): the shingles' numbers in each block as differences of the sorted ones, byte by byte, and
    the places and counts of those that come more than once."""
    x = np.sort(np.concatenate(sets) >> np.uint64(64 - SLOT))
    at = _runs(x)
    x, count = x[at], np.diff(np.append(at, len(x))).astype(np.uint32)
    blocks = (x >> np.uint64(SLOT - BLOCK_BITS)).astype(np.int32)
    low = (x & np.uint64((1 << SLOT - BLOCK_BITS) - 1)).astype(np.int64)
    first = _runs(blocks)
    step = np.diff(low, prepend=0)
    step[first] = low[first]
    planes = step.astype("<u4").view(np.uint8).reshape(-1, 4)
    slots, repeats = [], []
    for i, j in zip(first, np.append(first[1:], len(x))):
        slots.append(zlib.compress(planes[i:j, :STEP_BYTES].T.tobytes(), 1))
        more = np.flatnonzero(count[i:j] > 1).astype(np.uint32)
        repeats.append(np.concatenate([more, count[i:j][more]]).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(blocks[first], pa.int32()), pa.array(slots, pa.binary()),
                                       pa.array(repeats, pa.binary())], ["block", "slots", "repeats"])


def _unpacked(slots: bytes, repeats: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in their block, and their counts."""
    planes = np.frombuffer(zlib.decompress(slots), np.uint8).reshape(STEP_BYTES, -1).astype(np.int64)
    count = np.ones(planes.shape[1], np.int64)
    more, times = np.frombuffer(repeats, np.uint32).reshape(2, -1)
    count[more] = times
    return np.cumsum(sum(plane << 8 * k for k, plane in enumerate(planes))), count


def _sketch(texts: DataFrame, n: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Level of every cell (8 log2(1 + count) of its most frequent shingle, one byte each), the mean count of a number,
    and the number of shingles in cells of each level."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(SLOT_BITS, (size // CELL_BYTES).bit_length()))
    cells = 1 << bits - BLOCK_BITS

    def count(batches):
        held, size = [], 0
        for b in batches:
            for _, s in _sets(b, 0, n):
                held.append(s)
                size += len(s)
                if size >= FLUSH:
                    yield _packed(held)
                    held, size = [], 0
        if size:
            yield _packed(held)

    def add(batches):
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        mass, made = np.zeros(256, np.int64), False
        for block, parts in itertools.groupby(rows, lambda row: row[0]):
            x, c = (np.concatenate(p) for p in zip(*(_unpacked(*part[1:]) for part in parts)))
            order = np.argsort(x, kind="stable")
            at = _runs(x := x[order])
            c = np.add.reduceat(c[order], at)
            cell = x[at] >> SLOT - bits
            first = _runs(cell)
            level = np.minimum(8 * np.log2(1 + np.maximum.reduceat(c, first)), 255).astype(np.uint8)
            mass += np.bincount(level, np.add.reduceat(c, first), 256).astype(np.int64)
            whole, made = np.zeros(cells, np.uint8), True
            whole[cell[first]] = level
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zlib.compress(whole.tobytes(), 1)])],
                                             ["block", "levels"])
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([mass.tobytes()])], ["block", "levels"])

    parts = texts.mapInArrow(count, "block int, slots binary, repeats binary").repartition("block").sortWithinPartitions(
        "block")
    levels, mass = np.zeros(1 << bits, np.uint8), np.zeros(256, np.int64)
    for block, data in parts.mapInArrow(add, "block int, levels binary").collect():
        if block < 0:
            mass += np.frombuffer(data, np.int64)
        else:
            levels[block * cells:(block + 1) * cells] = np.frombuffer(zlib.decompress(data), np.uint8)
    return levels, mass.sum() / (1 << SLOT), mass


def _digest(s: np.ndarray) -> bytes:
    return hashlib.sha1(s.tobytes()).digest()


def _digests(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, digest) of every row of (doc_id, text); the digest of an empty set is null."""

    def run(batches):
        for b in batches:
            size, digest = np.zeros(len(b), np.int64), [None] * len(b)
            for row, s in _sets(b, 1, n):
                size[row], digest[row] = len(s), _digest(s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(digest, pa.binary())],
                                             ["doc_id", "n_shingles", "digest"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary")


def prefix_length(n: np.ndarray | int):
    """``n - ceil(0.8 n) + 1`` in whole numbers."""
    return n - (4 * n + 4) // 5 + 1


def _prefixes(docs: DataFrame, levels, mean: float, n: int) -> DataFrame:
    """Rows with a set: its digest and prefix, split into rare and frequent shingles."""
    frequent = min(255, int(8 * np.log2(1 + FREQUENT_MEANS * mean + FREQUENT_MORE)))

    def run(batches):
        level = levels.value
        for b in _slices(batches):
            ids = b.column(0)
            rows, sizes, digests, rare, common = [], [], [], [], []
            for row, s in _sets(b, 1, n):
                lv = _levels(s, level)
                first = np.argsort(lv, kind="stable")[:prefix_length(len(s))]  # s is sorted: ties by hash
                hot = lv[first] >= frequent
                rows.append(row)
                sizes.append(len(s))
                digests.append(_digest(s))
                rare.append(s[first[~hot]].view(np.int64))
                common.append(s[first[hot]].view(np.int64))
            if rows:
                lists = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(rare, lists), pa.array(common, lists)], ["doc_id", "n", "digest", "rare", "frequent"])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, rare array<long>, frequent array<long>")


def _classes(prefixes: DataFrame) -> DataFrame:
    """One node per distinct set. Node numbers put often copied sets first, then follow the stored rows."""
    c = prefixes.groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("rare").alias("rare"), F.first("frequent").alias("frequent"))
    node = F.shiftleft(2047 - F.least("copies", F.lit(2047)), 50) + F.monotonically_increasing_id()
    return stored(c.select(node.alias("node"), "digest", "first_id", "n", "rare", "frequent"), "join-classes")


def _buckets(classes: DataFrame) -> DataFrame:
    """(shingle, node, n, hub, hub_n, members) of prefix shingles in two or more sets. Rare shingles meet in a window;
    those the sketch calls frequent get their hub by an aggregate that is combined before the shuffle, and the join
    back can be split."""
    rare = classes.select("node", "n", F.explode("rare").alias("shingle"))
    w = Window.partitionBy("shingle")
    few = rare.withColumn("members", F.count("*").over(w)).withColumn("hub", F.min("node").over(w)).where("members > 1")
    frequent = classes.select("node", "n", F.explode("frequent").alias("shingle"))
    hubs = frequent.groupBy("shingle").agg(F.min("node").alias("hub"), F.count("*").alias("members")).where("members > 1")
    cols = ["shingle", "node", "n", "hub", "members"]
    return stored(few.select(*cols).unionByName(frequent.join(hubs, "shingle").select(*cols)), "join-buckets")


def _fits(a: str = "xn", b: str = "yn") -> Column:
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def _near_pairs(buckets: DataFrame) -> DataFrame:
    """Pairs of small buckets that share enough prefix shingles. Common shingles in large buckets are not counted
    here; each side's number of them bounds what is missing."""
    small = buckets.where(F.col("members") <= SMALL).select("shingle", "node", "n")
    large = buckets.where(F.col("members") > SMALL).groupBy("node").agg(F.count("*").alias("large"))
    x = small.select("shingle", F.col("node").alias("x"), F.col("n").alias("xn"))
    y = small.select("shingle", F.col("node").alias("y"), F.col("n").alias("yn"))
    pairs = x.join(y, "shingle").where(F.col("x") < F.col("y")).where(_fits()).groupBy("x", "y", "xn", "yn").agg(
        F.count("*").alias("common"))
    suffix = lambda c: F.floor((4 * F.col(c) + 4) / 5) - 1  # noqa: E731  ceil(0.8 n) - 1
    need = F.ceil(4 * (F.col("xn") + F.col("yn")) / 9) - F.greatest(suffix("xn"), suffix("yn"))
    pairs = pairs.withColumn("missing", need - F.col("common"))
    sure = pairs.where("missing <= 0").select("x", "y")
    open_ = pairs.where("missing > 0")
    more = (open_.join(large.select(F.col("node").alias("x"), F.col("large").alias("lx")), "x")
            .join(large.select(F.col("node").alias("y"), F.col("large").alias("ly")), "y")
            .where(F.col("missing") <= F.least("lx", "ly")).select("x", "y"))
    return sure.unionByName(more)


def _bit() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))


def _filter(ids: DataFrame) -> DataFrame:
    """(word, mask): a bit for each wanted id, by hash; at most 2^(FILTER_BITS - 5) rows whatever the number of ids."""
    bits = ids.select(_bit().alias("bit")).selectExpr("bit div 32 AS word", "shiftleft(1L, cast(bit % 32 AS int)) AS mask")
    return bits.groupBy("word").agg(F.bit_or("mask").alias("mask"))


def _order(s: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Places of shingles in the global order: their level, then their hash."""
    return _levels(s, level).astype(np.uint64) << np.uint64(56) | s >> np.uint64(8)


def _cuts(levels: np.ndarray, mass: np.ndarray | None = None) -> np.ndarray:
    """Places that cut the global order into FRAGMENTS parts of about equal mass. ``mass``: shingles in cells of each
    level, where they are more than those that gave the level."""
    if mass is None:
        mass = np.bincount(levels, minlength=256) * (2.0 ** (np.arange(256) / 8) - 1)
    mass = np.cumsum(mass)
    want = mass[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS
    at = np.searchsorted(mass, want)
    before = np.concatenate([[0.0], mass])[at]
    share = np.clip((want - before) / np.maximum(mass[at] - before, 1e-9), 0, 1 - 2.0 ** -40)
    return at.astype(np.uint64) << np.uint64(56) | (share * 2.0 ** 56).astype(np.uint64)


def _fragments(docs: DataFrame, wanted: DataFrame, levels, cuts: np.ndarray, n: int) -> DataFrame:
    """(node, fragment, codes): the sets of wanted nodes, cut in the global order. Texts pass a filter of fixed size before
    they meet ``wanted`` (node, doc_id, digest) in a join; a row of the same id with another text is no member."""
    hashed = docs.where("doc_id IS NOT NULL").withColumn("bit", _bit()).withColumn("word", F.expr("bit div 32"))
    likely = hashed.join(F.broadcast(_filter(wanted)), "word").where(
        "mask & shiftleft(1L, cast(bit % 32 AS int)) <> 0").select("doc_id", "text")

    def cut(batches):
        level = levels.value
        for b in _slices(batches):
            nodes, digests = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: tuple[list, list, list] = ([], [], [])
            for row, s in _sets(b, 2, n):
                if _digest(s) == digests[row]:
                    places = _order(s, level)
                    first = np.argsort(places)
                    for k, part in enumerate(np.split(s[first], np.searchsorted(places[first], cuts))):
                        out[0].append(nodes[row])
                        out[1].append(k)
                        out[2].append(part.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                              pa.array(out[2], pa.list_(pa.int64()))], ["node", "fragment", "codes"])

    return likely.join(wanted, "doc_id").select("node", "digest", "text").mapInArrow(
        cut, "node long, fragment int, codes array<long>")


def _overlaps(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """(x, y, common): partial overlaps per fragment, summed per pair. Repeated rows of a node give equal counts, so
    the largest stands for all."""
    rows = pairs.withColumn("fragment", F.explode(F.array(*[F.lit(k) for k in range(FRAGMENTS)])))
    left = fragments.select(F.col("node").alias("x"), "fragment", F.col("codes").alias("xs"))
    right = fragments.select(F.col("node").alias("y"), "fragment", F.col("codes").alias("ys"))
    # merge joins: the planner knows the pairs' size on disk, not that of their eight fragments each
    part = rows.hint("merge").join(left, ["x", "fragment"]).join(right.hint("merge"), ["y", "fragment"]).select(
        "x", "y", "fragment", F.size(F.array_intersect("xs", "ys")).cast("long").alias("part"))
    return part.groupBy("x", "y", "fragment").agg(F.max("part").alias("part")).groupBy("x", "y").agg(
        F.sum("part").alias("common"))


def _linked(common: str = "common", xn: str = "xn", yn: str = "yn") -> Column:
    union = F.col(xn) + F.col(yn) - F.col(common)
    return 100 * F.col(common) >= 80 * union


def _with_sizes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    n = classes.select("node", "n")
    return pairs.join(n.select(F.col("node").alias("x"), F.col("n").alias("xn")), "x").join(
        n.select(F.col("node").alias("y"), F.col("n").alias("yn")), "y")


def _references(members: DataFrame, own: DataFrame) -> DataFrame:
    """(grp, parts, ref, late, weight): reference set of every group of ``members`` (grp, node, n), and the elements that
    several voters differ in, with the number of these voters. ``parts``: in how many parts the group is dealt."""
    sizes = members.groupBy("grp").agg(F.count("*").alias("size"))
    voting = members.join(sizes, "grp").where(F.pmod(F.xxhash64("node", "grp"), "size") < VOTERS).select("grp", "node")
    votes = voting.join(own, "node").select("grp", F.explode("codes").alias("element")).groupBy("grp", "element").agg(
        F.count("*").alias("votes")).where("votes > 1")
    voters = voting.groupBy("grp").agg(F.count("*").alias("voters"))
    apart = F.least("votes", F.col("voters") - F.col("votes"))
    late = F.struct("element", apart.cast("int").alias("weight"))
    found = votes.join(voters, "grp").groupBy("grp").agg(
        F.collect_list(F.when(F.col("votes") * 2 > F.col("voters"), F.col("element"))).alias("ref"),
        F.array_sort(F.collect_list(F.when(apart > 1, late))).alias("late"))
    none = F.array().cast("array<long>")
    return sizes.join(found, "grp", "left").select(
        "grp", F.ceil(F.col("size") / GROUP).cast("int").alias("parts"), F.coalesce("ref", none).alias("ref"),
        F.coalesce(F.col("late.element"), none).alias("late"),
        F.coalesce(F.col("late.weight"), F.array().cast("array<int>")).alias("weight"))


def _differences(members: DataFrame, own: DataFrame, refs: DataFrame) -> DataFrame:
    """(grp, node, n, diff, late, weight, b): what every member and its group's reference do not share."""
    dealt = members.join(refs.select("grp", "parts"), "grp").withColumn(
        "part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    each = refs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    diff = F.concat(F.array_except("codes", "ref"), F.array_except("ref", "codes"))
    return dealt.join(own, "node").join(each, ["grp", "part"]).select(
        "grp", "node", "n", diff.alias("diff"), "late", "weight").withColumn("b", 9 * F.size("diff") - F.col("n"))


def _leads(differences: DataFrame, levels) -> DataFrame:
    """(grp, element, node, n, as_z, as_y, b, left): the first elements of differences (grp, node, n, diff, late, weight,
    b, least), in an order that all members of a group use."""

    def lead(batches):
        level = levels.value
        for batch in _slices(batches):
            grp, node, size, bs, least = (batch.column(k).to_numpy() for k in (0, 1, 2, 6, 7))
            out: tuple[list, ...] = tuple([] for _ in range(8))
            for k in range(len(batch)):
                e = np.asarray(batch.column(3)[k].values, np.int64)
                late = np.asarray(batch.column(4)[k].values, np.int64)
                weight = np.zeros(len(e), np.int64)
                if len(late):
                    at = np.minimum(np.searchsorted(late, e), len(late) - 1)
                    weight = np.where(late[at] == e, np.asarray(batch.column(5)[k].values, np.int64)[at], 0)
                e = e[np.lexsort((_order(e.view(np.uint64), level), weight))]
                d, n, b, c = len(e), int(size[k]), int(bs[k]), int(least[k])
                as_z = d - max(1, -(-(b + c) // 18), d - n // 4) + 1 if b + c > 0 else 0
                as_y = d - max(1, -(-(b - c + 1) // 18), d - n // 4) + 1
                m = max(as_z, as_y, 0)
                place = np.arange(m)
                for col, value in zip(out, (np.full(m, grp[k]), e[:m], np.full(m, node[k]), np.full(m, n), place < as_z,
                                            place < as_y, np.full(m, b), d - place)):
                    col.append(value)
            types = [pa.int64()] * 4 + [pa.bool_()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, types)],
                ["grp", "element", "node", "n", "as_z", "as_y", "b", "left"])

    return differences.mapInArrow(lead, "grp long, element long, node long, n long, as_z boolean, as_y boolean, "
                                        "b long, left long")


def _met(leads: DataFrame) -> DataFrame:
    """Candidate pairs (x, y) of leads that share an element."""
    z = leads.where("as_z").select("grp", "element", F.col("node").alias("z"), F.col("n").alias("xn"),
                                   F.col("b").alias("zb"), F.col("left").alias("zl"))
    y = leads.where("as_y").select("grp", "element", F.col("node").alias("o"), F.col("n").alias("yn"),
                                   F.col("b").alias("yb"), F.col("left").alias("yl"))
    # from the first common element on, no more elements can be common than either list has left
    enough = 18 * F.least("zl", "yl") >= F.col("zb") + F.col("yb")
    pairs = z.join(y, ["grp", "element"]).where("z <> o").where(_fits()).where(enough)
    return pairs.select(F.least("z", "o").alias("x"), F.greatest("z", "o").alias("y"))


def _group_pairs(members: DataFrame, fragments: DataFrame, levels) -> DataFrame:
    """Candidate pairs (x, y) in groups ``members`` (grp, node, n) that connect what links: every member that must link
    with its group's centre, and members whose differences from the reference meet."""
    own = stored(fragments.groupBy("node").agg(F.flatten(F.collect_set("codes")).alias("codes")), "join-sets")
    found = None
    for level in range(1, LEVELS + 1):
        refs = stored(_references(members, own), "join-references")
        diffs = stored(_differences(members, own, refs), "join-differences")
        centres = stored(diffs.groupBy("grp").agg(F.min(F.struct("b", "node")).alias("c"), F.max("b").alias("most")).select(
            "grp", F.col("c.b").alias("least"), F.col("c.node").alias("centre"), "most"), "join-centres")
        near = diffs.select("grp", "node", "b").join(centres, "grp").where("b + least <= 0 AND node <> centre").select(
            F.col("centre").alias("x"), F.col("node").alias("y"))
        # a group whose members all link with its centre needs nothing else
        open_ = diffs.join(centres.where("most + least > 0").select("grp", "least"), "grp")
        leads = _leads(open_, levels)
        if level < LEVELS:
            leads = stored(leads, "join-leads")
            by = ["grp", "element"]
            buckets = leads.groupBy(*by).agg(
                F.count("*").alias("members"), F.min("node").alias("first"), F.max("as_z").alias("any")).where(
                "any AND members > 1").drop("any")
            leads = stored(leads.join(buckets, by), "join-met")
            few = leads.where(F.col("members") <= CROWD)
            members = stored(leads.where(F.col("members") > CROWD).select(
                F.xxhash64("grp", "first").alias("grp"), "node", "n").distinct(), "join-members")
        else:
            few = leads
        pairs = stored(near.unionByName(_met(few)).distinct(), "join-more")
        found = pairs if found is None else found.unionByName(pairs)
        if level == LEVELS or members.isEmpty():
            return found.distinct()


def links(docs: DataFrame, n: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(classes, links): the nodes with their digest and smallest id, and verified links (x, y) between nodes: not all
    of them, but enough to give the components of all links. ``docs``: (doc_id long, text)."""
    sc = docs.sparkSession.sparkContext
    known = docs.where("doc_id IS NOT NULL")
    levels, mean, mass = _sketch(known.select("text"), n)
    cuts = _cuts(levels, mass)
    levels = sc.broadcast(levels)
    classes = _classes(_prefixes(known, levels, mean, n))
    buckets = _buckets(classes)
    members = stored(buckets.where(F.col("members") > SMALL).select(F.col("hub").alias("grp"), "node", "n").distinct(),
                     "join-members")
    pairs = stored(_near_pairs(buckets), "join-pairs")
    ends = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node")))

    def sets(nodes: DataFrame, name: str) -> DataFrame:
        wanted = stored(nodes.distinct().join(classes, "node").select(
            "node", F.col("first_id").alias("doc_id"), "digest"), name)
        return _fragments(known, wanted, levels, cuts, n)

    first = stored(_with_sizes(_overlaps(pairs, sets(ends, "join-wanted")), classes).where(_linked()).select("x", "y"),
                   "join-links")
    dense = stored(sets(members.select("node"), "join-grouped"), "join-dense")
    more = _group_pairs(members, dense, levels)
    second = _with_sizes(_overlaps(more, dense), classes).where(_linked()).select("x", "y")
    return classes, first.unionByName(second).distinct()


def _placed(docs: DataFrame, n: int) -> DataFrame:
    """(node, digest, first_id, n, component): every class of (doc_id long, text) and its component."""
    classes, found = links(docs, n)
    part = components(found.select(F.col("x").alias("u"), F.col("y").alias("v")))
    return classes.select("node", "digest", "first_id", "n").join(part, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def labelled(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of (doc_id long, text)."""
    own = _placed(docs, n)
    least = own.groupBy("component").agg(F.min("first_id").alias("component_id"))
    label = stored(own.join(least, "component").select("digest", "component_id"), "join-labels")
    known = _digests(docs, n)
    return known.join(label, "digest", "left").select("doc_id", "n_shingles", F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id."""
    return labelled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))


def _with_digests(docs: DataFrame, name: str, n: int) -> DataFrame:
    """``docs`` with the digest of each text's set as another column."""
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            digest = [None] * len(b)
            for row, s in _sets(b, at, n):
                digest[row] = _digest(s)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(digest, pa.binary())], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())]))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of each component, with the columns of ``docs``: of the smallest id, and where that id has several texts
    in the component, of the smallest set, then the shortest text. A text without words is kept once per id and text.
    Rows with a null id stay."""
    name = "digest"
    while name in docs.columns:
        name += "_"
    known = docs.where("doc_id IS NOT NULL")
    some = F.coalesce("text", F.lit("")).rlike(WORD)
    placed = _placed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), WORDS)
    first = placed.groupBy("component").agg(F.min(F.struct("first_id", "n", "digest")).alias("first")).select(
        F.col("first.first_id").alias("kept_id"), F.col("first.digest").alias("kept_digest"))
    full = _with_digests(known.where(some), name, WORDS)
    full = full.join(first, (F.col("doc_id") == F.col("kept_id")) & (F.col(name) == F.col("kept_digest")), "left_semi")

    def one(df: DataFrame, *by: Column) -> DataFrame:
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *by)
        w = Window.partitionBy(*rows.columns[1:]).orderBy(F.length("row.text"), F.md5("row.text"))
        return rows.withColumn("nth", F.row_number().over(w)).where("nth = 1").select("row")

    kept = one(full, F.col("doc_id"), F.col(f"`{name}`")).unionByName(
        one(known.where(~some), F.col("doc_id"), F.col("text"))).unionByName(
        docs.where("doc_id IS NULL").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
