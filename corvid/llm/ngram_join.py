"""N-gram Jaccard join by grouped prefixes.

Two documents link when the sets of their ``SIZE``-word shingles have at least
``PERCENT`` hundredths of their union in common.

1. Equal sets are merged first; every later step sees each distinct set once.
2. Shingles are ordered rarest first.  How rare one is comes from ``SLOTS`` counters
   over all texts, summed by block of counters; any order is right, this one keeps
   frequent shingles out of the prefixes.  The table has ``SLOTS`` entries at any
   input size and is all that tasks share.
3. A set's prefix is its first ``n * (100 - PERCENT) / 100 + 1`` shingles: sets that
   link have a shingle of their prefixes in common.  Sets of equal size and equal
   prefix collapse into one group; a group enters the lists once, whatever the
   number of its members.
4. Prefix shingles are sorted by range over (shingle, place, size, group), so that a
   list of any length lies over as many tasks as it needs.  Those found once drop out.
5. Group pairs are filtered by size and by the place of the common shingle: what
   stands before it cannot match.  Then they are expanded to members, and member pairs
   are filtered by parity maps of ``BITS`` bits (two sets differ in at least as many
   shingles as their maps differ in bits; sets of more shingles than bits are filtered
   once more by maps that grow with the set) and verified on full sets.  Verified links
   are contracted to components.  A list first asks each group only about its neighbour
   and about the list's head, the set with the fewest shingles of its own.  The last
   round asks for every pair of groups, and every pair of members, that is not yet in
   one component: lists whose members are all in one component are closed, so a family
   of near copies never makes all its pairs, and no link between two components can be
   missing at the end.

Defined cases: a null, empty or blank text has an empty set and links with nothing;
fewer words than ``SIZE`` make one shingle of all of them; repeated rows are equal
sets; a component is named by its smallest id, null ids ignored unless all are null;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import RID, byte_slices, connected_components, drop_stored, numbered, store, text_buffer
from corvid.llm.hashing import LOWER, gram_hashes, mix, word_hashes, words

SIZE = 4
PERCENT = 85
SLOTS = 1 << 22
BLOCK = 1 << 10
BITS = 1024
#: rounds that ask each set's likeliest partner before the last round asks for all that is open
EARLY_ROUNDS = 2
SALTS = 16
TURNS = 3


# --- sets ---------------------------------------------------------------------------

def flat_sets(data: np.ndarray, off: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the texts in a buffer, one after the other, and the n + 1 offsets."""
    data = LOWER[data]
    start, end, first = words(data, off)
    n = np.diff(first)
    values = word_hashes(data, start, end)
    grams = gram_hashes(values, size)
    held = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(held)]).astype(np.int64)
    flat = np.empty(bounds[-1], np.uint64)
    for lo, count, a, b in zip(first[:-1].tolist(), n.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
        if count >= size:
            some = flat[a:b]
            some[:] = grams[lo:lo + b - a]
            some.sort()
        elif count:
            flat[a:b] = mix(gram_hashes(values[lo:lo + count], count) + np.uint64(count))
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[bounds[:-1][held > 0]] = True
    return flat[new], np.concatenate([[0], np.cumsum(new)])[bounds]


def _texts(batches):
    for batch in batches:
        yield from byte_slices(batch, "__text")


COUNTS = [T.StructField("block", T.LongType()), T.StructField("counts", T.BinaryType())]


class SlotCounts:
    """How many sets of a task hold a shingle of each slot, as rows (``block``, ``counts`` of ``BLOCK`` slots)."""

    def __init__(self):
        self.total = np.zeros(SLOTS, np.uint32)
        self.held, self.size = [], 0

    def add(self, flat: np.ndarray) -> None:
        self.held.append(slots_of(flat))
        self.size += len(flat)
        if self.size >= SLOTS:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.total += np.bincount(np.concatenate(self.held), minlength=SLOTS).astype(np.uint32)
        self.held, self.size = [], 0

    def batches(self, before: list[pa.DataType] = (), names: list[str] = ()):
        """The rows with counts; the columns ``names`` that stand before them are null."""
        self.flush()
        blocks = self.total.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        for lo in range(0, len(used), 256):
            some = used[lo:lo + 256]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(len(some), t) for t in before], pa.array(some, pa.int64()),
                 pa.array([blocks[b].tobytes() for b in some], pa.binary())], names=[*names, *[f.name for f in COUNTS]])


def with_counts(batches, counts: SlotCounts):
    """Batches of other columns with empty ``block`` and ``counts``; after the last one the rows of ``counts``."""
    kinds, names = None, None
    for batch in batches:
        kinds, names = batch.schema.types, batch.schema.names
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, pa.int64()), pa.nulls(batch.num_rows, pa.binary())],
                                         names=[*names, *[f.name for f in COUNTS]])
    if names is not None:
        yield from counts.batches(kinds, names)


def marked_rows(rows: DataFrame, size: int) -> DataFrame:
    """``__rid, __id, n_shingles, digest`` (null for an empty set) of numbered rows, ``block`` and ``counts`` being null;
    besides, rows of these two alone: each task's :class:`SlotCounts`."""
    def mark(batches):
        counts = SlotCounts()

        def marks():
            for part in _texts(batches):
                flat, off = flat_sets(*text_buffer(part.column("__text")), size)
                counts.add(flat)
                digest = [hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() if b > a else None
                          for a, b in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays([part.column(RID), part.column("__id"), pa.array(np.diff(off)),
                                                  pa.array(digest, pa.binary())], names=[RID, "__id", "n_shingles", "digest"])

        yield from with_counts(marks(), counts)

    rows = rows.select(RID, "__id", "__text")
    return rows.mapInArrow(mark, T.StructType([T.StructField(RID, T.LongType()), T.StructField("__id", rows.schema["__id"].dataType),
                                               T.StructField("n_shingles", T.LongType()),
                                               T.StructField("digest", T.BinaryType()), *COUNTS]))


def pair_sets(rows: DataFrame, size: int) -> DataFrame:
    """(``a``, ``b``, ``set``) of rows with ``pairs``: the full set of a row's text once for each pair it is in."""
    def build(batches):
        for batch in batches:
            for part in byte_slices(batch, "__text"):
                flat, off = flat_sets(*text_buffer(part.column("__text")), size)
                sets = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat.view(np.int64)))
                held = part.column("pairs")
                pairs = held.flatten()
                of = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(held.offsets)))
                for lo in range(0, len(of), 256):
                    some = pa.array(of[lo:lo + 256])
                    yield pa.RecordBatch.from_arrays([*[pairs.field(c).slice(lo, 256) for c in ("a", "b")], sets.take(some)],
                                                     names=["a", "b", "set"])

    return rows.select("__text", "pairs").mapInArrow(build, "a long, b long, set array<long>")


# --- the order of shingles ------------------------------------------------------------

def slots_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(17)).astype(np.int64) & (SLOTS - 1)


def slot_counts(rows: DataFrame, size: int) -> DataFrame:
    """Each task's :class:`SlotCounts` of numbered rows."""
    def count(batches):
        counts = SlotCounts()
        for part in _texts(batches):
            counts.add(flat_sets(*text_buffer(part.column("__text")), size)[0])
        yield from counts.batches()

    return rows.select("__text").mapInArrow(count, T.StructType(COUNTS))


def rarity(counts: DataFrame) -> np.ndarray:
    """For each of ``SLOTS`` counters how many sets hold a shingle of it, on a logarithmic scale."""
    def add(batches):
        block, total = None, None
        for batch in batches:
            for b, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(counts.as_buffer(), np.uint32)
                if b != block:
                    if block is not None:
                        yield scale(block, total)
                    block, total = b, np.zeros(BLOCK, np.int64)
                total += part
        if block is not None:
            yield scale(block, total)

    def scale(block, total):
        rare = np.minimum(np.log2(total + 1.0) * 1024, 65535).astype(np.uint16)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([rare.tobytes()], pa.binary())],
                                          names=["block", "counts"])

    summed = (counts.filter("block is not null").select("block", "counts").repartition("block").sortWithinPartitions("block")
              .mapInArrow(add, T.StructType(COUNTS)).toArrow())
    out = np.zeros(SLOTS, np.uint16)                  # SLOTS values at any input size
    for b, rare in zip(summed.column(0).to_pylist(), summed.column(1)):
        out[b * BLOCK:(b + 1) * BLOCK] = np.frombuffer(rare.as_buffer(), np.uint16)
    return out


# --- prefixes and groups ----------------------------------------------------------------

def prefixes(rows: DataFrame, size: int, percent: int, counts: DataFrame | None = None) -> DataFrame:
    """``node, n, key`` (digest of size and prefix), ``bits``, ``wide`` (null for sets of at most ``BITS`` shingles) and
    ``prefix``, rarest shingle first, of numbered rows.

    ``counts``: the slot counts of these rows, where an earlier pass has made them.
    """
    rare = rows.sparkSession.sparkContext.broadcast(rarity(slot_counts(rows, size) if counts is None else counts))

    def cut(batches):
        for part in _texts(batches):
            flat, off = flat_sets(*text_buffer(part.column("__text")), size)
            n = np.diff(off)
            of = np.repeat(np.arange(len(n), dtype=np.uint64), n)
            flat = rarest_first(flat, of, rare.value)
            bits = parity_maps(flat, of, len(n))
            wide = [wide_map(flat[a:b]) if b - a > BITS else None for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            take = np.where(n > 0, n * (100 - percent) // 100 + 1, 0)
            bounds = np.concatenate([[0], np.cumsum(take)])
            pick = np.arange(bounds[-1]) - np.repeat(bounds[:-1], take) + np.repeat(off[:-1], take)
            chosen = flat[pick]
            key = [hashlib.blake2b(chosen[a:b].tobytes(), digest_size=16, salt=int(m).to_bytes(8, "little")).digest()
                   for a, b, m in zip(bounds[:-1], bounds[1:], n)]
            yield pa.RecordBatch.from_arrays(
                [part.column(RID), pa.array(n), pa.array(key, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * bits.shape[1]), pa.array(bits.ravel())),
                 pa.array(wide, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(chosen.view(np.int64)))],
                names=["node", "n", "key", "bits", "wide", "prefix"])

    return rows.select(RID, "__text").mapInArrow(
        cut, "node long, n long, key binary, bits array<long>, wide binary, prefix array<long>")


def rarest_first(flat: np.ndarray, of: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Shingles of the sets ``of``, each set's rarest first; those of one slot count stay in the order of their hashes."""
    place = np.uint64(len(flat).bit_length())         # set, rarity and place fill less than 64 bits: a buffer holds 2^31 bytes
    order = (((of << np.uint64(16)) | rare[slots_of(flat)]) << place) | np.arange(len(flat), dtype=np.uint64)
    order.sort()
    return flat[(order & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)]


def parity_maps(flat: np.ndarray, of: np.ndarray, sets: int) -> np.ndarray:
    """``BITS`` bits per set, as int64 words: whether an odd number of its shingles falls on the bit."""
    out = np.empty((sets, BITS // 64), np.int64)
    step = max(1, (1 << 22) // BITS)
    for lo in range(0, sets, step):
        hi = min(sets, lo + step)
        a, b = np.searchsorted(of, [lo, hi])
        spot = (of[a:b].astype(np.int64) - lo) * BITS + (flat[a:b] & np.uint64(BITS - 1)).astype(np.int64)
        odd = (np.bincount(spot, minlength=(hi - lo) * BITS) & 1).astype(bool)
        out[lo:hi] = np.packbits(odd, bitorder="little").view(np.int64).reshape(hi - lo, -1)
    return out


def wide_map(shingles: np.ndarray) -> bytes:
    """The parity map of one set with between two and four bits a shingle, a power of two; its halves, one XORed onto the
    other, are the map of half as many bits."""
    bits = 1 << (2 * len(shingles)).bit_length()
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def wide_differing(x: bytes, y: bytes) -> int:
    """In how many bits two wide maps differ, the longer one folded to the length of the other."""
    x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    return int(np.bitwise_count(np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0) ^ x).sum())


def differing(x: str, y: str):
    """In how many bits two parity maps differ."""
    total = F.lit(0)
    for k in range(BITS // 64):
        total = total + F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k]))
    return total


def postings(groups: DataFrame) -> DataFrame:
    """Prefix shingles that two groups share: ``s, i, n, g``, the group before in the list ``pg`` and its head ``hg``.

    Sorted by range over the whole (shingle, place, size, group): a list may run over
    many tasks (the head is then the first one in the task).  Rows at the edge of a
    task stay, whatever lies beyond.
    """
    rows = (groups.select("g", "n", F.posexplode("prefix").alias("i", "s"))
            .select("s", F.col("i").cast("long").alias("i"), F.col("n").cast("long").alias("n"), "g")
            .repartitionByRange("s", "i", "n", "g").sortWithinPartitions("s", "i", "n", "g"))

    def scan(batches):
        held = None                                   # the last two rows; of these the last waits for its successor
        head = None                                   # (shingle, head) of the last row's list
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.asarray(c) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            done = 0 if held is None else len(held[0]) - 1
            s, g = cols[0], cols[3]
            same = np.zeros(len(s), bool)             # one list with the row before
            same[1:] = s[1:] == s[:-1]
            first = np.maximum.accumulate(np.where(same, 0, np.arange(len(s))))
            heads = g[first]
            if head is not None:
                heads = np.where(s == head[0], head[1], heads)
            keep = same.copy()
            keep[:-1] |= same[1:]
            if done == 0:
                keep[0] = True
            yield chosen(cols, heads, same, np.flatnonzero(keep[done:-1]) + done)
            held, same, heads, head = [c[-2:] for c in cols], same[-2:], heads[-2:], (s[-1], heads[-1])
        if held is not None:
            yield chosen(held, heads, same, np.array([len(held[0]) - 1]))

    def chosen(cols, heads, same, at):
        out = [pa.array(c[at]) for c in cols]
        out += [pa.array(x, mask=~same[at]) for x in (cols[3][at - 1], heads[at])]
        return pa.RecordBatch.from_arrays(out, names=["s", "i", "n", "g", "pg", "hg"])

    return rows.mapInArrow(scan, "s long, i long, n long, g long, pg long, hg long")


def _possible(n1, i1, n2, i2, percent: int):
    """Whether two sets of these sizes (n1 >= n2) that first meet at these places can have enough in common."""
    need = percent * (n1 + n2)
    return ((i1 * 100 <= n1 * (100 - percent)) & (i2 * (100 + percent) <= n2 * (100 - percent))
            & ((n1 - i1) * (100 + percent) >= need) & ((n2 - i2) * (100 + percent) >= need))


# --- links --------------------------------------------------------------------------------

def confirmed(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs of nodes (``a``, ``b``) whose full sets, made from the texts of numbered rows, reach the threshold.

    Texts cross the shuffle once: they meet the list of their pairs (few: candidates ask for a bounded number of
    partners a round), and those with a list are stored beside it.  Each sends its set to its pairs, so a set crosses
    the shuffle once a pair and is written nowhere else.  Pairs are taken in ``TURNS`` turns, so that only the sets of
    one turn are on disk at a time.
    """
    ends = pairs.select(F.col("a").alias("__n"), "a", "b").unionByName(pairs.select(F.col("b").alias("__n"), "a", "b"))
    # a node that very many pairs ask for (a list's head) is dealt over salts, its text once for each
    ends = ends.withColumn("__salt", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)))
    lists = ends.groupBy("__n", "__salt").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
    # one plan at every size: pairs grow with the input and are never a broadcast
    texts = store(rows.join(lists.hint("shuffle_hash"), F.col(RID) == F.col("__n")).select("__text", "pairs"), "join_texts")
    found = None
    for turn in range(TURNS):
        some = F.filter("pairs", lambda p: F.pmod(F.xxhash64(F.lit(3), p["a"], p["b"]), F.lit(TURNS)) == turn)
        now = texts.select("__text", some.alias("pairs")).filter(F.size("pairs") > 0)
        both = pair_sets(now, size).groupBy("a", "b").agg(F.collect_list("set").alias("sets"))
        common = F.size(F.array_intersect(F.col("sets")[0], F.col("sets")[1]))
        total = F.size(F.col("sets")[0]) + F.size(F.col("sets")[1])
        links = store(both.select("a", "b", common.alias("i"), total.alias("n"))
                      .filter(F.col("i") * 100 >= percent * (F.col("n") - F.col("i"))).select("a", "b"), "join_links")
        found = links if found is None else found.unionByName(links)
    drop_stored(texts)
    return found


def _pair(x, y):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _with_part(members: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Members with ``part``, their component so far (themselves if none)."""
    if parts is None:
        return members.withColumn("part", F.col("node"))
    named = parts.select(F.col("node").alias("__n"), "component")
    return (members.join(named, F.col("node") == F.col("__n"), "left")
            .withColumn("part", F.coalesce("component", "node")).drop("__n", "component"))


def near(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) of nodes whose parity maps allow a link, with ``far``, the share of shingles that differ at least."""
    def side(name):
        return members.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("bits").alias(f"w{name}"))

    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    sizes = F.col("na") + F.col("nb")
    allowed = (both.withColumn("d", differing("wa", "wb")).filter(F.col("d") * (100 + percent) <= sizes * (100 - percent))
               .select("a", "b", sizes.alias("n"), "d"))

    # maps of BITS bits let all pairs of large sets pass: what is left of these is told apart by their wide maps
    def wide(name):
        return members.filter("wide is not null").select(F.col("node").alias(name), F.col("wide").alias(f"w{name}"))

    def tell_apart(batches):
        for batch in batches:
            d = np.asarray(batch.column(3)).copy()
            for at, (x, y) in enumerate(zip(batch.column(4), batch.column(5))):
                if x.is_valid and y.is_valid:
                    d[at] = max(d[at], wide_differing(x.as_buffer(), y.as_buffer()))
            n = np.asarray(batch.column(2))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d / n)], names=["a", "b", "far"])
            yield out.filter(pa.array(d * (100 + percent) <= n * (100 - percent)))

    return (allowed.join(wide("a").hint("merge"), "a", "left").join(wide("b").hint("merge"), "b", "left")
            .select("a", "b", "n", "d", "wa", "wb").mapInArrow(tell_apart, "a long, b long, far double"))


def links(rows: DataFrame, nodes: DataFrame, size: int, percent: int, tested: DataFrame | None = None,
          found: DataFrame | None = None, early_rounds: int = EARLY_ROUNDS, counts: DataFrame | None = None) -> DataFrame | None:
    """(``node``, ``component``) of the linked ones among the ``nodes`` of numbered rows; None if there is no link.

    ``nodes``: one row of each distinct set.  ``tested`` and ``found``: pairs that were verified before and those of
    them that link, from another source of candidates.  ``counts``: see :func:`prefixes`.
    """
    cut = store(prefixes(rows, size, percent, counts).filter("n > 0").join(nodes.hint("shuffle_hash"), "node", "left_semi"), "join_prefixes")
    named = cut.groupBy("key").agg(F.min("node").alias("g"))
    members = store(cut.join(named, "key").select("node", "g", "n", "bits", "wide"), "join_members")
    lists = store(postings(cut.join(members.filter("node = g").select("node", "g"), "node").select("g", "n", "prefix")), "join_lists")
    drop_stored(cut)

    # first: neighbours and heads in the lists, and each member's group
    beside = (lists.select(F.explode(F.array("pg", "hg")).alias("x"), "g").filter("x is not null and x <> g").select(*_pair("x", "g"))
              .union(members.filter("node <> g").select(*_pair("node", "g"))).distinct())
    beside = store(near(beside, members, percent), "join_beside")
    parts = None if found is None or found.isEmpty() else store(connected_components(found), "join_components")
    for number in range(early_rounds + 1):
        if number < early_rounds:
            asked = likeliest(across(beside, parts))
        else:
            asked = open_members(lists, store(_with_part(members, parts), "join_parts"), percent)
        asked = asked if tested is None else asked.join(tested, ["a", "b"], "left_anti")
        asked = store(asked, "join_pairs")
        new = confirmed(asked, rows, size, percent)
        tested = asked if tested is None else tested.unionByName(asked)
        found = new if found is None else found.unionByName(new)
        if not new.isEmpty():
            parts = store(connected_components(found), "join_components")
    for used in (members, lists, beside, tested, found):
        drop_stored(used)
    return parts


def across(pairs: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Those of the pairs that join two components."""
    if parts is None:
        return pairs
    a = _with_part(pairs.withColumn("node", F.col("a")), parts).withColumnRenamed("part", "pa")
    return _with_part(a.withColumn("node", F.col("b")), parts).filter("pa <> part").select("a", "b", "far")


def likeliest(pairs: DataFrame) -> DataFrame:
    """Of the pairs (``a``, ``b``, ``far``) each side's nearest, ties to the smaller node."""
    both = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "far").unionByName(
        pairs.select(F.col("b").alias("x"), F.col("a").alias("y"), "far"))
    best = both.groupBy("x").agg(F.min_by("y", F.struct("far", "y")).alias("y"))
    return best.select(*_pair("x", "y")).distinct()


def open_members(lists: DataFrame, parted: DataFrame, percent: int) -> DataFrame:
    """All distinct member pairs (``a`` < ``b``) between components, of one group or of groups that may link."""
    spans = store(parted.groupBy("g").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("k"),
                                          F.min_by("bits", "node").alias("bits")), "join_spans")
    rows = lists.select("s", "i", "n", "g").join(spans.drop("bits"), "g")
    # a list within one component has nothing left to ask
    open_lists = rows.groupBy("s").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).filter("l <> h").select("s")
    rows = store(rows.join(open_lists, "s", "left_semi").join(spans.select("g", "bits").hint("merge"), "g"), "join_open")
    large = rows.select("s", *[F.col(c).alias(f"{c}1") for c in ("i", "n", "g", "lo", "hi", "k", "bits")])
    small = (rows.filter(F.col("i") * (100 + percent) <= F.col("n") * (100 - percent))
             .select(F.col("s").alias("t"), *[F.col(c).alias(f"{c}2") for c in ("i", "n", "g", "lo", "hi", "k", "bits")]))
    one_part = (F.col("lo1") == F.col("hi1")) & (F.col("lo2") == F.col("hi2")) & (F.col("lo1") == F.col("lo2"))
    # groups of one member can be told apart here by their parity maps, others after they are expanded
    apart = ((F.col("k1") == 1) & (F.col("k2") == 1)
             & (differing("bits1", "bits2") * (100 + percent) > (F.col("n1") + F.col("n2")) * (100 - percent)))
    pairs = (large.join(small.hint("merge"), (F.col("s") == F.col("t")) & (F.struct("n1", "g1") > F.struct("n2", "g2"))
                        & _possible(F.col("n1"), F.col("i1"), F.col("n2"), F.col("i2"), percent) & ~one_part & ~apart)
             .select("g1", "g2").distinct())
    own = spans.filter("lo <> hi").select(F.col("g").alias("g1"), F.col("g").alias("g2"))
    one = parted.select(F.col("g").alias("g1"), F.col("node").alias("x"), F.col("part").alias("px"))
    two = parted.select(F.col("g").alias("g2"), F.col("node").alias("y"), F.col("part").alias("py"))
    every = pairs.unionByName(own).join(one, "g1").join(two, "g2").filter("px <> py").select(*_pair("x", "y")).distinct()
    return near(every, parted, percent).select("a", "b")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                       percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``__rid, __id, n_shingles, component_id`` (smallest id reachable)."""
    rows = numbered(df, id_col, text_col)
    everything = store(marked_rows(rows, size), "join_marks")
    marks = everything.filter("block is null").drop("block", "counts")
    distinct = store(marks.filter("digest is not null").groupBy("digest")
                     .agg(F.min(RID).alias("node"), F.min("__id").alias("low")), "join_distinct")
    parts = links(rows, distinct.select("node"), size, percent, counts=everything)
    named = distinct.withColumn("part", F.col("node"))
    if parts is not None:
        named = (distinct.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")))
    smallest = named.groupBy("part").agg(F.min("low").alias("component_id"))
    by_set = named.join(smallest, "part").select(F.col("digest").alias("__digest"), "component_id")
    return (marks.join(by_set, F.col("digest") == F.col("__digest"), "left")
            .select(RID, "__id", "n_shingles",
                    F.when(F.col("digest").isNull(), F.col("__id")).otherwise(F.col("component_id")).alias("component_id")))
