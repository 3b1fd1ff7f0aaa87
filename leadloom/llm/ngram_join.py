"""Jaccard join of n-gram sets over prefix trees.

All n-grams have one global order, rare ones first. Two sets that link share SHARED n-grams of their prefixes (the first
``n - required + SHARED`` of each), so sets meet in the posting lists of their prefixes only. Where they meet, the sets of a tile
go into a tree of their ordered n-grams: sets that begin alike share a path, the overlap with a probe is counted once for
all sets below a node, and a subtree goes when what is left of the probe and of its longest set cannot reach the bound.

* *Order*: a sketch of 2 ** SKETCH_BITS counters is summed over the whole corpus; an n-gram's key is its counter's binary
  logarithm followed by 58 bits of its hash. Any order gives the right links; this one keeps common passages out of prefixes, as long
  as a counter has few n-grams: where it has hundreds, n-grams of hundreds of texts pass for rare, and pairs grow with the square of the texts.
* *Postings*: most n-grams of prefixes are in one set only; a bitmap of those that are in two leaves the others out before anything is dealt out by n-gram.
* *Classes*: documents with equal sets are one class; only classes are joined.
* *Short lists*, of SHORT classes at most, give their pairs as numbers. Prefixes are SHARED - 1 longer than one common n-gram needs, so a pair that links has
  SHARED in common there; pairs with fewer, most of them chance, go before any text is moved.
* *Stars*: a longer list's first class is compared with the others of it: a group of near copies costs its size.
* *Tiles*: what is still apart in a longer list is compared once more. Classes are dealt to blocks of at most about BLOCK_GRAMS n-grams, by the
  component of their stars or by the longest list they are in; a pair is looked at in the tile of its two blocks only. A
  tile of one component is left out, so a list of many near copies is not squared.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table
from leadloom.llm.skew import join_one
from leadloom.operators.components import components

WORDS, PERCENT = 5, 80
#: Common n-grams that the prefixes of a linking pair are sure to have, or all that it must have if that is fewer.
SHARED = 3
#: Classes of a list whose pairs are counted; longer lists go through stars and tiles.
SHORT = 8
#: Counters of the sketch: 67,108,864 levels of half a byte each are broadcast, whatever the input.
SKETCH_BITS, SKETCH_PARTS = 26, 256
HASH_BITS = 58
#: Bits that tell which n-grams of prefixes are in two or more: 32 MB are broadcast, whatever the input; and those of the hash by which they are found.
MET_BITS, MET_PARTS, CELL_BITS = 28, 1024, 40
#: Numbers that a task holds before it sends them, sorted.
BLOCK_CELLS = 1 << 21
#: n-grams of a block, 2 MB of keys; a longer set is a block of its own.
BLOCK_GRAMS = 1 << 18
#: Rows of numbers and keys (under 40 bytes each) that are broadcast; beyond it the join shuffles.
MAX_BROADCAST_ROWS = 500_000
_SLICE_WORDS = 1 << 16


@lru_cache(1)
def _byte_values():
    import numpy as np

    return np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)


_FACTOR = 0x9E3779B97F4A7C17
_POWERS: list = []


def _powers(n: int):
    """Powers of an odd factor and of its inverse modulo 2 ** 64."""
    import numpy as np

    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, f, np.uint64)]) for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64))]
    return _POWERS


def _hashes(words: list[bytes], size: int):
    """64-bit hashes of the runs of ``size`` words: polynomials over their bytes, read off one running sum, then mixed."""
    import numpy as np

    raw = np.frombuffer(b" ".join(words), np.uint8)
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_byte_values()[raw] * up[: len(raw)], out=sums[1:])
    blank = np.flatnonzero(raw == 32)
    first, last = np.r_[0, blank + 1], np.r_[blank, len(raw)]
    first, last = first[: len(words) - size + 1], last[size - 1 :]
    h = (sums[last] - sums[first]) * down[first]
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _distinct(values):
    import numpy as np

    values.sort()
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def shingles(text: str | None, words: int = WORDS):
    """Sorted distinct hashes of a text's runs of ``words`` words; of all its words if it has fewer; none without words."""
    import numpy as np

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z are lowered, only ASCII blanks split
    if not found:
        return np.empty(0, np.uint64)
    size = min(words, len(found))
    parts = [_hashes(found[at : at + _SLICE_WORDS + size - 1], size) for at in range(0, len(found) - size + 1, _SLICE_WORDS)]
    return _distinct(np.concatenate(parts))


def required(a, b, percent: int = PERCENT):
    """The least overlap of sets of ``a`` and ``b`` that gives a Jaccard similarity of ``percent`` in a hundred."""
    return -(-percent * (a + b) // (100 + percent))


def _dealt_cells(blocks, bits: int, parts: int, most: int | None = None):
    """Batches of part, n and cells: of each block of numbers below 2 ** ``bits``, those of a part in order, as differences; ``most``: of equal ones in a block, so many."""
    import numpy as np
    import pyarrow as pa

    shift = np.uint64(bits - parts.bit_length() + 1)
    for cells in blocks:
        cells.sort()
        if most is not None and len(cells) > most:
            cells = cells[np.r_[np.ones(most, bool), cells[most:] != cells[:-most]]]
        ends = np.r_[0, np.searchsorted(cells, np.arange(1, parts, dtype=np.uint64) << shift), len(cells)]
        local = (cells & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.uint32)
        rows = []
        for k in np.flatnonzero(np.diff(ends)).tolist():
            gaps = np.diff(local[ends[k] : ends[k + 1]], prepend=np.uint32(0))
            rows.append((k, len(gaps), pa.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)))  # the higher bytes are zeros for the most part
        if rows:
            part, n, packed = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(n, pa.int32()), pa.array(packed, pa.binary())], names=["part", "n", "cells"])


def _by_part(batches, made):
    """Batches of part and bits: ``made`` of the cells of each part, which come as arrays one after the other. The rows are in the order of parts."""
    from itertools import groupby

    import numpy as np
    import pyarrow as pa

    def unpacked(rows):
        for _, n, packed in rows:
            planes = np.frombuffer(pa.decompress(packed, 4 * n, "zstd", asbytes=True), np.uint8)
            yield np.cumsum(np.ascontiguousarray(planes.reshape(4, n).T).view(np.uint32).ravel(), dtype=np.uint32)

    rows = ((k, n, x.as_py()) for batch in batches for k, n, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)))
    for part, own in groupby(rows, key=lambda r: r[0]):
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([made(unpacked(own))], pa.binary())], names=["part", "bits"])


def _in_blocks(arrays):
    """The numbers of many small arrays in arrays of about BLOCK_CELLS."""
    import numpy as np

    waiting, n = [], 0
    for x in arrays:
        waiting.append(x)
        n += len(x)
        if n >= BLOCK_CELLS:
            yield np.concatenate(waiting)
            waiting, n = [], 0
    if n:
        yield np.concatenate(waiting)


def _gathered(cells: DataFrame, made, parts: int, width: int) -> Broadcast:
    """``width`` bytes of each part, as ``made`` gives them, zeros for parts without cells; broadcast as one array."""
    import numpy as np

    whole = np.zeros((parts, width), np.uint8)
    dealt = cells.repartition("part").sortWithinPartitions("part")
    for row in dealt.mapInArrow(lambda batches: _by_part(batches, made), "part int, bits binary").collect():  # ``parts`` rows at most, of ``width`` bytes
        whole[row.part] = np.frombuffer(row.bits, np.uint8)
    return cells.sparkSession.sparkContext.broadcast(whole.reshape(-1))


def sketch(texts: DataFrame, words: int) -> Broadcast:
    """Levels (binary logarithm of the counter, 15 at most, two to a byte) of all n-grams of the column ``text``, by the first SKETCH_BITS of the hash."""
    width = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches):
        found = (shingles(text.as_py(), words) >> np.uint64(64 - SKETCH_BITS) for batch in batches for text in batch.column(0))
        return _dealt_cells(_in_blocks(found), SKETCH_BITS, SKETCH_PARTS)

    def levels(arrays):
        total = np.zeros(width, np.uint32)
        for cells in _in_blocks(arrays):
            total += np.bincount(cells, minlength=width).astype(np.uint32)
        level = np.minimum(np.log2(np.maximum(total, 1)), 15).astype(np.uint8)
        return (level[::2] | level[1::2] << 4).tobytes()

    import numpy as np

    return _gathered(texts.select("text").mapInArrow(count, "part int, n int, cells binary"), levels, SKETCH_PARTS, width // 2)


def ordered(hashes, levels):
    """Keys of n-grams, ascending in the global order: the level of the counter, then the hash's lower bits."""
    import numpy as np

    at = (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
    level = (levels[at >> 1] >> ((at & 1) << 2).astype(np.uint8) & 15).astype(np.uint64)
    return _distinct((level << np.uint64(HASH_BITS)) | (hashes & np.uint64((1 << HASH_BITS) - 1)))


def met(prefixes: DataFrame) -> Broadcast:
    """A bit for each 2 ** -MET_BITS of the keys' hashes: whether some n-gram there is in two rows' ``prefix`` or more (told by CELL_BITS of its hash).

    Most n-grams of prefixes are in one only; who leaves those out before they are dealt out with their classes moves few rows."""
    width = (1 << MET_BITS) // MET_PARTS

    def cells(batches):
        found = (np.frombuffer(x.as_py(), np.uint64) << np.uint64(64 - HASH_BITS) >> np.uint64(64 - CELL_BITS) for batch in batches for x in batch.column(0))
        return _dealt_cells(_in_blocks(found), CELL_BITS, MET_PARTS, 2)

    def bits(arrays):
        own = np.sort(np.concatenate([*arrays]))
        flags = np.zeros(width, np.uint8)
        flags[own[1:][own[1:] == own[:-1]] >> np.uint32(CELL_BITS - MET_BITS)] = 1
        return np.packbits(flags, bitorder="little").tobytes()

    import numpy as np

    return _gathered(prefixes.select("prefix").mapInArrow(cells, "part int, n int, cells binary"), bits, MET_PARTS, width // 8)


def may_meet(keys, bits):
    """Of keys of ``ordered``, whether each may be in another prefix too, by the bits of ``met``."""
    import numpy as np

    at = (keys << np.uint64(64 - HASH_BITS) >> np.uint64(64 - MET_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


class Tree:
    """Ordered sets (arrays of ranks in the global order) in a compressed prefix tree; nodes are arrays, by their level.

    A node has the run of n-grams between its parent and itself; ``low`` and ``high`` are the sizes of the smallest and the
    largest set below it, ``same`` the component of all of them, or -1.
    """

    def __init__(self, sets: list, component: list[int]):
        import numpy as np

        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        parent, start, end, by, ends_at = [-1], [0], [0], [0], [0] * len(sets)
        path, last = [0], None
        for i in order:
            x = sets[i]
            shared = 0
            if last is not None:
                m = min(len(x), len(last))
                differ = np.flatnonzero(x[:m] != last[:m])
                shared = int(differ[0]) if len(differ) else m
            below = None
            while end[path[-1]] > shared:
                below = path.pop()
            if end[path[-1]] < shared:  # the paths part inside a run: a node between
                parent.append(path[-1]), start.append(start[below]), end.append(shared), by.append(by[below])
                parent[below], start[below] = len(parent) - 1, shared
                path.append(len(parent) - 1)
            if end[path[-1]] < len(x):
                parent.append(path[-1]), start.append(shared), end.append(len(x)), by.append(i)
                path.append(len(parent) - 1)
            ends_at[i], last = path[-1], x
        n = len(parent)
        self.end = np.array(end)
        self.runs = [sets[by[k]][start[k] : end[k]] if k else np.empty(0, np.int64) for k in range(n)]
        depth = [0] * n
        children: list[list[int]] = [[] for _ in range(n)]
        for k in range(1, n):
            children[parent[k]].append(k)
        walk = [0]
        for k in walk:
            for c in children[k]:
                depth[c] = depth[k] + 1
                walk.append(c)
        low, high, same = [1 << 62] * n, [0] * n, [-2] * n
        self.sets_at: list[list[int]] = [[] for _ in range(n)]
        for i, k in enumerate(ends_at):
            self.sets_at[k].append(i)
            low[k], high[k] = min(low[k], len(sets[i])), max(high[k], len(sets[i]))
            same[k] = component[i] if same[k] in (-2, component[i]) else -1
        for k in reversed(walk[1:]):
            p = parent[k]
            low[p], high[p] = min(low[p], low[k]), max(high[p], high[k])
            same[p] = same[k] if same[p] in (-2, same[k]) else -1
        self.low, self.high, self.same, self.children = np.array(low), np.array(high), np.array(same), children

    def near(self, probe, n_ranks: int, component: int, percent: int):
        """Sets of other components that link with ``probe``."""
        import numpy as np

        has = np.zeros(n_ranks, np.int32)
        has[probe] = 1
        upto = np.cumsum(has)
        size, found, front, shared = len(probe), [], [0], [0]
        while front:
            at, got = np.array(front), np.array(shared)
            runs = [self.runs[k] for k in front]
            lengths = np.array([len(r) for r in runs])
            if lengths.any():
                cells = np.concatenate(runs)
                full = lengths > 0
                starts = (np.cumsum(lengths) - lengths)[full]
                got[full] += np.add.reduceat(has[cells], starts)
                rest = np.full(len(at), size)
                rest[full] -= upto[cells[starts + lengths[full] - 1]]
            else:
                rest = np.full(len(at), size)
            reach = got + np.minimum(rest, self.high[at] - self.end[at])
            alive = (reach >= required(size, self.low[at], percent)) & (self.same[at] != component)
            alive &= (100 * self.high[at] >= percent * size) & (percent * self.low[at] <= 100 * size)
            front, shared = [], []
            for k, o in zip(at[alive].tolist(), got[alive].tolist()):
                for i in self.sets_at[k]:
                    if o >= required(size, int(self.end[k]), percent):
                        found.append(i)
                front += self.children[k]
                shared += [o] * len(self.children[k])
        return found


def tile_links(words: int, percent: int, levels: Broadcast):
    """The function of a tile: links between its sides 0 and 1, or inside side 0 if that is all; as many as join its components."""

    def links(tile):
        import zlib

        import numpy as np
        import pyarrow as pa

        side, name, component = (tile.column(c).to_pylist() for c in ("side", "class", "component"))
        sets = [ordered(shingles(zlib.decompress(x.as_py()).decode("utf-8", "surrogatepass"), words), levels.value) for x in tile.column("packed")]
        lengths = np.array([len(x) for x in sets])
        values, rank = np.unique(np.concatenate(sets), return_inverse=True)
        sets = np.split(rank, np.cumsum(lengths)[:-1])
        left = [i for i, s in enumerate(side) if not s]
        right = [i for i, s in enumerate(side) if s] or left
        tree = Tree([sets[i] for i in right], [component[i] for i in right])
        up = {c: c for c in component}

        def top(c):
            while up[c] != c:
                up[c] = c = up[up[c]]
            return c

        edges = []
        for i in left:
            for k in tree.near(sets[i], len(values), component[i], percent):
                a, b = top(component[i]), top(component[right[k]])
                if a != b:
                    up[a] = b
                    edges.append((name[i], name[right[k]]))
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})

    return links


def _fits(percent: int) -> str:
    """Of sets of ``n`` and ``other_n``: whether their sizes allow a link."""
    return f"{percent} * greatest(n, other_n) <= 100 * least(n, other_n)"


def _enough(percent: int) -> str:
    """Whether ``shared`` n-grams of the prefixes are as many as a pair that links has there."""
    return f"shared >= least({SHARED}, ({percent} * (n + other_n) + {99 + percent}) div {100 + percent})"


def _short_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """first, class and n: pairs of classes of short lists that have enough of them in common, the smaller one early in each."""
    own = F.collect_list(F.struct("class", "n", "early"))  # SHORT at most
    after = lambda m, x: F.filter(m, lambda y: y["class"] > x["class"])
    pairs = F.flatten(F.transform("m", lambda x: F.transform(after(F.col("m"), x), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    met = lists.groupBy("gram").agg(own.alias("m")).select(F.explode(pairs).alias("p"))
    met = met.select(F.col("p.x.class").alias("first"), F.col("p.y.class").alias("class"), F.col("p.x.n").alias("other_n"), F.col("p.y.n").alias("n"), F.col("p.x.early").alias("other_early"), F.col("p.y.early").alias("early"))
    met = met.where(f"{_fits(percent)} AND ((n <= other_n AND early) OR (other_n <= n AND other_early))")
    return met.groupBy("first", "class", "n", "other_n").agg(F.count(F.lit(1)).alias("shared")).where(_enough(percent)).select("first", "class", "n")


def _star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """first, class and n: each list's first class and those that share enough of its lists; what this leaves out is found in tiles."""
    star = lists.where("class <> first").groupBy("first", "class", "n").agg(F.count(F.lit(1)).alias("shared"))
    first_n = lists.where("class = first").groupBy("first").agg(F.first("n").alias("other_n"))
    return star.join(first_n, "first").where(f"{_fits(percent)} AND {_enough(percent)}").select("first", "class", "n")


def _star_tiles(pairs: DataFrame) -> DataFrame:
    """For each ``first`` of the pairs, itself on side 0 and its classes on side 1, in parts of about BLOCK_GRAMS."""
    parts = pairs.groupBy("first").agg(F.ceil(F.sum("n") / F.lit(BLOCK_GRAMS)).alias("parts"))
    dealt = pairs.join(parts, "first").select("first", "class", F.xxhash64("first", F.pmod(F.xxhash64("class"), "parts")).alias("tile"))
    other = dealt.select("tile", F.lit(1).alias("side"), "class")
    first = dealt.select("tile", F.lit(0).alias("side"), F.col("first").alias("class")).distinct()
    return first.unionByName(other).withColumn("component", F.col("class"))


def _rest_tiles(members: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """Tiles of two blocks, or of one, that a list has in common, with the classes of such lists; none of a single component.

    The first SHARED n-grams that a pair has in common stand among the first ``n - required(n, n) + SHARED`` of the smaller set (``early``), so a class goes into a tile
    only with classes beside it, in the same list, of a fitting size and the smaller ones early."""
    placed = members.join(component.select(F.col("node").alias("class"), "root"), "class", "left")
    placed = placed.select("gram", "class", "n", "early", "first", "size", F.col("root").isNull().alias("alone"), F.coalesce("root", "class").alias("component"))
    digests = [F.bit_xor(F.xxhash64("class", "early", F.lit(k))).alias(f"digest_{k}") for k in (0, 1)]
    lists = placed.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), *digests)
    apart = lists.where("lo < hi").groupBy("digest_0", "digest_1").agg(F.min("gram").alias("gram")).select("gram")  # of lists with the same classes, one
    placed = materialize(placed.join(apart, "gram", "left_semi"), "lists-apart")
    of_class = placed.groupBy("class").agg(F.first("n").alias("n"), F.first("alone").alias("alone"), F.first("component").alias("component"), F.max("size").alias("size"))
    longest = placed.where("alone").join(of_class.select("class", "size"), ["class", "size"]).groupBy("class").agg(F.min("first").alias("longest"))
    keyed = of_class.join(longest, "class", "left").withColumn("key", F.xxhash64("alone", F.coalesce("longest", "component")))
    parts = keyed.groupBy("key").agg(F.ceil(F.sum("n") / F.lit(BLOCK_GRAMS)).alias("parts"))
    block = keyed.join(parts, "key").select("class", F.xxhash64("key", F.pmod(F.xxhash64("class"), "parts")).alias("block"))
    rows = materialize(placed.select("gram", "class", "component", "n", "early").join(block, "class"), "blocks")
    early = F.when(F.col("early"), F.col("n"))
    ranges = {"lo": F.min("component"), "hi": F.max("component"), "n_lo": F.min("n"), "n_hi": F.max("n"), "early_lo": F.min(early), "early_hi": F.max(early)}
    held = materialize(rows.groupBy("gram", "block").agg(*[c.alias(k) for k, c in ranges.items()]), "lists-of-blocks")
    other = held.select("gram", *[F.col(c).alias(f"{c}_b") for c in ("block", *ranges)])
    met = held.join(other, "gram").where("block <= block_b AND (lo < hi OR lo_b < hi_b OR lo <> lo_b)")
    met = materialize(met.withColumn("tile", F.xxhash64("block", "block_b")), "tiles")
    beside = ["n_lo", "n_hi", "early_lo", "early_hi"]
    left = met.select("gram", "tile", F.lit(0).alias("side"), "block", *[F.col(f"{c}_b").alias(f"o_{c}") for c in beside])
    right = met.where("block < block_b").select("gram", "tile", F.lit(1).alias("side"), F.col("block_b").alias("block"), *[F.col(c).alias(f"o_{c}") for c in beside])
    smaller = f"early AND o_n_hi >= n AND {percent} * o_n_lo <= 100 * n"
    larger = f"o_early_lo <= n AND 100 * o_early_hi >= {percent} * n"
    return left.unionByName(right).join(rows, ["gram", "block"]).where(f"({smaller}) OR ({larger})").select("tile", "side", "class", "component").distinct()


def _bounded(keys: DataFrame) -> DataFrame:
    """``keys``, stored before, marked for broadcast if they are MAX_BROADCAST_ROWS at most; else the join shuffles."""
    return F.broadcast(keys) if keys.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else keys


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the smallest doc_id that links of ``percent`` in a hundred reach.

    A set is a text's distinct runs of ``words`` words, with fewer words all of them as one; a text without words (null, empty,
    blank) has none, links with nothing and is its own component. Runs are told apart by 64 bits of hash (58 and the level in the join). Rows
    with equal sets link, so repeated rows share a component; a null id takes part but names a component only where all its ids are null.
    An empty table gives no rows; other columns are not read; texts of any length count whole, in slices of 65,536 words.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text, name = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.col(f"`{id_col}`").cast("string")
    key = F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.length(name), F.lit(-1)), F.coalesce(name, F.lit("")), text)))
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), key.alias("key"), text.alias("text"))
    levels = sketch(source, words)

    def read(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            n, digest, prefix = [], [], []
            for text in batch.column(3):
                found = shingles(text.as_py(), words)
                n.append(len(found))
                digest.append(xxhash.xxh3_128_digest(found.tobytes()))
                keys = ordered(found, levels.value)
                prefix.append(keys[: len(keys) - -(-percent * len(keys) // 100) + SHARED].tobytes())
            made = [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(prefix, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=["row_no", "doc_id", "key", "n", "digest", "prefix"])

    numbered = source.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "key", "text")
    rows = materialize(numbered.mapInArrow(read, f"row_no bigint, doc_id {kind}, key binary, n bigint, digest binary, prefix binary"), "ngram-sets")
    classes = rows.where("n > 0").groupBy("digest").agg(F.min("row_no").alias("class"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("size"))
    classes = materialize(classes, "ngram-classes")

    def meeting(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            prefix, early = [], []
            for n, x in zip(batch.column(1).to_pylist(), batch.column(2)):
                keys = np.frombuffer(x.as_py(), np.uint64)
                kept = may_meet(keys, bits.value)
                prefix.append(keys[kept].tobytes())
                early.append(int(kept[: n - required(n, n, percent) + SHARED].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(early, pa.int64()), pa.array(prefix, pa.binary())], names=["row_no", "n", "n_early", "prefix"])

    def spread(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keys = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(3)]
            names, sizes, early = (batch.column(c).to_numpy() for c in range(3))
            for lo in range(0, len(keys), 256):
                part = keys[lo : lo + 256]
                many = [len(x) for x in part]
                at = np.concatenate([np.arange(n) for n in many])
                repeated = [np.repeat(x[lo : lo + 256], many) for x in (names, sizes, early)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part)), pa.array(repeated[0]), pa.array(repeated[1]), pa.array(at < repeated[2])], names=["gram", "class", "n", "early"])

    def packed(batches):
        import zlib

        import pyarrow as pa

        for batch in batches:
            texts = [zlib.compress(x.as_py().encode("utf-8", "surrogatepass"), 1) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["class", "packed"])

    bits = met(rows)
    kept = rows.where("n > 0").select("row_no", "n", "prefix").mapInArrow(meeting, "row_no bigint, n bigint, n_early bigint, prefix binary").where("length(prefix) > 0")
    of_class = kept.join(_bounded(classes.select(F.col("class").alias("row_no"))), "row_no", "left_semi").select("row_no", "n", "n_early", "prefix")
    postings = of_class.mapInArrow(spread, "gram bigint, class bigint, n bigint, early boolean")
    sizes = [F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.min(F.when(F.col("early"), F.col("n"))).alias("early_lo")]
    heads = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("size"), F.min("class").alias("first"), *sizes)
    # A list of two matters if they are of fitting size and the smaller has the n-gram early; a longer one if any has.
    heads = heads.where(f"early_lo IS NOT NULL AND (size > 2 OR (size = 2 AND early_lo = n_lo AND {percent} * n_hi <= 100 * n_lo))").select("gram", "size", "first")
    members = materialize(postings.join(heads, "gram"), "ngram-lists")
    bits.destroy()

    short, long = members.where(F.col("size") <= SHORT), members.where(F.col("size") > SHORT)
    pairs = materialize(_short_pairs(short, percent).unionByName(_star_pairs(long, percent)).distinct(), "ngram-pairs")

    def links(tiles):
        """Links found in ``tiles`` (tile, side, class, component); only texts of their classes are moved."""
        tiles = materialize(tiles, "tile-rows")
        repeated = rows.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("repeated"))
        wanted = tiles.select("class").distinct().join(rows.select(F.col("row_no").alias("class"), "key"), "class").join(repeated, "key")
        wanted = source.select("key", "text").join(_bounded(materialize(wanted, "ngram-wanted")), "key").select("class", "text", "repeated")
        once = wanted.where("repeated").dropDuplicates(["class"])
        texts = wanted.where("NOT repeated").unionByName(once).select("class", "text").mapInArrow(packed, "class bigint, packed binary")
        dealt = materialize(texts, "ngram-wanted-texts").join(_bounded(tiles), "class").select("tile", "side", "class", "component", "packed")
        return dealt.groupBy("tile").applyInArrow(tile_links(words, percent, levels), "a bigint, b bigint")

    edges = materialize(links(_star_tiles(pairs)), "ngram-star-links")
    if not long.isEmpty():
        edges = materialize(edges.unionByName(links(_rest_tiles(long, components(edges), percent))), "ngram-links")
    root = classes.join(components(edges), F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    smallest = root.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = root.select("digest", "size", "root").join(smallest, "root").select("digest", "size", "component_id")
    linked = join_one(rows.where("n > 0").select("doc_id", "n", "digest"), materialize(named, "ngram-components"), "digest", "size")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles and component_id of every document under five words and 80 in a hundred, as ``ngram_join`` defines them."""
    return ngram_join(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS gram FROM d
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1
), sets AS (SELECT doc_id, md5(string_agg(gram, chr(10) ORDER BY gram)) AS digest FROM g GROUP BY 1
), class AS (SELECT digest, min(doc_id) AS c FROM sets GROUP BY 1
), cg AS (SELECT g.doc_id AS c, g.gram FROM g JOIN class ON g.doc_id = class.c
), pairs AS (SELECT x.c AS a, y.c AS b, count(*) AS o FROM cg x JOIN cg y ON x.gram = y.gram AND x.c <> y.c GROUP BY 1, 2
), links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o >= 80 * (na.n + nb.n - o)
), reach AS (SELECT c AS a, c AS b FROM class UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), comp AS (SELECT a AS c, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN class USING (digest) LEFT JOIN comp USING (c)
"""
