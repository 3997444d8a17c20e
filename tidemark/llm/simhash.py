"""SimHash near-duplicates by a self-join of a binary trie.

A fingerprint is a path in a binary trie. The join starts with the pair of the
root with itself and goes down in both nodes together; bits in which the two
paths differ are added up, and a pair over the budget is pruned with everything
below. Spark does the upper levels as joins between the nodes of a level, until
both nodes of a pair together hold few enough fingerprints for one task; each
such pair of subtrees is then traversed in one task, in numpy, level by level
over all live node pairs at once. There the bits are turned once: two fingerprints
within the budget keep to half of it in the front part of the bits, or to less
than the other half in the back part, so each turn prunes by half a budget.

Every level that the joins go down multiplies the pairs that a node is in, up to
all nodes within the budget. So a large trie is joined in `budget` + 1 turns, each
with another block of the bits turned to the front: two fingerprints within the
budget agree in one block at least, and there only pairs of equal nodes go down.
A fingerprint is then in as many subtrees as there are turns, until a whole block
is used up, however many fingerprints there are.

A task gives back a spanning forest of the links that it found: the connected
fingerprints are the same, and copies of copies do not make all their pairs. A
subtree pair whose fingerprints are all connected already is pruned as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, components, documents, let
from tidemark.llm.registry import query

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED = 42
#: Levels that one round of joins goes down.
STEP = 2
#: Fingerprints in the two subtrees that one task traverses.
TASK_KEYS = 32_768
#: Products of sizes up to which two nodes are compared leaf by leaf, and comparisons or node pairs at once (that fit in a cache).
LEAF, CHUNK = 256, 1 << 16


def shingles(text: bytes | None, width: int) -> list[bytes]:
    """Lower-cased word shingles, repeats included; of fewer words, the whole sequence; of none, nothing."""
    # bytes.split() cuts at exactly \\x20 and \\x09-\\x0D
    words = text.translate(LOWER).split() if text else []
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)))))


def fingerprint(parts: list[bytes], seeds: tuple[int, ...] = (SEED,)) -> list[int]:
    """64 bits for each seed: a bit is set if it is set in over half the hashes of the shingles."""
    import xxhash

    votes = np.zeros(len(seeds) * 64, dtype=np.int64)
    for at in range(0, len(parts), 255):  # as many as a byte can count
        some = parts[at:at + 255]
        digests = b"".join(chain.from_iterable(map(xxhash.xxh64_digest, some, repeat(seed)) for seed in seeds))
        # a row for each shingle
        hashes = np.ascontiguousarray(np.frombuffer(digests, np.uint64).reshape(len(seeds), -1).T)
        votes += np.unpackbits(hashes.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * votes > len(parts)).view(">i8").tolist()


def fingerprints(docs: DataFrame, id_columns: list[str], width: int, seeds: tuple[int, ...] = (SEED,),
                 distinct: bool = False) -> DataFrame:
    """id_columns and `prints`, an array with 64 bits as a long for each seed; zeros for a text without words.

    With `distinct` a shingle counts once, however often it is there.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = (shingles(t.as_py(), width) for t in batch.column(batch.num_columns - 1))
            found = [fingerprint(list(dict.fromkeys(p)) if distinct else p, seeds) for p in parts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.int64()))], names=[*id_columns, "prints"])

    rows = docs.select(*id_columns, F.col("text").cast("binary").alias("text"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in id_columns)
    return rows.mapInArrow(each, f"{schema}, prints array<long>")


# --- traversal of two subtrees in one task ---------------------------------------------------------------------------

class Forest:
    """Union-find over positions; `component` is one of the positions of each one's component."""

    def __init__(self, n: int, labels: np.ndarray | None = None):
        self.top = np.arange(n)
        self.component, self.uniform = self.top.copy(), None
        if labels is not None and n:  # positions of one label are connected from the start
            _, first, which = np.unique(labels, return_index=True, return_inverse=True)
            self.component = first[which]
        self.connects = bool((self.component != self.top).any())

    def add(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links that were needed of those between a and b."""
        open_ = self.component[a] != self.component[b]
        a, b = a[open_], b[open_]
        needed, up = np.zeros(len(a), dtype=bool), {}

        def find(x: int) -> int:
            while x in up:
                above = up[x]
                if above in up:
                    up[x] = up[above]
                x = above
            return x

        for at, (x, y) in enumerate(zip(self.component[a].tolist(), self.component[b].tolist(), strict=True)):
            x, y = find(x), find(y)
            if x != y:
                up[max(x, y)] = min(x, y)
                needed[at] = True
        if up:
            # a component that has gone into another one does not come again
            gone = list(up)
            self.top[gone] = [find(x) for x in gone]
            self.component, self.uniform, self.connects = self.top[self.component], None, True
        return a[needed], b[needed]

    def joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        """Are all fingerprints of both ranges in one component?"""
        c = self.component
        if self.uniform is None:
            self.uniform = np.concatenate([[0], np.cumsum(c[1:] != c[:-1])])
        u = self.uniform
        return (u[alo] == u[ahi - 1]) & (u[blo] == u[bhi - 1]) & (c[alo] == c[blo])


def ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, … n[0] values, then those of the next range."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - ends + n, n)


def compare(keys, alo, ahi, blo, bhi, budget, forest, accept) -> None:
    """Compare the leaves of node pairs one by one; pairs within the budget go to `accept`."""
    work = np.cumsum((ahi - alo) * (bhi - blo))
    at = 0
    while at < len(alo):
        past = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + CHUNK, "right")))
        a0, a1, b0, b1 = alo[at:past], ahi[at:past], blo[at:past], bhi[at:past]
        at = past
        # rows of a pair one after the other: a node pair may itself be large where keys repeat
        row, left, width = ranges(a0, a1 - a0), np.repeat(b0, a1 - a0), np.repeat(b1 - b0, a1 - a0)
        sums = np.cumsum(width)
        begin = 0
        while begin < len(row):
            end = max(begin + 1, int(np.searchsorted(sums, (sums[begin - 1] if begin else 0) + CHUNK, "right")))
            some, n = row[begin:end], width[begin:end]
            j = ranges(left[begin:end], n)
            # few are near, so the row of a comparison is looked up for these only
            near = np.flatnonzero(np.bitwise_count(np.repeat(keys[some], n) ^ keys[j]) <= budget)
            i, j = some[np.searchsorted(sums[begin:end] - (sums[begin - 1] if begin else 0), near, "right")], j[near]
            ahead = i < j
            accept(forest, i[ahead], j[ahead])
            begin = end


class Trie:
    """The nodes of sorted keys of `bits` bits, level by level; node pairs are pairs of their numbers in a level.

    Of the keys of two subtrees (`split`) only what is below their roots is used.
    """

    def __init__(self, keys: np.ndarray, split: int, bits: int):
        self.keys, self.bits, self.levels = keys, bits, {}
        differ = (keys[1:] ^ keys[:-1]).astype(np.uint64)
        high = (differ >> np.uint64(32)).astype(np.float64)
        low = (differ & np.uint64(0xFFFFFFFF)).astype(np.float64)
        # bits that a key has in common with the one before it
        self.common = bits - np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])
        if split:
            self.common[split - 1] = -1

    def starts(self, level: int) -> np.ndarray:
        """Where the nodes of a level begin, and the end of the last one."""
        if level not in self.levels:
            self.levels[level] = np.concatenate([[0], 1 + np.flatnonzero(self.common < level), [len(self.keys)]])
        return self.levels[level]

    def children(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the lower and the upper child of each node, -1 where there is none."""
        if (level, "children") not in self.levels:
            above, below = self.starts(level), self.starts(level + 1)
            first = np.searchsorted(below, above)
            both = np.diff(first) > 1
            first = first[:-1]
            upper = (self.keys[above[:-1]] >> self.keys.dtype.type(self.bits - level - 1)) & self.keys.dtype.type(1) != 0
            self.levels[level, "children"] = np.where(upper, -1, first), np.where(upper | both, first + both, -1)
        return self.levels[level, "children"]


def descend(trie: Trie, own: bool, allowed: list[int], budget: int, forest: Forest, accept) -> None:
    """Compare the leaves of all node pairs that differ in `allowed[d]` bits at most after d bits, for each d."""
    stack = [(0, np.array([0]), np.array([0 if own else 1]), np.array([0], dtype=np.int8))]
    while stack:
        d, a, b, differ = stack.pop()
        if len(a) > CHUNK:
            half = len(a) // 2
            stack.append((d, a[half:], b[half:], differ[half:]))
            a, b, differ = a[:half], b[:half], differ[:half]
        at = trie.starts(d)
        alo, ahi, blo, bhi = at[a], at[a + 1], at[b], at[b + 1]
        go = (ahi - alo) * (bhi - blo) > 1 if own else np.ones(len(a), dtype=bool)
        if own:  # a single key with itself is no pair
            go |= a != b
        if forest.connects:
            go &= ~forest.joined(alo, ahi, blo, bhi)
        small = ((ahi - alo) * (bhi - blo) <= LEAF) | (d >= trie.bits)
        now = go & small
        if now.any():
            compare(trie.keys, alo[now], ahi[now], blo[now], bhi[now], budget, forest, accept)
        go &= ~small
        a, b, differ = a[go], b[go], differ[go]
        if not len(a):
            continue
        lower, upper = trie.children(d)
        la, ua, lb, ub = lower[a], upper[a], lower[b], upper[b]
        more = differ < allowed[d + 1]
        parts = [(la, lb, differ, True), (ua, ub, differ, True), (la, ub, differ + 1, more), (ua, lb, differ + 1, more & (a != b))]
        kept = [(x >= 0) & (y >= 0) & may for x, y, _, may in parts]
        stack.append((d + 1, *(np.concatenate([p[k][keep] for p, keep in zip(parts, kept)]) for k in range(3))))


def traverse(keys: np.ndarray, split: int, budget: int, depth: int, bits: int, full: np.ndarray | None = None,
             limit: int = 0, labels: np.ndarray | None = None, every: bool = False, exact: int = 0) -> np.ndarray:
    """Links, as rows of two positions, of a spanning forest between keys at most `budget` bits apart (and `full` rows at most `limit`).

    `keys` are the sorted keys of subtree u, then (from `split`) those of subtree
    v; without v (split = 0 or the end) pairs inside u are looked for. Keys of one
    label are connected from the start; with `every` (and `full`) all links
    between different labels are given instead of a forest. Pairs that differ in
    the first `exact` bits need not be given.

    The bits that are left go through the trie twice: with their first part in
    front, in which up to half of the budget may differ, and turned, with the
    other part in front and what is then left of the budget less one. A pair that
    is over both would be over the budget. So few node pairs live where nodes are
    many, and most keys that are compared are near.
    """
    n = len(keys)
    own = split in (0, n)
    same = max(0, exact - depth)
    rest = bits - depth
    spent = 0 if own else int(np.bitwise_count((keys[0] ^ keys[split]) >> np.uint64(64 - depth)))
    left = budget - spent
    if n < 2 or left < 0:
        return np.empty((0, 2), dtype=np.int64)
    word = np.uint32 if rest <= 32 else np.uint64
    below = (keys << np.uint64(depth)) >> np.uint64(64 - rest) if rest else np.zeros(n, dtype=np.uint64)
    turning = rest - same
    first, second = left // 2, left - 1 - left // 2
    front = turning // 2 + (first > second)
    if second < 0 or n < 3 or front >= turning:
        first, front = left, 0  # one turn is enough
    found = []

    def accept(order, beyond):
        def take(forest, i, j):
            if beyond is not None and len(i):
                # the first turn has found these
                new = np.bitwise_count((below[order[i]] ^ below[order[j]]) >> np.uint64(turning - front)) > beyond
                i, j = i[new], j[new]
            if full is not None and len(i):
                open_ = forest.component[i] != forest.component[j]
                i, j = i[open_], j[open_]
                x, y = order[i], order[j]
                near = np.bitwise_count(full[x] ^ full[y]).sum(axis=1) <= limit
                i, j = i[near], j[near]
            if not every:
                i, j = forest.add(i, j)
            found.append(np.stack([order[i], order[j]], axis=1))
        return take

    def allowed(part, at_first):
        return [0] * (same + 1) + [at_first] * part + [left] * (turning - part)

    forest = Forest(n, labels)
    order = np.arange(n)
    descend(Trie(below.astype(word), 0 if own else split, rest), own, allowed(front, first), left, forest, accept(order, None))
    if front:
        low = np.uint64((1 << turning) - 1)
        inner = below & low
        turned_ = (below & ~low) | ((inner << np.uint64(front)) & low) | (inner >> np.uint64(turning - front))
        order = np.lexsort((turned_, np.zeros(n, dtype=bool) if own else np.arange(n) >= split))
        forest = Forest(n, forest.component[order])
        descend(Trie(turned_[order].astype(word), 0 if own else split, rest), own, allowed(turning - front, second), left, forest,
                accept(order, first))
    return np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)


# --- upper levels as joins -------------------------------------------------------------------------------------------

def turned(keys: DataFrame, bits: int, blocks: int) -> DataFrame:
    """`keys` once for each block of their bits, as trees of their own, with that block turned to the front."""
    upper = -1 << (64 - bits)

    def turn(by: int):
        if by == 0:
            return F.col("key")
        return F.shiftleft("key", by).bitwiseOR(F.shiftrightunsigned("key", bits - by)).bitwiseAND(F.lit(upper).cast("long"))

    each = F.array(*[F.struct((F.col("tree") * blocks + i).cast("int").alias("tree"), turn(i * (bits // blocks)).alias("key"))
                     for i in range(blocks)])
    others = [c for c in keys.columns if c not in ("tree", "key")]
    return keys.select(F.explode(each).alias("__turn"), *others).select("__turn.tree", "__turn.key", *others)


def trie_links(keys: DataFrame, budget: int, bits: int = 64, limit: int | None = None, task_keys: int = TASK_KEYS,
               every: bool = False) -> DataFrame:
    """(a, b): links that connect the same nodes as all links do.

    `keys` has `tree` (int), `key` (long, its `bits` upper bits used), `node`
    (long) and, if `limit` is given, `prints` (array<long>): a link then also
    needs at most `limit` differing bits there. Trees are joined each with itself,
    large ones in turns; links that several turns find come more than once.
    With `every`, `keys` also has `label` (long), and all links between nodes of
    different labels are given, maybe more than once.
    """
    node_key, scratch = F.col("key"), Scratch(keys.sparkSession)
    largest = keys.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    # levels until two nodes together are small, and the pairs that a node is in there
    depth = STEP * -(-max(0, 2 * largest // task_keys).bit_length() // STEP) if largest > task_keys else 0
    blocks, exact = budget + 1, 0
    if depth and bits // blocks >= STEP and blocks <= sum(comb(min(depth, bits), i) for i in range(blocks)):
        keys, exact = turned(keys, bits, blocks), bits // blocks

    def prefix(level: int):
        return F.shiftrightunsigned(node_key, 64 - level) if level else F.lit(0).cast("long")

    def agreeing(level: int):
        """Are two nodes the same as far as the block in front goes?"""
        beyond = max(0, level - exact)
        return F.shiftrightunsigned("cu", beyond) == F.shiftrightunsigned("cv", beyond) if exact else F.lit(True)

    def nodes(level: int) -> DataFrame:
        return keys.groupBy("tree", prefix(level).alias("u")).agg(F.count("*").alias("n"))

    level, jobs = 0, []
    live = nodes(0).select("tree", F.col("u"), F.col("u").alias("v"), F.lit(0).alias("differ"), F.col("n").alias("nu"), F.col("n").alias("nv"))
    while True:
        live = scratch.save(f"trie-level-{level}", live)
        load = F.when(F.col("u") == F.col("v"), F.col("nu")).otherwise(F.col("nu") + F.col("nv"))
        small = (load <= task_keys) | F.lit(level >= bits)
        jobs.append(live.filter(small).select("tree", F.lit(level).alias("level"), "u", "v"))
        live = live.filter(~small)
        if level >= bits or live.isEmpty():
            break
        step = min(STEP, bits - level)
        level += step
        children = scratch.save("trie-nodes", nodes(level))
        cu = children.select("tree", F.shiftrightunsigned("u", step).alias("u"), F.col("u").alias("cu"), F.col("n").alias("nu"))
        cv = children.select("tree", F.shiftrightunsigned("u", step).alias("v"), F.col("u").alias("cv"), F.col("n").alias("nv"))
        live = (live.select("tree", "u", "v", "differ").join(cu, ["tree", "u"]).join(cv, ["tree", "v"]).filter("cu <= cv")
                .withColumn("differ", F.bit_count(F.col("cu").bitwiseXOR(F.col("cv"))))
                .filter((F.col("differ") <= budget) & agreeing(level))
                .select("tree", F.col("cu").alias("u"), F.col("cv").alias("v"), "differ", "nu", "nv"))
    work = scratch.save("trie-jobs", _union(jobs))
    levels = [r[0] for r in work.select("level").distinct().collect()]  # at most bits / STEP
    sides = []
    for at in levels:
        here = work.filter(F.col("level") == at)
        # the right side of a pair; a node paired with itself comes once
        ends = here.select("tree", "level", "u", "v", F.col("u").alias("mine")).unionByName(
            here.filter("u <> v").select("tree", "level", "u", "v", F.col("v").alias("mine")))
        sides.append(keys.withColumn("mine", prefix(at)).join(ends, ["tree", "mine"])
                     .select("tree", "level", "u", "v", *keys.columns[1:]))
    if not sides:
        return keys.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)

    def task(rows: pa.Table) -> pa.Table:
        at, u, v = (rows[c][0].as_py() for c in ("level", "u", "v"))
        key, node = (rows[c].to_numpy() for c in ("key", "node"))
        key = key.astype(np.uint64)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        split = 0 if u == v else int(np.searchsorted(key >> np.uint64(64 - at), np.uint64(v)))
        full = labels = None
        if limit is not None:
            full = rows["prints"].combine_chunks().flatten().to_numpy().reshape(len(key), -1).astype(np.uint64)[order]
        if every:
            labels = rows["label"].to_numpy()[order]
        pairs = node[traverse(key, split, budget, at, bits, full, limit or 0, labels, every, exact)]
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return _union(sides).groupBy("tree", "level", "u", "v").applyInArrow(task, "a long, b long")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def simhash_classes(docs: DataFrame, width: int = 3, budget: int = 3, task_keys: int = TASK_KEYS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: documents whose fingerprints are connected by links.

    Two fingerprints link at `budget` or fewer differing bits. A NULL, empty or
    blank text has fingerprint zero and links like any other; `component_id` is the
    smallest doc_id of the component (NULL ids do not count). Repeated rows come
    as often as they are there. Other columns are not used.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.save("prints", fingerprints(docs, ["doc_id"], width).select("doc_id", F.col("prints")[0].alias("print")))
    keys = scratch.save("keys", prints.groupBy("print").agg(F.min("doc_id").alias("first")))
    links = trie_links(keys.select(F.lit(0).alias("tree"), F.col("print").alias("key"), F.col("print").alias("node")),
                       budget, task_keys=task_keys)
    joined = components(links, "simhash")
    member = scratch.save("members", keys.join(joined.select(F.col("node").alias("print"), "component"), "print", "left")
                          .select("print", "first", F.coalesce("component", "print").alias("component")))
    first = scratch.save("firsts", member.groupBy("component").agg(F.min("first").alias("component_id")))
    classes = scratch.save("classes", member.join(first, "component").select("print", "component_id"))
    return prints.join(classes, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


#: Near-duplicates by shingle similarity: five words, 320 bits, ten tries of 32 bits each.
NEAR_WIDTH, NEAR_SEEDS, NEAR_LIMIT, NEAR_TASK_KEYS, NEAR_SIMILARITY = 5, (42, 43, 44, 45, 46), 80, 131_072, 0.8
#: Differing bits (of 320, and of 32 in a trie) of the pairs that are compared first.
CLOSE_LIMIT, CLOSE_BUDGET = 40, 3


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, n, shingles) of (node, text): the distinct 64-bit hashes of the shingles, and their number."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            found = [list({xxhash.xxh64_intdigest(s, SEED) - (1 << 63) for s in shingles(t.as_py(), width)}) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, found), pa.int32()), pa.array(found, pa.list_(pa.int64()))],
                                             names=["node", "n", "shingles"])

    rows = texts.select("node", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(each, "node long, n int, shingles array<long>")


def without_near_duplicates(docs: DataFrame, width: int = NEAR_WIDTH, seeds: tuple[int, ...] = NEAR_SEEDS, budget: int = 4,
                            limit: int = NEAR_LIMIT, task_keys: int = NEAR_TASK_KEYS, similarity: float = NEAR_SIMILARITY) -> DataFrame:
    """`docs` with one document of each group of near-duplicates: the least by doc_id (a NULL id first) and text.

    Two documents link if the Jaccard similarity of their sets of `width`-word
    shingles is `similarity` or more, which is computed for every pair that the
    fingerprints bring together. Documents of similarity J differ in
    acos(2 J / (1 + J)) / pi of the bits on average, 48 of 320 at 0.8 (unrelated
    ones in 160). So many bits are far beyond the budget of a trie, so the bits are
    dealt over tries of 32 bits: a pair is a candidate if it keeps to the budget in
    any of them, and to the limit over all. First a forest of the closest pairs is
    compared; then all candidates that this has not connected.

    All columns stay, whatever their names. NULL, empty and blank texts are one
    group; of rows that repeat each other one stays.
    """
    scratch = Scratch(docs.sparkSession)
    identity = ["__id", "__mark"]  # without NULLs, so that joining and grouping share one shuffle
    named = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn(
        "__mark", F.xxhash64(F.col("doc_id").isNull(), "text"))
    prints = scratch.save("near-prints", fingerprints(named, ["doc_id", *identity], width, seeds, distinct=True))
    keys = scratch.save("near-keys", prints.groupBy("prints").agg(F.min(F.struct(*identity)).alias("shown"))
                        .withColumn("node", F.monotonically_increasing_id()))
    tries = F.array(*[F.struct(F.lit(2 * i + half).alias("tree"), (
        F.shiftleft(F.col("prints")[i], 32) if half else F.shiftleft(F.shiftrightunsigned(F.col("prints")[i], 32), 32)).alias("key"))
        for i in range(len(seeds)) for half in (0, 1)])

    def tried(labelled: DataFrame) -> DataFrame:
        more = [c for c in labelled.columns if c == "label"]
        return scratch.save("near-tries", labelled.withColumn("trie", F.explode(tries)).select(
            "trie.tree", "trie.key", "node", "prints", *more))

    def verified(found: DataFrame, name: str) -> DataFrame:
        """The candidate links whose documents are similar."""
        pairs = scratch.save("near-pairs", found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        shown = keys.join(nodes, "node").select("node", "shown.*")
        texts = named.select(*identity, "text").join(shown, identity).dropDuplicates(["node"])
        sets = scratch.save("near-sets", shingle_sets(texts, width))
        # pairs carry their sets, so they go in as many turns as it takes for a turn to carry few more sets than there are
        turns = max(1, -(-pairs.count() // (2 * sets.count() + 1)))
        links = []
        for turn in range(turns):
            some = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(turns)) == turn) if turns > 1 else pairs
            both = (some.join(sets.toDF("a", "na", "x"), "a").join(sets.toDF("b", "nb", "y"), "b")
                    .filter(F.least("na", "nb") >= similarity * F.greatest("na", "nb")))
            common = let(F.size(F.array_intersect("x", "y")), lambda n: n / (F.col("na") + F.col("nb") - n))
            links.append(scratch.save(f"near-links-{name}-{turn}", both.filter(common >= similarity).select("a", "b")))
        scratch.drop("near-pairs", "near-sets")
        return _union(links)

    close = verified(trie_links(tried(keys.select("prints", "node")), CLOSE_BUDGET, 32, CLOSE_LIMIT, task_keys), "close")
    labels = scratch.save("near-labels", components(close, "close"))
    labelled = keys.select("prints", "node").join(labels, "node", "left").select(
        "prints", "node", F.coalesce("component", "node").alias("label"))
    rest = verified(trie_links(tried(labelled), budget, 32, limit, task_keys, every=True), "rest")
    joined = components(close.unionByName(rest), "near")
    classes = scratch.save("near-classes", keys.join(joined, "node", "left").select(
        "prints", F.coalesce("component", "node").alias("component")))
    scratch.drop("near-tries", "near-keys", "near-labels")
    kept = prints.join(classes, "prints").groupBy("component").agg(
        F.min(F.struct("doc_id", *identity)).alias("kept")).select("kept.__id", "kept.__mark")
    kept = scratch.save("near-kept", kept)
    scratch.drop("near-prints", "near-classes")
    # the join brings equal rows together, so repeated ones go without another shuffle
    return named.join(kept, identity, "left_semi").dropDuplicates(identity).drop(*identity)


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark, sf_dir):
    return simhash_classes(documents(spark, sf_dir))
