"""N-gram Jaccard join by prefix trees: which texts share 75 % of their 5-word shingles.

1. Every text becomes its set of shingle hashes. A sketch of fixed size counts shingles over all
   texts and gives the global order: common ones last, ties by hash.
2. Texts that link share a shingle among the first quarter of either set in that order. Tasks
   exchange these as packed arrays, cut by hash; what is left is, for each shared shingle, the list
   of its texts, once however many shingles have the same list. A shingle that the sketch counts
   above ``HOT`` is cut into blocks of texts, and every two blocks meet in a list of their own.
3. Within each list, sizes and parity bitmaps (a lower bound of what two sets do not share) rule
   out pairs. A spanning forest of the rest, not its pairs, groups texts into clusters.
4. The sets of a cluster are stored in a path-compressed prefix tree in the global order, common
   first. Each set runs down the tree: nodes carry the overlap so far, shared by all sets below,
   and subtrees go where the rest cannot reach the overlap that is needed. Clusters above
   ``BLOCK`` texts are cut into blocks and every two blocks meet in a task. Only a spanning forest
   of the links comes out; components follow from it.

Nothing is capped: lists, clusters and texts of any size are worked through in full. Equal sets are
one class from the start. Null and empty texts have an empty set and link with nothing; a null id is
kept, without a component. Rows with the same id are one node. Extra columns are not read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import Words, flat, mix, pieces, ranges, release, table, text_batches, window_hashes
from zonalis.llm.components import components, roots
from zonalis.session import stage

WIDTH = 5
SKETCH = 1 << 20
SLICES = 64
HOT = 200_000
BLOCK = 4096
#: Early shingles a task holds before it sends them on.
FLUSH = 500_000
PIECE = 1 << 18
#: Bits of a parity bitmap for each shingle, before rounding up to a power of two.
BITS = 2


def needed(a, b, percent: int):
    """Least overlap of sets of these sizes that link: 100 * o >= percent * (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def set_pieces(column: pa.Array, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, set sizes by row, and the sorted distinct shingles of all rows end to end."""
    data, bounds = flat(column)
    for start, stop in pieces(bounds, PIECE):
        part = bounds[start : stop + 1]
        words = Words(data[part[0] : part[-1]], part - part[0])
        hashes, counts = words.hashes(), np.diff(words.first)
        whole = window_hashes(hashes, width)
        full = np.maximum(counts - width + 1, 0)
        shingles = [whole[ranges(words.first[:-1], full)]]
        rows = [np.repeat(np.arange(len(counts)), full)]
        for n in range(1, width):  # a shorter text is one shingle
            at = np.flatnonzero(counts == n)
            if len(at):
                shingles.append(window_hashes(hashes, n)[words.first[at]])
                rows.append(at)
        row, shingle = np.concatenate(rows), np.concatenate(shingles)
        order = np.lexsort((shingle, row))
        row, shingle = row[order], shingle[order]
        fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])]) if len(row) else row > 0
        yield start, np.bincount(row[fresh], minlength=len(counts)), shingle[fresh]


def bitmap_bits(n: int) -> int:
    return 1 << max(6, (BITS * n - 1).bit_length())


def bitmap(shingles: np.ndarray) -> bytes:
    """Parities of the shingles' bits; two bitmaps differ in no more bits than the sets do."""
    size = bitmap_bits(len(shingles))
    odd = np.bincount((shingles >> np.uint64(20) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of fewer bits over the same set."""
    while bits.shape[-1] * 8 > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


MEMBERS = "doc_id bigint, n_shingles bigint, digest binary, bits binary, slice int, counts binary"


def describe(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """A row per text with size, digest and bitmap of its set; and the task's sketch in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for start, sizes, shingles in set_pieces(batch.column("text"), width):
                sketch += np.bincount((shingles & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                ends = np.cumsum(sizes)
                sets = [shingles[e - n : e] for e, n in zip(ends, sizes, strict=True)]
                digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                count = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(start, count), pa.array(sizes.astype(np.int64)),
                     pa.array(digest, pa.binary()), pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([None] * count, pa.int32()), pa.array([None] * count, pa.binary())], _NAMES)
        release()
        parts = sketch.reshape(SLICES, -1)
        none = [None] * SLICES
        yield pa.RecordBatch.from_arrays(
            [pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.binary()),
             pa.array(none, pa.binary()), pa.array(range(SLICES), pa.int32()),
             pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary())], _NAMES)

    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, MEMBERS)


_NAMES = ["doc_id", "n_shingles", "digest", "bits", "slice", "counts"]


def order_classes(described: DataFrame) -> np.ndarray:
    """Class of each sketch cell, rarer first; the sketch has a fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(SKETCH // SLICES, np.int64), 0
        for batch in batches:
            for number, packed in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                total += np.frombuffer(packed.as_py(), "<u4")
        yield pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int32()), "counts": [total.tobytes()]})

    parts = described.where("slice IS NOT NULL").select("slice", "counts")
    out = np.zeros((SLICES, SKETCH // SLICES), np.int64)
    for row in parts.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect():
        out[row["slice"]] = np.frombuffer(row["counts"], "<i8")
    return out.reshape(-1)


def shared_lists(df: DataFrame, key: str, text: str, width: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Distinct lists (``list`` and packed ``docs``) of texts that share an early shingle."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(counts)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        classes = np.floor(2 * np.log2(np.maximum(counts, 1))).astype(np.int64)
        blocks = np.ceil(counts / HOT).astype(np.int64)
        seen: set[bytes] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush():
            tokens, docs = (np.concatenate(x) for x in zip(*held, strict=True))
            shard = ((tokens >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((tokens, shard))
            shard, tokens, docs = shard[order], tokens[order], docs[order]
            edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            out = {"shard": [], "tokens": [], "at": [], "docs": []}
            for a, b in zip(edges, edges[1:], strict=False):
                ids, at = np.unique(docs[a:b], return_inverse=True)
                out["shard"].append(int(shard[a]))
                out["tokens"].append(tokens[a:b].tobytes())
                out["at"].append(at.astype("<u4").tobytes())
                out["docs"].append(ids.tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(out["shard"], pa.int32()), *(pa.array(out[k], pa.binary()) for k in ("tokens", "at", "docs"))],
                list(out))

        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for start, sizes, shingles in set_pieces(batch.column("text"), width):
                row = np.repeat(np.arange(len(sizes)), sizes)
                cell = (shingles & np.uint64(SKETCH - 1)).astype(np.int64)
                order = np.lexsort((shingles, classes[cell], row))
                ends = np.cumsum(sizes)
                place = np.arange(len(row)) - np.repeat(ends - sizes, sizes)
                early = place < (sizes - -(-percent * sizes // 100) + 1)[row]
                fresh = np.zeros(len(sizes), bool)
                for i, (e, size) in enumerate(zip(ends, sizes, strict=True)):
                    if size:  # equal sets of a task are sent once
                        digest = hashlib.blake2b(shingles[e - size : e].tobytes(), digest_size=16).digest()
                        fresh[i] = digest not in seen
                        seen.add(digest)
                pick = order[early & fresh[row]]
                tokens, docs = shingles[pick], keys[start + row[pick]].astype(np.int64)
                many = blocks[cell[pick]]
                if len(many) and many.max() > 1:
                    hot = np.flatnonzero(many > 1)
                    more_tokens, more_docs = _in_blocks(tokens[hot], docs[hot], many[hot])
                    rest = many <= 1
                    tokens = np.concatenate([tokens[rest], more_tokens])
                    docs = np.concatenate([docs[rest], more_docs])
                held.append((tokens, docs))
                n += len(tokens)
                if n >= FLUSH:
                    yield flush()
                    held.clear()
                    n = 0
        if n:
            yield flush()
        held.clear()
        release()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, docs = [], []
        for batch in batches:
            for t, a, d in zip(*(batch.column(c).to_pylist() for c in ("tokens", "at", "docs")), strict=True):
                tokens.append(np.frombuffer(t, "<u8"))
                docs.append(np.frombuffer(d, "<i8")[np.frombuffer(a, "<u4")])
        tokens, docs = np.concatenate(tokens), np.concatenate(docs)
        order = np.argsort(tokens, kind="stable")
        ranked = tokens[order]
        del tokens
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        ends = np.concatenate([starts[1:], [len(ranked)]])
        found: dict[bytes, bytes] = {}
        for s, e in zip(*(x[ends - starts > 1] for x in (starts, ends)), strict=True):
            packed = np.unique(docs[order[s:e]]).tobytes()
            if len(packed) > 8:
                found[hashlib.blake2b(packed, digest_size=16).digest()] = packed
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())],
                                         ["list", "docs"])

    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"))
    posted = rows.where("key IS NOT NULL").mapInArrow(post, "shard int, tokens binary, at binary, docs binary")
    lists = posted.groupBy("shard").applyInArrow(meet, "list binary, docs binary")
    return lists.groupBy("list").agg(F.first("docs").alias("docs"))


def _in_blocks(tokens: np.ndarray, docs: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hot shingles under a name for each pair of blocks of texts, so that every two texts meet."""
    own = (mix(docs.view(np.uint64)) % many.astype(np.uint64)).astype(np.int64)
    at = np.repeat(np.arange(len(tokens)), many)
    other = ranges(np.zeros(len(many), np.int64), many)
    low, high = np.minimum(own[at], other), np.maximum(own[at], other)
    return mix(tokens[at] ^ mix((low * many[at] + high + 1).astype(np.uint64))), docs[at]


def list_forest(reps: np.ndarray, sizes: np.ndarray, bits: list[bytes], percent: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs of one list that sizes and bitmaps do not rule out."""
    a: list[int] = []
    b: list[int] = []
    group = np.arange(len(reps))
    widths = np.array([len(x) for x in bits])
    stacks = []
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        stacks.append((int(width), rows, np.stack([np.frombuffer(bits[i], np.uint8) for i in rows])))
    for i, n in enumerate(sizes):
        for width, rows, stack in stacks:
            pick = np.flatnonzero(
                (rows > i) & (group[rows] != group[i])
                & (100 * np.minimum(n, sizes[rows]) >= percent * np.maximum(n, sizes[rows]))
            )
            if not len(pick):
                continue
            size = 8 * min(width, len(bits[i]))
            own = folded(np.frombuffer(bits[i], np.uint8), size)
            apart = np.bitwise_count(folded(stack[pick], size) ^ own).sum(axis=1, dtype=np.int64)
            others = rows[pick]
            hits = others[apart <= n + sizes[others] - 2 * needed(n, sizes[others], percent)]
            found, first = np.unique(group[hits], return_index=True)
            a += [int(reps[i])] * len(found)
            b += reps[hits[first]].tolist()
            group[np.isin(group, found)] = group[i]
    return a, b


def clusters_of(lists: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """``id`` and ``component`` of the classes that may link with another one."""
    spark = lists.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = [np.frombuffer(d, "<i8") for d in batch.column("docs").to_pylist()]
            if docs:
                counts = [len(d) for d in docs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("list").take(pa.array(np.repeat(np.arange(len(docs)), counts))),
                     pa.array(np.concatenate(docs))], ["list", "doc_id"])

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches).sort_by([("list", "ascending"), ("rep", "ascending")])
        names = held["list"].to_pylist()
        reps, sizes, bits = held["rep"].to_numpy(), held["n_shingles"].to_numpy(), held["bits"].to_pylist()
        a: list[int] = []
        b: list[int] = []
        start = 0
        while start < len(names):
            stop = start + 1
            while stop < len(names) and names[stop] == names[start]:
                stop += 1
            more = list_forest(reps[start:stop], sizes[start:stop], bits[start:stop], percent)
            a += more[0]
            b += more[1]
            start = stop
        del held, bits
        release()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    entries = lists.mapInArrow(split, "list binary, doc_id bigint")
    # merge joins at every size, so that what is moved grows with the input and not by jumps
    told = entries.join(members.select("doc_id", "rep", "n_shingles", "bits").hint("merge"), "doc_id").select(
        "list", "rep", "n_shingles", "bits"
    )
    sharded = told.withColumn("shard", F.pmod(F.xxhash64("list"), F.lit(4 * shards)))
    return components(sharded.groupBy("shard").applyInArrow(forest, "a bigint, b bigint"))


class PrefixTree:
    """Path-compressed tree of sorted sequences of small integers."""

    def __init__(self, sequences: list[np.ndarray]):
        order = sorted(range(len(sequences)), key=lambda i: sequences[i].astype(">u4").tobytes())
        self.parent, self.depth = [-1], [0]  # depth: tokens above and in the node
        runs: list[np.ndarray] = [np.empty(0, np.int64)]
        self.leaf = np.zeros(len(sequences), np.int64)
        path = [0]
        before = np.empty(0, np.int64)
        for i in order:
            now = sequences[i]
            n = min(len(before), len(now))
            apart = np.flatnonzero(before[:n] != now[:n])
            common = int(apart[0]) if len(apart) else n
            while self.depth[path[-1]] > common:
                last = path.pop()
                above = self.parent[last]
                if self.depth[above] < common:  # cut the node's run in two
                    cut = common - self.depth[above]
                    self.parent.append(above)
                    self.depth.append(common)
                    runs.append(runs[last][:cut])
                    runs[last] = runs[last][cut:]
                    self.parent[last] = len(self.parent) - 1
                    path.append(len(self.parent) - 1)
            if len(now) > common or not len(now):
                self.parent.append(path[-1])
                self.depth.append(len(now))
                runs.append(now[common:])
                path.append(len(self.parent) - 1)
            self.leaf[i] = path[-1]
            before = now
        self.parent, self.depth = np.array(self.parent), np.array(self.depth)
        self.lengths = np.array([len(r) for r in runs])
        self.tokens = np.concatenate(runs)
        self.starts = np.cumsum(self.lengths) - self.lengths
        size = np.array([len(s) for s in sequences])
        nodes = len(self.parent)
        self.longest, self.shortest = np.zeros(nodes, np.int64), np.full(nodes, np.iinfo(np.int64).max)
        np.maximum.at(self.longest, self.leaf, size)
        np.minimum.at(self.shortest, self.leaf, size)
        for node in np.argsort(-self.depth, kind="stable"):
            up = self.parent[node]
            if up >= 0:
                self.longest[up] = max(self.longest[up], self.longest[node])
                self.shortest[up] = min(self.shortest[up], self.shortest[node])
        self.by_parent = np.argsort(self.parent, kind="stable")
        self.first = np.searchsorted(self.parent[self.by_parent], np.arange(nodes + 1))

    def overlaps(self, mask: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Overlap with each sequence of the set in ``mask``; -1 where it cannot be enough."""
        shared = np.full(len(self.parent), -1, np.int64)
        shared[0] = 0
        active = np.array([0])
        while len(active):
            kids = self.by_parent[ranges(self.first[active], self.first[active + 1] - self.first[active])]
            fits = (100 * self.longest[kids] >= percent * size) & (100 * size >= percent * self.shortest[kids])
            kids = kids[fits]
            if not len(kids):
                break
            hit = mask[self.tokens[ranges(self.starts[kids], self.lengths[kids])]]
            total = np.concatenate([[0], np.cumsum(hit)])
            ends = np.cumsum(self.lengths[kids])
            sums = total[ends] - total[ends - self.lengths[kids]]
            shared[kids] = shared[self.parent[kids]] + sums
            # the rest of either side bounds what can still be shared
            rest = np.minimum(self.longest[kids] - self.depth[kids], size - shared[kids])
            least = needed(size, np.maximum(self.shortest[kids], -(-percent * size // 100)), percent)
            active = kids[shared[kids] + rest >= least]
            shared[kids[shared[kids] + rest < least]] = -1
        return shared[self.leaf]


def tree_links(ids: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, classes: np.ndarray,
               percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between sets at ``left`` and at ``right``."""
    used = np.union1d(left, right)
    tokens = np.unique(np.concatenate([sets[i] for i in used]))
    # common shingles first: the reverse of the global order
    rank = np.lexsort((tokens, -classes[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)]))
    code = np.empty(len(tokens), np.int64)
    code[rank] = np.arange(len(tokens))
    coded = {i: np.sort(code[np.searchsorted(tokens, sets[i])]) for i in used}
    tree = PrefixTree([coded[i] for i in right])
    sizes = np.array([len(sets[i]) for i in right])
    group = {int(i): int(i) for i in used}

    def find(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    mask = np.zeros(len(tokens), bool)
    a, b = [], []
    for i in left:
        mask[coded[i]] = True
        n = len(sets[i])
        shared = tree.overlaps(mask, n, percent)
        mask[coded[i]] = False
        for k in np.flatnonzero((shared >= 0) & (100 * shared >= percent * (n + sizes - shared))):
            j = int(right[k])
            if find(int(i)) != find(j):
                group[find(j)] = find(int(i))
                a.append(ids[i])
                b.append(ids[j])
    return np.array(a, np.int64), np.array(b, np.int64)


def links(df: DataFrame, key: str, text: str, width: int, percent: int, clusters: DataFrame, counts: np.ndarray) -> DataFrame:
    """A spanning forest (a, b) of the links within the clusters."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(counts)
    sized = clusters.groupBy("component").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit(5), F.col("id")), F.col("blocks")).cast("int")
    placed = (
        clusters.join(sized, "component")
        .withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("id", "component", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, sizes, shingles in set_pieces(batch.column("text"), width):
                ends = np.cumsum(sizes)
                sets = [shingles[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(start, len(sizes)) for c in ("id", "component", "own", "low", "high")),
                     pa.array(sets, pa.binary())], ["id", "component", "own", "low", "high", "shingles"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        classes = np.floor(2 * np.log2(np.maximum(counts, 1))).astype(np.int64)
        held = pa.Table.from_batches(batches).sort_by([("component", "ascending"), ("low", "ascending"),
                                                       ("high", "ascending"), ("id", "ascending")])
        ids, own = held["id"].to_numpy(), held["own"].to_numpy()
        low, high, where = held["low"].to_numpy(), held["high"].to_numpy(), held["component"].to_numpy()
        sets = [np.frombuffer(s, "<u8") for s in held["shingles"].to_pylist()]
        same = (where[1:] == where[:-1]) & (low[1:] == low[:-1]) & (high[1:] == high[:-1])
        edges = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
        for s, e in zip(edges, edges[1:], strict=False):
            rows = np.arange(s, e)
            # classes of equal sets that share an id are one node already
            left, right = rows[own[s:e] == low[s]], rows[own[s:e] == high[s]]
            if len(rows) > 1 and len(left) and len(right):
                a, b = tree_links(ids, sets, left, right, classes, percent)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    texts = df.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = texts.join(placed.hint("merge"), "id").select("id", "component", "own", "low", "high", "text").mapInArrow(
        shingled, "id bigint, component bigint, own int, low int, high int, shingles binary")
    sharded = sets.withColumn("shard", F.pmod(F.xxhash64("component", "low", "high"), F.lit(shards)))
    return sharded.groupBy("shard").applyInArrow(join, "a bigint, b bigint")


def ngram_components(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                     percent: int = 75) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row."""
    text_batches(df.sparkSession)
    described = stage(describe(df, key, text, width), "shingles")
    counts = order_classes(described)
    rows = described.where("slice IS NULL")
    reps = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    members = stage(rows.join(reps, "digest", "left").select("doc_id", "n_shingles", "rep", "bits"), "members")
    lists = stage(shared_lists(df, key, text, width, percent, counts), "lists")
    clusters = stage(clusters_of(lists, members.where("rep IS NOT NULL"), percent), "clusters")
    found = links(df, key, text, width, percent, clusters, counts)
    # rows that share an id join the classes of their texts
    twins = members.where("rep != doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    linked = stage(components(found.unionByName(twins)), "linked")
    out = members.join(linked.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left")
    return out.select(F.col("doc_id").alias(key), "n_shingles",
                      F.coalesce("component", "doc_id").alias("component_id"))


def op3_ngram_join(spark, sf_dir):
    """Shingle counts and near-duplicate components of every document."""
    return ngram_components(table(spark, sf_dir, "documents"))


#: All pairs that share a shingle, and what each document reaches.
OP3_SQL = """
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(2, len(w) - 3))]) AS s
  FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT s FROM shingles GROUP BY s HAVING count(*) > 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM shingles x JOIN shared USING (s)
  JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
edges AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * i >= 75 * (p.n + q.n - i)),
reach AS (SELECT doc_id AS id, doc_id AS other FROM documents
  UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, cast(coalesce(n, 0) AS bigint) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT id AS doc_id, min(other) AS component_id FROM reach GROUP BY id) c USING (doc_id)"""
