"""Suffix-array dedup: removes passages that an earlier document has, byte for byte.

A byte goes when a string of ``length`` bytes that covers it also starts in a document with a
smaller id. The suffix array is distributed by content:

1. Anchors. The anchor of a string is its ``GRAM``-byte part with the least hash, so equal strings
   have equal anchors. Tasks exchange anchor hashes as packed arrays; those of a single document
   cannot lie in a repeated string and are left out (a hash that collides only adds work).
2. Contexts. A run of neighbouring strings with one anchor, with the bytes they span, is a context.
   Equal contexts of a bucket of documents are sent once, with their smallest and largest id, to
   the shard of their anchor. So a passage that a third of all documents share is a row per bucket.
3. Suffix array of each shard's distinct contexts by difference cover modulo 3: sort the sampled
   triples (of 8-byte characters), name them, recurse on the names until they span ``length``
   bytes, merge the remaining suffixes by first byte and rank of the next sampled suffix, and
   compare adjacent prefixes. Each class of equal strings takes the smallest id of its contexts.
4. The verdicts return to the buckets, where each document's strings are looked up and cut.

Null and empty texts, and texts shorter than ``length``, stay as they are. A row without an id
neither loses bytes nor takes any from others. Rows with one id do not take bytes from each other.
Strings never cross documents and are judged on the input. Extra columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import flat, mix, pieces, powers, prefix_hash, ranges, release, runs, table, text_batches
from zonalis.session import stage

LENGTH = 50
GRAM = 24
#: Longer rows are read in overlapping parts; positions within a part take 24 bits.
PART = 1 << 22
#: Bytes of text whose strings are hashed at a time.
PIECE = 1 << 18
#: Anchors a task holds before it sorts them and sends them on.
FLUSH = 500_000
#: Bytes of text for which there is a shard at least; results do not depend on it.
SHARD_BYTES = 1 << 22
#: Contexts of a shard that are sorted at a time; those of one anchor stay together.
SORTED_AT_ONCE = 20_000

_PLACE = np.uint64((1 << 24) - 1)
_LOW40 = np.uint64((1 << 40) - 1)


class Contexts:
    """Runs of strings with one anchor, within the rows of ``raw`` cut at ``edges``."""

    def __init__(self, raw: np.ndarray, edges: np.ndarray, length: int):
        n, gram = len(raw), min(GRAM, length)
        self.raw, self.length = raw, length
        self.start = self.stop = np.empty(0, np.int64)
        self.anchor = self.digest = np.empty(0, np.uint64)
        if n < length:
            self.row = self.start
            return
        whole = prefix_hash(raw)
        _, down = powers(n + 1)
        grams = mix((whole[gram:] - whole[:-gram]) * down[: n - gram + 1])
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        width, reach = length - gram + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if rest := width - reach:
            least = np.minimum(least[:-rest], least[rest:])
        place = (least & _PLACE).astype(np.int64)  # of the anchor of the string at each byte
        cuts = np.zeros(n + 1, np.int64)
        cuts[edges] = 1
        before = np.cumsum(cuts)
        inside = before[length - 1 : n] == before[: n - length + 1]
        change = np.concatenate([[True], (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])])
        first = np.flatnonzero(change)
        last = np.concatenate([first[1:], [len(place)]])
        own = inside[first]
        self.start, self.stop = first[own], last[own]  # of strings; bytes reach to stop + length - 1
        self.anchor = grams[place[self.start]]
        end = self.stop + (length - 1)
        content = (whole[end] - whole[self.start]) * down[self.start]
        self.digest = mix(content ^ (self.stop - self.start).astype(np.uint64))
        self.row = np.searchsorted(edges, self.start, "right") - 1


def parts(bounds: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """First and last row and byte range of each part; parts of one row share length - 1 bytes."""
    for start, stop in pieces(bounds, PIECE):
        low, high = int(bounds[start]), int(bounds[stop])
        if stop - start > 1 or high - low <= PART:
            yield start, stop, low, high
        else:
            for at in range(low, high - length + 1, PART):
                yield start, stop, at, min(high, at + PART + length - 1)


def contexts(data: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[Contexts, int, np.ndarray]]:
    """Contexts of each part, its first byte, and the row of each context."""
    for start, stop, low, high in parts(bounds, length):
        edges = np.clip(bounds[start : stop + 1] - low, 0, high - low)
        found = Contexts(data[low:high], edges if stop - start > 1 else np.array([0, high - low]), length)
        yield found, low, start + (found.row if stop - start > 1 else np.zeros(len(found.row), np.int64))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def named(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Anchors by shard and 40 further bits."""
    return (shard_of(hashes, shards).astype(np.uint64) << np.uint64(40)) | (hashes & _LOW40)


def pack40(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack40(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return out.view("<u8")[:, 0]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    n = len(columns[0])
    fresh = np.zeros(n, bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return fresh


def repeated_anchors(rows: DataFrame, length: int, shards: int) -> DataFrame:
    """By bucket: packed anchors that two or more documents have (``shard``, ``anchors``)."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush():
            anchor, bucket = (np.concatenate(x) for x in zip(*held, strict=True))
            name = named(anchor, shards)
            order = np.lexsort((bucket, name))
            name, bucket = name[order], bucket[order]
            # two documents of a bucket are as good as many
            third = np.zeros(len(name), bool)
            third[2:] = (name[2:] == name[:-2]) & (bucket[2:] == bucket[:-2])
            name, bucket = name[~third], bucket[~third]
            shard = (name >> np.uint64(40)).astype(np.int64)
            order = np.lexsort((name, bucket, shard))
            name, bucket, shard = name[order], bucket[order], shard[order]
            edges = np.flatnonzero(np.concatenate([_starts(shard), [True]]))
            spans = list(zip(edges, edges[1:], strict=False))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(shard[a]) for a, _ in spans], pa.int32()),
                 pa.array([pack40(name[a:b] & _LOW40) for a, b in spans], pa.binary()),
                 pa.array([bucket[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary())],
                ["shard", "anchors", "buckets"])

        for batch in batches:
            data, bounds = flat(batch.column("text"))
            buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
            for found, _, row in contexts(data, bounds, length):
                order = np.lexsort((found.anchor, row))
                row, anchor = row[order], found.anchor[order]
                once = _starts(row, anchor)
                held.append((anchor[once], buckets[row[once]]))
                n += int(once.sum())
                if n >= FLUSH:
                    yield flush()
                    held.clear()
                    n = 0
        if n:
            yield flush()
        held.clear()
        release()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, buckets, shard = [], [], 0
        for batch in batches:
            for shard, a, b in zip(*(batch.column(c).to_pylist() for c in ("shard", "anchors", "buckets")), strict=True):
                anchors.append(unpack40(a))
                buckets.append(np.frombuffer(b, "<u4"))
        anchors, buckets = np.concatenate(anchors), np.concatenate(buckets)
        order = np.lexsort((buckets, anchors))
        anchors, buckets = anchors[order], buckets[order]
        fresh = np.flatnonzero(_starts(anchors))
        count = np.diff(np.concatenate([fresh, [len(anchors)]]))
        keep = np.repeat(count > 1, count) & _starts(anchors, buckets)
        anchors, buckets = anchors[keep], buckets[keep]
        order = np.argsort(buckets, kind="stable")
        anchors, buckets = anchors[order], buckets[order]
        edges = np.flatnonzero(np.concatenate([_starts(buckets), [True]])) if len(buckets) else np.zeros(1, int)
        spans = list(zip(edges, edges[1:], strict=False))
        del order, fresh, count, keep
        release()
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(buckets[a]) for a, _ in spans], pa.int32()), pa.array([shard] * len(spans), pa.int32()),
             pa.array([pack40(anchors[a:b]) for a, b in spans], pa.binary())], ["bucket", "shard", "anchors"])

    posted = rows.where("id IS NOT NULL").select("bucket", "text").mapInArrow(
        post, "shard int, anchors binary, buckets binary")
    return posted.groupBy("shard").applyInArrow(meet, "bucket int, shard int, anchors binary")


def _row_batch(key: np.ndarray, name: str, columns: dict[str, np.ndarray], blobs=None) -> dict:
    """Packed rows by the sorted ``key``; ``blobs`` packs further columns from a row range."""
    edges = np.flatnonzero(np.concatenate([_starts(key), [True]])) if len(key) else np.zeros(1, int)
    spans = list(zip(edges, edges[1:], strict=False))
    out = {name: pa.array([int(key[a]) for a, _ in spans], pa.int32())}
    for c, values in columns.items():
        out[c] = pa.array([values[a:b].tobytes() for a, b in spans], pa.binary())
    for c, pack in (blobs or {}).items():
        out[c] = pa.array([pack(a, b) for a, b in spans], pa.binary())
    return out


CONTEXTS = "shard int, bucket int, anchor binary, strings binary, low binary, spread binary, bytes binary"
#: Parts of an anchor shard that are sorted as groups of their own, which bounds a task's memory.
SPLIT = 4


def send_contexts(rows: DataFrame, anchors: DataFrame, length: int, shards: int) -> DataFrame:
    """Distinct contexts of each bucket with a repeated anchor, to the shards of the anchors."""

    def gather(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        schema = pa.schema([(n.split()[0], pa.int32() if n.endswith("int") else pa.binary()) for n in CONTEXTS.split(", ")])
        if not len(docs) or not len(wanted):
            return schema.empty_table()
        known = np.sort(np.concatenate([
            (np.uint64(s) << np.uint64(40)) | unpack40(a)
            for s, a in zip(wanted["shard"].to_pylist(), wanted["anchors"].to_pylist(), strict=True)]))
        if docs["id"].null_count:
            docs = docs.filter(docs["id"].is_valid())
        ids = docs["id"].to_numpy()
        data, bounds = flat(docs["text"])
        found = []
        for part, low, row in contexts(data, bounds, length):
            name = named(part.anchor, shards)
            hit = known[np.minimum(np.searchsorted(known, name), len(known) - 1)] == name
            found.append((name[hit], part.digest[hit], (part.stop - part.start)[hit], ids[row[hit]], low + part.start[hit]))
        if not found:
            return schema.empty_table()
        name, digest, strings, doc, at = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((doc, digest, name))
        name, digest, strings, doc, at = (x[order] for x in (name, digest, strings, doc, at))
        first = np.flatnonzero(_starts(name, digest))
        last = np.concatenate([first[1:], [len(name)]]) - 1
        name, strings, at = (x[first] for x in (name, strings, at))
        content = lambda a, b: data[ranges(at[a:b], strings[a:b] + length - 1)].tobytes()
        low, high = doc[first], doc[last]
        shard = (name >> np.uint64(40)).astype(np.int64) * SPLIT + (name % np.uint64(SPLIT)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        shard, name, strings, at, low, high = (x[order] for x in (shard, name, strings, at, low, high))
        made = _row_batch(
            shard, "shard",
            {"strings": strings.astype("<u4"), "low": low.astype("<i8"), "spread": (high - low).astype("<i8")},
            {"anchor": lambda a, b: pack40(name[a:b] & _LOW40), "bytes": content})
        made["bucket"] = pa.array([docs["bucket"][0].as_py()] * len(made["shard"]), pa.int32())
        del found, name, digest, strings, doc, at, data
        release()
        return pa.table({n: made[n] for n in schema.names}, schema=schema)

    return rows.groupBy("bucket").cogroup(anchors.groupBy("bucket")).applyInArrow(gather, CONTEXTS)


def _names(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Ranks, from 1, of keys sorted by ``order``; equal keys have equal ranks."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(_starts(*(k[order] for k in keys)))
    return out


def string_classes(blob: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Context and class of each string of ``length`` bytes in contexts of ``size`` bytes.

    A suffix array by difference cover modulo 3, as deep as strings go: classes are numbers of
    groups of adjacent suffixes whose prefixes of that length are equal.
    """
    begin = np.cumsum(size) - size
    padded = np.concatenate([blob, np.zeros(length + 32, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(blob) + length + 24, np.uint64)  # eight bytes as one character
    for j in range(8):
        words |= padded[j : j + len(words)] << np.uint64(56 - 8 * j)

    def places(reach: int, *residues: int) -> np.ndarray:
        """Positions from which ``reach`` bytes lie in the context, by place in it modulo 3."""
        free = np.maximum(size - reach + 1, 0)
        inside = ranges(np.zeros(len(size), np.int64), free)
        return (np.repeat(begin, free) + inside)[np.isin(inside % 3, residues)]

    # sort the sampled triples of characters and name them
    block = 24
    sample = places(block, 1, 2)
    triple = [words[sample], words[sample + 8], words[sample + 16]]
    name = np.zeros(len(blob) + length + 24, np.int64)
    name[sample] = _names(np.lexsort(triple[::-1]), *triple)
    # recurse on the names: they sort what strings of up to `length` bytes consist of
    blocks = (length - 2) // block
    rest = length - blocks * block
    deep = places(length - 2, 1, 2)
    keys = [name[deep + i * block] for i in range(blocks)]

    def tail(count: int) -> list[np.ndarray]:
        """The first ``count`` bytes after the named blocks."""
        out = []
        for j in range(0, count, 8):
            cut = np.uint64(8 * max(0, 8 - (count - j)))
            out.append(words[deep + blocks * block + j] >> cut)
        return out

    order = np.lexsort([*tail(rest)[::-1], *keys[::-1]])
    ranks = {}
    for less in (0, 1, 2):
        ranks[less] = np.zeros(len(name), np.int64)
        ranks[less][deep] = _names(order, *keys, *tail(rest - less))
    # merge the remaining suffixes: first byte (or two) and the rank of the sampled suffix after it
    one, two = places(length, 1), places(length, 2)
    zero = places(length, 0)
    first = blob.astype(np.int64)
    by_one = lambda p: (first[p] << 40) | ranks[1][p + 1]
    by_two = lambda p: (first[p] << 48) | (first[p + 1] << 40) | ranks[2][p + 2]
    classes = np.empty(len(zero), np.int64)
    # adjacent suffixes of the merged order with equal prefixes are one class
    own = by_one(zero)
    _, fresh = np.unique(own, return_inverse=True)
    classes[:] = len(name) + 1 + fresh
    for other, key in ((one, by_one), (two, by_two)):
        asked = key(zero)
        held = key(other)
        line = np.argsort(held, kind="stable")
        held, group = held[line], ranks[0][other[line]]
        if len(held):
            at = np.minimum(np.searchsorted(held, asked), len(held) - 1)
            classes = np.where(held[at] == asked, group[at], classes)
    place = np.concatenate([one, two, zero])
    classes = np.concatenate([ranks[0][one], ranks[0][two], classes])
    order = np.argsort(place, kind="stable")
    place = place[order]
    return np.searchsorted(begin, place, "right") - 1, classes[order]


def first_documents(blob: np.ndarray, size: np.ndarray, low: np.ndarray, length: int) -> np.ndarray:
    """For each string, the smallest id of a context that has it."""
    owner, classes = string_classes(blob, size, length)
    _, group = np.unique(classes, return_inverse=True)
    least = np.full(group.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, low[owner])
    return least[group]


VERDICTS = "bucket int, digest binary, anchor binary, n_runs binary, run binary, first binary"


def digests(blob: np.ndarray, at: np.ndarray, strings: np.ndarray, length: int) -> np.ndarray:
    """Digests of contexts, equal to those that ``Contexts`` gives them in their documents."""
    out = np.empty(len(at), np.uint64)
    for start, stop in pieces(np.concatenate([at, [len(blob)]]), PIECE):
        first = at[start]
        begin = at[start:stop] - first
        end = begin + strings[start:stop] + (length - 1)
        whole = prefix_hash(blob[first : first + end[-1]])
        _, down = powers(len(whole))
        out[start:stop] = (whole[end] - whole[begin]) * down[begin]
    return mix(out ^ strings.astype(np.uint64))


def judge_contexts(sent: DataFrame, length: int) -> DataFrame:
    """To each bucket: for its contexts, runs of strings and the first document that has them."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"strings": "<u4", "low": "<i8", "spread": "<i8", "bytes": "u1"}
        held = {n: [] for n in types}
        anchors, buckets, shard = [], [], 0
        for batch in batches:
            for n in types:
                held[n] += [np.frombuffer(x, types[n]) for x in batch.column(n).to_pylist()]
            anchors += [unpack40(x) for x in batch.column("anchor").to_pylist()]
            buckets += batch.column("bucket").to_pylist()
            shard = batch.column("shard")[0].as_py()
        bucket = np.repeat(buckets, [len(x) for x in anchors])
        anchor = np.concatenate(anchors) | (np.uint64(shard // SPLIT) << np.uint64(40))
        strings, low, spread, blob = (np.concatenate(held.pop(n)) for n in types)
        high = low + spread
        strings = strings.astype(np.int64)
        size = strings + length - 1
        at = np.cumsum(size) - size
        digest = digests(blob, at, strings, length)
        order = np.lexsort((low, digest, anchor))
        fresh = _starts(anchor[order], digest[order])
        kind = np.empty(len(order), np.int64)  # distinct context of each row
        kind[order] = np.cumsum(fresh) - 1
        chosen = order[fresh]  # with the smallest id
        names = anchor[chosen]
        runs_of, firsts_of, counts, start = [], [], [], 0
        while start < len(chosen):
            stop = min(len(chosen), start + SORTED_AT_ONCE)
            stop = int(np.searchsorted(names, names[stop - 1], "right"))
            some = chosen[start:stop]
            part = blob[ranges(at[some], size[some])]
            first = first_documents(part, size[some], low[some], length)
            # only runs of strings with one first document outlive a part
            owner = np.repeat(np.arange(len(some)), strings[some])
            edge = np.flatnonzero(_starts(owner, first))
            runs_of.append(np.diff(np.concatenate([edge, [len(first)]])).astype(np.uint32))
            firsts_of.append(first[edge])
            counts.append(np.bincount(owner[edge], minlength=len(some)))
            start = stop
        run, run_first = np.concatenate(runs_of), np.concatenate(firsts_of)
        del blob, runs_of, firsts_of, first, owner, edge
        from_run = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        least = np.minimum.reduceat(run_first, from_run[:-1])
        useful = np.flatnonzero(least[kind] < high)  # others lose nothing
        useful = useful[np.lexsort((digest[useful], bucket[useful]))]
        which = kind[useful]
        count = from_run[which + 1] - from_run[which]
        pick = ranges(from_run[which], count)
        before = np.concatenate([[0], np.cumsum(count)])
        made = _row_batch(
            bucket[useful], "bucket",
            {"digest": digest[useful].astype("<u8"), "anchor": anchor[useful].astype("<u8"), "n_runs": count.astype("<u4")},
            {"run": lambda a, b: run[pick[before[a] : before[b]]].astype("<u4").tobytes(),
             "first": lambda a, b: run_first[pick[before[a] : before[b]]].astype("<i8").tobytes()})
        del held, run, run_first, pick
        release()
        yield pa.RecordBatch.from_pydict(made)

    return sent.groupBy("shard").applyInArrow(judge, VERDICTS)


CUT = "kept binary, removed array<struct<start:bigint,stop:bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def cut_documents(rows: DataFrame, verdicts: DataFrame, length: int, shards: int) -> DataFrame:
    """``rest`` (all columns but the text), the kept bytes and the removed spans."""

    def cut(docs: pa.Table, told: pa.Table) -> pa.Table:
        data, bounds = flat(docs["text"])
        gone = np.zeros(len(data), bool)
        if len(told) and len(docs):
            load = lambda n, t: np.concatenate([np.frombuffer(x, t) for x in told[n].to_pylist()])
            digest, anchor, count = load("digest", "<u8"), load("anchor", "<u8"), load("n_runs", "<u4").astype(np.int64)
            run, first = load("run", "<u4").astype(np.int64), load("first", "<i8")
            from_run = np.cumsum(count) - count
            order = np.argsort(digest, kind="stable")
            digest, anchor, count, from_run = digest[order], anchor[order], count[order], from_run[order]
            offset = np.cumsum(run) - run  # within a context after taking off its first
            known = docs["id"].is_valid().to_numpy()
            ids = docs["id"].fill_null(0).to_numpy()
            for part, low, row in contexts(data, bounds, length):
                at = np.minimum(np.searchsorted(digest, part.digest), len(digest) - 1)
                hit = np.flatnonzero(
                    (digest[at] == part.digest) & (anchor[at] == named(part.anchor, shards)) & known[row])
                at = at[hit]
                pick = ranges(from_run[at], count[at])
                whose = np.repeat(np.arange(len(hit)), count[at])
                use = first[pick] < ids[row[hit]][whose]
                pick, whose = pick[use], whose[use]
                begin = part.start[hit][whose] + offset[pick] - offset[from_run[at]][whose]
                edge = np.zeros(len(part.raw) + 1, np.int32)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + run[pick] + length - 1, -1)
                gone[low : low + len(part.raw)] |= np.cumsum(edge[:-1]) > 0
        kept, removed = [], []
        for a, b in zip(bounds, bounds[1:], strict=False):
            out = gone[a:b]
            if not out.any():
                kept.append(data[a:b].tobytes())
                removed.append([])
                continue
            kept.append(data[a:b][~out].tobytes())
            removed.append([{"start": int(s), "stop": int(e)} for s, e in zip(*runs(out), strict=True)])
        del data, gone
        release()
        return pa.table({"rest": docs["rest"], "kept": pa.array(kept, pa.binary()), "removed": pa.array(removed, _SPANS)})

    shape = f"rest {rows.schema['rest'].dataType.simpleString()}, {CUT}"
    return rows.groupBy("bucket").cogroup(verdicts.groupBy("bucket")).applyInArrow(cut, shape)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """All columns but the text, with the ``kept`` bytes and the ``removed`` spans (byte offsets).

    Columns named ``kept`` or ``removed`` are replaced.
    """
    if length < GRAM + 2:
        raise ValueError(f"length must be at least {GRAM + 2}")
    spark = df.sparkSession
    text_batches(spark)
    total = df.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // SHARD_BYTES + 1)
    identity = F.col(f"`{key}`").cast("bigint")
    bucket = F.pmod(F.xxhash64(F.coalesce(identity, F.xxhash64(F.col(f"`{text}`")))), F.lit(shards)).cast("int")
    others = [c for c in df.columns if c not in (text, "kept", "removed")]
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    whole = df.select(bucket.alias("bucket"), identity.alias("id"), F.col(f"`{text}`").alias("text"), rest.alias("rest"))
    rows = whole.drop("rest")
    anchors = stage(repeated_anchors(rows, length, shards), "anchors")
    sent = send_contexts(rows, anchors, length, shards)
    verdicts = stage(judge_contexts(sent, length), "verdicts")
    cut = cut_documents(whole, verdicts, length, shards)
    return cut.select(*[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(others)], "kept", "removed")


def op1_suffix_dedup(spark, sf_dir):
    """What every document loses to earlier ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = remove_repeats(docs)
    lost = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return cut.select(
        "doc_id", (F.octet_length("kept") + lost).cast("bigint").alias("n_bytes"), lost.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Every string of 50 bytes by itself, the runs of those that an earlier document has, and what lies between.
OP1_SQL = """
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
strings AS (SELECT doc_id, p, b[p:p + 49] AS s
  FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 48)) AS p FROM docs WHERE octet_length(b) >= 50)),
firsts AS (SELECT s, min(doc_id) AS first_id FROM strings GROUP BY s),
hits AS (SELECT doc_id, p FROM strings JOIN firsts USING (s) WHERE first_id < doc_id),
marked AS (SELECT doc_id, p, cast(p > lag(p, 1, -100) OVER w + 50 AS integer) AS opens FROM hits
  WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
numbered AS (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked),
spans AS (SELECT doc_id, min(p) AS first_byte, max(p) + 49 AS last_byte FROM numbered GROUP BY doc_id, span),
edges AS (SELECT doc_id, first_byte, last_byte FROM spans UNION ALL SELECT doc_id, octet_length(b) + 1, octet_length(b) + 1 FROM docs),
gaps AS (SELECT doc_id, lag(last_byte, 1, 0) OVER (PARTITION BY doc_id ORDER BY first_byte) + 1 AS a, first_byte - 1 AS z FROM edges),
kept AS (SELECT doc_id, unhex(coalesce(string_agg(CASE WHEN a <= z THEN hex(b[a:z]) ELSE '' END, '' ORDER BY a), '')) AS k
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id),
lost AS (SELECT doc_id, sum(last_byte - first_byte + 1) AS n, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, cast(octet_length(b) AS bigint) AS n_bytes, cast(coalesce(n, 0) AS bigint) AS n_removed,
  cast(coalesce(spans, 0) AS bigint) AS n_spans, sha256(k) AS kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""
