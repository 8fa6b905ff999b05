"""Near-duplicate vectors by a robust-pruned flat graph and range-expanding greedy search.

Equal vectors of a label are one class. Centres fitted on a bounded sample cut the classes into
shards by label; each class goes to its ``overlap`` nearest centres. Every shard builds a graph:
robust pruning keeps an edge only if no kept neighbour is much nearer to its end, and a few random
edges keep it in one piece. The adjacency lists of a class from all its shards are united. Then each
class is searched for from the medoid of each of its shards: greedily with a beam until it cannot
come nearer, and on from every class within the range, widened by a margin, until none is left.
What the search finds is verified in double precision; only true links remain.

Recall is audited against brute force for a bounded number of queries (ids divisible by 50) against
all classes; below ``RECALL`` the search repeats with twice the overlap.

A shard above ``LIMIT`` classes is cut into blocks and every two blocks meet in a task, so tasks stay
bounded and nothing is capped. Vectors that are null, zero, or hold null or non-finite components,
rows with a null label or id, link with nothing; vectors of different lengths never meet. Rows
with an id that occurs twice count as two vectors. Extra columns are not read.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import hashed_rank, mix, table
from zonalis.llm.components import components
from zonalis.session import stage

THRESHOLD = 0.98
MARGIN = 0.03
SAMPLE = 20_000
SHARD, MOST_CENTRES = 500, 1024
OVERLAP = 3
LIMIT = 3000
DEGREE, POOL, ALPHA, RANDOM_EDGES = 20, 40, 1.2, 2
BEAM = 12
AUDITED, RECALL = 1000, 0.98
QUERY_STEP = 50


def valid_vectors(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``id``, ``label`` and the packed double vector, null where it links with nothing."""

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for v in batch:
                raw = v.as_py()
                x = np.array([np.nan if c is None else c for c in raw], "<f8") if raw else None
                with np.errstate(over="ignore", invalid="ignore"):
                    good = x is not None and np.isfinite(x).all() and x.any()
                out.append(x.tobytes() if good else None)
            yield pa.array(out, pa.binary())

    rows = df.select(
        F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
        packed(F.col(f"`{vector}`")).alias("vector"))
    linkable = F.col("id").isNotNull() & F.col("label").isNotNull()
    return rows.withColumn("vector", F.when(linkable, F.col("vector"))).withColumn(
        "digest", F.sha2("vector", 256))


def unit(rows: list[bytes]) -> np.ndarray:
    """Rows of length one; scaled first so that squares neither overflow nor vanish."""
    x = np.stack([np.frombuffer(r, "<f8") for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centres(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Centres by vector length, by Lloyd's steps on a bounded sample."""
    sample = classes.orderBy(hashed_rank("rep"), "rep").limit(SAMPLE).select("vector").collect()
    by_length: dict[int, list[bytes]] = {}
    for r in sample:
        by_length.setdefault(len(r["vector"]), []).append(bytes(r["vector"]))
    out = {}
    for size, rows in by_length.items():
        x = unit(rows)
        k = min(MOST_CENTRES, len(x), max(1, -(-n * len(rows) // (len(sample) * SHARD))))
        centre = x[np.linspace(0, len(x) - 1, k).astype(int)]
        for _ in range(6):
            best = (x @ centre.T).argmax(axis=1)
            total = np.zeros_like(centre)
            np.add.at(total, best, x)
            norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
            centre = np.where(norm > 0, total / np.where(norm > 0, norm, 1), centre)
        out[size] = centre
    return out


def place(classes: DataFrame, centres: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """A row per class and shard it goes to; shards are label, length, centre and pair of blocks."""
    sent = classes.sparkSession.sparkContext.broadcast(centres)  # at most MOST_CENTRES by length

    @F.arrow_udf("array<int>")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            raw = [bytes(v.as_py()) for v in batch]
            out: list = [[0]] * len(raw)
            for size in {len(r) for r in raw}:
                at = [i for i, r in enumerate(raw) if len(r) == size]
                centre = sent.value.get(size)
                if centre is None:  # a length that the sample lacks: one shard
                    continue
                near = np.argsort(-(unit([raw[i] for i in at]) @ centre.T), axis=1, kind="stable")[:, :overlap]
                for i, c in zip(at, near.tolist(), strict=True):
                    out[i] = c
            yield pa.array(out, pa.list_(pa.int32()))

    key = ["label", "length", "centre"]
    spread = classes.withColumn("length", F.octet_length("vector")).withColumn("centre", F.explode(nearest("vector")))
    sizes = spread.groupBy(*key).agg(F.ceil(F.count("*") / LIMIT).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(F.lit(3), F.col("rep")), F.col("blocks")).cast("int")
    return (
        spread.join(sizes, key).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("shard", F.sha1(F.concat_ws("/", *key, F.least("own", "other"), F.greatest("own", "other"))))
        .select("shard", "rep", "vector")
    )


def robust_prune(near: np.ndarray, x: np.ndarray, node: int) -> list[int]:
    """Neighbours of a node among candidates sorted by nearness."""
    distance = np.maximum(2 - 2 * (x[near] @ x[node]), 0)
    apart = np.maximum(2 - 2 * (x[near] @ x[near].T), 0)
    alive = np.ones(len(near), bool)
    kept = []
    for i in range(len(near)):
        if alive[i]:
            kept.append(int(near[i]))
            if len(kept) == DEGREE:
                break
            alive &= ALPHA * apart[i] > distance
    return kept


def build_graph(x: np.ndarray, seeds: np.ndarray) -> list[set[int]]:
    """Undirected adjacency of a shard; random edges depend on the ids only."""
    n = len(x)
    graph: list[set[int]] = [set() for _ in range(n)]
    if n < 2:
        return graph
    pool = min(POOL, n - 1)
    for start in range(0, n, 512):
        scores = x[start : start + 512] @ x.T
        scores[np.arange(len(scores)), np.arange(start, start + len(scores))] = -2
        near = np.argpartition(-scores, pool - 1, axis=1)[:, :pool]
        order = np.argsort(-np.take_along_axis(scores, near, axis=1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, axis=1)
        for i, row in enumerate(near, start):
            for j in robust_prune(row, x, i):
                graph[i].add(j)
                graph[j].add(i)
    for r in range(RANDOM_EDGES):
        for i, j in enumerate((mix(seeds.view(np.uint64) + np.uint64(r)) % np.uint64(n)).astype(int)):
            if i != j:
                graph[i].add(int(j))
                graph[int(j)].add(i)
    return graph


def range_search(x: np.ndarray, graph: list[np.ndarray], query: np.ndarray, start: int, least: float) -> list[int]:
    """Nodes visited by a beam from ``start`` that widens to all nodes nearer than ``least``."""
    seen = {start}
    first = float(x[start] @ query)
    front = [(-first, start)]
    best = [first]  # the beam's scores, worst first
    inside = [start] if first >= least else []
    while front:
        score, node = heapq.heappop(front)
        if -score < least and len(best) == BEAM and -score < best[0]:
            break
        fresh = [j for j in graph[node] if j not in seen]
        if not fresh:
            continue
        seen.update(fresh)
        for j, s in zip(fresh, (x[fresh] @ query).tolist(), strict=True):
            if s >= least:
                inside.append(j)
            if s >= least or len(best) < BEAM or s > best[0]:
                heapq.heappush(front, (-s, j))
                if len(best) < BEAM:
                    heapq.heappush(best, s)
                else:
                    heapq.heappushpop(best, s)
    return inside


def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Table]]:
    held = pa.Table.from_batches(batches).sort_by([("shard", "ascending"), ("rep", "ascending")])
    names = held["shard"].to_pylist()
    start = 0
    while start < len(names):
        stop = start + 1
        while stop < len(names) and names[stop] == names[start]:
            stop += 1
        yield names[start], held.slice(start, stop - start)
        start = stop


def united_graph(placed: DataFrame) -> DataFrame:
    """Adjacency of each class over all its shards: ``rep`` and ``near``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in shards_of(batches):
            reps = rows["rep"].to_numpy()
            graph = build_graph(unit(rows["vector"].to_pylist()), reps)
            near = [reps[sorted(g)].astype("<i8").tobytes() for g in graph]
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(near, pa.binary())], ["rep", "near"])

    tasks = 4 * int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sharded = placed.withColumn("task", F.pmod(F.xxhash64("shard"), F.lit(tasks)))
    built = sharded.groupBy("task").applyInArrow(build, "rep bigint, near binary")
    return built.groupBy("rep").agg(F.collect_list("near").alias("near"))  # one list per shard of the class


def search_links(placed: DataFrame, graph: DataFrame, threshold: float) -> DataFrame:
    """Verified links (a, b) of classes, both ways."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in shards_of(batches):
            reps = rows["rep"].to_numpy()
            x = unit(rows["vector"].to_pylist())
            graph = []
            for lists in rows["near"].to_pylist():
                ids = np.unique(np.concatenate([np.frombuffer(n, "<i8") for n in lists])) if lists else np.empty(0, np.int64)
                at = np.minimum(np.searchsorted(reps, ids), len(reps) - 1)
                graph.append(at[reps[at] == ids].tolist())  # those that lie in this shard
            medoid = int((x @ x.mean(axis=0)).argmax())
            a, b = [], []
            for i in range(len(reps)):
                found = np.array([j for j in range_search(x, graph, x[i], medoid, threshold - MARGIN) if j != i], np.int64)
                true = found[(x[found] * x[i]).sum(axis=1) >= threshold] if len(found) else found
                a += [int(reps[i])] * len(true)
                b += reps[true].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    tasks = 4 * int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = placed.join(graph, "rep").withColumn("task", F.pmod(F.xxhash64("shard"), F.lit(tasks)))
    found = rows.select("task", "shard", "rep", "vector", "near").groupBy("task").applyInArrow(search, "a bigint, b bigint")
    return found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def audited_recall(classes: DataFrame, links: DataFrame, threshold: float) -> float:
    """Share of the true links of a bounded set of queries that were found."""
    asked = classes.where(F.pmod("rep", F.lit(QUERY_STEP)) == 0).orderBy(hashed_rank("rep"), "rep").limit(AUDITED)
    queries = [(r["rep"], r["label"], bytes(r["vector"])) for r in asked.select("rep", "label", "vector").collect()]
    if not queries:
        return 1.0
    spark = classes.sparkSession
    sent = spark.sparkContext.broadcast(queries)  # at most AUDITED vectors

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, list[int]] = {}
        for i, (_, label, raw) in enumerate(sent.value):
            groups.setdefault((label, len(raw)), []).append(i)
        stacks = {k: unit([sent.value[i][2] for i in v]) for k, v in groups.items()}
        for batch in batches:
            a, b = [], []
            rows: dict[tuple, list[int]] = {}
            raw = batch.column("vector").to_pylist()
            reps = batch.column("rep").to_pylist()
            for i, (label, r) in enumerate(zip(batch.column("label").to_pylist(), raw, strict=True)):
                rows.setdefault((label, len(r)), []).append(i)
            for k in rows.keys() & stacks.keys():
                hit = np.argwhere(stacks[k] @ unit([raw[i] for i in rows[k]]).T >= threshold)
                for q, c in hit.tolist():
                    pair = (sent.value[groups[k][q]][0], reps[rows[k][c]])
                    if pair[0] != pair[1]:
                        a.append(pair[0])
                        b.append(pair[1])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    true = classes.select("rep", "label", "vector").mapInArrow(compare, "a bigint, b bigint")
    found = true.join(links.withColumn("found", F.lit(1)), ["a", "b"], "left")
    row = found.agg(F.count("*").alias("n"), F.count("found").alias("found")).first()
    return row["found"] / row["n"] if row["n"] else 1.0


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, overlap: int = OVERLAP) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    members = stage(valid_vectors(df, key, vector, label), "vectors")
    classes = stage(
        members.where("vector IS NOT NULL").groupBy("label", "digest").agg(
            F.min("id").alias("rep"), F.count("*").alias("size"), F.first("vector").alias("vector")), "classes")
    # an id that stands for several classes: one node, so the classes get numbers of their own
    n = classes.count()
    numbered = stage(classes.withColumn("number", F.monotonically_increasing_id()), "numbered")
    nodes = numbered.select(F.col("number").alias("rep"), "label", "vector")
    centres = fit_centres(nodes, n)
    while True:
        placed = stage(place(nodes, centres, overlap), "placed")
        links = stage(search_links(placed, united_graph(placed), threshold), "links")
        widest = max((len(c) for c in centres.values()), default=1)
        if overlap >= widest or audited_recall(nodes, links, threshold) >= RECALL:
            break
        overlap *= 2
    sized = numbered.select("number", F.col("rep").alias("id"), "size")
    direct = links.join(sized, links["b"] == sized["number"]).groupBy("a").agg(F.sum("size").alias("linked"))
    ends = links.where("a < b").join(sized.select(F.col("number").alias("a"), F.col("id").alias("u")), "a").join(
        sized.select(F.col("number").alias("b"), F.col("id").alias("v")), "b")
    twins = members.where("vector IS NOT NULL").join(
        classes.select("label", "digest", "rep"), ["label", "digest"]).where("id != rep").select(
        F.col("id").alias("u"), F.col("rep").alias("v"))
    reached = components(ends.select("u", "v").unionByName(twins), "u", "v")
    told = numbered.join(direct, numbered["number"] == direct["a"], "left").select(
        "label", "digest", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    joined = members.select("id", "label", "digest").join(stage(told, "told"), ["label", "digest"], "left").join(
        stage(reached, "reached"), "id", "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op7_vectors(spark, sf_dir):
    """Links and components of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: All pairs of a label, and what each vector reaches.
OP7_SQL = """
WITH RECURSIVE vectors AS (SELECT vec_id, label, cast(embedding AS double[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
  AND len([x FOR x IN embedding IF x <> 0]) > 0),
edges AS (SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.98),
reach AS (SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.other),
links AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT e.vec_id, cast(coalesce(n, 0) AS bigint) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN links ON a = e.vec_id
JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) c ON c.id = e.vec_id"""
