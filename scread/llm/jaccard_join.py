"""N-gram Jaccard join with a count-vector R-tree.

A set's shingles are hashed into groups; the counts of the groups are a point. The overlap of two sets is at
most the sum of the smaller coordinates, and for a box of points at most the sum of minima with its upper
corner, so an R-tree skips boxes that cannot hold a partner. Equal sets are one point. Points meet only
under a shared token of their prefixes (rarest tokens first), without which the wanted overlap is impossible,
and tokens that the same sets share are one bucket; what survives the bound forms clusters, and inside a
cluster surviving pairs are verified on the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, discard, grams, mix64, stage, unzipped, words, zipped
from .components import connected
from .passages import groups

NGRAM = 3
GROUPS = 256
THRESHOLD = 9, 10  # numerator and denominator
SAMPLE_DOCS = 20_000
FREQUENT = 200_000
BUCKET_SETS = 3_000
CLUSTER_DOCS = 4_000
CLUSTER_SHINGLES = 2_000_000
QUERY_BLOCK, PAIR_BLOCK = 128, 1 << 13
BROADCAST_ROWS = 200_000
NO_ID = (1 << 63) - 1
_TOP = np.uint64(1 << 63)


def token_sets(texts: pa.Array, frequent: np.ndarray, ngram: int = NGRAM) -> Iterator[np.ndarray]:
    """The distinct tokens of each text, sorted: tokens not in ``frequent`` by hash, then those by their rank there."""
    for first, last, data, offsets in blocks(texts):
        _, _, hashes, at = words(data, offsets, lower=True)
        shingles = grams(hashes, ngram) | np.uint64(1)
        shingles = (shingles >> np.uint64(1)).astype(np.uint64)
        if len(frequent) and len(shingles):
            place = np.searchsorted(frequent["token"], shingles).clip(max=len(frequent) - 1)
            known = frequent["token"][place] == shingles
            shingles = np.where(known, _TOP | frequent["rank"][place], shingles)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= ngram:
                yield np.unique(shingles[a : b - ngram + 1])
            elif b > a:
                yield (grams(hashes[a:b], b - a) ^ np.uint64(b - a)) >> np.uint64(1)
            else:
                yield np.zeros(0, np.uint64)


def prefix_length(n: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    """Two sets that link share a token among this many first ones of each."""
    return n - -(-threshold[0] * n // threshold[1]) + 1 if n else 0


def group_counts(tokens: np.ndarray) -> np.ndarray:
    return np.bincount((mix64(tokens) & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)


def packed_counts(counts: np.ndarray) -> bytes:
    """A power of two and each count in units of it, rounded up, one byte each."""
    shift = max(0, int(counts.max()).bit_length() - 8)
    units = -(-counts // (1 << shift))
    if units.max() > 255:
        shift += 1
        units = -(-counts // (1 << shift))
    return bytes([shift]) + units.astype(np.uint8).tobytes()


def unpacked_counts(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, GROUPS + 1)
    return raw[:, 1:].astype(np.int32) << raw[:, :1].astype(np.int32)


def may_link(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: tuple[int, int] = THRESHOLD) -> np.ndarray:
    """Whether sets of sizes a and b with this overlap, or at most this, reach the threshold."""
    return sum(threshold) * overlap >= threshold[0] * (a + b)


class RTree:
    """Points packed by size into boxes of boxes; a search skips a box that no partner can be in.

    ``group`` divides the points: only points of a query's own group are found.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fan: int = 16, threshold: tuple[int, int] = THRESHOLD, group: np.ndarray | None = None):
        group = np.zeros(len(points), np.int64) if group is None else group
        # tiles: by group and set size, then by the coordinate with the largest spread
        spread = int(np.argmax(points.max(0) - points.min(0))) if len(points) else 0
        slab = max(1, int(np.ceil(np.sqrt(len(points) / fan)))) * fan
        tile = np.empty(len(points), np.int64)
        tile[np.lexsort((sizes, group))] = np.arange(len(points)) // slab
        self.order = np.lexsort((points[:, spread], tile, group))
        self.levels = [tuple(x[self.order] for x in (points, sizes, sizes, group, group))]
        while len(self.levels[-1][0]) > 1:
            high, least, most, first, last = self.levels[-1]
            edges = np.arange(0, len(high), fan)
            joined = ((np.maximum, high), (np.minimum, least), (np.maximum, most), (np.minimum, first), (np.maximum, last))
            self.levels.append(tuple(f.reduceat(x, edges) for f, x in joined))
        self.fan, self.threshold = fan, threshold

    def search_many(self, points: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) numbers of all pairs that may link."""
        numerator, denominator = self.threshold
        q = np.repeat(np.arange(len(points)), len(self.levels[-1][0]))
        at = np.tile(np.arange(len(self.levels[-1][0])), len(points))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most, first, last = self.levels[depth]
            n, g = sizes[q], group[q]
            near = np.flatnonzero((first[at] <= g) & (g <= last[at]) & (denominator * most[at] >= numerator * n) & (denominator * n >= numerator * least[at]))
            q, at, ok = q[near], at[near], np.zeros(len(near), bool)
            for i in range(0, len(near), PAIR_BLOCK):
                part = slice(i, i + PAIR_BLOCK)
                # the smallest partner in the box needs the least overlap
                ok[part] = may_link(np.minimum(high[at[part]], points[q[part]]).sum(1), least[at[part]], sizes[q[part]], self.threshold)
            q, at = q[ok], at[ok]
            if depth:
                q, at = np.repeat(q, self.fan), (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                inside = at < len(self.levels[depth - 1][0])
                q, at = q[inside], at[inside]
        return q, self.order[at]

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the points that may link with this one."""
        return self.search_many(point[None], np.array([size]), np.zeros(1, np.int64))[1]


def _sketch(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, ngram: int, threshold: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, keys, prefix, vec = [], [], [], []
        for s in token_sets(batch.column(1), frequent, ngram):
            n.append(len(s))
            m = mix64(s)
            keys.append((m.sum(), np.bitwise_xor.reduce(m)))
            prefix.append(s[: prefix_length(len(s), threshold)].view(np.int64))
            vec.append(packed_counts(group_counts(s)))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(p) for p in prefix])].astype(np.int32)), pa.array(np.concatenate(prefix) if prefix else np.zeros(0, np.int64)))
        k = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64)
        columns = [batch.column(0), batch.column(2), pa.array(n, pa.int32()), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), lists, pa.array(vec, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["did", "rk", "n", "k1", "k2", "prefix", "vec"])


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the smallest number of each component so far) after the pairs (a, b) are linked."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    return label


def _bucket_edges(batches: Iterator[pa.RecordBatch], threshold: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Of each bucket the components of the pairs that survive the bound, as edges to their first nodes."""
    for table in groups(batches, 6_000):
        key, node, n = (table.column(i).to_numpy() for i in range(3))
        n, number = n.astype(np.int64), np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1
        points = unpacked_counts(table.column(3).combine_chunks())
        tree, label = RTree(points, n, threshold=threshold, group=number), np.arange(len(n))
        for at in range(0, len(n), QUERY_BLOCK):
            part = slice(at, at + QUERY_BLOCK)
            q, r = tree.search_many(points[part], n[part], number[part])
            label = joined(label, at + q, r)
        other = np.flatnonzero(label != np.arange(len(n)))
        if len(other):
            yield pa.RecordBatch.from_arrays([pa.array(node[label[other]]), pa.array(node[other])], names=["a", "b"])


def spanning(points: np.ndarray, sizes: np.ndarray, near, verify, threshold: tuple[int, int] = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs in ``near(u)`` that survive the bound and ``verify(u, candidates)``."""
    waiting = np.ones(len(points), bool)
    a: list[int] = []
    b: list[int] = []
    for root in range(len(points)):
        if not waiting[root]:
            continue
        waiting[root] = False
        queue = [root]
        while queue and waiting.any():
            u = queue.pop()
            found = near(u)
            found = found[waiting[found]]
            found = found[may_link(np.minimum(sizes[found], sizes[u]), sizes[found], sizes[u], threshold)]
            found = found[may_link(np.minimum(points[found], points[u]).sum(1), sizes[found], sizes[u], threshold)]
            found = found[verify(u, found)] if len(found) else found
            waiting[found] = False
            a += [u] * len(found)
            b += found.tolist()
            queue += found.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _verified_edges(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, ngram: int, threshold: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Links of each cluster (or pair of its chunks): a spanning forest of the verified pairs.

    The tree's bound says little about long texts, so only sets that share a token of their prefixes are compared.
    """
    for table in groups(batches, 1):
        key = table.column(0).to_numpy()
        edges = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            node = table.column(1).to_numpy()[lo:hi]
            sets = list(token_sets(unzipped(table.column(2).combine_chunks().slice(lo, hi - lo)), frequent, ngram))
            sizes = np.array([len(s) for s in sets])
            points = np.stack([group_counts(s) for s in sets]).astype(np.int32)
            # tokens as numbers of this cluster, so that a set is a mark in an array
            flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
            begin = np.r_[0, np.cumsum(sizes)]
            lengths = np.array([prefix_length(n, threshold) for n in sizes.tolist()])
            prefix = np.concatenate([flat[i : i + n] for i, n in zip(begin.tolist(), lengths.tolist())])
            holders = np.repeat(np.arange(len(sets)), lengths)[np.argsort(prefix, kind="stable")]
            held = np.r_[0, np.cumsum(np.bincount(prefix, minlength=int(flat.max()) + 1))]
            marked = np.zeros(int(flat.max()) + 1, np.uint8)

            def near(u: int) -> np.ndarray:
                mine = flat[begin[u] : begin[u] + lengths[u]]
                shared = np.zeros(len(sets), bool)
                count = held[mine + 1] - held[mine]
                shared[holders[np.arange(count.sum()) + np.repeat(held[mine] - np.cumsum(count) + count, count)]] = True
                return np.flatnonzero(shared)

            def verify(u: int, vs: np.ndarray) -> np.ndarray:
                mine = flat[begin[u] : begin[u + 1]]
                marked[mine] = 1
                hits = marked[np.concatenate([flat[begin[v] : begin[v + 1]] for v in vs])]
                marked[mine] = 0
                ends = np.cumsum(sizes[vs])
                overlap = np.add.reduceat(hits, ends - sizes[vs], dtype=np.int64)
                return may_link(overlap, sizes[vs], sizes[u], threshold)

            a, b = spanning(points, sizes, near, verify, threshold)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])


def _frequent(docs_x: DataFrame, sample_docs: int, ngram: int) -> np.ndarray:
    """Tokens met three times or more in a bounded sample of documents, by rising count; at most ``FREQUENT``."""
    total = docs_x.count()
    sample = docs_x.filter(F.pmod(F.xxhash64("rk", F.lit(1)), F.lit(1 << 30)) < int(min(1.0, sample_docs / max(total, 1)) * (1 << 30)))
    none = np.zeros(0, dtype=[("token", np.uint64), ("rank", np.uint64)])

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in token_sets(batch.column(0), none, ngram):
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["t"])

    counted = sample.select("text").mapInArrow(tokens, "t long").groupBy("t").count().filter("count >= 3")
    rows = counted.orderBy(F.desc("count"), "t").limit(FREQUENT).toPandas()
    rows["rank"] = rows.sort_values(["count", "t"]).assign(r=np.arange(len(rows)))["r"]
    rows = rows.sort_values("t")
    out = np.zeros(len(rows), none.dtype)
    out["token"], out["rank"] = rows["t"].to_numpy(np.int64).view(np.uint64), rows["rank"].to_numpy(np.uint64)
    return np.sort(out, order="token")


def _row_keys(docs: DataFrame) -> tuple:
    """Expressions of a row's id (null after all others) and of the hash that tells apart rows of one id."""
    doc_id = F.col("doc_id").cast("long")
    return F.coalesce(doc_id, F.lit(NO_ID)), F.xxhash64(doc_id.isNull(), doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")))


def linked_rows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, cluster_docs: int = CLUSTER_DOCS, ngram: int = NGRAM, threshold: tuple[int, int] = THRESHOLD) -> tuple[DataFrame, list[DataFrame]]:
    """did, rk (the row's keys), n (its set's size) and first (did, rk of its component's first row) for every row of ``docs``; and the staged tables that hold it."""
    did, rk = _row_keys(docs)
    docs_x = docs.select(did.alias("did"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), rk.alias("rk"))
    frequent = _frequent(docs_x, sample_docs, ngram)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sketch(batches, frequent, ngram, threshold)

    def bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _bucket_edges(batches, threshold)

    def verified_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _verified_edges(batches, frequent, ngram, threshold)

    sets = stage(docs_x.mapInArrow(sketch, "did long, rk long, n int, k1 long, k2 long, prefix array<long>, vec binary"), "jaccard-sets")
    same = ["k1", "k2", "n"]
    classes = sets.filter("n > 0").groupBy(*same).agg(F.min(F.struct("did", "rk")).alias("first"), F.first("prefix").alias("prefix"), F.first("vec").alias("vec"))
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "jaccard-classes")

    # tokens that the same sets hold make one bucket: its key is a hash of its holders
    tokens = classes.select(F.explode("prefix").alias("token"), "node")
    holders = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"h{i}") for i in (1, 2)]
    held = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("held"), *holders).filter("held > 1")
    buckets = tokens.join(held, "token").select("h1", "h2", "held", "node").distinct()
    # a crowded bucket is searched in pairs of chunks
    chunks = F.ceil(F.col("held") / F.lit(BUCKET_SETS)).cast("int")
    buckets = _in_pairs(buckets.withColumn("chunks", chunks), ["h1", "h2"]).join(classes.select("node", "n", "vec"), "node").select("task", "node", "n", "vec")
    pairs = buckets.repartition("task").sortWithinPartitions("task", "n").mapInArrow(bucket_edges, "a long, b long")
    clusters = connected(pairs, "jaccard-clusters")

    # each different set of a cluster goes, as text, to the cluster's task; of a large cluster to pairs of its chunks
    members = clusters.join(classes.select("node", "first.did", "first.rk", "n"), "node")
    chunks = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(cluster_docs)), F.ceil(F.sum("n") / F.lit(CLUSTER_SHINGLES))).cast("int")
    members = members.join(members.groupBy("component").agg(chunks.alias("chunks")), "component")
    members = stage(_in_pairs(members, ["component"]).select("did", "rk", "node", "task"), "jaccard-members")
    discard(clusters)
    texts = docs_x.select("did", "rk", "text")
    if members.count() <= BROADCAST_ROWS:  # texts that no cluster holds then need no shuffle
        shipped = zipped(texts.join(F.broadcast(members), ["did", "rk"]).select("task", "node", "text"))
    else:
        shipped = members.join(zipped(texts), ["did", "rk"]).select("task", "node", "text")
    # rows that repeat bring a text more than once
    shipped = shipped.repartition("task").dropDuplicates(["task", "node"]).sortWithinPartitions("task", "node")
    links = connected(shipped.mapInArrow(verified_edges, "a long, b long"), "jaccard-links")
    discard(members)

    owner = classes.select("node", *same, "first").join(links, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = owner.select(*same, "component").join(owner.groupBy("component").agg(F.min("first").alias("first")), "component")
    out = sets.select("did", "rk", *same).join(named.select(*same, "first"), same, "left")
    return out.select("did", "rk", "n", F.coalesce("first", F.struct("did", "rk")).alias("first")), [sets, classes, links]


def _in_pairs(members: DataFrame, key: list[str]) -> DataFrame:
    """``members`` (node, chunks, the key) with ``task``: one a key of one chunk, else one for each pair of its chunks."""
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    other = F.when(F.col("chunks") > 1, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(F.lit(0)))
    members = members.withColumn("chunk", chunk).withColumn("other", F.explode(other))
    return members.withColumn("task", F.xxhash64(*key, F.least("chunk", "other"), F.greatest("chunk", "other")))


def link_components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text).

    Texts are sets of distinct shingles of ``ngram`` words (A-Z lower-cased; a shorter text is one shingle);
    sets with a Jaccard similarity of ``threshold`` (numerator, denominator) or more link. Null, empty and
    wordless texts have empty sets and link with nothing. A component's id is its smallest doc_id; a null id
    counts as larger than any other and gives null only if the component has no other. Rows that repeat are in
    one component if they have words. Extra columns are not read; an empty table gives no rows. No pair is
    dropped: buckets of more than ``BUCKET_SETS`` different sets, and clusters of more than ``cluster_docs`` or
    of ``CLUSTER_SHINGLES`` shingles, are searched in pairs of chunks.
    """
    out, _ = linked_rows(docs, **options)
    real = lambda c: F.when(c != NO_ID, c)
    return out.select(real(F.col("did")).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), real(F.col("first.did")).alias("component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with exactly one row of each component: that of the smallest id, then of the smallest text hash.

    A null id comes last. Rows without words link with nothing and all stay. Of rows with equal id and text
    the first by their other columns stays. All columns are kept and rows are told apart by id and text, so
    a text goes only if another of its component stays.
    """
    did, rk = _row_keys(docs)
    linked, held = linked_rows(docs, **options)
    rows = linked.filter("n > 0").groupBy("did", "rk", "first").agg(F.count(F.lit(1)).alias("rows"))
    verdict = rows.withColumn("goes", F.struct("did", "rk") != F.col("first")).filter("goes or rows > 1").select(F.col("did").alias("__did"), F.col("rk").alias("__rk"), "goes")
    verdict = stage(verdict.withColumnRenamed("goes", "__goes"), "jaccard-verdicts")
    for table in held:
        discard(table)
    if verdict.count() <= BROADCAST_ROWS:
        verdict = F.broadcast(verdict)
    judged = docs.join(verdict, (did == F.col("__did")) & (rk == F.col("__rk")), "left")
    order = Window.partitionBy("__did", "__rk").orderBy(*[docs[c] for c in docs.columns])
    twice = judged.filter("not __goes").withColumn("__nth", F.row_number().over(order)).filter("__nth = 1")
    return judged.filter("__goes is null").select(docs.columns).unionByName(twice.select(docs.columns))


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return link_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g FROM (
    SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM d)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') || '  ' FROM d WHERE len(ws) IN (1, 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS root FROM documents
  UNION SELECT l.b, r.root FROM r JOIN l ON r.doc_id = l.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id
FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
"""
