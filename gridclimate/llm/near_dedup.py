"""MinHash near-duplicates (operator 1).

Method: fast similarity sketching. In round i each shingle is thrown into one of
t bins with value (i, hash); once every bin has been hit the rest is decided, and
from round t on each round fills one bin with the smallest hash of all shingles,
so 2t rounds fill every bin even of a one-shingle text. A bin of two texts agrees
with the probability of their Jaccard similarity. Bands of bins bring candidates
together; every link is confirmed on the full shingle sets.

The search is whole, yet never lists the pairs of a group:

1. texts with equal sets collapse into one class, so copies cost nothing further;
2. in each band bucket every class is compared with the most central class only
   (the one that shares the largest buckets), and links are followed;
3. classes of buckets that still hold several components go through an exact
   prefix filter: sets with similarity s share one of their rarest shingles.
   Frequent shingles stay out of these prefixes, so this meets few rows.

The chance that two texts of similarity 0.8 share no bucket is (1 - 0.8^4)^30,
about 1 in 7 million; no other step can miss a link.

Defined cases: null and empty texts have no shingles and are linked with nothing;
a null `doc_id` keeps its row, links with nothing, and has a null component;
repeated rows form one class; several texts under one id are separate classes;
an empty table gives no rows; a text longer than a piece is hashed in segments, whole.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import U64, mapped, mix, pieces, small_side, stored, string_buffers, text_shingles, word_hashes

BANDS, BAND_ROWS = 30, 4
#: Ids sent to every task at most; beyond, the join shuffles.
SMALL_IDS = 1_000_000
#: Cells of the table that orders shingles by how frequent they are.
RANK_CELLS = 1 << 18


def fast_sketch(shingles: np.ndarray, owner: np.ndarray, texts: int, bins: int) -> np.ndarray:
    """Sketch of each text: `texts` x `bins` values. `shingles` are distinct within a text, `owner` is the text's number."""
    empty = np.iinfo(U64).max
    sketch = np.full(texts * bins, empty, dtype=U64)
    base = owner.astype(np.int64) * bins
    seeds = np.random.default_rng(11).integers(1, 2**63, 2 * bins, dtype=U64)
    for i in range(2 * bins):
        if not len(shingles):
            break
        h = mix(shingles ^ seeds[i])
        value = (h & U64((1 << 40) - 1)) | U64(i << 40)
        place = base + (((h >> U64(40)) * U64(bins)) >> U64(24)).astype(np.int64) if i < bins else base + (i - bins)
        np.minimum.at(sketch, place, value)
        open_texts = (sketch.reshape(texts, bins) == empty).any(axis=1)
        going = open_texts[owner]
        if not going.all():
            shingles, owner, base = shingles[going], owner[going], base[going]
    return sketch.reshape(texts, bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key per text and band."""
    cells = sketch.reshape(len(sketch), bands, rows)
    out = np.tile(np.arange(1, bands + 1, dtype=U64), (len(sketch), 1))
    for j in range(rows):
        out *= U64(0x9FB21C651E98DF25)
        out ^= mix(cells[:, :, j].copy())
        out ^= out >> U64(31)
    return mix(out).view(np.int64)


def _sets(column: pa.Array, n: int) -> Iterator[list[np.ndarray]]:
    offsets, data = string_buffers(column)
    for a, b in pieces(offsets):
        words, counts = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        yield list(text_shingles(words, counts, n))


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def sketches(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set) and band keys of every text."""
    def run(batches):
        for batch in batches:
            ids, at = batch.column(0), 0
            for sets in _sets(batch.column(1), n):
                sizes = np.array([len(s) for s in sets])
                sketch = fast_sketch(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets), bands * rows)
                keys = band_keys(sketch, bands, rows)
                filled = sizes > 0
                edges = np.concatenate([[0], np.cumsum(np.where(filled, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, len(sets)), batch.column(2).slice(at, len(sets)), pa.array(sizes, pa.int64()),
                    pa.array([_digest(s) for s in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(edges), pa.array(keys[filled].ravel()))],
                    ["doc_id", "text_hash", "n_shingles", "node", "bands"])
                at += len(sets)

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")), run,
                  "doc_id long, text_hash long, n_shingles long, node binary, bands array<long>")


def _set_rows(docs: DataFrame, needed: DataFrame, n: int) -> DataFrame:
    """node and full set (sorted 64-bit hashes) of the classes named in `needed` (node, doc_id), which is stored."""
    def run(batches):
        for batch in batches:
            nodes, values = [], []
            for sets in _sets(batch.column(0), n):
                nodes += [_digest(s) for s in sets]
                values += [s.tobytes() for s in sets]
                if sum(map(len, values)) > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(values, pa.binary())], ["node", "items"])
                    nodes, values = [], []
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(values, pa.binary())], ["node", "items"])

    ids = small_side(needed.select("doc_id"), SMALL_IDS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi").select("text")
    return mapped(texts, run, "node binary, items binary")


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough. `pairs` is stored."""
    def run(batches):
        for batch in batches:
            hit = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), dtype=U64), np.frombuffer(b.as_buffer(), dtype=U64)
                both = len(a) + len(b) - len(np.union1d(a, b)) if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) else 0
                hit.append(100 * both >= percent * (len(a) + len(b) - both))
            keep = pa.array(hit, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    needed = stored(classes.join(nodes, "node", "left_semi").select("node", "doc_id"), "needed")
    # Repeated ids can deliver a class twice; the pair is then confirmed twice.
    sets = stored(_set_rows(docs, needed, n), "sets")
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("xs")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("items").alias("ys")), "b")
    return mapped(both.select("a", "b", "xs", "ys"), run, "a binary, b binary")


def components(links: DataFrame, name: str) -> DataFrame:
    """node and root (smallest node of its component) for all nodes of stored links (a, b).

    Large-star and small-star steps: each node hands its larger neighbours, then all
    its smaller ones, to the smallest; the edges become stars in a logarithmic number of steps.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi != lo").distinct(), name)
    before = None
    while True:
        # large star: a node's larger neighbours go to its smallest neighbour, or to itself
        both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(edges.select("lo", "hi"))
        least = both.groupBy("n").agg(F.min("m").alias("root"))
        large = both.where("m > n").join(least, "n").select(F.col("m").alias("hi"), F.least("root", "n").alias("lo")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of these
        small_least = large.groupBy("hi").agg(F.min("lo").alias("root"))
        small = large.join(small_least, "hi").select(F.explode(F.array(
            F.struct(F.col("lo").alias("hi"), F.col("root").alias("lo")), F.struct("hi", F.col("root").alias("lo")))).alias("e")) \
            .select("e.*").where("hi != lo").distinct()
        edges = stored(small, name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _star_pairs(live: DataFrame) -> DataFrame:
    """Each class of a bucket with the bucket's most central class; `live` has bucket, size, node and is stored."""
    weight = live.groupBy("node").agg(F.sum(F.log2("size")).alias("weight"))
    centre = live.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("c")).select("bucket", F.col("c.node").alias("b"))
    return live.join(centre, "bucket").where("node != b").select(F.col("node").alias("a"), "b").distinct()


def _prefix_pairs(live: DataFrame, docs: DataFrame, classes: DataFrame, roots: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs of classes in different components that share one of their rarest shingles, out of buckets not yet of one component.

    Rare is what few of these classes have, read from a table of fixed size that counts shingles by hash.
    Any fixed order gives the same links; this one keeps common shingles out of the prefixes.
    """
    open_buckets = live.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("bucket")
    nodes = stored(live.join(open_buckets, "bucket", "left_semi").select("node").distinct().join(classes, "node").select("node", "doc_id"), "open")
    sets = stored(_set_rows(docs, nodes, n).join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]), "open-sets")
    shift = U64(64 - RANK_CELLS.bit_length() + 1)

    def cells(batches):
        total = np.zeros(RANK_CELLS, dtype=np.int64)
        for batch in batches:
            for items in batch.column(0):
                np.add.at(total, (np.frombuffer(items.as_buffer(), dtype=U64) >> shift).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    counted = mapped(sets.select("items"), cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rank = np.zeros(RANK_CELLS, dtype=np.int32)
    for batch in counted.toArrow().to_batches():
        rank[batch.column(0).to_numpy()] = np.minimum(batch.column(1).to_numpy(), 2**31 - 1)
    shared = live.sparkSession.sparkContext.broadcast(rank)

    def prefixes(batches):
        for batch in batches:
            tokens, owners, sizes, places = [], [], [], []
            for node, items in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = np.frombuffer(items.as_buffer(), dtype=U64)
                often = shared.value[(s >> shift).astype(np.int64)]
                first = s[np.lexsort((s, often))][:len(s) - -(-percent * len(s) // 100) + 1]
                place = np.flatnonzero(shared.value[(first >> shift).astype(np.int64)] > 1)  # a shingle counted once is nobody else's
                first = first[place]
                tokens.append(first.view(np.int64))
                places.append(place)
                owners += [node] * len(first)
                sizes.append(np.full(len(first), len(s)))
            if tokens:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(tokens)), pa.array(owners, pa.binary()), pa.array(np.concatenate(sizes), pa.int64()), pa.array(np.concatenate(places), pa.int64())],
                    ["token", "node", "size", "place"])

    rows = stored(_rooted(mapped(sets.select("node", "items"), prefixes, "token long, node binary, size long, place long"), roots), "prefixes")
    several = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("token")
    rows = rows.join(several, "token", "left_semi")
    other = rows.select("token", F.col("node").alias("b"), F.col("root").alias("b_root"), F.col("size").alias("b_size"), F.col("place").alias("b_place"))
    # what can still be shared from this shingle on, against what the similarity needs
    most = F.least(F.col("size") - F.col("place"), F.col("b_size") - F.col("b_place"))
    fits = (F.col("root") < F.col("b_root")) & ((100 + percent) * most >= percent * (F.col("size") + F.col("b_size")))
    return rows.join(other, "token").where(fits).select(F.col("node").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links), kept and text_hash for every row of `docs` (doc_id, text)."""
    sketched = stored(sketches(docs, shingle, bands, rows), "sketches")
    classes = stored(sketched.where("node is not null and doc_id is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min_by("bands", "doc_id").alias("bands")), "classes")
    keyed = classes.select("node", F.explode("bands").alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    live = stored(keyed.join(sizes, "bucket"), "buckets")
    links = stored(_confirmed(stored(_star_pairs(live), "stars"), docs, classes, shingle, percent), "links")
    roots = components(links, "components")
    pairs = stored(_prefix_pairs(stored(_rooted(live, roots), "rooted"), docs, classes, roots, shingle, percent), "pairs")
    more = stored(_confirmed(pairs, docs, classes, shingle, percent), "links")
    roots = components(links.union(more), "components")
    # the component's name: the smallest id of its classes
    members = classes.select("node", "doc_id").join(roots, "node")
    roots_too = roots.select(F.col("root").alias("node")).distinct().join(classes.select("node", "doc_id"), "node").withColumn("root", F.col("node"))
    everyone = members.unionByName(roots_too)
    names = everyone.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = everyone.join(names, "root").select("node", "component_id")
    alone = classes.where("copies > 1").join(linked, "node", "left_anti").select("node", F.col("doc_id").alias("component_id"))
    named = stored(linked.union(alone), "names")
    out = sketched.select("doc_id", "n_shingles", "node", "text_hash").join(named, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_hash")
