"""Near duplicates by BagMinHash signatures, banding and exact multiset verification.

A text is the multiset of its five-word shingles.  Its signature follows
BagMinHash: the weight axis is cut into unit cells, grouped in octaves [0,1),
[1,2), [2,4), [4,8), ...; every (shingle, octave) has a seeded Poisson process
over "time" whose points fall on a random signature slot and, by their bits,
on a cell of the octave.  A point counts if its cell lies below the shingle's
weight, and a slot keeps its earliest point; two slots agree with the
probability of the weighted Jaccard similarity.  Points are made in ascending
order and a process stops at the first point later than every slot of its
document, so most shingles of a long text cost one point.

Steps (nodes are distinct normalised texts, named by their 128-bit digest):
1. one Arrow pass over the texts: digest, shingle weight, ``BANDS`` band keys;
2. copies collapse to one node (grouped by digest, pre-aggregated);
3. per (band, key) bucket, every node is paired with the bucket's leader, the
   node with the smallest hash: a star, not all pairs;
4. pairs are verified exactly: similarity of the multisets >= ``THRESHOLD``;
5. verified links make classes (minimum label with pointer jumping);
6. buckets whose nodes fell into several classes are searched again for links
   between nodes of different classes, with a second, longer signature: a
   pair is only joined if its weights (a similarity of s needs weights within
   a factor of s) and two bits of each slot allow it.  ``ROUNDS`` stars with
   other leaders come first, in buckets of more than ``SMALL`` nodes (such as
   those of a passage that many texts share) within each of ``FINE_BANDS``
   narrower bands.  Then all nodes of different classes that still share a
   group (a smaller bucket, or a narrower band of a large one) are compared:
   the group's nodes are dealt out to pairs of blocks, a task compares the
   sketches of its two blocks and verifies there; rows are nodes and links,
   never pairs.  No bucket is capped.  At the threshold, the bands
   of step 2 miss a link with a chance of 3.5e-4, sketches and fine bands with
   1.5e-4; two texts of a large bucket are also missed if no leader that they
   meet is similar to both.
A class's id is its smallest document id.

Edge cases: a text of 1 to 4 words is one shingle; a text without words (or
null) is alone in its class; rows with the same text share a class even with
equal or null ids; a class id is null only where all its ids are null.  Words
are runs of ASCII letters (lower-cased), digits and characters above U+007F.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import ALNUM, U64, mix, raw_bytes, release, shingles, slices
from .shared import cut, fresh

WIDTH = 5
THRESHOLD = 0.8
BANDS = 20
ROWS = 5
#: Second look at buckets of several classes: rounds of stars, sketch slots, fine bands and their rows, nodes of a
#: bucket above which it is split by fine bands, and the sketch's margin in standard deviations.
ROUNDS = 3
SLOTS = 512
FINE_BANDS, FINE_ROWS = 48, 8
SMALL = 64
SURE = 4.5
#: Nodes on a side of a block of pairs that one task compares, and shingles on a side of a cell that it verifies.
BLOCK = 512
CELL_SHINGLES = 1 << 17
#: Text bytes that are hashed at once: bounds the arrays a worker holds (about a hundred bytes per shingle).
PIECE = 1 << 20
_UNIT = 2.0 ** -53
_SIG = "struct<node:binary,weight:bigint,bands:array<bigint>>"


def counted(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, weight) of the distinct shingles of each row, sorted by row, then hash."""
    if not len(h):
        return h, rows, np.empty(0, np.int64)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])))
    at = np.flatnonzero(new)
    return h[at], rows[at], np.diff(np.append(at, len(h)))


def bag_min_hash(h: np.ndarray, rows: np.ndarray, weights: np.ndarray, n_rows: int, slots: int) -> np.ndarray:
    """(n_rows, slots) array of each slot's earliest point (infinite where a row has no shingle)."""
    out = np.full((n_rows, slots), np.inf)
    flat = out.reshape(-1)
    # One process per (shingle, octave) that the weight reaches: octave k > 0 is [2^(k-1), 2^k).
    octaves = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64), 0) + 1
    if (octaves > 1).any():
        source = np.repeat(np.arange(len(h)), octaves)
        octave = np.arange(len(source)) - np.repeat(np.cumsum(octaves) - octaves, octaves)
    else:
        source, octave = np.arange(len(h)), np.zeros(len(h), np.int64)
    seed = mix(h[source] + mix(octave.astype(U64) + U64(1)))
    row, weight = rows[source], weights[source]
    base = np.where(octave > 0, 1 << np.maximum(octave - 1, 0), 0)  # first cell of the octave
    cells = np.maximum(base, 1)  # number of cells: 1, 1, 2, 4, ...
    time = np.zeros(len(source))
    step, burst = 0, 1
    while len(seed):
        for _ in range(burst):
            step += 1
            r = mix(seed + U64(step * 0x9E3779B97F4A7C15 % 2 ** 64))
            time -= np.log(((r >> U64(11)).astype(np.float64) + 0.5) * _UNIT) / (slots * cells)
            r = mix(r)
            slot = ((r >> U64(32)) * U64(slots) >> U64(32)).astype(np.int64)
            cell = base + ((r & U64(0xFFFFFFFF)) * cells.astype(U64) >> U64(32)).astype(np.int64)
            on = cell < weight
            np.minimum.at(flat, row[on] * slots + slot[on], time[on])
        live = time <= out.max(axis=1)[row]
        seed, row, weight, base, cells, time = (x[live] for x in (seed, row, weight, base, cells, time))
        if step >= 4:
            burst = min(burst * 2, 32)
    return out


def band_keys(signature: np.ndarray, bands: int, width: int) -> np.ndarray:
    """(rows, bands) array of 64-bit bucket keys; equal only for the same band."""
    parts = signature.view(U64).reshape(len(signature), bands, width)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), parts.shape[:2])
    for i in range(width):
        key = mix(key * U64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def _signatures(width: int, bands: int, rows_per_band: int):
    @F.arrow_udf(_SIG)
    def sign(texts: pa.Array) -> pa.Array:
        nodes, weights, keys, sizes = [], [], [], []
        for piece in slices(texts, PIECE):
            h, row, n_words = shingles(piece, width)
            offsets, data = raw_bytes(piece)
            data = data.translate(ALNUM)
            weight = np.bincount(row, minlength=len(piece))
            nodes += [hashlib.md5(b" ".join(data[a:b].split())).digest() if w else None
                      for a, b, w in zip(offsets[:-1], offsets[1:], weight)]
            signature = bag_min_hash(*counted(h, row), len(piece), bands * rows_per_band)
            full = weight > 0
            keys.append(band_keys(np.ascontiguousarray(signature[full]), bands, rows_per_band).ravel())
            weights.append(weight)
            sizes.append(full * bands)
        join = lambda xs: np.concatenate(xs) if xs else np.empty(0, np.int64)
        offsets = np.concatenate(([0], np.cumsum(join(sizes)))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(join(keys).astype(np.int64), pa.int64()))
        return pa.StructArray.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(join(weights).astype(np.int64), pa.int64()), lists],
            ["node", "weight", "bands"])

    return sign


def _similar(width: int):
    @F.arrow_udf("double")
    def similarity(a: pa.Array, b: pa.Array) -> pa.Array:
        """Weighted Jaccard similarity of the shingle multisets of each pair of texts."""
        out = [np.empty(0)]
        at = 0
        for left in slices(a, PIECE):
            right = b.slice(at, len(left))
            at += len(left)
            done = 0
            for piece in slices(right, PIECE):
                out.append(_jaccard(left.slice(done, len(piece)), piece, width))
                done += len(piece)
        return pa.array(np.concatenate(out), pa.float64())

    return similarity


def _jaccard(a: pa.Array, b: pa.Array, width: int) -> np.ndarray:
    ha, ra, wa = counted(*shingles(a, width)[:2])
    hb, rb, wb = counted(*shingles(b, width)[:2])
    n = len(a)
    h, r = np.concatenate([ha, hb]), np.concatenate([ra, rb])
    w = np.concatenate([wa, wb])
    order = np.lexsort((h, r))
    h, r, w = h[order], r[order], w[order]
    both = np.flatnonzero((h[1:] == h[:-1]) & (r[1:] == r[:-1])) if len(h) else np.empty(0, np.int64)
    common = np.bincount(r[both], np.minimum(w[both], w[both + 1]), minlength=n)
    total = np.bincount(r, w, minlength=n) - common
    return np.where(total > 0, common / np.maximum(total, 1), 0.0)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected part; ``links`` has (a, b).

    Each round every node takes the smallest label among its own, its neighbours' and its label's
    label; the labels are written to the shared folder after each round.
    """
    edges = cut(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(nodes.select("node", F.col("node").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")) \
            .agg(F.min("label").alias("near"))
        step = labels.join(near, "node", "left").select(
            "node", "label", F.least("label", F.coalesce("near", "label")).alias("low"))
        jump = step.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        now = cut(step.join(jump, "low", "left").select(
            "node", F.least("low", F.coalesce("lower", "low")).alias("next"), "label"))
        changed = now.filter(F.col("next") != F.col("label")).limit(1).count()
        labels = now.select("node", F.col("next").alias("label"))
        if not changed:
            return labels


def _verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are similar enough."""
    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    both = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    return both.filter(_similar(width)("ta", "tb") >= threshold).select("a", "b")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows_per_band: int = ROWS) -> DataFrame:
    """(node, first, n_first, class_id, size, is_kept) per distinct text with words: ``first`` is its smallest
    id, found in ``n_first`` rows, ``size`` the number of rows in its class; ``is_kept`` marks one text per class,
    that with the class id."""
    sign = _signatures(width, bands, rows_per_band)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = rows.select("doc_id", sign("text").alias("s")).select("doc_id", "s.*").filter("node is not null")
    # Copies first meet by (text, id), then one row per text is left.
    by_id = signed.groupBy("node", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.any_value("weight").alias("weight"), F.any_value("bands").alias("bands"))
    uniq = cut(by_id.groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("n"))).alias("f"), F.sum("n").alias("copies"),
        F.any_value("weight").alias("weight"), F.any_value("bands").alias("bands"))
        .select("node", F.col("f.doc_id").alias("first"), F.col("f.n").alias("n_first"), "copies", "weight", "bands"))
    # The leader of a bucket is its node with the smallest hash, the same order in every bucket.
    buckets = uniq.select("node", "weight", F.xxhash64("node").alias("h"), F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")) \
        .filter("low != high").select("key", "low")
    members = cut(buckets.join(shared, "key"))
    leads = members.filter("h = low").select("key", F.col("node").alias("lead"))
    star = members.filter("h != low").join(leads, "key") \
        .select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()
    nodes = cut(members.select("node").distinct())
    texts = _texts(rows, nodes.join(uniq, "node").select("node", "first"))
    links = cut(_verified(star, texts, width, threshold))
    labels = components(nodes, links)
    # Buckets with several classes left: more stars with other leaders, in large buckets per fine band, so that
    # what belongs together is joined; then all pairs of different classes that are left.
    sketches = None
    for step in range(ROUNDS + 1):
        rest = _open_rows(members, labels)
        if sketches is None:
            sketches = cut(rest.select("node").distinct().join(texts, "node").select(
                "node", _sketch(width)("text").alias("s")).select("node", "s.*"))
        if step < ROUNDS:
            more = cut(_verified(_star_pairs(rest, sketches, step, threshold), texts, width, threshold))
        else:
            more = cut(_links_in_cells(_cells(rest, sketches), texts, width, threshold).distinct())
        if more.limit(1).count():
            links = cut(links.unionAll(more))
            labels = components(nodes, links)
    joined = cut(uniq.select("node", "first", "n_first", "copies").join(labels, "node", "left")
                 .withColumn("label", F.coalesce("label", "node")))
    per_class = joined.groupBy("label").agg(
        F.min(F.struct(F.col("first").isNull(), F.col("first"), F.col("node"))).alias("kept"),
        F.sum("copies").alias("size"))
    return cut(joined.join(per_class, "label").select(
        "node", "first", "n_first", F.col("kept.first").alias("class_id"), "size",
        (F.col("kept.node") == F.col("node")).alias("is_kept")))


def _sketch(width: int):
    @F.arrow_udf("struct<bits:array<bigint>,fine:array<bigint>>")
    def sketch(texts: pa.Array) -> pa.Array:
        """Two bits of each slot of a longer signature, packed, and that signature's fine band keys."""
        bits, fine = [np.empty((0, SLOTS // 32), U64)], [np.empty((0, FINE_BANDS), np.int64)]
        for piece in slices(texts, PIECE):
            h, row, _ = shingles(piece, width)
            signature = bag_min_hash(*counted(mix(h), row), len(piece), SLOTS)
            codes = mix(signature.view(U64)) & U64(3)
            places = U64(2) * np.arange(32, dtype=U64)
            bits.append((codes.reshape(len(piece), -1, 32) << places).sum(axis=2, dtype=U64))
            some = np.ascontiguousarray(signature[:, :FINE_BANDS * FINE_ROWS])
            fine.append(band_keys(some, FINE_BANDS, FINE_ROWS))
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()),
                                          pa.array(x.view(np.int64).ravel(), pa.int64()))
                 for x in (np.concatenate(bits), np.concatenate(fine))]
        release()
        return pa.StructArray.from_arrays(lists, ["bits", "fine"])

    return sketch


def _open_rows(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, n, node, weight, label) of the buckets whose ``n`` nodes are in more than one class."""
    inside = members.join(labels, "node")
    open_keys = inside.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"),
                                          F.count(F.lit(1)).alias("n")).filter("least != most").select("key", "n")
    return cut(inside.join(open_keys, "key").select("key", "n", "node", "weight", "label"))


def _can_be_similar(threshold: float) -> Column:
    """Of rows x and y: different classes, weights within the threshold, and sketches that differ in no more
    slots than ``SURE`` standard deviations allow at the threshold."""
    agree = threshold + (1 - threshold) / 4  # two bits also agree by chance
    allowed = SLOTS * (1 - agree) + SURE * (SLOTS * agree * (1 - agree)) ** 0.5
    differ = F.lit(0)
    for i in range(SLOTS // 32):
        z = F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])
        differ = differ + F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return ((F.col("x.label") != F.col("y.label")) & (F.col("x.weight") >= threshold * F.col("y.weight"))
            & (F.col("y.weight") >= threshold * F.col("x.weight")) & (differ <= int(allowed)))


def _groups(rest: DataFrame, sketches: DataFrame, fine: Column) -> DataFrame:
    """(node, weight, label, sub) of the groups in which nodes meet: small buckets, or the ``fine`` bands of the nodes
    of large ones; a node of several large buckets is in each of its fine bands once."""
    bands = F.transform(fine, lambda f: F.xxhash64(F.lit("fine"), f))
    sub = F.when(F.col("n") > SMALL, bands).otherwise(F.array(F.col("key")))
    return rest.join(sketches.select("node", "fine"), "node").select("node", "weight", "label", F.explode(sub).alias("sub")) \
        .distinct()


def _star_pairs(rest: DataFrame, sketches: DataFrame, step: int, threshold: float) -> DataFrame:
    """Candidates (a, b) of every node with the leader of its group in this round, the smallest seeded hash.

    A group is a bucket or, of the nodes of large buckets, those that share a fine band of this round's half."""
    half = FINE_BANDS // 2
    rows = _groups(rest, sketches, F.slice("fine", step % 2 * half + 1, half)).withColumn("h", F.xxhash64("node", F.lit(step)))
    several = rows.groupBy("sub").agg(F.min("label").alias("least"), F.max("label").alias("most"),
                                      F.min("h").alias("lead")).filter("least != most").select("sub", "lead")
    rows = cut(rows.join(several, "sub").join(sketches.select("node", "bits"), "node"))
    return rows.alias("x").join(rows.filter("h = lead").alias("y"),
                                (F.col("x.sub") == F.col("y.sub")) & _can_be_similar(threshold)) \
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _cells(rest: DataFrame, sketches: DataFrame) -> DataFrame:
    """(sub, i, j, block, node, weight, label, bits, subs): the open groups' nodes, dealt out to pairs of blocks.

    A group is cut into blocks of about ``BLOCK`` nodes and ``CELL_SHINGLES`` shingles; a node goes once to each
    pair of blocks that has its own.  ``subs`` are the open groups that the node is in (a bounded list)."""
    rows = cut(_groups(rest, sketches, F.col("fine")))
    several = rows.groupBy("sub").agg(F.min("label").alias("least"), F.max("label").alias("most"),
                                      F.count(F.lit(1)).alias("m"), F.sum("weight").alias("w")).filter("least != most")
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("w") / CELL_SHINGLES)).cast("int")
    rows = cut(rows.join(several.select("sub", blocks.alias("blocks")), "sub"))
    subs = rows.groupBy("node").agg(F.collect_set("sub").alias("subs"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), "blocks").cast("int")) \
        .join(subs, "node").join(sketches.select("node", "bits"), "node")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.withColumn("other", other).select(
        "sub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "weight",
        "label", "bits", "subs")


def _candidates(cell: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of a cell: different classes, weights and sketches that allow the threshold, and no smaller group
    that both nodes are in (so every pair belongs to one cell)."""
    sub, i, j = (cell[c][0].as_py() for c in ("sub", "i", "j"))
    block, weight = (cell[c].to_numpy() for c in ("block", "weight"))
    label = cell["label"].combine_chunks().dictionary_encode().indices.to_numpy()
    bits = cell["bits"].combine_chunks().flatten().to_numpy().view(U64).reshape(len(cell), -1)
    subs = [set(x) for x in cell["subs"].to_pylist()]
    agree = threshold + (1 - threshold) / 4  # two bits also agree by chance
    allowed = SLOTS * (1 - agree) + SURE * (SLOTS * agree * (1 - agree)) ** 0.5
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    out = [np.empty((0, 2), np.int64)]
    for x in left.tolist():
        y = right[right > x] if i == j else right
        y = y[(label[y] != label[x]) & (weight[x] >= threshold * weight[y]) & (weight[y] >= threshold * weight[x])]
        z = bits[y] ^ bits[x]
        differ = np.bitwise_count((z | (z >> U64(1))) & U64(0x5555555555555555)).sum(axis=1)
        y = [k for k in y[differ <= int(allowed)].tolist() if min(subs[x] & subs[k]) == sub]
        out.append(np.array([(x, k) for k in y], np.int64).reshape(-1, 2))
    pairs = np.concatenate(out)
    return pairs[:, 0], pairs[:, 1]


def _links_in_cells(cells: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """Links (a, b) that join the same nodes as all pairs of the ``cells`` whose texts are similar enough.

    A task compares the sketches of a cell and names the nodes that need their texts; the texts are sent to these
    cells, and a task verifies there, leaving out pairs whose nodes its links have joined already.  Nodes and links
    are rows, pairs never are."""
    kept = ("sub", "i", "j", "block", "node", "weight", "label", "bits", "subs")

    def wanted(cell: pa.Table) -> pa.Table:
        a, b = _candidates(cell, threshold)
        return cell.select(kept).take(np.unique(np.concatenate((a, b))))

    def verify(cell: pa.Table) -> pa.Table:
        bags: list[tuple] = []
        for chunk in cell["text"].chunks:
            for piece in slices(chunk, PIECE):
                h, row, w = counted(*shingles(piece, width)[:2])
                at = np.searchsorted(row, np.arange(len(piece) + 1))
                bags += [(h[p:q], w[p:q]) for p, q in zip(at[:-1], at[1:])]
        root = list(range(len(bags)))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        links: list[tuple] = []
        for a, b in zip(*(x.tolist() for x in _candidates(cell, threshold))):
            ra, rb = find(a), find(b)
            if ra == rb:
                continue
            (ha, wa), (hb, wb) = bags[a], bags[b]
            at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
            both = hb[at] == ha
            common = int(np.minimum(wa[both], wb[at[both]]).sum())
            if common / (int(wa.sum()) + int(wb.sum()) - common) >= threshold:
                root[ra] = rb
                links.append((a, b))
        del bags
        release()
        node = cell["node"].to_pylist()
        ends = ([min(node[a], node[b]) for a, b in links], [max(node[a], node[b]) for a, b in links])
        return pa.table({"a": pa.array(ends[0], pa.binary()), "b": pa.array(ends[1], pa.binary())})

    asked = cut(cells.groupBy("sub", "i", "j").applyInArrow(wanted, cells.select(*kept).schema))
    return asked.join(texts, "node").groupBy("sub", "i", "j").applyInArrow(verify, "a binary, b binary")


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the ``wanted`` (node, first) rows; equal ids with other texts are told apart by the digest."""
    some = rows.alias("r").join(wanted.alias("w"), F.col("r.doc_id").eqNullSafe(F.col("w.first"))) \
        .select("w.node", "r.text")
    return cut(some.filter(_node_column(F.col("text")) == F.col("node")).dropDuplicates(["node"]))


def _node_column(text: Column) -> Column:
    """Digest of the text's words, or null without words."""
    @F.arrow_udf("binary")
    def node(texts: pa.Array) -> pa.Array:
        out = []
        for piece in slices(texts, PIECE):
            offsets, data = raw_bytes(piece)
            data = data.translate(ALNUM)
            for a, b in zip(offsets[:-1], offsets[1:]):
                words = data[a:b].split()
                out.append(hashlib.md5(b" ".join(words)).digest() if words else None)
        release()
        return pa.array(out, pa.binary())

    return node(text)


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, class_id, class_size) per row of ``docs``; a text without words has its own id and size 1."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    mine = docs.select(F.col(id_col).alias("doc_id"), _node_column(F.col(text_col)).alias("node"))
    return mine.join(found.select("node", "class_id", "size"), "node", "left").select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("class_size"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row per class: that of the class id (of equal rows, one); texts without words stay."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    node, hit, no = (fresh(docs, c) for c in ("__node", "__hit", "__no"))
    rows = docs.withColumn(node, _node_column(F.col(text_col)))
    kept = found.filter("is_kept").select(F.col("node").alias("k_node"), F.col("first").alias("k_first"))
    # Joined by (id, text digest), so neither a hot text nor a hot id brings its rows together.
    mine = rows.alias("r").join(kept.alias("k"), F.col(f"r.{id_col}").eqNullSafe(F.col("k.k_first"))
                                & (F.col(f"r.{node}") == F.col("k.k_node")), "left")
    mine = mine.select("r.*", F.col("k.k_node").isNotNull().alias(hit)).filter(F.col(hit) | F.col(node).isNull())
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if found.filter("is_kept and n_first > 1").limit(1).count():  # repeated rows of one id and text: keep one
        order = Window.partitionBy(F.col(id_col), F.col(node)).orderBy(F.lit(0))
        mine = mine.withColumn(no, F.row_number().over(order)).filter((F.col(no) == 1) | F.col(node).isNull())
    return mine.select(*columns)
