"""Near-duplicate documents by a chosen-path similarity join on MinHash sketches.

Every document has a sketch of 64 least hashes of its shingles. A tree starts with all documents; at a node, a
pseudo-random choice of (coordinate, value) pairs, two of the 64 coordinates on average, says into which children a
document goes, so that documents with equal values there take the same branch. The choice depends on the path only, not on other documents, so
the first two levels of all trees are computed where the text is read. Nodes with few documents are compared exhaustively,
large ones branch on. Independent trees are repeated for recall: a pair at the threshold meets in one tree with a
probability of about 0.7 at any depth (branches double while about 0.85 of them are shared), and in one of six of them with 0.999.

Large groups of copies must not become pairs. Equal sets are one document by their 128-bit hash. Pairs of a node are only
looked at while they lie in different components of the links confirmed so far, in three rounds: each document of a
node with the smallest one; each with the most central one (whose sketch agrees most with those of the others);
then all pairs that are still apart. A large node whose documents agree too much to be split by branching (on average in
more than a half of their coordinates) is compared block against block, as the method compares points of high average similarity
with all others. Parity signatures and sizes drop most pairs without a loss before they are emitted; every link is confirmed on the full sets
of both texts.

Defined cases: texts without words have an empty set and link with nothing; fewer words than a shingle make one token;
NULL ids have no component, link with nothing and are kept; rows that repeat an id are one document; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import IdFilter, Powers, byte_codes, mix, slices
from adlake.llm.components import components
from adlake.llm.jaccard_join import Sets, as_long, common, order_hash, parity_bits, sets_of, whole_groups
from adlake.session import cut_lineage

SHINGLE = 5
SIMILAR = (85, 100)
COORDINATES = 64
TREES = 6
BRANCHES = 2.0  # children of a document at a node, on average
FIRST_DEPTH = 2  # levels computed with the sketch
MOST_DEPTH = 12  # deeper nodes are compared whatever their size
SMALL = 4096  # documents of a node that are compared with one another in one task
TEXT_BYTES = 1 << 19  # bytes of text of a numpy step

_ODD = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_FLIP = mix(np.arange(1001, COORDINATES + 1001, dtype=np.uint64))
_LIMIT = np.uint64(int(BRANCHES / COORDINATES * 2.0**64))


# --- sketches and paths


def sketches(sets: Sets) -> np.ndarray:
    """(rows, coordinates): for each coordinate a hash of the token whose hash is the least. Rows without tokens are 0."""
    out = np.zeros((len(sets.firsts) - 1, COORDINATES), np.uint32)
    full = np.flatnonzero(sets.sizes())
    if len(full):
        for i in range(COORDINATES):
            least = np.minimum.reduceat((sets.tokens ^ _FLIP[i]) * _ODD[i], sets.firsts[full])
            out[full, i] = (mix(least) >> np.uint64(32)).astype(np.uint32)
    return out


def children(sketch: np.ndarray, row: np.ndarray, path: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, path, used) of the next level for the documents ``sketch[row]`` at the nodes ``path``.

    ``used`` has a bit for each coordinate on the path, which is not chosen again.
    """
    coordinate = np.arange(COORDINATES, dtype=np.uint64)
    out = []
    for at in range(0, len(row), 8192):
        r, p, u = (x[at : at + 8192] for x in (row, path, used))
        value = sketch[r].astype(np.uint64) | (coordinate << np.uint64(32))
        chosen = mix(mix(value) ^ p[:, None])
        which, i = np.nonzero((chosen < _LIMIT) & ((u[:, None] >> coordinate) & np.uint64(1) == 0))
        out.append((r[which], mix(chosen[which, i] + np.uint64(1)), u[which] | (np.uint64(1) << i.astype(np.uint64))))
    return tuple(np.concatenate([x[k] for x in out]) if out else (row, path, used)[k][:0] for k in range(3))


def first_nodes(sketch: np.ndarray, sizes: np.ndarray, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of every row after the first levels of all trees, in the order of the rows."""
    full = np.flatnonzero(sizes)
    row, path = np.repeat(full, trees), np.tile(mix(np.arange(1, trees + 1, dtype=np.uint64)), len(full))
    used = np.zeros(len(row), np.uint64)
    for _ in range(FIRST_DEPTH):
        row, path, used = children(sketch, row, path, used)
    order = np.argsort(row, kind="stable")
    return row[order], path[order], used[order]


def profile(docs: DataFrame, trees: int = TREES, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n, k1, k2, bits, sketch, nodes, used) of every row: set size and hash, parity signature, sketch and paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes = Powers(), byte_codes()
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                sets = sets_of(batch.column("text"), powers, codes, shingle)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(order_hash(sets.tokens, k))]) for k in (8, 9)]
                keys = [as_long(s[sets.firsts[1:]] - s[sets.firsts[:-1]]) for s in sums]
                sketch = sketches(sets)
                row, path, used = first_nodes(sketch, sets.sizes(), trees)
                places = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(places, as_long(x)) for x in (path, used)]
                body = pa.array([r.tobytes() for r in sketch], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sets.sizes()), *keys, parity_bits(sets), body, *lists],
                    ["doc_id", "n", "k1", "k2", "bits", "sketch", "nodes", "used"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n bigint, k1 bigint, k2 bigint, bits array<bigint>, sketch binary, nodes array<bigint>, used array<bigint>"
    )


def sketch_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


# --- links


def verified(docs: DataFrame, pairs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The pairs that link, by the full sets of both texts. Texts of other documents do not shuffle."""
    part, whole_part = SIMILAR
    wanted = IdFilter(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id")
    texts = docs.where(wanted.may_hold(F.col("doc_id"))).select("doc_id", "text")
    left, right = (texts.select(F.col("doc_id").alias(f"_{s}"), F.col("text").alias(f"text_{s}")) for s in "ab")
    both = pairs.join(right, F.col("b") == F.col("_b")).drop("_b").join(left, F.col("a") == F.col("_a")).drop("_a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes = Powers(), byte_codes()
        for whole in batches:
            for half in slices(whole, "text_a", TEXT_BYTES):
                for batch in slices(half, "text_b", TEXT_BYTES):
                    sides = [sets_of(batch.column(c), powers, codes, shingle) for c in ("text_a", "text_b")]
                    inside = common([(s.tokens, s.rows()) for s in sides], batch.num_rows)
                    union = sides[0].sizes() + sides[1].sizes() - inside
                    linked = (inside * whole_part >= part * union) & (inside > 0)
                    yield batch.select(["a", "b"]).filter(pa.array(linked))

    return both.mapInArrow(run, pairs.schema)


def close_pairs(n: np.ndarray, c: np.ndarray, bits: pa.Array, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x, y) of rows of different components that size and parity signature allow.

    ``side`` is the block of a row; if there are two blocks, pairs cross them. Rows of the largest component are not paired with one
    another, so they stand at the end and are only looked at from the others.
    """
    part, whole = SIMILAR
    _, number = np.unique(c, return_inverse=True)
    main = number == np.bincount(number).argmax()
    order = np.argsort(main, kind="stable")
    n, number, side = n[order], number[order], side[order]
    folded, widths = folded_signatures(bits.take(pa.array(order)))
    crossing = side.min() != side.max()
    xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x in range(int((~main).sum())):
        y = np.arange(x + 1, len(n))
        y = y[(number[y] != number[x]) & (np.minimum(n[y], n[x]) * whole >= np.maximum(n[y], n[x]) * part)]
        if crossing:
            y = y[side[y] != side[x]]
        for width, signature in folded.items():
            z = y[np.minimum(widths[y], widths[x]) == width]
            if len(z):
                apart = np.bitwise_count(signature[z] ^ signature[x]).sum(axis=1, dtype=np.int64)
                z = z[apart * (whole + part) <= (n[z] + n[x]) * (whole - part)]
                xs.append(np.full(len(z), x))
                ys.append(z)
    return order[np.concatenate(xs)], order[np.concatenate(ys)]


def folded_signatures(bits: pa.Array) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Signatures of all rows in each of their widths, as far as they have it (a wider one folds to a narrower), and the widths."""
    offsets, words = np.asarray(bits.offsets), np.asarray(bits.values).view(np.uint64)
    widths = np.diff(offsets)
    out = {}
    for width in np.unique(widths):
        out[int(width)] = folds = np.zeros((len(widths), width), np.uint64)
        for r in np.flatnonzero(widths >= width):
            folds[r] = np.bitwise_xor.reduce(words[offsets[r] : offsets[r + 1]].reshape(-1, width))
    return out, widths


def central(sketch: np.ndarray) -> int:
    """The row that agrees with most others in most coordinates, the first of equals."""
    if len(sketch) <= 32:
        return int((sketch[:, None] == sketch[None]).sum(axis=(1, 2)).argmax())
    agreed = np.zeros(len(sketch), np.int64)
    for values in sketch.T:
        _, number, counts = np.unique(values, return_inverse=True, return_counts=True)
        agreed += counts[number]
    return int(agreed.argmax())


def agreement(sketch: np.ndarray) -> float:
    """Mean share of coordinates in which two different rows agree."""
    m = len(sketch)
    equal = sum(int((np.unique(values, return_counts=True)[1].astype(np.int64) ** 2).sum()) for values in sketch.T)
    return (equal / COORDINATES - m) / (m * (m - 1)) if m > 1 else 0.0


def id_pairs(batch: pa.RecordBatch, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    doc = batch.column("doc_id").to_numpy(zero_copy_only=False)
    a, b = doc[x], doc[y]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Groups of equal keys in sorted rows, one at a time; a group is a block or two."""
    for batch in whole_groups(batches, keys):
        key = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows - 1, bool)
        for k in key:
            new |= k[1:] != k[:-1]
        edges = np.concatenate([[0], np.flatnonzero(new) + 1, [batch.num_rows]])
        for start, end in zip(edges[:-1], edges[1:]):
            yield batch.slice(int(start), int(end - start))


def central_pairs(members: DataFrame) -> DataFrame:
    """(a, b): every document of a block of a node with the most central one, if they are apart and may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["node", "side"]):
            c = group.column("c").to_numpy(zero_copy_only=False)
            if group.num_rows > 1 and (c != c[0]).any():
                centre = central(sketch_rows(group.column("sketch")))
                n, side = group.column("n").to_numpy(), np.arange(group.num_rows) == centre
                # Everything else counts as one component, so that only pairs with the centre are looked at.
                x, y = close_pairs(n, side.astype(np.int64), group.column("bits"), np.zeros(len(n), np.int64))
                apart = c[x] != c[y]
                yield id_pairs(group, x[apart], y[apart])

    kind = members.schema["doc_id"].dataType.simpleString()
    ordered = members.repartition("node", "side").sortWithinPartitions("node", "side", "doc_id")
    return ordered.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def all_pairs(members: DataFrame) -> DataFrame:
    """(a, b): all pairs of a node that are apart and may link. Every task compares two blocks of a node."""
    other = F.transform(
        F.sequence(F.lit(0), F.col("sides") - 1),
        lambda k: F.struct(F.least(k, F.col("side")).alias("i"), F.greatest(k, F.col("side")).alias("j")),
    )
    cells = members.withColumn("_cell", F.explode(other)).select("*", "_cell.i", "_cell.j").drop("_cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["node", "i", "j"]):
            n, c, side = (group.column(k).to_numpy(zero_copy_only=False) for k in ("n", "c", "side"))
            i, j = (group.column(k)[0].as_py() for k in ("i", "j"))
            if group.num_rows > 1 and (c != c[0]).any() and (i == j or side.min() != side.max()):
                yield id_pairs(group, *close_pairs(n, c, group.column("bits"), side))

    kind = members.schema["doc_id"].dataType.simpleString()
    ordered = cells.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "doc_id")
    return ordered.mapInArrow(run, f"a {kind}, b {kind}").distinct()


# --- the tree


def shared_nodes(rows: DataFrame) -> DataFrame:
    """``rows`` of nodes with two documents or more, with their number ``m`` and the smallest of them."""
    sizes = rows.groupBy(F.col("node").alias("_node")).agg(F.count("*").alias("m"), F.min("doc_id").alias("least")).where("m > 1")
    return cut_lineage(rows.join(cut_lineage(sizes), F.col("node") == F.col("_node")).drop("_node"))


def mixed(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of nodes whose documents lie in several components, with the component ``c`` and the number ``m`` of documents."""
    placed = nodes.drop("m", "least", "c").join(known.select(F.col("id").alias("_id"), "component"), F.col("doc_id") == F.col("_id"), "left")
    placed = cut_lineage(placed.withColumn("c", F.coalesce("component", "doc_id")).drop("_id", "component"))
    kinds = placed.groupBy(F.col("node").alias("_node")).agg(F.min("c").alias("_lo"), F.max("c").alias("_hi"), F.count("*").alias("m"))
    kinds = cut_lineage(kinds.where("_lo < _hi").drop("_lo", "_hi"))
    return placed.join(kinds, F.col("node") == F.col("_node")).drop("_node")


def members_of(nodes: DataFrame, info: DataFrame, small: int) -> DataFrame:
    """Rows of nodes with what comparing needs, dealt into blocks of about ``small`` documents."""
    facts = info.select(F.col("doc_id").alias("_id"), F.col("n").cast("bigint").alias("n"), "bits", "sketch")
    joined = nodes.select("node", "doc_id", "c", "m").join(facts, F.col("doc_id") == F.col("_id")).drop("_id")
    sides = F.ceil(F.col("m") / small).cast("int")
    return joined.withColumn("sides", sides).withColumn("side", F.pmod(F.xxhash64("doc_id"), F.col("sides")).cast("int"))


def dense_nodes(members: DataFrame) -> DataFrame:
    """Nodes whose documents agree so much that branching would not make the work less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["node", "side"]):
            share = agreement(sketch_rows(group.column("sketch")))
            yield pa.RecordBatch.from_arrays([group.column("node")[:1], pa.array([share]), pa.array([group.num_rows])], ["node", "share", "rows"])

    ordered = members.repartition("node", "side").sortWithinPartitions("node", "side")
    blocks = ordered.mapInArrow(run, "node bigint, share double, rows bigint")
    means = blocks.groupBy(F.col("node").alias("_dense")).agg((F.sum(F.col("share") * F.col("rows")) / F.sum("rows")).alias("_share"))
    return means.where(F.col("_share") * BRANCHES > 1).select("_dense")


def grown(rows: DataFrame, info: DataFrame) -> DataFrame:
    """(node, used, doc_id) one level below the nodes of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, used = (batch.column(c).to_numpy().view(np.uint64) for c in ("node", "used"))
            row, path, used = children(sketch_rows(batch.column("sketch")), np.arange(batch.num_rows), path, used)
            yield pa.RecordBatch.from_arrays([as_long(path), as_long(used), batch.column("doc_id").take(pa.array(row))], ["node", "used", "doc_id"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    facts = info.select(F.col("doc_id").alias("_id"), "sketch")
    joined = rows.select("node", "used", "doc_id").join(facts, F.col("doc_id") == F.col("_id")).drop("_id")
    return joined.mapInArrow(run, f"node bigint, used bigint, doc_id {kind}")


def leaves(nodes: DataFrame, info: DataFrame, known: DataFrame, small: int) -> DataFrame:
    """(node, doc_id, c, m): nodes that are compared exhaustively. Nodes of more than ``small`` documents branch until they are
    small, dense, or of one component. Of first nodes with two documents the pair has been looked at with the smallest."""
    found, depth = [], FIRST_DEPTH
    open_ = cut_lineage(mixed(nodes.where("m > 2"), known))
    while True:
        large = open_.where(F.col("m") > small)
        found.append(open_.where(F.col("m") <= small).select("node", "doc_id", "c", "m"))
        if large.isEmpty():
            break
        dense = cut_lineage(dense_nodes(members_of(large, info, small)))
        is_dense = F.col("node") == F.col("_dense")
        stays = large if depth >= MOST_DEPTH else large.join(dense, is_dense, "left_semi")
        found.append(stays.select("node", "doc_id", "c", "m"))
        if depth >= MOST_DEPTH:
            break
        below = grown(large.join(dense, is_dense, "left_anti"), info)
        open_ = cut_lineage(mixed(shared_nodes(below), known))
        depth += 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return cut_lineage(out)


def may_link(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Drop pairs whose sizes or parity signatures rule a link out."""
    sides = [info.select(*[F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "n", "bits")]) for s in "ab"]
    known = pairs.join(sides[0], F.col("a") == F.col("doc_id_a")).join(sides[1], F.col("b") == F.col("doc_id_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, whole = SIMILAR
        for batch in batches:
            n = [batch.column(f"n_{s}").to_numpy().astype(np.int64) for s in "ab"]
            folded, widths = folded_signatures(pa.concat_arrays([batch.column("bits_a"), batch.column("bits_b")]))
            rows, ok = batch.num_rows, np.zeros(batch.num_rows, bool)
            narrow = np.minimum(widths[:rows], widths[rows:])
            for width, signature in folded.items():
                z = np.flatnonzero(narrow == width)
                apart = np.bitwise_count(signature[z] ^ signature[rows + z]).sum(axis=1, dtype=np.int64)
                ok[z] = apart * (whole + part) <= (n[0] + n[1])[z] * (whole - part)
            ok &= np.minimum(*n) * whole >= np.maximum(*n) * part
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return known.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, pairs.schema)


def connected(known: DataFrame, links: DataFrame) -> DataFrame:
    stems = known.select(F.col("component").alias("a"), F.col("id").alias("b")).where("a < b")
    return cut_lineage(components(stems.unionByName(links)))


def equal_sets(named: DataFrame) -> DataFrame:
    """(a, b): every document with the smallest one of the same set."""
    keys = ["n", "k1", "k2"]
    least = named.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("doc_id").alias("a"), F.count("*").alias("_m"))
    least = cut_lineage(least.where("_m > 1").drop("_m"))
    met = [F.col(k) == F.col(f"_{k}") for k in keys]
    return cut_lineage(named.select("doc_id", *keys).join(least, met).where("a < doc_id").select("a", F.col("doc_id").alias("b")).distinct())


def link(docs: DataFrame, shingle: int = SHINGLE, trees: int = TREES, small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n) of every row, and (id, component) of every document with a link."""
    info = cut_lineage(profile(docs, trees, shingle))
    named = info.where("doc_id IS NOT NULL AND n > 0")
    equal = equal_sets(named)
    copies = equal.select(F.col("b").alias("_copy")).distinct()
    single = named.select("doc_id", "nodes", "used").join(copies, F.col("doc_id") == F.col("_copy"), "left_anti").dropDuplicates(["doc_id"])
    rows = single.select("doc_id", F.explode(F.arrays_zip("nodes", "used")).alias("_n")).select("doc_id", F.col("_n.nodes").alias("node"), F.col("_n.used").alias("used"))
    nodes = shared_nodes(rows)
    named = named.dropDuplicates(["doc_id"])

    first = nodes.where("least < doc_id").select(F.col("least").alias("a"), F.col("doc_id").alias("b")).distinct()
    looked = cut_lineage(may_link(first, named))
    known = cut_lineage(components(equal.unionByName(verified(docs, looked, shingle))))

    members = cut_lineage(members_of(leaves(nodes, named, known, small), named, small))
    fresh = cut_lineage(central_pairs(members).join(looked, ["a", "b"], "left_anti"))
    if not fresh.isEmpty():
        known = connected(known, verified(docs, fresh, shingle))
        looked = looked.unionByName(fresh)
    fresh = cut_lineage(all_pairs(mixed(members.drop("sketch"), known)).join(looked, ["a", "b"], "left_anti"))
    if not fresh.isEmpty():
        known = connected(known, verified(docs, fresh, shingle))
    return info.select("doc_id", "n"), known


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, trees: int = TREES, small: int = SMALL) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    info, known = link(docs, shingle, trees, small)
    out = info.join(known.select(F.col("id").alias("_id"), "component"), F.col("doc_id") == F.col("_id"), "left")
    component: Column = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
