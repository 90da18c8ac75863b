"""SimHash near duplicates over a covering code.

Anchors are the codewords of nine Hamming [7,4] codes side by side on the low 63 bits, a perfect
covering: every fingerprint has exactly one nearest anchor, its home. Two fingerprints that differ
in 2 bits or fewer have one between them within 1 bit of both. So each fingerprint is replicated to
the home anchors of everything within 1 bit of it (at most 1 + 27 anchors), and any two that must be
linked meet at the home of what lies between them. With 2^36 anchors the cells stay small.

A cell never emits its pairs: linked members are merged inside and leave as a star, and the
components of all stars are found by joins. Equal fingerprints are one node throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgercast.llm.components import components
from ledgercast.llm.words import byte_words
from ledgercast.session import stage_path
from ledgercast.sources.stages import staged

SEED = 42
BLOCKS = 9
CELL_ROWS = 65_536
CLOSE = 2


# -- fingerprints --------------------------------------------------------------------------------


def fold(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; 0 for none."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, joined by one space; fewer words are one shingle."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([digest(joined[s:e], SEED) for s, e in spans], dtype=np.uint64)


def simhash(text: str | None, width: int = 3) -> int:
    """64-bit SimHash over the shingles of the lower-cased text, repeats included."""
    return fold(shingle_hashes(byte_words(text), width))


def fingerprint(width: int = 3) -> Callable[[Column], Column]:
    @F.pandas_udf(T.LongType())
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([simhash(t, width) for t in batch], dtype=np.uint64).view(np.int64))

    return of


# -- anchors -------------------------------------------------------------------------------------


def _homes_of_blocks() -> np.ndarray:
    """Nearest codeword of each 7-bit block: the parity checks name the bit that is wrong."""
    words = np.arange(128)
    syndrome = np.zeros(128, dtype=np.int64)
    for bit in range(7):
        syndrome ^= ((words >> bit) & 1) * (bit + 1)
    return np.where(syndrome > 0, words ^ (1 << np.maximum(syndrome - 1, 0)), words).astype(np.uint64)


HOMES = _homes_of_blocks()


def home(points: np.ndarray) -> np.ndarray:
    """The anchor nearest to each point. Bit 63 belongs to no block and every anchor has it 0."""
    anchor = np.zeros(points.shape, dtype=np.uint64)
    for block in range(BLOCKS):
        shift = np.uint64(7 * block)
        anchor |= HOMES[((points >> shift) & np.uint64(127)).astype(np.int64)] << shift
    return anchor


FLIPS = np.array([0] + [1 << b for b in range(64)], dtype=np.uint64)


def replicas(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of each point and the index of the point, without repeats."""
    anchors = np.sort(home(points[:, None] ^ FLIPS[None, :]), axis=1)
    fresh = np.ones(anchors.shape, dtype=bool)
    fresh[:, 1:] = anchors[:, 1:] != anchors[:, :-1]
    row, _ = np.nonzero(fresh)
    return anchors[fresh], row


# -- cells ---------------------------------------------------------------------------------------


def distances(point: np.uint64, points: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ point)


def cell_stars(points: np.ndarray, bits: int) -> np.ndarray:
    """For each member of a cell, the index of its group's first member.

    Groups grow from one member: what is linked to it joins and is asked next. Members that have
    joined are never compared again, so a dense cell costs a few passes over its members.
    """
    group = np.full(len(points), -1, dtype=np.int64)
    free = np.arange(len(points))
    while len(free):
        first, free = free[0], free[1:]
        group[first] = first
        asking = [first]
        while asking and len(free):
            near = distances(points[asking.pop()], points[free]) <= bits
            joined, free = free[near], free[~near]
            group[joined] = first
            asking.extend(joined.tolist())
    return group


def _pieces(batches: Iterator[pa.RecordBatch], columns: int = 3) -> Iterator[tuple[np.ndarray, ...]]:
    """Sorted (cell, node, point, …) columns, cut only between cells."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)))
        rows += batch.num_rows
        cells = held[-1][0]
        if rows >= CELL_ROWS and cells[0] != cells[-1]:
            keep = int(np.searchsorted(cells, cells[-1]))
            tail = tuple(c[keep:] for c in held[-1])
            held[-1] = tuple(c[:keep] for c in held[-1])
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, rows = [tail], len(tail[0])
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def cell_tree(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that join the members of a cell over their shortest distances of ``bits`` or fewer.

    Members within ``CLOSE`` bits of a leader hang on it, so a dense cell has few leaders. The leaders
    form a shortest spanning tree: whatever limit a later check sets, leaders that some chain of
    shorter steps joins stay joined by the tree.
    """
    a, b, leaders = [], [], []
    free = np.arange(len(points))
    while len(free):
        first, free = free[0], free[1:]
        near = distances(points[first], points[free]) <= CLOSE
        leaders.append(first)
        a.append(np.full(int(near.sum()), first))
        b.append(free[near])
        free = free[~near]
    out = np.array(leaders[1:], dtype=np.int64)
    best = np.full(len(out), 255, dtype=np.uint8)
    via = np.full(len(out), leaders[0], dtype=np.int64)
    last = leaders[0]
    while len(out):
        gap = distances(points[last], points[out])
        closer = gap < best
        best, via = np.where(closer, gap, best), np.where(closer, last, via)
        k = int(best.argmin())
        last = out[k]
        if best[k] <= bits:
            a.append(np.array([via[k]]))
            b.append(np.array([out[k]]))
        best[k], via[k], out[k] = best[-1], via[-1], out[-1]
        best, via, out = best[:-1], via[:-1], out[:-1]
    return np.concatenate(a), np.concatenate(b)


def star_pairs(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a cell's groups: first member and each other."""
    group = cell_stars(points, bits)
    member = np.flatnonzero(group != np.arange(len(points)))
    return group[member], member


def _links_in_cells(bits: int, join):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells, nodes, points in _pieces(batches):
            points = points.view(np.uint64)
            starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            sizes = np.diff(np.r_[starts, len(cells)])
            pairs = starts[sizes == 2]
            near = pairs[np.bitwise_count(points[pairs] ^ points[pairs + 1]) <= bits]
            a, b = [nodes[near]], [nodes[near + 1]]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                first, second = join(points[start : start + size], bits)
                a.append(nodes[start + first])
                b.append(nodes[start + second])
            left, right = np.concatenate(a), np.concatenate(b)
            other = left != right
            edges = pd.DataFrame({"a": left[other], "b": right[other]}).drop_duplicates()
            yield pa.RecordBatch.from_pandas(edges, preserve_index=False)

    return links


def cell_links(members: DataFrame, bits: int, join=star_pairs) -> DataFrame:
    """Edges ``a, b`` from rows ``cell, node, point``: fewer than members in every cell."""
    dealt = members.repartition("cell").sortWithinPartitions("cell", "node")
    return dealt.mapInArrow(_links_in_cells(bits, join), "a long, b long")


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for start in range(0, len(points), 8192):
            part = points[start : start + 8192]
            anchors, row = replicas(part)
            node = part[row].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(node), pa.array(node)], ["cell", "node", "point"])


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id``, a row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of ``bits`` (at most 2) or fewer
    differing bits. Null and blank texts have fingerprint zero and link like any other. Null ids
    never name a component unless it has no other.
    """
    if not 0 <= bits <= 2:
        raise ValueError("the anchors cover fingerprints that differ in up to 2 bits")
    spark = docs.sparkSession
    prints = staged(docs.select("doc_id", fingerprint(width)("text").alias("print")), stage_path(spark, "prints"))
    nodes = prints.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    members = nodes.select("print").mapInArrow(_replicate, "cell long, node long, point long")
    roots = components(cell_links(members, bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(named, "root").select("print", "component_id")
    return prints.join(labels, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


# -- near duplicates by shingle similarity -------------------------------------------------------
#
# Texts a and b with a similarity of 0.8 share four fifths of the larger set. In any fixed order of all
# shingles, the first fifth (and one more) of a then holds a shingle of the first fifth of b: every such
# pair meets in the cell of a shingle. The order is by hash, shingles that many texts have come last; it
# decides the cost, never the result. The shared shingles of each pair decide exactly.

SHINGLE = 5
SAMPLED = 16  # one text of so many is counted for the order
HOT = 8  # sampled texts that make a shingle hot
HOT_SHINGLES = 100_000
SMALL_CELL = 16
SALT_ROWS = 1024
PART_ROWS = 4096
SLICE = 256  # texts whose shingles are held at once
PRINTS = "identity binary, point long, size int, prefix array<long>"


def identity(words: list[bytes]) -> bytes:
    """Identity of a word sequence, 128 bits."""
    return xxhash.xxh3_128_digest(b" ".join(words), SEED)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def prefix(shingles: np.ndarray, hot: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first of a text's sorted distinct shingles, as many as a text with 0.8 in common cannot miss.

    ``hot`` is sorted; the order is by hash, then hot shingles by rank.
    """
    count = len(shingles) - (4 * len(shingles) + 4) // 5 + 1 if len(shingles) else 0
    if not len(hot):
        return shingles[:count]
    at = np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)
    is_hot = hot[at] == shingles
    last = at[is_hot]
    return np.concatenate([shingles[~is_hot], hot[last[np.argsort(rank[last])]]])[:count]


def _by_slices(make: Callable[[list, list[str | None]], list[pa.Array]], names: list[str]):
    """``make`` of the kept columns and the texts (the last column), some rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                part = batch.slice(first, SLICE)
                *kept, texts = part.columns
                yield pa.RecordBatch.from_arrays(make(kept, texts.to_pylist()), names)

    return run


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate([np.empty(0, dtype=np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def all_prints(docs: DataFrame, hot: np.ndarray, rank: np.ndarray) -> DataFrame:
    """``doc_id``, identity of the word sequence, SimHash of its five-word shingles, their number and prefix."""

    def make(kept: list, texts: list[str | None]) -> list[pa.Array]:
        words = [byte_words(t) for t in texts]
        hashes = [shingle_hashes(w, SHINGLE) for w in words]
        distinct = [np.unique(h) for h in hashes]
        return [
            *kept, pa.array([identity(w) for w in words], pa.binary()), pa.array([_signed(fold(h)) for h in hashes], pa.int64()),
            pa.array([len(d) for d in distinct], pa.int32()), _lists([prefix(d, hot, rank) for d in distinct]),
        ]

    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(PRINTS).fields])
    return docs.select("doc_id", "text").mapInArrow(_by_slices(make, schema.names), schema)


def _cells(kept: list, texts: list[str | None]) -> list[pa.Array]:
    return [_lists(text_sets(texts)).flatten()]


def text_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    return [np.unique(shingle_hashes(byte_words(t), SHINGLE)) for t in texts]


def hot_shingles(docs: DataFrame) -> DataFrame:
    """``cell, texts``: the commonest shingles by a count over a sample of the distinct texts."""
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0).select("text").distinct()
    counted = sample.mapInArrow(_by_slices(_cells, ["cell"]), "cell long").groupBy("cell").agg(F.count("*").alias("texts"))
    return counted.where(F.col("texts") >= HOT).orderBy(F.desc("texts"), "cell").limit(HOT_SHINGLES)


def alike(size: np.ndarray, place: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sizes and places of a shared shingle leave pairs a similarity of 0.8.

    In one of a pair's cells the shingle is its first shared one, so no more than what follows is shared.
    """
    most = np.minimum(size[a] - place[a], size[b] - place[b])
    either = size[a] + size[b]
    return (5 * np.minimum(size[a], size[b]) >= 4 * np.maximum(size[a], size[b])) & (9 * most >= 4 * either)


CELL_ROWS_OUT = "node long, other long, cell long, size int, place int"


def _cell_batch(node, other, cell, size, place) -> pa.RecordBatch:
    none = lambda kind: pa.nulls(len(node), kind)
    columns = [
        pa.array(node, pa.int64()), none(pa.int64()) if other is None else pa.array(other, pa.int64()),
        none(pa.int64()) if cell is None else pa.array(cell, pa.int64()),
        none(pa.int32()) if size is None else pa.array(size, pa.int32()), none(pa.int32()) if place is None else pa.array(place, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["node", "other", "cell", "size", "place"])


def _pair_batches(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    pairs = pd.DataFrame({"node": np.minimum(a, b), "other": np.maximum(a, b)}).drop_duplicates()
    yield _cell_batch(pairs["node"].to_numpy(), pairs["other"].to_numpy(), None, None, None)


def _prefix_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``node, other`` of cells: all of a small cell, a shortest spanning tree of a large one.

    The members of large cells leave as well, with their cell, as the tree does not hold all pairs.
    """
    for keys, nodes, points, cells, size, place, salted in _pieces(batches, 7):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        large = (sizes > SMALL_CELL) | salted[starts]
        cells = np.where(salted, cells, keys)
        row_large, left = np.repeat(large, sizes), np.repeat(sizes, sizes) - (np.arange(len(keys)) - np.repeat(starts, sizes))
        a, b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for step in range(1, SMALL_CELL):
            first = np.flatnonzero((left > step) & ~row_large)
            a.append(first)
            b.append(first + step)
        points = points.view(np.uint64)
        for start, count in zip(starts[large].tolist(), sizes[large].tolist()):
            first, second = cell_tree(points[start : start + count], 64)
            a.append(start + first)
            b.append(start + second)
        a, b = np.concatenate(a), np.concatenate(b)
        fit = alike(size, place, a, b)
        a, b = nodes[a[fit]], nodes[b[fit]]
        yield from _pair_batches(a, b)
        if large.any():
            yield _cell_batch(nodes[row_large], None, cells[row_large], size[row_large], place[row_large])


@F.pandas_udf(T.BinaryType())
def identity_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([identity(byte_words(t)) for t in batch])


SPREAD = 4  # bits of a bitmap for each shingle, at least
NEAREST = 4


def bitmap(distinct: np.ndarray) -> bytes:
    """A power of two of bits, ``SPREAD`` for each shingle or more, with the low bits of the hashes set."""
    width = max(64, 1 << int(SPREAD * len(distinct) - 1).bit_length()) if len(distinct) else 64
    bits = np.zeros(width, dtype=bool)
    bits[(distinct & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _with_bits(kept: list, texts: list[str | None]) -> list[pa.Array]:
    sets = text_sets(texts)
    return [*kept, pa.array([len(x) for x in sets], pa.int32()), pa.array([bitmap(x) for x in sets], pa.binary())]


def _with_sets(kept: list, texts: list[str | None]) -> list[pa.Array]:
    return [*kept, _lists(text_sets(texts))]


def shingle_bits(texts: DataFrame) -> DataFrame:
    """``node, size, bits``: number of distinct shingles and their bitmap."""
    return texts.select("node", "text").mapInArrow(_by_slices(_with_bits, ["node", "size", "bits"]), "node long, size int, bits binary")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``node, shingles``: the distinct shingles."""
    return texts.select("node", "text").mapInArrow(_by_slices(_with_sets, ["node", "shingles"]), "node long, shingles array<long>")


def differing_bits(bitmaps: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which the bitmaps of each pair differ; the wider one is folded to the width of the other.

    Every such bit is an element of one set alone, so sets of a similarity of 0.8 differ in a ninth
    of both sizes at most.
    """
    words = np.fromiter((len(x) // 8 for x in bitmaps), dtype=np.int64, count=len(bitmaps))
    common = np.minimum(words[a], words[b])
    out = np.zeros(len(a), dtype=np.int64)
    for width in np.unique(common).tolist():
        pairs = np.flatnonzero(common == width)
        members, at = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
        table = np.empty((len(members), width), dtype=np.uint64)
        for row, member in enumerate(members.tolist()):
            whole = np.frombuffer(bitmaps[member], dtype=np.uint64)
            table[row] = np.bitwise_or.reduce(whole.reshape(-1, width), axis=0)
        step = max(1, COMPARED // width)
        for start in range(0, len(pairs), step):
            left, right = at[: len(pairs)][start : start + step], at[len(pairs) :][start : start + step]
            out[pairs[start : start + step]] = np.bitwise_count(table[left] ^ table[right]).sum(axis=1)
    return out


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size_a, size_b = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 4))
        count = batch.num_rows
        bits = batch.column(3).to_pylist() + batch.column(5).to_pylist()
        fit = size_a + size_b >= 9 * differing_bits(bits, np.arange(count), count + np.arange(count))
        yield batch.select(["a", "b"]).filter(pa.array(fit))


def _of_nodes(pairs: DataFrame, texts_of: Callable[[DataFrame], DataFrame], made: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """What ``made`` gives of the texts in ``pairs``, written once, with its columns named for either side."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    rows = staged(made(texts_of(asked)), stage_path(pairs.sparkSession, made.__name__.replace("_", "-")))
    return [rows.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in rows.columns[1:]]) for side in "ab"]


def possible_links(links: DataFrame, texts_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The ``links`` (a, b) whose bitmaps leave them a similarity of 0.8."""
    bits_a, bits_b = _of_nodes(links, texts_of, shingle_bits)
    met = links.join(bits_b, "b").join(bits_a, "a").select("a", "b", "size_a", "bits_a", "size_b", "bits_b")
    return staged(met.mapInArrow(_possible, "a long, b long"), stage_path(links.sparkSession, "possible"))


def similar_links(links: DataFrame, texts_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The ``links`` (a, b) whose texts share four fifths or more of all their five-word shingles.

    ``texts_of`` gives ``node, text`` for a table of nodes. Whole sets travel with every link, so bitmaps
    should have sorted most out before. A node with very many links meets them in a join whose other side
    is its one row, so adaptive execution may split it.
    """
    sets_a, sets_b = _of_nodes(links, texts_of, shingle_sets)
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    either = F.size("shingles_a") + F.size("shingles_b") - shared
    return links.join(sets_b, "b").join(sets_a, "a").where(5 * shared >= 4 * either).select("a", "b")


COMPARED = 1 << 21


def _nearest(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Index of the pairs that are among the ``NEAREST`` least apart of one of their members."""
    of, pair = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
    order = np.lexsort((pair, np.tile(apart, 2), of))
    of = of[order]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    return np.unique(pair[order[place < NEAREST]])


def _rest_of_cells(nearest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs ``node, other`` of a cell that no links join yet and whose sizes, places and bitmaps leave a
    similarity of 0.8: all, or each member's nearest.

    Cells come in parts; a pair of two parts meets in the cell of both. Sizes that are too far apart
    are never compared.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, nodes, roots, size, place, bits in _pieces(batches, 6):
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                order = start + np.argsort(size[start:end], kind="stable")
                sizes, left, root = size[order].astype(np.int64), (size[order] - place[order]).astype(np.int64), roots[order]
                bitmaps, names = bits[order].tolist(), nodes[order]
                stop = np.searchsorted(4 * sizes, 5 * sizes, side="right")
                first = 0
                while first < len(order):
                    last = min(len(order), first + max(1, COMPARED // max(1, int(stop[first]) - first)))
                    i, j = np.arange(first, last)[:, None], np.arange(first, int(stop[last - 1]))[None, :]
                    fit = (j > i) & (root[i] != root[j]) & (9 * np.minimum(left[i], left[j]) >= 4 * (sizes[i] + sizes[j]))
                    a, b = np.nonzero(fit & (j < stop[i]))
                    a, b = first + a, first + b
                    apart = 9 * differing_bits(bitmaps, a, b) / (sizes[a] + sizes[b])
                    a, b, apart = a[apart <= 1], b[apart <= 1], apart[apart <= 1]
                    if nearest:
                        chosen = _nearest(a, b, apart)
                        a, b = a[chosen], b[chosen]
                    if len(a):
                        yield from _pair_batches(names[a], names[b])
                    first = last

    return pairs


def prefix_pairs(nodes: DataFrame, hot: DataFrame) -> DataFrame:
    """Pairs ``node, other`` of texts that share a shingle of their prefixes, and the members ``node, cell,
    size, place`` of large cells. Hot cells are dealt in salted parts."""
    members = nodes.select("node", "point", "size", F.posexplode("prefix").alias("place", "cell")).join(F.broadcast(hot), "cell", "left")
    parts = F.ceil(F.col("texts") * SAMPLED / SALT_ROWS)
    salted = F.xxhash64("cell", F.pmod(F.xxhash64("node"), parts))
    keyed = members.select(
        F.when(F.col("texts").isNull(), F.col("cell")).otherwise(salted).alias("key"), "node", "point",
        F.when(F.col("texts").isNotNull(), F.col("cell")).otherwise(0).alias("cell"), "size", "place",
        F.col("texts").isNotNull().alias("salted"),
    )
    dealt = keyed.repartition("key").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(_prefix_cells, CELL_ROWS_OUT)


def rest_pairs(members: DataFrame, roots: DataFrame, bits: DataFrame, nearest: bool) -> DataFrame:
    """Pairs ``a, b`` of large cells whose members are in different groups so far."""
    rooted = members.join(roots, "node", "left").select("node", "cell", "size", "place", F.coalesce("root", "node").alias("root"))
    rooted = staged(rooted, stage_path(members.sparkSession, "rooted"))
    open_cells = rooted.groupBy("cell").agg(F.count("*").alias("rows"), F.min("root").alias("least"), F.max("root").alias("most"))
    open_cells = open_cells.where("least < most").select("cell", F.ceil(F.col("rows") / PART_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    met = rooted.join(open_cells, "cell").withColumn("part", part).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keyed = met.join(bits, "node").select(
        F.xxhash64("cell", F.least("part", "with"), F.greatest("part", "with")).alias("key"), "node", "root", "size", "place", "bits"
    )
    dealt = keyed.repartition("key").sortWithinPartitions("key", "node")
    pairs = dealt.mapInArrow(_rest_of_cells(nearest), CELL_ROWS_OUT)
    return pairs.select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()


def anchored_links(nodes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of each text and the leader of its group over the covering code: texts whose SimHashes
    are joined by steps of ``CLOSE`` bits or fewer."""
    points = staged(nodes.groupBy("point").agg(F.min("node").alias("leader")), stage_path(nodes.sparkSession, "points"))
    members = points.select("point").mapInArrow(_replicate, "cell long, node long, point long")
    roots = components(cell_links(members, CLOSE)).withColumnRenamed("node", "point")
    rooted = points.join(roots, "point", "left").select("point", F.coalesce("root", "point").alias("root"))
    led = rooted.join(points.withColumnRenamed("point", "root"), "root").select("point", "leader")
    pairs = nodes.select("node", "point").join(led, "point").where("node <> leader")
    return pairs.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b"))


def between_groups(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The ``links`` (a, b) whose ends are not in one group yet."""
    ends = links
    for side in "ab":
        ends = ends.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    return ends.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def similar_groups(nodes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], hot: DataFrame) -> DataFrame:
    """``node, root`` of texts linked by a similarity of 0.8.

    SimHash groups of the covering code come first: each text is checked against its group's leader. The
    prefix filter then finds the pairs that fingerprints miss, between groups only. A large cell first joins its members by a tree, then each to the nearest of other groups; then every
    pair of it that is not in one group yet is decided. So a dense group costs its members and no
    pair is left out.
    """
    spark = nodes.sparkSession
    anchored = staged(anchored_links(nodes), stage_path(spark, "anchored"))
    close = staged(similar_links(anchored, texts_of), stage_path(spark, "close"))
    groups = staged(components(close), stage_path(spark, "groups"))
    met = staged(prefix_pairs(nodes, hot), stage_path(spark, "met"))
    links = met.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
    tried = staged(between_groups(links.distinct(), groups), stage_path(spark, "links"))
    similar = similar_links(possible_links(tried, texts_of), texts_of)
    similar = staged(close.union(similar), stage_path(spark, "similar"))
    members = met.where("other IS NULL")
    if members.isEmpty():
        return components(similar)
    bits = staged(shingle_bits(texts_of(members.select("node").distinct())).select("node", "bits"), stage_path(spark, "bitmaps"))
    roots = staged(components(similar), stage_path(spark, "roots"))
    for nearest in (True, False):
        rest = rest_pairs(members, roots, bits, nearest).join(tried, ["a", "b"], "left_anti")
        rest = staged(rest, stage_path(spark, "rest"))
        if rest.isEmpty():
            continue
        more = similar_links(rest, texts_of)
        edges = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(more.select("a", "b"))
        roots = staged(components(edges), stage_path(spark, "roots"))
        tried = tried.union(rest)
    return roots


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates, in its own columns: of each group the row with the smallest
    doc_id stays (null ids last), and of equal rows one.

    Texts with the same lower-cased words are one, told by 128 bits; null and blank texts are all the same
    text. Every distinct text gets a number, written once, which stands for it in links and cells.
    """
    spark = docs.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    hot = staged(hot_shingles(docs), stage_path(spark, "hot"))
    common = hot.orderBy("texts", "cell").toPandas()  # at most HOT_SHINGLES rows
    cells = common["cell"].to_numpy(dtype=np.int64).view(np.uint64)
    by_hash = np.argsort(cells)
    prints = all_prints(docs, cells[by_hash], by_hash)
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"))
    distinct = prints.groupBy("identity").agg(F.min(rank).alias("best"), *[F.first(c).alias(c) for c in ("point", "size", "prefix")])
    nodes = staged(distinct.withColumn("node", F.monotonically_increasing_id()), stage_path(spark, "nodes"))

    def texts_of(asked: DataFrame) -> DataFrame:
        wanted = nodes.join(asked, "node", "left_semi").select("node", "identity")
        texts = docs.select(identity_of("text").alias("identity"), "text").join(wanted, "identity")
        return texts.groupBy("node").agg(F.first("text").alias("text"))

    roots = similar_groups(nodes, texts_of, hot)
    grouped = nodes.select("node", "identity", "best").join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "identity", "best")
    best = grouped.groupBy("root").agg(F.min(F.struct("best", "identity")).alias("b"))
    own_key = lambda identity, id: F.concat(F.hex(identity), F.when(id.isNull(), "-").otherwise(F.concat(F.lit("+"), id.cast("string"))))
    kept = best.select(own_key(F.col("b.identity"), F.col("b.best.id")).alias("own"))
    mine = docs.select(row, own_key(identity_of("text"), F.col("doc_id")).alias("own"))
    return mine.join(kept, "own", "left_semi").groupBy("own").agg(F.first("row").alias("row")).select("row.*")
