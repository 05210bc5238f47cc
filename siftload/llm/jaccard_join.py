"""N-gram Jaccard self-join: size-banded tiles, bitmap bounds, exact intersection of sorted arrays, and the linked components."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.llm.common import text_runs
from siftload.sources.staging import staged

# Counters of the rarity table, and of the table of documents that take part: fixed sizes, whatever the input.
SLOTS = 1 << 22
CHUNK = 1 << 16
# Sets in one block of a tile, and elements of all sets in it; tiles that hang together are one up to GROUP_ such.
BLOCK_SETS, BLOCK_ELEMENTS = 1024, 1 << 20
GROUP_SETS, GROUP_ELEMENTS = 1 << 14, 8 << 20
# Bytes that are kept of an element where sets are compared, and the most bits of a bitmap.
ELEMENT_BYTES, MOST_BITS = 5, 1 << 12
# Words a Python worker keeps the hashes of.
MOST_KEPT = 1 << 19

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = WordHashes()


def shingle_set(text: str | None, words_per_shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; of a shorter text, one for the whole; of none, no element."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    width = min(words_per_shingle, len(words))
    hashed = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = (total ^ hashed[i : len(words) - width + 1 + i]) * _MIX[i % len(_MIX)]
        total ^= total >> np.uint64(29)
    return np.unique(total)


def set_id(elements: np.ndarray) -> int:
    """One id for equal sets."""
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)


def slot_of(values: np.ndarray) -> np.ndarray:
    return ((values * _MIX[0]) >> np.uint64(64 - 22)).astype(np.int64)


def doc_slot(ids: np.ndarray) -> np.ndarray:
    return slot_of(ids.astype(np.int64).view(np.uint64))


def packed(elements: np.ndarray) -> bytes:
    """Elements cut to ELEMENT_BYTES, sorted: two different ones agree once in 2**40 pairs."""
    short = np.sort(elements & np.uint64((1 << 8 * ELEMENT_BYTES) - 1))
    return short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ELEMENT_BYTES].tobytes()


def unpacked(raw: pa.Buffer) -> np.ndarray:
    short = np.frombuffer(raw, np.uint8).reshape(-1, ELEMENT_BYTES)
    wide = np.zeros((len(short), 8), np.uint8)
    wide[:, :ELEMENT_BYTES] = short
    return wide.view("<u8").ravel()


def bitmap(elements: np.ndarray) -> bytes:
    """One bit per element by its hash; about as many bits as elements, a power of two, MOST_BITS at most."""
    bits = min(MOST_BITS, 1 << max(6, int(len(elements) - 1).bit_length()))
    held = np.zeros(bits, bool)
    held[(elements & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(held, bitorder="little").tobytes()


def trim_hashes() -> None:
    if len(_hashes) > MOST_KEPT:
        _hashes.clear()


# ---------------------------------------------------------------- tables of fixed size


def chunk_rows(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for i in range(0, SLOTS, CHUNK):
        part = counts[i : i + CHUNK]
        if part.any():
            yield i // CHUNK, zlib.compress(part.astype("<u4").tobytes(), 1)


def added_up(chunks: DataFrame) -> np.ndarray:
    """The sum of all tasks' tables (chunk, counts), added up by chunk on the executors; SLOTS numbers in the end."""
    import pandas as pd

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, np.uint64)
        for raw in frame["counts"]:
            total += np.frombuffer(zlib.decompress(raw), "<u4")
        packed = zlib.compress(np.minimum(total, np.iinfo(np.uint32).max).astype("<u4").tobytes(), 1)
        return pd.DataFrame({"chunk": [frame["chunk"].iloc[0]], "counts": [packed]})

    out = np.zeros(SLOTS, np.uint32)
    for row in chunks.groupBy("chunk").applyInPandas(add, "chunk int, counts binary").toLocalIterator():
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(row["counts"]), "<u4")
    return out


# ---------------------------------------------------------------- passes over the texts


def read_sets(docs: DataFrame, words_per_shingle: int) -> tuple[DataFrame, np.ndarray]:
    """doc_id, text_hash, n, set (id of the element set) and bitmap of every row, and how often each slot's elements occur in all."""
    names = ["doc_id", "text_hash", "n", "set", "bitmap", "chunk", "counts"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint32)
        for batch in text_runs(batches, "text"):
            trim_hashes()
            sets = [shingle_set(t, words_per_shingle) for t in batch.column(1).to_pylist()]
            if sets:
                counts += np.bincount(slot_of(np.concatenate(sets)), minlength=SLOTS).astype(np.uint32)
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id(s) for s in sets], pa.int64()), pa.array([bitmap(s) for s in sets], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                names,
            )
        rows = list(chunk_rows(counts))
        none = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.nulls(len(rows), pa.binary()), pa.array([c for c, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names
        )

    schema = "doc_id long, text_hash long, n long, set long, bitmap binary, chunk int, counts binary"
    found = staged(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(read, schema))
    counts = added_up(found.where("chunk IS NOT NULL").select("chunk", "counts"))
    return found.where("chunk IS NULL").select("doc_id", "text_hash", "n", "set", "bitmap"), counts


def prefix_tokens(docs: DataFrame, counts: np.ndarray, words_per_shingle: int, percent: int) -> DataFrame:
    """token, set and n: the necessary prefix of each distinct set.

    Elements are ordered by how often their slot occurs, then by hash. Two sets that reach the similarity share at least
    one of their first n - ceil(similarity * n) + 1 elements in any common order; this one makes those rare.
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches, "text"):
            trim_hashes()
            ids, sizes, kept = [], [], []
            for text in batch.column(0).to_pylist():
                elements = shingle_set(text, words_per_shingle)
                n = len(elements)
                if n:
                    first = n + (-percent * n // 100) + 1
                    order = np.lexsort((elements, counts[slot_of(elements)]))[:first]
                    ids.append(set_id(elements))
                    sizes.append(n)
                    kept.append(elements[order].astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary())], ["set", "n", "prefix"])

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).to_pylist()
            lengths = np.array([len(b) // 8 for b in raw], np.int64)
            tokens = np.frombuffer(b"".join(raw), "<i8")
            sets, n = (np.repeat(batch.column(i).to_numpy(), lengths) for i in (0, 1))
            for i in range(0, len(tokens), 1 << 18):
                part = slice(i, i + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(tokens[part]), pa.array(sets[part]), pa.array(n[part])], ["token", "set", "n"])

    each = docs.select("text").mapInArrow(prefixes, "set long, n long, prefix binary")
    distinct = each.groupBy("set", "n").agg(F.first("prefix").alias("prefix"))
    return distinct.mapInArrow(apart, "token long, set long, n long")


def elements_of(docs: DataFrame, wanted: np.ndarray, words_per_shingle: int) -> DataFrame:
    """set and elements (sorted) of documents whose id falls on a marked slot; each set once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = wanted > 0
        for batch in text_runs(batches, "text"):
            trim_hashes()
            ids = batch.column(0)
            take = np.array(ids.is_null()) | marked[doc_slot(ids.fill_null(0).cast(pa.int64()).to_numpy())]
            sets = [shingle_set(t, words_per_shingle) for t in batch.column(1).filter(pa.array(take)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_id(s) for s in sets], pa.int64()), pa.array([packed(s) for s in sets], pa.binary())], ["set", "elements"]
            )

    each = docs.select("doc_id", "text").mapInArrow(read, "set long, elements binary")
    return each.groupBy("set").agg(F.first("elements").alias("elements"))


def marked_slots(ids: DataFrame) -> np.ndarray:
    """Counts by slot of the ids (doc_id)."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            known = batch.column(0).drop_null().to_numpy()
            np.add.at(counts, doc_slot(known), 1)
        rows = list(chunk_rows(counts))
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], ["chunk", "counts"])

    return added_up(ids.select("doc_id").mapInArrow(mark, "chunk int, counts binary"))


# ---------------------------------------------------------------- tiles


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """(starts, rows) of sorted batches, cut so that no run of equal keys is broken. starts has the end as its last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if held and held[-1].column(key)[0].as_py() != keys[-1]:
            held.append(batch.slice(0, last))
            yield _cut(held, key)
            held = [batch.slice(last)]
        elif held or not last:
            held.append(batch)
        else:
            yield _cut([batch.slice(0, last)], key)
            held = [batch.slice(last)]
    if held:
        yield _cut(held, key)


def _cut(batches: list[pa.RecordBatch], key: str) -> tuple[np.ndarray, pa.Table]:
    rows = pa.Table.from_batches(batches)
    keys = rows.column(key).to_numpy()
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]), rows


def size_bands(sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Stretches of ascending sizes in which neighbours can still reach the similarity, two or more long."""
    breaks = np.flatnonzero(percent * sizes[1:] > 100 * sizes[:-1]) + 1
    for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(sizes)], strict=True):
        if b - a > 1:
            yield a, b


def blocks_of(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Cuts of ascending sizes into blocks of bounded number and total size."""
    out, start = [], 0
    sums = np.concatenate([[0], np.cumsum(sizes)])
    while start < len(sizes):
        end = min(start + BLOCK_SETS, max(start + 1, int(np.searchsorted(sums, sums[start] + BLOCK_ELEMENTS, side="right")) - 1))
        out.append((start, end))
        start = end
    return out


def tiles_of(tokens: DataFrame, percent: int) -> DataFrame:
    """tile and set: the sets of a token, in bands of size, cut into blocks; a tile is a block, or two that can link.

    Tokens with the same sets give the same tile once."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for starts, rows in runs(batches, "token"):
            several = np.flatnonzero(np.diff(starts) > 1)
            if not len(several):
                continue
            sets, n = rows.column("set").to_numpy(), rows.column("n").to_numpy()
            made: list[tuple[int, np.ndarray]] = []
            held = 0
            for r in several.tolist():
                for a, b in size_bands(n[starts[r] : starts[r + 1]], percent):
                    own, sizes = sets[starts[r] + a : starts[r] + b], n[starts[r] + a : starts[r] + b]
                    blocks = blocks_of(sizes)
                    for i, (c, d) in enumerate(blocks):
                        for j, (e, f) in enumerate(blocks[i:], start=i):
                            if percent * sizes[e] > 100 * sizes[d - 1] or (i == j and d - c < 2):
                                continue
                            members = own[c:d] if i == j else np.concatenate([own[c:d], own[e:f]])
                            tile = xxhash.xxh3_64_intdigest(np.sort(members).tobytes()) - (1 << 63)
                            if tile in seen:
                                continue
                            if len(seen) > 1 << 20:
                                seen.clear()
                            seen.add(tile)
                            made.append((tile, members))
                            held += len(members)
                            if held > 1 << 18:
                                yield _tile_rows(made)
                                made, held = [], 0
            if made:
                yield _tile_rows(made)

    ordered = tokens.repartition("token").sortWithinPartitions("token", "n", "set")
    return ordered.mapInArrow(make, "tile long, set long").distinct()


def _tile_rows(made: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    lengths = [len(m) for _, m in made]
    tiles = np.repeat(np.array([t for t, _ in made], np.int64), lengths)
    return pa.RecordBatch.from_arrays([pa.array(tiles), pa.array(np.concatenate([m for _, m in made]))], ["tile", "set"])


def may_link(sizes: np.ndarray, maps: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Pairs (i, j) that join all sets whose sizes and bitmaps leave open that they are linked. ``sizes`` ascend.

    An element whose bit the other set lacks is in no overlap, so the overlap is at most a set's size less its bits that
    the other lacks. Maps of different lengths are compared at the shorter one, the longer folded onto it.
    """
    widths = np.array([len(m) // 8 for m in maps])
    at_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for width in np.unique(widths).tolist():
        table = np.zeros((len(maps), width), np.uint64)
        for i in np.flatnonzero((widths == width) | (widths == 2 * width)).tolist():
            own = np.frombuffer(maps[i], "<u8")
            table[i] = own if len(own) == width else own[:width] | own[width:]
        at_width[width] = table, np.bitwise_count(table).sum(1, dtype=np.int64)
    pairs: list[tuple[int, int]] = []
    left = np.arange(len(maps))
    while len(left) > 1:
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            p = reached.pop()
            low, high = np.searchsorted(sizes[left], [-(-percent * sizes[p] // 100), 100 * sizes[p] // percent + 1])
            near = left[low:high]
            found = []
            for width in (int(widths[p]) // 2, int(widths[p])):
                # The shorter map's width: that of the other set if it is shorter, else that of this one.
                same = near[(widths[near] == width) if width < widths[p] else (widths[near] >= width)]
                if not len(same) or width not in at_width:
                    continue
                table, bits = at_width[width]
                shared = np.bitwise_count(table[same] & table[p]).sum(1, dtype=np.int64)
                most = np.minimum(sizes[p] - (bits[p] - shared), sizes[same] - (bits[same] - shared))
                found.append(same[(100 + percent) * most >= percent * (sizes[p] + sizes[same])])
            joined = np.concatenate(found) if found else np.zeros(0, np.int64)
            if len(joined):
                pairs.extend((p, i) for i in joined.tolist())
                reached.extend(joined.tolist())
                left = left[~np.isin(left, joined)]
    return pairs


def likely_links(tiles: DataFrame, sized: DataFrame, percent: int) -> DataFrame:
    """a and b: pairs that join, in every tile, the sets that bitmaps can't keep apart. ``sized`` has set, n, bitmap."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, rows in runs(batches, "tile"):
            ids, n, maps = rows.column("set").to_numpy(), rows.column("n").to_numpy(), rows.column("bitmap").to_pylist()
            a, b = [], []
            for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                for i, j in may_link(n[start:end], maps[start:end], percent):
                    a.append(ids[start + i])
                    b.append(ids[start + j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    full = tiles.join(sized, "set").select("tile", "set", "n", "bitmap")
    return full.repartition("tile").sortWithinPartitions("tile", "n").mapInArrow(link, "a long, b long").distinct()


def joined_tiles(tiles: DataFrame, sized: DataFrame, percent: int) -> DataFrame:
    """tile and set, where all that bitmaps can't keep apart is one tile as long as it is not too large.

    The sets of a group of near duplicates share many tokens, and every token's tile is another part of the group; as
    one tile each set is sent once. What hangs together beyond GROUP_SETS or GROUP_ELEMENTS stays in its tokens' tiles.
    """
    roots = staged(components(likely_links(tiles, sized, percent)))
    groups = roots.join(sized.select("set", "n"), roots["node"] == F.col("set")).groupBy("root").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("elements"))
    large = groups.where((F.col("sets") > GROUP_SETS) | (F.col("elements") > GROUP_ELEMENTS)).select("root")
    small = roots.join(large, "root", "left_anti").select(F.col("root").alias("tile"), F.col("node").alias("set"))
    apart = roots.join(large, "root", "left_semi").select(F.col("node").alias("set"))
    return staged(small.unionByName(tiles.join(apart, "set", "left_semi").select("tile", "set")))


def overlaps(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Common elements of one sorted array with each of several."""
    every = np.concatenate(others)
    owner = np.repeat(np.arange(len(others)), [len(o) for o in others])
    at = np.minimum(np.searchsorted(own, every), len(own) - 1)
    return np.bincount(owner[own[at] == every], minlength=len(others))


def links_in_tile(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that join what is linked in the tile; links between sets already joined are left out.

    From each set reached, those not reached yet are tried: by size, then by the bound of the bitmaps (an element whose
    bit the other set lacks is in no overlap), and what is left by intersecting the sorted arrays.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    bits = min(MOST_BITS, 1 << max(6, int(sizes.max() - 1).bit_length()))
    maps = np.zeros((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        at = (s & np.uint64(bits - 1)).astype(np.int64)
        np.bitwise_or.at(maps[i], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    set_bits = np.bitwise_count(maps).sum(1, dtype=np.int64)
    links: list[tuple[int, int]] = []
    left = np.arange(len(sets))
    while len(left) > 1:
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            p = reached.pop()
            near = left[(percent * sizes[left] <= 100 * sizes[p]) & (percent * sizes[p] <= 100 * sizes[left])]
            if not len(near):
                continue
            shared = np.bitwise_count(maps[near] & maps[p]).sum(1, dtype=np.int64)
            most = np.minimum(sizes[p] - (set_bits[p] - shared), sizes[near] - (set_bits[near] - shared))
            near = near[(100 + percent) * most >= percent * (sizes[p] + sizes[near])]
            if not len(near):
                continue
            overlap = np.concatenate([overlaps(sets[p], [sets[i] for i in near[c:d]]) for c, d in blocks_of(sizes[near])])
            found = near[(100 + percent) * overlap >= percent * (sizes[p] + sizes[near])]
            if len(found):
                links.extend((p, i) for i in found.tolist())
                reached.extend(found.tolist())
                left = left[~np.isin(left, found)]
    return links


def link_sets(tiles: DataFrame, elements: DataFrame, percent: int) -> DataFrame:
    """a and b: links that join every two sets which a chain of links in some tile joins."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, rows in runs(batches, "tile"):
            ids = rows.column("set").to_numpy()
            raw = rows.column("elements")
            a, b = [], []
            for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                sets = [unpacked(raw[i].as_buffer()) for i in range(start, end)]
                for i, j in links_in_tile(sets, percent):
                    a.append(ids[start + i])
                    b.append(ids[start + j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    full = tiles.join(elements, "set").select("tile", "set", "elements")
    return full.repartition("tile").sortWithinPartitions("tile").mapInArrow(link, "a long, b long").distinct()


# ---------------------------------------------------------------- components


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of all nodes in ``links`` (a, b).

    Each round links every node's neighbours to the smallest of them (large-star), then the smaller ones to the
    smallest (small-star). The number of links does not grow, rounds are logarithmic, and each is written to the
    shared folder, so lineage stays short. A hot node's neighbours are only aggregated by minimum, never collected.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # v > u: the larger neighbour goes to the smallest one; u itself is one of the larger neighbours of its smallest.
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()


def jaccard_components(docs: DataFrame, words_per_shingle: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, text_hash (xxhash64), n_shingles, component and component_id of every document row.

    Documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more are linked; component_id is the
    smallest doc_id reachable by links, component a key of its own (ids can repeat). A shorter text is one shingle; null and empty texts have none and are linked with
    nothing (each row keeps its own id). Rows with a null doc_id take part and get the component's smallest id, null if
    there is none. Repeated rows come back repeated. Extra columns are not read.

    Equal sets are one node from the start, so copies are never expanded. All limits bound memory only: tables of fixed
    size order the tokens and preselect rows, and long token lists are cut into blocks that are all compared.
    """
    if percent < 50:
        # Linked sets may then differ more than twofold in size, and their bitmaps more than twofold in width.
        raise ValueError("bitmaps keep sets apart only from a similarity of 50 percent on")
    rows, counts = read_sets(docs, words_per_shingle)
    sets = rows.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    tiles = staged(tiles_of(prefix_tokens(docs, counts, words_per_shingle, percent), percent))
    sized = rows.where("n > 0").groupBy("set", "n").agg(F.first("bitmap").alias("bitmap"))
    tiles = joined_tiles(tiles, sized, percent)
    taking_part = tiles.select("set").distinct().join(sets, "set").select(F.col("first_id").alias("doc_id"))
    elements = elements_of(docs, marked_slots(taking_part), words_per_shingle)
    roots = staged(components(link_sets(tiles, elements, percent)))
    named = sets.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_set = named.select("set", "root").join(smallest, "root").select("set", F.col("root").alias("component"), "component_id")
    own = ["doc_id", "text_hash", F.col("n").alias("n_shingles")]
    linked = rows.where("n > 0").join(by_set, "set").select(*own, "component", "component_id")
    alone = rows.where("n = 0").select(*own, F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
