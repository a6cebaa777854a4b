"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.shared import EDGE_BYTES, LEFT, RIGHT, by_bytes, components, id_filter, in_filter, mix, packed, stored, word_hashes

# 25 bands of 5 rows miss a pair at similarity 0.85 with probability 4e-7, one at 0.8 with 5e-5.
BANDS, ROWS = 25, 5
# Documents and shingles that are compared in one task at a time.
BLOCK_DOCS, BLOCK_SHINGLES = 4096, 1 << 21


def shingle_sets(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles of each text, as sorted 64-bit hashes, and the offset of each text's first."""
    words, first = word_hashes(texts, lower=True)
    parts, bounds = [], [0]
    if len(words) >= k:
        windows = words[: len(words) - k + 1].copy()
        for j in range(1, k):
            windows = mix(windows * LEFT + words[j : len(words) - k + 1 + j] * RIGHT)
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        if n >= k:
            part = np.unique(windows[a : b - k + 1])
        elif n:
            whole = np.array([n], np.uint64)
            for j in range(a, b):
                whole = mix(whole * LEFT + words[j : j + 1] * RIGHT)
            part = whole
        else:
            part = np.zeros(0, np.uint64)
        parts.append(part)
        bounds.append(bounds[-1] + len(part))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(bounds)


def superminhash(sets: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """Signatures of m places, one row per set; a place holds `step << 24 | 24 random bits`.

    Every element walks its own random permutation of the places, one place per step, and the smallest
    value stays. Values of a later step are larger than all of an earlier one, so a set is finished as
    soon as no place is empty: long texts after one or two steps, only the shortest ones need many.
    """
    n_sets = len(bounds) - 1
    out = np.full((n_sets, m), np.iinfo(np.uint32).max, np.uint32)
    owner = np.repeat(np.arange(n_sets), np.diff(bounds))
    values, order = sets, None
    for step in range(m):
        if not len(values):
            break
        random = mix(values + np.uint64((step + 1) * int(LEFT) % (1 << 64)))
        draw = (step + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(m - step) >> np.uint64(32))).astype(np.int64)
        if step == 0:
            place, first = draw, draw
        else:
            rows = np.arange(len(values))
            if order is None:
                order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(values), 1))
                order[rows, first], order[:, 0] = 0, first
            place = order[rows, draw].astype(np.int64)
            order[rows, draw] = order[:, step]
        flat = out.reshape(-1)
        at = owner * m + place
        empty = flat[at] >= np.uint32(step << 24)
        np.minimum.at(flat, at[empty], (np.uint32(step << 24) | (random[empty] >> np.uint64(40)).astype(np.uint32)))
        open_sets = (out == np.iinfo(np.uint32).max).any(axis=1)
        keep = open_sets[owner]
        if not keep.all():
            values, owner = values[keep], owner[keep]
            if order is not None:
                order = order[keep]
            else:
                first = first[keep]
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(signatures), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signatures), b + 1, np.uint64)
        for r in range(rows):
            key = mix(key * LEFT + signatures[:, b * rows + r].astype(np.uint64) * RIGHT)
        keys[:, b] = key
    return keys


def _signed(batches: Iterator[pa.RecordBatch], k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, texts in by_bytes(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), 1 << 20):
            sets, bounds = shingle_sets(texts, k)
            sizes = np.diff(bounds)
            keys = band_keys(superminhash(sets, bounds, bands * rows), bands, rows).view(np.int64)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets ^ RIGHT))])
            mixed = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets + LEFT))])
            offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)),
                pa.array((mixed[bounds[1:]] - mixed[bounds[:-1]]).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[sizes > 0].reshape(-1))),
            ], names=["doc_id", "n_shingles", "key_a", "key_b", "bands"])


def _chosen_sets(batches: Iterator[pa.RecordBatch], k: int, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wanted = pa.array(in_filter(chosen, batch["doc_id"].to_pylist()), pa.bool_())
        batch = batch.filter(wanted)
        for ids, texts in by_bytes(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), 1 << 20):
            sets, bounds = shingle_sets(texts, k)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), packed(sets, bounds)], names=["rep", "shingles"])


def _linked(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Component numbers of the sets of one block, or of two blocks; links inside a block are those of `right=None`."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    begin = np.concatenate([[0], np.cumsum(np.bincount(code))])
    holders = owner[order]
    at = np.concatenate([[0], np.cumsum(sizes)])
    label = np.arange(len(sets))
    for i in range(len(left)):
        codes = code[at[i] : at[i + 1]]
        counts = begin[codes + 1] - begin[codes]
        spot = np.repeat(begin[codes] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        shared = np.bincount(holders[spot], minlength=len(sets))
        near = 100 * shared >= percent * (sizes[i] + sizes - shared)
        near[: i + 1 if right is None else len(left)] = False
        if near.any():
            merged = np.unique(np.append(label[near], label[i]))
            label[np.isin(label, merged)] = merged[0]
    return label


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links that span the components of a block (`side` 0 alone) or between two blocks (`side` 0 and 1)."""
    side = np.array(table["side"])
    reps = np.array(table["rep"])
    sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
    order = np.lexsort((reps, side))
    cut = int((side == 0).sum())
    ordered, names = [sets[i] for i in order], reps[order]
    label = _linked(ordered[:cut], ordered[cut:] if cut < len(ordered) else None, percent)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return pa.table({"a": pa.array(names[moved]), "b": pa.array(names[label[moved]])})


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch["shingles"].to_pylist(), batch["hub_shingles"].to_pylist(), strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _compare(members: DataFrame, percent: int) -> DataFrame:
    """Links between `members (family, rep, part, shingles)`; `part` is what is known to be connected.

    A family is dealt into blocks that keep connected parts together; each block and each pair of blocks that are not already one part is a
    group of its own, so no task holds more than two blocks. Groups emit only links that
    connect something, never all pairs.
    """
    weight = F.greatest(F.lit(1.0 / BLOCK_DOCS), F.octet_length("shingles") / F.lit(8.0 * BLOCK_SHINGLES))
    parts = members.groupBy("family", "part").agg(F.sum(weight).alias("weight"))
    families = parts.groupBy("family").agg(F.sum("weight").alias("all"), F.sum(F.when(F.col("weight") < 1, F.col("weight"))).alias("loose"))
    shape = parts.join(families, "family").select(
        "family", "part", F.when(F.col("all") <= 1, 0).when(F.col("weight") < 1, 1).otherwise(2).alias("kind"),
        F.ceil(F.when(F.col("weight") < 1, F.col("loose")).otherwise(F.col("weight"))).cast("int").alias("n"),
    )
    spot = F.when(F.col("kind") == 0, F.lit(0)).when(F.col("kind") == 1, F.pmod(F.xxhash64("part"), F.col("n"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("n"))).cast("bigint")
    placed = stored(
        members.join(shape, ["family", "part"]).select("family", "rep", "shingles", F.when(F.col("kind") == 2, F.col("part")).alias("whole"), spot.alias("spot")),
        "blocks",
    )
    key = ["family", "whole", "spot"]
    blocks = placed.select(*key).distinct().withColumn("block", F.xxhash64(*key))
    other = blocks.select("family", F.col("whole").alias("whole_2"), F.col("block").alias("block_2"))
    # Pairs of blocks, not of documents; a family of one block has none.
    pairs = blocks.join(other, "family").where("block < block_2 and not (whole <=> whole_2 and whole is not null)")
    groups = stored(pairs.select("block", "block_2").unionByName(blocks.where("whole is null").select("block", F.col("block").alias("block_2"))), "block-pairs")
    held = placed.withColumn("block", F.xxhash64(*key)).select("block", "rep", "shingles")
    sent = groups.select("block", "block_2", F.lit(0).alias("side")).unionByName(
        groups.where("block <> block_2").select(F.col("block_2").alias("block"), F.col("block").alias("block_2"), F.lit(1).alias("side"))
    )
    loads = held.join(sent, "block").select(F.least("block", "block_2").alias("x"), F.greatest("block", "block_2").alias("y"), F.when(F.col("block") > F.col("block_2"), 1).otherwise(0).alias("side"), "rep", "shingles")
    return loads.groupBy("x", "y").applyInArrow(lambda table: _block_links(table, percent), "a bigint, b bigint")


def _large(members: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """`rep`, `component` in families that are larger than a block."""
    spoke = members.select(F.col("rep").alias("a"), "shingles")
    hub = members.select(F.col("rep").alias("b"), F.col("shingles").alias("hub_shingles"))
    tried = stars.join(spoke, "a").join(hub, "b").select("a", "b", "shingles", "hub_shingles")
    star_links = stored(tried.mapInArrow(lambda it: _verified(it, percent), "a bigint, b bigint"), "star-links")
    known = stored(components(star_links).toDF("rep", "part"), "parts")
    staged = members.join(known, "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    return components(stored(_compare(staged, percent).unionByName(star_links), "links")).toDF("rep", "component")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Near-duplicate classes of `docs (doc_id, text)`.

    Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a document's set holds its distinct k-word
    shingles, a shorter text is one shingle as a whole. Documents are linked where 100 * intersection >=
    percent * union, counted on the full sets (64-bit shingle hashes).

    Result, one row per input row: `doc_id`, `n_shingles`, `component_id` (the smallest doc_id reachable),
    `kept`. Null, empty and blank texts have no shingles and are linked with nothing. Rows with a null
    doc_id have a null component and are kept. A repeated doc_id counts with the shingles of each row.
    Other columns of the input, whatever their names, are not used. No rows give no rows.

    Equal sets are first merged into one representative. Bands of SuperMinHash signatures give candidate
    families (components of shared band keys). A family within one block is compared on full sets in one task. A larger
    one is first linked to the smallest member of each bucket, and then compared in pairs of blocks, without blocks of one component.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = stored(docs.mapInArrow(
        lambda it: _signed(it, k, bands, rows),
        "doc_id bigint, n_shingles bigint, key_a bigint, key_b bigint, bands array<bigint>",
    ), "signatures")
    named = signed.where("doc_id is not null and n_shingles > 0")
    n_named, n_shingles = named.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    same = ["n_shingles", "key_a", "key_b"]
    classes = stored(named.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes", n_named * (32 + 8 * bands))
    rows_of = classes.select("rep", F.explode("bands").alias("bucket"))
    hubs = rows_of.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last")
    stars = stored(rows_of.join(hubs, "bucket").where("rep > hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct(), "stars", n_named * bands * EDGE_BYTES)
    families = stored(components(stars).select(F.col("id").alias("rep"), F.col("component").alias("family")), "families", n_named * EDGE_BYTES)
    chosen = id_filter(families, "rep")
    sets = docs.where("doc_id is not null").mapInArrow(lambda it: _chosen_sets(it, k, chosen), "rep bigint, shingles binary")
    # A representative whose doc_id occurs on several rows keeps the set of each.
    members = stored(families.join(sets, "rep").where(F.octet_length("shingles") > 0).distinct(), "members", n_named * EDGE_BYTES + 8 * n_shingles)
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("shingles")).alias("bytes"))
    big = stored(sizes.where((F.col("n") > BLOCK_DOCS) | (F.col("bytes") > 8 * BLOCK_SHINGLES)).select("family"), "large-families", n_named * EDGE_BYTES)
    within = members.join(big, "family", "left_anti").withColumn("side", F.lit(0))
    joined = stored(within.groupBy("family").applyInArrow(lambda table: _block_links(table, percent), "a bigint, b bigint"), "links").toDF("rep", "component")
    if not big.isEmpty():
        joined = joined.unionByName(_large(members.join(big, "family"), stars, percent))
    # One doc_id on several rows joins the classes of these rows; the smallest id stays.
    labelled = classes.select(*same, "rep").join(joined, "rep", "left").select(*same, F.coalesce("component", "rep").alias("component_id"))
    own = signed.join(labelled, same, "left")
    return own.select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

