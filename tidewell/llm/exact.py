"""Exact duplicates by deterministic block naming, with DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.shared import stored

# Bytes of a block. A text of up to this many bytes has its identity after one naming.
BLOCK = 4096


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; `lower` does the same, and faster, where all characters are ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _named(keys: DataFrame, order: list[str]) -> DataFrame:
    """An integer for each of the distinct `keys`, in sorted order; written, so that it never changes."""
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.withColumn("name", F.monotonically_increasing_id()), "names")


def identities(docs: DataFrame, block: int = BLOCK, hash_bits: int = 64) -> DataFrame:
    """`row`, `doc_id`, `n_bytes`, `text_sha256`, `name`: equal texts, and only those, have equal (`n_bytes`, `name`).

    Blocks are sorted by (hash, bytes). Of a hash whose blocks are all equal, which is found by comparing the bytes of the
    smallest and the largest one, the hash alone is sorted; blocks of a hash that clashes are sorted with their bytes.
    `hash_bits` below 64 makes clashes common, for tests.
    """
    texts = docs.select("doc_id", lower_ascii(F.coalesce("text", F.lit(""))).alias("norm"))
    cut = f"transform(sequence(0, greatest(0, (octet_length(norm) - 1) div {block})), i -> substring(cast(norm as binary), i * {block} + 1, {block}))"
    mask = f"shiftrightunsigned(xxhash64(b), {64 - hash_bits})"
    digests = stored(texts.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.octet_length("norm").alias("n_bytes"),
        F.sha2("norm", 256).alias("text_sha256"), F.expr(f"transform({cut}, b -> {mask})").alias("hashes"),
    ), "digests")
    blocks = texts.select("doc_id", "norm", F.expr(f"posexplode({cut}) as (pos, b)")).select("doc_id", "norm", "pos", "b", F.expr(mask).alias("h"))
    hashes = stored(blocks.groupBy("h").agg(F.min("b").alias("low"), F.max("b").alias("high")).select("h", (F.col("low") != F.col("high")).alias("clash")), "hashes")
    clashing = hashes.where("clash").select("h")
    keys = hashes.where("not clash").select("h", F.lit(None).cast("binary").alias("b"))
    spots = digests.select("row", "doc_id", "n_bytes", "text_sha256", F.posexplode("hashes").alias("pos", "h"))
    if clashing.isEmpty():
        state = spots.join(_named(keys, ["h", "b"]).select("h", "name"), "h").select("row", "n_bytes", "pos", "name")
    else:
        torn = stored(blocks.join(clashing, "h").select("doc_id", F.sha2("norm", 256).alias("text_sha256"), "pos", "h", "b"), "clashes")
        names = _named(keys.unionByName(torn.select("h", "b").distinct()), ["h", "b"])
        own = torn.join(names.where("b is not null"), ["h", "b"]).select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("t"), F.col("pos").alias("p"), F.col("name").alias("exact")).distinct()
        same = spots["doc_id"].eqNullSafe(own["d"]) & (spots["text_sha256"] == own["t"]) & (spots["pos"] == own["p"])
        state = spots.join(names.where("b is null").select("h", "name"), "h", "left").join(own, same, "left").select(
            "row", "n_bytes", "pos", F.coalesce("exact", "name").alias("name"))
    state, done = stored(state, "blocks"), []
    most = digests.agg(F.max("n_bytes")).first()[0] or 0
    width = block
    while True:
        # Texts of one length are finished at the same level, so names of different levels never meet.
        done.append(state.where(F.col("n_bytes") <= width).select("row", "name"))
        if most <= width:
            break
        open_rows = state.where(F.col("n_bytes") > width)
        pairs = stored(open_rows.groupBy("row", "n_bytes", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.min(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("r"),
        ), "pairs")
        names = _named(pairs.select("l", "r").distinct(), ["l", "r"])
        state = stored(pairs.join(names, ["l", "r"]).select("row", "n_bytes", "pos", "name"), "blocks")
        width *= 2
    final = done[0]
    for part in done[1:]:
        final = final.unionByName(part)
    return digests.drop("hashes").join(final, "row")


def exact_duplicates(docs: DataFrame, block: int = BLOCK, hash_bits: int = 64) -> DataFrame:
    """Groups of equal texts of `docs (doc_id, text)`, whole texts after lower-casing A-Z only; null counts as empty.

    Fixed-size byte blocks are sorted into integer names, names of adjacent blocks are paired and sorted again, until each
    document has one name: its collision-free identity.

    Result, one row per input row: `doc_id`, `keep_id` (the largest doc_id of the group), `group_size`, `kept`,
    `text_sha256` (of the normalised text). A row with a null doc_id is kept only if no equal text has an id. Rows
    that repeat the staying doc_id with an equal text are all marked kept. No rows give no rows; other columns are not used.
    """
    named = stored(identities(docs.select("doc_id", "text"), block, hash_bits), "identities")
    groups = named.groupBy("n_bytes", "name").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["n_bytes", "name"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
