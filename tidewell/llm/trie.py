"""Prefix trie of conversations; totals over subtrees by parallel tree contraction in join rounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.shared import stored
from tidewell.operators.ordering import with_position
from tidewell.session import released, task_rows

# Conversations whose ids agree but for so many bits are listed together.
CHUNK_BITS = 12
KEY = ["depth", "p1", "p2"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `pos` (from 0), `h1`, `h2`, `words` of `conversations (conv_id, turn, role, text)`.

    Turns are ordered by `turn`, null first; turns with equal numbers by a hash of what they say, so that the order is always the same. A null role or text
    is empty. Two 64-bit hashes stand for role and text, `words` counts `[^\\x20\\x09-\\x0D]+` in the text. Rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"))
    return with_position(told, ["turn", "h1", "h2"], ["conv_id"]).select("conv_id", "pos", "h1", "h2", "words")


def _prefixes(steps: DataFrame) -> DataFrame:
    """`conv_id`, `depth`, `p1`, `p2`: every step with the combined hash of all steps up to it; `q1`, `q2`: that of the steps before it.

    A conversation of more than the rows that a task may hold is read in runs, with the combined hash of the runs before.
    """
    spots = steps.withColumn("k1", F.xxhash64("depth", "h1", "h2")).withColumn("k2", F.xxhash64("h2", "depth", "h1"))
    run, most = task_rows(steps.sparkSession), steps.agg(F.max("depth")).first()[0] or 0
    home = F.floor(F.col("depth") / run)
    so_far = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = spots.withColumn("run", home).withColumn("p1", F.bit_xor("k1").over(so_far)).withColumn("p2", F.bit_xor("k2").over(so_far))
    if most >= run:
        earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        runs = spots.groupBy("conv_id", home.alias("run")).agg(F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"))
        before = [F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(f"before_{x}") for x in ("x1", "x2")]
        runs = stored(runs.select("conv_id", "run", *before), "runs")
        inner = inner.join(runs, ["conv_id", "run"]).withColumn("p1", F.col("p1").bitwiseXOR(F.col("before_x1"))).withColumn("p2", F.col("p2").bitwiseXOR(F.col("before_x2")))
    return inner.select("conv_id", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("k1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("k2")).alias("q2"), "words")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node out of its sorted lists of ids, which are read one after the other and never held together."""
    now, digest = None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*KEY, "ends_sha256"])

    for batch in batches:
        rows = []
        for *key, ids in zip(*(batch[c].to_pylist() for c in [*KEY, "ids"]), strict=True):
            if key == now:
                digest.update(b",")
            else:
                if now:
                    rows.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256()
            digest.update(ids.encode())
        yield out(rows)
    if now:
        yield out([(*now, digest.hexdigest())])


def _ends(places: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of the conversations that end at a node, by node.

    Ids are listed in chunks of at most 2^CHUNK_BITS; the digest of a node is the one part that has to be read in sequence.
    """
    last = places.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("last")).select("conv_id", "last.*")
    chunks = last.groupBy(*KEY, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    listed = chunks.select(*KEY, "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    return listed.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").mapInArrow(_digested, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def _turn_of(conv: Column, depth: Column) -> Column:
    """Order in which neighbours of a chain are spliced: odd depths first, then even ones by the number of times that 2 divides them."""
    lowest = F.bit_count(depth.bitwiseAND(-depth) - 1)
    return F.struct(lowest.alias("twos"), F.xxhash64(conv, depth).alias("h"), conv.alias("c"), depth.alias("d"))


def _raked(tree: DataFrame) -> DataFrame:
    """The tree without its leaves; each has left its total to its parent."""
    leaves = tree.where("kids = 0").groupBy(F.col("up_c").alias("c"), F.col("up_d").alias("d")).agg(
        F.sum(F.col("leaves") + F.col("edge_leaves")).alias("more_leaves"), F.sum(F.col("saved") + F.col("edge_saved")).alias("more_saved"), F.count(F.lit(1)).alias("fewer"))
    more = lambda c: F.coalesce(c, F.lit(0))
    return tree.where("kids > 0").join(leaves, ["c", "d"], "left").select(
        "c", "d", "up_c", "up_d", (F.col("kids") - more("fewer")).alias("kids"), (F.col("leaves") + more("more_leaves")).alias("leaves"),
        (F.col("saved") + more("more_saved")).alias("saved"), "edge_leaves", "edge_saved")


def _splices(tree: DataFrame) -> DataFrame:
    """Nodes with one child that leave the tree in this round, no two of them neighbours, each with its child."""
    child = F.struct("c", "d", "kids", "edge_leaves", "edge_saved")
    # Combined before the shuffle: a parent of many sends one row per task.
    sole = tree.groupBy(F.col("up_c").alias("c"), F.col("up_d").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(child).alias("child")).where("n = 1")
    chain = tree.where("kids = 1 and up_c is not null").join(sole.select("c", "d", "child"), ["c", "d"])
    chain = stored(chain.select("c", "d", "up_c", "up_d", "leaves", "saved", "edge_leaves", "edge_saved", F.col("child.c").alias("to_c"), F.col("child.d").alias("to_d"),
                                F.col("child.kids").alias("to_kids"), F.col("child.edge_leaves").alias("to_leaves"), F.col("child.edge_saved").alias("to_saved")), "chain")
    mine, theirs = _turn_of(F.col("c"), F.col("d")), _turn_of(F.col("to_c"), F.col("to_d"))
    later = chain.where("to_kids = 1").select(F.greatest(mine, theirs).alias("later")).select("later.c", "later.d")
    return chain.join(later, ["c", "d"], "left_anti")


def _compressed(tree: DataFrame, splices: DataFrame) -> DataFrame:
    """The tree without the spliced nodes; their children hang one node higher, and what they held lies on the edge."""
    moved = splices.select(
        F.col("to_c").alias("c"), F.col("to_d").alias("d"), F.col("up_c").alias("new_c"), F.col("up_d").alias("new_d"),
        (F.col("leaves") + F.col("edge_leaves")).alias("more_leaves"), (F.col("saved") + F.col("edge_saved")).alias("more_saved"), F.lit(False).alias("gone"))
    none = F.lit(None).cast("bigint")
    gone = splices.select("c", "d", none.alias("new_c"), none.alias("new_d"), none.alias("more_leaves"), none.alias("more_saved"), F.lit(True).alias("gone"))
    # A spliced node's neighbours stay, so an id is in one of the two and once.
    both = tree.join(moved.unionByName(gone), ["c", "d"], "left").where("gone is null or not gone")
    more = lambda c: F.coalesce(c, F.lit(0))
    return both.select(
        "c", "d", F.coalesce("new_c", "up_c").alias("up_c"), F.coalesce("new_d", "up_d").alias("up_d"), "kids", "leaves", "saved",
        (F.col("edge_leaves") + more("more_leaves")).alias("edge_leaves"), (F.col("edge_saved") + more("more_saved")).alias("edge_saved"))


def subtree_totals(tree: DataFrame) -> DataFrame:
    """Totals over subtrees of `tree (c, d, up_c, up_d, kids, leaves, saved)`: `c`, `d`, `leaves`, `saved`.

    A node is a pair (c, d), its parent (up_c, up_d), null for a root; `kids` counts its children. In each round all leaves are raked into their parents, then an
    independent part of the nodes with one child is spliced out, about half of every chain; so the rounds are about as many as the logarithm of the nodes, however deep the
    tree is. A leaf that is raked has its total. A spliced node has that of its child, the edge to it, and its own: the rounds are
    undone from the last to the first, when the child's total is known.
    """
    state = stored(tree.withColumn("edge_leaves", F.lit(0).cast("bigint")).withColumn("edge_saved", F.lit(0).cast("bigint")), "tree")
    rounds = []
    while not state.isEmpty():
        leaves = stored(state.where("kids = 0").select("c", "d", "leaves", "saved"), "raked")
        inner = stored(_raked(state), "inner")
        released(state)
        splices = stored(_splices(inner), "splices")
        rounds.append((leaves, splices))
        state = stored(_compressed(inner, splices), "tree")
        released(inner)
    known = None
    for leaves, splices in reversed(rounds):
        if known is None:
            known = leaves
            continue
        totals = known.select(F.col("c").alias("to_c"), F.col("d").alias("to_d"), F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))
        again = splices.join(totals, ["to_c", "to_d"]).select(
            "c", "d", (F.col("leaves") + F.col("to_leaves") + F.col("below_leaves")).alias("leaves"), (F.col("saved") + F.col("to_saved") + F.col("below_saved")).alias("saved"))
        known = known.unionByName(stored(again, "totals")).unionByName(leaves)
    return known if known is not None else tree.select("c", "d", "leaves", "saved")


def prefix_trie(steps: DataFrame, members: DataFrame) -> DataFrame:
    """The trie of conversations: `steps (conv_id, depth, h1, h2, words)`, depths from 1 without gaps, and all `members (conv_id)`, also those without a step.

    A node is a distinct sequence of first steps. Result, one row per node: `conv_id` (its smallest member), `depth`, `parent_conv_id` (null for the root), `n_convs`
    (members), `n_children`, `n_leaves` (nodes without children in its subtree, itself included), `saved_tokens` (over its subtree: (members - 1) times the words of
    the last step), `ends_sha256` (of the ascending ids of the members that end here, joined by commas). Sequences are told apart by 128-bit hashes.
    Without members there is no node. Repeated members count once.
    """
    members = members.select("conv_id").where("conv_id is not null").distinct()
    zero = F.lit(0).cast("bigint")
    root = members.select("conv_id", *[zero.alias(c) for c in ("depth", "p1", "p2", "q1", "q2", "words")])
    places = stored(_prefixes(steps).unionByName(root), "prefixes")
    found = places.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"), F.min("q1").alias("q1"), F.min("q2").alias("q2"))
    found = stored(found, "nodes")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    kids = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("kids"))
    # Written first, so that the parent of many children is split where it is joined.
    named = stored(found.join(above, ["depth", "q1", "q2"], "left"), "named")
    nodes = stored(named.join(kids, KEY, "left").select(
        "conv_id", *KEY, "parent_conv_id", "n_convs", F.coalesce("kids", zero).alias("n_children"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "nodes")
    released(found, named)
    totals = subtree_totals(nodes.select(
        F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("up_c"), F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("up_d"),
        F.col("n_children").alias("kids"), F.when(F.col("n_children") == 0, F.lit(1)).otherwise(0).cast("bigint").alias("leaves"), "saved"))
    totals = totals.select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    empty = hashlib.sha256().hexdigest()
    return nodes.join(totals, ["conv_id", "depth"]).join(_ends(places), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
