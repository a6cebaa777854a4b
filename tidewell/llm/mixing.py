"""Temperature mixing: an exponent on the sources' token shares, realised as budgeted block permutations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.shared import stored

# Blocks of a source, and parts of a block. A source's order is a permutation of blocks, of parts and of documents, so
# no window holds more than this many rows or a millionth of a source.
BLOCKS = 1024
# Exponents tried in one job, and jobs: the exponent is found to 64^-5.
TRIES, ROUNDS = 64, 5
SHARE_OF_ENTROPY, MAX_REPEATS = 0.95, 2.0


@dataclass(frozen=True)
class Mixture:
    exponent: float
    scale: float
    sources: DataFrame


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _bisected(totals: DataFrame, entropy_share: float) -> float:
    """The largest exponent in 0..1 whose weights have the target share of the greatest possible entropy.

    Entropy falls as the exponent rises. Each job evaluates a grid over the interval that the last one left; the sources are only summed.
    """
    low, high = 0.0, 1.0
    n, total = totals.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    if not n or n == 1:
        return 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / TRIES for i in range(TRIES + 1)]
        mass = F.pow(F.col("tokens") / F.lit(float(total)), F.col("exponent"))
        told = totals.select("tokens", F.explode(F.array(*map(F.lit, grid))).alias("exponent")).select("exponent", mass.alias("mass"))
        sums = told.groupBy("exponent").agg(F.sum("mass").alias("z"), F.sum(F.col("mass") * F.log("mass")).alias("s"))
        entropy = F.log("z") - F.col("s") / F.col("z")
        met = sums.where(entropy >= entropy_share * F.log(F.lit(float(n))) - 1e-12).agg(F.max("exponent")).first()[0]
        if met is None:
            return 0.0
        low, high = met, min(high, met + (high - low) / TRIES)
        if low == high:
            break
    return low


def _repeat_bound(smallest: float, largest: float, max_repeats: float) -> float:
    """The smallest exponent at which no source is repeated more often than `max_repeats`, by bisection."""
    low, high = 0.0, 1.0
    if (largest / smallest) <= max_repeats:
        return 0.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if (largest / smallest) ** (1 - middle) <= max_repeats else (middle, high)
    return high


def weights(counted: DataFrame, entropy_share: float, max_repeats: float, budget: int | None) -> Mixture:
    """Per source: `mix_source`, `tokens`, `weight`, `epochs`. Sources without tokens are taken once."""
    totals = stored(counted.groupBy("mix_source").agg(F.sum("n_tokens").alias("tokens")), "totals")
    filled = totals.where("tokens > 0")
    smallest, largest = filled.agg(F.min("tokens"), F.max("tokens")).first()
    if smallest is None:
        return Mixture(1.0, 0.0, totals.withColumns({"weight": F.lit(0.0), "epochs": F.lit(1.0)}))
    # A repetition limit holds against an entropy that can only be had by more repetition.
    exponent = max(_bisected(filled, entropy_share), _repeat_bound(smallest, largest, max_repeats) if budget is None else 0.0)
    norm = filled.agg(F.sum(F.pow(F.col("tokens").cast("double"), F.lit(exponent)))).first()[0]
    share = F.pow(F.col("tokens").cast("double"), F.lit(exponent)) / F.lit(norm)
    # Without a budget the largest source is read exactly once, all others at least once.
    scale = float(budget) if budget is not None else norm * largest ** (1 - exponent)
    epochs = F.least(F.lit(scale) * F.col("weight") / F.col("tokens"), F.lit(float(max_repeats)))
    epochs = epochs if budget is not None else F.greatest(epochs, F.lit(1.0))
    told = totals.withColumn("weight", F.when(F.col("tokens") > 0, share).otherwise(0.0))
    return Mixture(exponent, scale, told.withColumn("epochs", F.when(F.col("tokens") > 0, epochs).otherwise(1.0)))


def mix(
    docs: DataFrame, entropy_share: float = SHARE_OF_ENTROPY, max_repeats: float = MAX_REPEATS, budget: int | None = None,
    tokens: Column | None = None, seed: int = 7,
) -> DataFrame:
    """How often each of `docs (doc_id, source, text)` is read in the mixture.

    Source weights are token shares to the power of an exponent in 0..1: the largest one that meets `entropy_share` of
    the greatest possible entropy, or a larger one where a source would be read more than `max_repeats` times. `tokens`
    counts a document (words `[^\\x20\\x09-\\x0D]+` by default).

    A source of weight w gets w * `budget` tokens; without a budget as many that the largest source is read once and all others at least once. Whole
    epochs read every document. In the last one the source's blocks are permuted and read until the budget is spent; the block, part and
    document where it ends are found in turn, and a document that does not fit is left out.

    Result: all input columns and `n_tokens`, `epochs` (of its source), `copies` (how often the row is read, 0 possible only with a budget under one
    epoch), `mix_key` (double; ordering a copy c by (mix_key + c) / epochs mixes the sources evenly). Input columns of these names are replaced; null sources are one source;
    null and empty texts count 0 tokens and are read once per whole epoch; rows that share an id are read
    separately. No rows give no rows.
    """
    clash = ["n_tokens", "epochs", "copies", "mix_key", "mix_source", "mix_hash", "mix_block", "mix_part", "spent", "part_tokens", "left_tokens"]
    counted = docs.drop(*clash).withColumn("n_tokens", n_words() if tokens is None else tokens)
    counted = counted.withColumn("mix_source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    counted = counted.withColumn("mix_hash", F.xxhash64(F.lit(seed), F.col("doc_id")))
    counted = counted.withColumns({"mix_block": F.pmod("mix_hash", F.lit(BLOCKS)), "mix_part": F.pmod(F.shiftright("mix_hash", 20), F.lit(BLOCKS))})
    mixture = weights(counted, entropy_share, max_repeats, budget)
    sources = stored(mixture.sources, "sources")
    part = ["mix_source", "mix_block", "mix_part"]
    parts = stored(counted.groupBy(*part).agg(F.sum("n_tokens").alias("part_tokens")), "parts")
    order = lambda name: [F.xxhash64(F.lit(seed + 1), F.col(name)), F.col(name)]
    blocks = parts.groupBy("mix_source", "mix_block").agg(F.sum("part_tokens").alias("block_tokens"))
    until = Window.partitionBy("mix_source").orderBy(*order("mix_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("mix_source", "mix_block", F.coalesce(F.sum("block_tokens").over(until), F.lit(0)).alias("before_block"))
    inside = Window.partitionBy("mix_source", "mix_block").orderBy(*order("mix_part")).rowsBetween(Window.unboundedPreceding, -1)
    spent = F.col("before_block") + F.coalesce(F.sum("part_tokens").over(inside), F.lit(0))
    last = (F.col("epochs") - F.floor("epochs")) * F.col("tokens")
    placed = parts.join(blocks, ["mix_source", "mix_block"]).withColumn("spent", spent).join(sources, "mix_source")
    placed = stored(placed.select(*part, "epochs", "part_tokens", F.floor(last - F.col("spent")).alias("left_tokens")), "placed")
    told = counted.join(placed, part)
    # Only the part of each source in which its budget ends needs an order of documents.
    ends = (F.col("left_tokens") > 0) & (F.col("left_tokens") < F.col("part_tokens"))
    along = Window.partitionBy(*part).orderBy(F.xxhash64(F.lit(seed + 2), F.col("doc_id")), "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = told.where(ends).withColumn("extra", F.when(F.sum("n_tokens").over(along) <= F.col("left_tokens"), 1).otherwise(0))
    plain = told.where(~ends).withColumn("extra", F.when((F.col("left_tokens") > 0) & (F.col("part_tokens") > 0), 1).otherwise(0))
    key = F.pmod(F.xxhash64(F.lit(seed + 3), "mix_block", "mix_part", "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return plain.unionByName(cut).withColumns({"copies": (F.floor("epochs") + F.col("extra")).cast("int"), "mix_key": key}).drop(*part, "mix_hash", "part_tokens", "left_tokens", "extra")
