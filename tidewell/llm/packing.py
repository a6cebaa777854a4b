"""Token sequences packed by swap-based local search, shard by shard."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm.shared import stored

CAPACITY = 2048
# Pieces that are packed in one task. A shard wastes less than one sequence.
SHARD = 16_384
# Words whose ids a task remembers; the memory is emptied when it is full.
REMEMBERED = 700_000
# Words that are tokenized as one text.
JOINED = 512
# Bytes of text whose words are looked up together.
PART = 8 << 20
PIECE = "doc_id bigint, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

_tokenizers: dict[str, Tokenizer] = {}
_ends: dict[str, np.ndarray] = {}
_ids_of: dict[str, dict[bytes, bytes]] = {}


def _word_ends(path: str) -> np.ndarray:
    """Whether each id ends a pre-token, by the suffix that the model gives to ends."""
    if path not in _ends:
        tokenizer = _tokenizer(path)
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        flags = np.zeros(tokenizer.get_vocab_size(), bool)
        if suffix:
            flags[[i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        _ends[path] = flags
    return _ends[path]


def _tokenizer(path: str) -> Tokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


# Punctuation between a letter or digit and white space is a pre-token of its own. Apostrophes (contractions) and <, |, > (added tokens) are left out.
STOPS = "([a-z0-9\u00df-\u00f6\u00f8-\u00ff])([!-&(-/:;=?@\\[-`{}~]+)([ \n]|$)"
# From U+0300 on a character may combine with an earlier one, which lower-casing first would change; added tokens keep their case.
CASED = "[\u0130\u0300-\U0010ffff]|<\\|"
COMBINING = re.compile("[\u0130\u0300-\U0010ffff]")


def _words(texts: pa.Array) -> pa.Array:
    """The words of each text, in the fewest forms that surely have its ids."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), STOPS, r"\1 \2\3")
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(texts, CASED), texts, plain))


def _encoded(words: list[str], path: str) -> list[bytes]:
    """The ids of each word. Words of letters are one pre-token each, so many are tokenized as one text and cut at the word ends."""
    tokenizer, ends = _tokenizer(path), _word_ends(path)
    plain = [i for i, w in enumerate(words) if w.isalpha() and (w.isascii() or not COMBINING.search(w))]
    out: list[bytes | None] = [None] * len(words)
    for at in range(0, len(plain), JOINED):
        part = plain[at : at + JOINED]
        coded = tokenizer.encode_batch_fast([" ".join([words[i] for i in part])], add_special_tokens=False)
        ids = np.array(coded[0].ids, "<u4")
        cuts = 4 * (np.flatnonzero(ends[ids]) + 1)
        if len(cuts) == len(part):
            data = ids.tobytes()
            for i, begin, end in zip(part, [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                out[i] = data[begin:end]
    rest = [i for i, ids in enumerate(out) if ids is None]
    for i, coded in zip(rest, tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False), strict=True):
        out[i] = np.array(coded.ids, "<u4").tobytes()
    return out


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `PART` bytes of text; a longer text is in a range with few others."""
    at = np.cumsum(pc.binary_length(texts).to_numpy()) // PART
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(texts)]
    return ((begin, end) for begin, end in zip(cuts, cuts[1:], strict=False) if begin < end)


def _part_bytes(texts: pa.Array, path: str) -> list[bytes]:
    words, known = _words(texts), _ids_of.setdefault(path, {})
    places = words.flatten().dictionary_encode()
    distinct = places.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
    new = [w for w in distinct if w not in known]
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = distinct
    known.update(zip(new, _encoded([w.decode("utf-8") for w in new], path), strict=True))
    ids = pa.array([known[w] for w in distinct], pa.large_binary()).take(places.indices)
    _, offsets, data = ids.buffers()
    cuts = np.frombuffer(offsets, np.int64)[words.offsets.to_numpy()].tolist()
    data = memoryview(data or b"")
    return [data[begin:end].tobytes() for begin, end in zip(cuts, cuts[1:], strict=False)]


def token_bytes(texts: pa.Array | list[str | None], path: str) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers.

    The vocabulary's normaliser lower-cases, its pre-tokenizer drops white space and no token crosses it, so a text's ids are those of
    its lower-cased words (between ASCII white space), and each word is tokenized once. Arrow cuts the texts into words and numbers the
    distinct ones, so Python sees a word once per part of `PART` bytes.
    """
    texts = pc.fill_null((texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).cast(pa.large_string()), "")
    return [data for begin, end in _parts(texts) for data in _part_bytes(texts.slice(begin, end - begin), path)]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        whole = pc.fill_null(batch["text"].cast(pa.large_string()), "")
        for begin, stop in _parts(whole):
            ids, rows = (batch[c].slice(begin, stop - begin).to_pylist() for c in ("doc_id", "row"))
            out = []
            for doc, row, data in zip(ids, rows, _part_bytes(whole.slice(begin, stop - begin), path), strict=True):
                data += end
                for piece, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    out.append((doc, row, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])


class Bins:
    """Bins of one capacity, with the underfull ones in order of fill."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.items, self.fill, self.order = capacity, [], [], []

    def open(self) -> int:
        self.items.append([])
        self.fill.append(0)
        return len(self.items) - 1

    def place(self, b: int, size: int, item: int) -> None:
        self._refill(b, size)
        insort(self.items[b], (size, item))

    def take(self, b: int, at: int) -> tuple[int, int]:
        size, item = self.items[b].pop(at)
        self._refill(b, -size)
        return size, item

    def _refill(self, b: int, change: int) -> None:
        before, after = self.fill[b], self.fill[b] + change
        if 0 < before < self.capacity:
            self.order.pop(bisect_left(self.order, (before, b)))
        if 0 < after < self.capacity:
            insort(self.order, (after, b))
        self.fill[b] = after

    def find(self, b: int, least: int, most: int) -> int | None:
        """Place of the largest item of a bin with least <= size <= most."""
        at = bisect_right(self.items[b], (most, float("inf"))) - 1
        return at if at >= 0 and self.items[b][at][0] >= least else None


def best_fit(sizes: np.ndarray, capacity: int) -> Bins:
    """Largest first, each into the fullest bin that has room."""
    bins = Bins(capacity)
    for item in np.lexsort((np.arange(len(sizes)), -sizes)).tolist():
        size = int(sizes[item])
        at = bisect_right(bins.order, (capacity - size, float("inf"))) - 1
        bins.place(bins.order[at][1] if at >= 0 else bins.open(), size, item)
    return bins


def _improve(bins: Bins, target: int, donor: int) -> bool:
    """One step that makes `target`, the fuller bin, fuller out of `donor`: a move, or an exchange of one or two for one."""
    room = bins.capacity - bins.fill[target]
    moved = bins.find(donor, 1, room)
    if moved is not None:
        bins.place(target, *bins.take(donor, moved))
        return True
    best = None
    for i, (size, _) in enumerate(bins.items[target]):
        j = bins.find(donor, size + 1, size + room)
        if j is not None and (best is None or bins.items[donor][j][0] - size > best[0]):
            best = (bins.items[donor][j][0] - size, [i], j)
    held = bins.items[target]
    if best is None or best[0] < room:
        for i in range(len(held) - 1):
            if i and held[i][0] == held[i - 1][0]:
                continue
            for k in range(i + 1, len(held)):
                if k > i + 1 and held[k][0] == held[k - 1][0]:
                    continue
                pair = held[i][0] + held[k][0]
                j = bins.find(donor, pair + 1, pair + room)
                if j is not None and (best is None or bins.items[donor][j][0] - pair > best[0]):
                    best = (bins.items[donor][j][0] - pair, [i, k], j)
    if best is None:
        return False
    incoming = bins.take(donor, best[2])
    outgoing = [bins.take(target, i) for i in reversed(best[1])]
    for size, item in outgoing:
        bins.place(donor, size, item)
    bins.place(target, *incoming)
    return True


class Reach:
    """Index by size: which bins have a step for an item of a size, by a move or an exchange of one or two for it."""

    def __init__(self, bins: Bins) -> None:
        self.bins, self.fill = bins, np.array(bins.fill, np.int64)
        self.steps = np.zeros((bins.capacity + 1, len(bins.items)), bool)
        for b in range(len(bins.items)):
            self.renew(b)

    def renew(self, b: int) -> None:
        """After bin `b` has changed."""
        capacity, fill = self.bins.capacity, self.bins.fill[b]
        self.fill[b] = fill
        if not 0 < fill < capacity:
            self.steps[:, b] = False
            return
        sizes = [size for size, _ in self.bins.items[b]]
        once = sorted(set(sizes))
        twice = {x for x, y in zip(sizes, sizes[1:], strict=False) if x == y}
        out = np.array([0, *once, *(x + y for i, x in enumerate(once) for y in once[i + 1 :]), *(2 * x for x in twice)], np.int64)
        begins = np.bincount(out + 1, minlength=capacity + 2)
        ends = np.bincount(out + 1 + capacity - fill, minlength=capacity + 2)
        self.steps[:, b] = np.cumsum(begins - ends)[: capacity + 1] > 0

    def target(self, donor: int) -> int | None:
        """The fullest of all underfull bins, not less filled than `donor`, with a step for one of its items."""
        sizes = list({size for size, _ in self.bins.items[donor]})
        found = np.flatnonzero(self.steps[sizes].any(0) & (self.fill >= self.fill[donor]))
        found = found[found != donor]
        return int(found[np.argmax(self.fill[found])]) if len(found) else None


def local_search(bins: Bins) -> Bins:
    """Empties the least filled bin into fuller ones, step by step; each step raises the sum of squared fills.

    Partners are looked up among all underfull bins. A donor that no step helps is left as it is and the next one is tried; when all
    are settled and a bin has changed since, they are tried again. The search ends: the sum is bounded.
    """
    reach, settled_bins, changed = Reach(bins), set(), False
    least = -(-sum(bins.fill) // bins.capacity)
    while sum(1 for f in bins.fill if f) > least:
        donor = next((b for _, b in bins.order if b not in settled_bins), None)
        if donor is None:
            if not changed:
                return bins
            settled_bins, changed = set(), False
            continue
        while bins.fill[donor]:
            target = reach.target(donor)
            if target is None:
                settled_bins.add(donor)
                break
            _improve(bins, target, donor)
            reach.renew(target)
            reach.renew(donor)
            changed = True
    return bins


def _packed(table: pa.Table, capacity: int) -> pa.Table:
    table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("row", "ascending"), ("piece", "ascending")])
    bins = local_search(best_fit(np.array(table["length"]), capacity))
    sequence, offset = np.zeros(len(table), np.int64), np.zeros(len(table), np.int64)
    for number, items in enumerate(i for i in bins.items if i):
        at = 0
        for size, item in sorted(items, key=lambda x: (-x[0], x[1])):
            sequence[item], offset[item] = number, at
            at += size
    return table.append_column("bin", pa.array(sequence)).append_column("offset", pa.array(offset))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, shard: int = SHARD) -> DataFrame:
    """Packs `docs (doc_id, text)` into sequences of at most `capacity` tokens.

    A document is the ids of its text by the tokenizer file `tokenizer` (no special tokens added), then `end_id`; a null text is empty. A document
    longer than `capacity` is cut into pieces of `capacity`, the last one may be shorter; no other is cut.

    Full pieces are sequences of their own. The others are dealt at random into shards of about `shard` pieces, whatever
    the input's size; each shard is packed best-fit and then improved by moves and exchanges.

    Result, one row per piece: `doc_id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset`. Rows with null or
    repeated doc_ids are documents of their own. No rows give no rows; other columns are not used. An executor needs the tokenizer file at the same path.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    cut = partial(_pieces, path=tokenizer, capacity=capacity, end_id=end_id)
    pieces = stored(texts.mapInArrow(cut, PIECE), "pieces")
    whole = pieces.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = pieces.where(F.col("length") < capacity)
    shards = max(1, round(rest.count() / shard))
    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).cast("bigint"))
    bound = dealt.groupBy("shard").applyInArrow(lambda table: _packed(table, capacity), PIECE + ", shard bigint, bin bigint, offset bigint")
    return whole.unionByName(bound.select(
        "doc_id", "piece", "start", "length", "ids_crc32", ((F.col("shard") * (1 << 31) + F.col("bin")) * 2).alias("sequence_id"), "offset"))
