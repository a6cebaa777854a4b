"""Maximal runs of repeated word sequences: common extensions from a difference cover drive a harmonic grid."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.shared import by_bytes, word_hashes

# Every distance modulo MODULUS is the difference of two members of COVER, so any two places reach sampled ones after the same few words.
MODULUS, COVER = 13, (0, 1, 3, 9)
MIN_WORDS, MIN_EXPONENT = 24, 3
# Characters whose words are handled together, and pairs of places that are looked at together.
SLICE_CHARS, GRID_PAIRS = 1 << 22, 1 << 19

_STEPS = np.zeros((MODULUS, MODULUS), np.int32)
for _i in range(MODULUS):
    for _j in range(MODULUS):
        _STEPS[_i, _j] = min(d for d in range(MODULUS) if (_i + d) % MODULUS in COVER and (_j + d) % MODULUS in COVER)


class Extensions:
    """Number of equal words from any two places of a sequence on.

    `words` are small integers and end with one that occurs nowhere else; so does every part of it that is not to reach the next.
    Only the suffixes at places of the cover are sorted: blocks of MODULUS words are named in order, and names are doubled
    until all suffixes differ, each round among those that are still tied. A query compares at most MODULUS - 1 words to
    reach two sampled places, and takes the minimum of the common prefixes between them from a sparse table.
    """

    def __init__(self, words: np.ndarray) -> None:
        self.words = np.concatenate([words, np.full(2 * MODULUS, -1, words.dtype)])
        n = len(words)
        rows = [np.arange(r, n, MODULUS) for r in COVER]
        first = np.concatenate([[0], np.cumsum([len(r) + 1 for r in rows])])
        # Places of the samples, one residue after the other; each residue ends with a place outside the sequence.
        self.places = np.concatenate([x for r in rows for x in (r, [n])])
        self.begin = np.full(MODULUS, -1, np.int64)
        self.begin[list(COVER)] = first[:-1]
        self.rank = self._named(n)
        levels = self._doubled()
        order = np.empty(len(self.rank), np.int64)
        order[self.rank] = np.arange(len(order))
        self._tabled(self._common(order[:-1], order[1:], levels))

    def _named(self, n: int) -> np.ndarray:
        """Rank of the block at each sample: the number of samples with smaller blocks. Places outside come first."""
        bits = max(1, int(self.words.max() + 2).bit_length())
        each = 63 // bits
        inside = self.places < n
        at = np.where(inside, self.places, n)
        columns = [np.where(inside, 1, 0)]
        for begin in range(0, MODULUS, each):
            key = np.zeros(len(at), np.int64)
            for t in range(begin, min(MODULUS, begin + each)):
                key = (key << bits) | (self.words[at + t] + 1)
            columns.append(key)
        # Places outside differ by their index, so that no two suffixes are alike.
        columns.append(np.where(inside, 0, np.arange(len(at))))
        order = np.lexsort(columns[::-1])
        fresh = np.zeros(len(at), bool)
        fresh[0] = True
        for c in columns:
            s = c[order]
            fresh[1:] |= s[1:] != s[:-1]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        return rank

    def _doubled(self) -> list[np.ndarray]:
        """Ranks by 1, 2, 4, ... blocks; `rank` is that of the whole suffixes at the end."""
        levels, h = [self.rank.astype(np.int32)], 1
        while True:
            tied = np.flatnonzero(np.bincount(self.rank, minlength=len(self.rank))[self.rank] > 1)
            if not len(tied):
                return levels
            # A tied suffix has no end among its first h blocks, so it stays within its residue.
            first, second = self.rank[tied], self.rank[tied + h]
            order = np.lexsort((second, first))
            first, second, tied = first[order], second[order], tied[order]
            group = np.concatenate([[True], first[1:] != first[:-1]])
            fresh = group.copy()
            fresh[1:] |= second[1:] != second[:-1]
            at = np.arange(len(tied))
            rank = self.rank.copy()
            rank[tied] = first + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
            self.rank = rank
            levels.append(rank.astype(np.int32))
            h *= 2

    def _common(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that neighbours in the order of suffixes have in common."""
        a, b, words = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            same = (levels[level][a] == levels[level][b]) & (a != b)
            a[same] += 1 << level
            b[same] += 1 << level
            words += np.where(same, MODULUS << level, 0)
        left, right = self.places[a], self.places[b]
        live = np.flatnonzero(left != right)
        for t in range(MODULUS):
            live = live[self.words[left[live] + t] == self.words[right[live] + t]]
            words[live] += 1
        return words.astype(np.int32)

    def _tabled(self, common: np.ndarray) -> None:
        """Minima of 1, 2, 4, ... consecutive common prefixes, one after the other in one array."""
        rows, width = [common], 1
        while 2 * width <= len(common):
            last = rows[-1]
            rows.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        self.row = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        self.minima = np.concatenate(rows)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from `a` and from `b` on, which are different places of the sequence."""
        ahead = _STEPS[a % MODULUS, b % MODULUS]
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for t in range(MODULUS):
            done = ahead[live] == t
            if done.any():
                at = live[done]
                out[at] = t + self._sampled(a[at] + t, b[at] + t)
            live = live[~done]
            same = self.words[a[live] + t] == self.words[b[live] + t]
            out[live[~same]] = t
            live = live[same]
            if not len(live):
                return out
        return out

    def _sampled(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = (self.rank[self.begin[x % MODULUS] + x // MODULUS] for x in (a, b))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        at = self.row[level] + low
        return np.minimum(self.minima[at], self.minima[at + (high - low) - (1 << level)])


def _grid(first: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place and period of the grid: for each period p of a text the places 0, p, 2p, ... that have two more periods to come.

    There are about n / p places for a period, n log n in all.
    """
    order = np.argsort(-sizes, kind="stable")
    lengths = sizes[order]
    most = int(lengths[0]) // MIN_EXPONENT if len(lengths) else 0
    # Texts that a period fits, and the pairs that it makes at most.
    fits = np.searchsorted(-lengths, -MIN_EXPONENT * np.arange(1, most + 1), "right")
    totals = np.concatenate([[0], np.cumsum(lengths)])
    pairs = np.concatenate([[0], np.cumsum(totals[fits] // np.arange(1, most + 1))])
    low = 0
    while low < most:
        high = max(low + 1, int(np.searchsorted(pairs, pairs[low] + GRID_PAIRS, "right")) - 1)
        period = np.repeat(np.arange(low + 1, high + 1), fits[low:high])
        begin = np.cumsum(fits[low:high]) - fits[low:high]
        text = order[np.arange(len(period)) - np.repeat(begin, fits[low:high])]
        times = sizes[text] // period - 1
        # One period of a very long text may have many pairs: they come in parts.
        for part in np.array_split(np.arange(len(period)), max(1, int(times.sum()) // (2 * GRID_PAIRS))):
            p, t = np.repeat(period[part], times[part]), np.repeat(text[part], times[part])
            step = np.arange(len(p)) - np.repeat(np.cumsum(times[part]) - times[part], times[part])
            yield t, first[t] + step * p, p
        low = high


def _alike(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of the grid whose next words, a period or MODULUS of them, are the same one period on."""
    for text, place, period in _grid(first, sizes):
        for t in range(MODULUS):
            # A place has two periods to come, so words that are looked at are of its text; beyond its period the first word stands for them.
            step = np.where(period > t, t, 0)
            same = words[place + step] == words[place + step + period]
            text, place, period = text[same], place[same], period[same]
        yield text, place, period


def runs_of(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """All runs of texts whose words are `words[first[i]:first[i + 1]]`: rows of text, start, end, period, by text, start and period.

    A run has its smallest period, at least max(MIN_WORDS, MIN_EXPONENT * period) words, and cannot be made longer at either end. Its words
    equal those one period on over two periods at least, so some place of the grid has a whole period before the same words again.
    Places are first looked at word by word; only texts where some are left have their suffixes sorted.
    """
    sizes = np.diff(first)
    asked = np.zeros(len(sizes), bool)
    for text, _, _ in _alike(words, first[:-1], sizes):
        asked[text] = True
    asked = np.flatnonzero(asked)
    if not len(asked):
        return np.zeros((0, 4), np.int64)
    # The texts in question, one after the other, each with an end of its own.
    sizes = sizes[asked]
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    names = np.unique(np.concatenate([words[first[t] : first[t + 1]] for t in asked]), return_inverse=True)[1]
    ends = begin[1:] - 1
    joined = np.empty(begin[-1], np.int64)
    inner = np.ones(len(joined), bool)
    inner[ends] = False
    joined[inner] = names
    joined[ends] = names.max() + 1 + np.arange(len(asked))
    forwards = Extensions(joined)
    # The same backwards: the sequence turned around, and the last end behind it again.
    backwards, last = Extensions(np.concatenate([joined[-2::-1], joined[-1:]])), len(joined) - 2
    kept = []
    for text, place, period in _alike(joined, begin[:-1], sizes):
        ahead = forwards(place, place + period)
        full = ahead >= period
        text, place, period, ahead = text[full], place[full], period[full], ahead[full]
        # Nothing is before the first word of all.
        back = np.zeros(len(place), np.int64)
        some = np.flatnonzero(place > 0)
        back[some] = backwards(last + 1 - place[some], last + 1 - place[some] - period[some])
        start, end = place - back - begin[text], place + ahead + period - begin[text]
        long = end - start >= np.maximum(MIN_WORDS, MIN_EXPONENT * period)
        # A run is met at several places.
        kept.append(np.unique(np.stack([text, start, end, period], 1)[long], axis=0))
    found = np.unique(np.concatenate(kept), axis=0)
    # And with multiples of its period.
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:, :3] != found[:-1, :3]).any(1)
    found = found[fresh]
    found[:, 0] = asked[found[:, 0]]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _collapsed(words: list[bytes], runs: list[list[int]]) -> list[bytes]:
    """Words that are in no run after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, end, period in runs:
        edge[start + period] += 1
        edge[end] -= 1
    return [w for w, c in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not c]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in by_bytes(list(range(len(batch))), batch["text"].to_pylist(), SLICE_CHARS):
            hashes, first = word_hashes(texts)
            found = runs_of(hashes, first)
            bounds = np.searchsorted(found[:, 0], np.arange(len(rows) + 1))
            runs = [found[a:b, 1:].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            best, digests, collapsed, kept = [], [], [], []
            for text, own in zip(texts, runs, strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                left = _collapsed(words, own) if own else words
                top = max(own, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
                best.append(top and {"start": top[0], "length": top[1] - top[0], "period": top[2], "exponent_milli": 1000 * (top[1] - top[0]) // top[2]})
                digests.append(hashlib.sha256("".join(f"{s},{e - s},{p}\n" for s, e, p in own).encode()).hexdigest())
                joined = b" ".join(left)
                collapsed.append(hashlib.sha256(joined).hexdigest())
                kept.append(joined.decode("utf-8", "surrogatepass") if own else None)
            run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"].take(pa.array(rows)), pa.array(np.diff(first), pa.int64()),
                pa.array([[{"start": s, "length": e - s, "period": p} for s, e, p in own] for own in runs], pa.list_(run)),
                pa.array(best, pa.struct([*run, ("exponent_milli", pa.int64())])), pa.array(digests, pa.string()), pa.array(collapsed, pa.string()), pa.array(kept, pa.string()),
            ], names=["doc_id", "n_words", "runs", "best", "runs_sha256", "collapsed_sha256", "collapsed_text"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of repeated words in every whole text of `docs (doc_id, text)`.

    Words are `[^\\x20\\x09-\\x0D]+`. A run is a stretch of consecutive words with smallest period q (words q apart are equal, by 64-bit
    hashes) of at least max(24, 3 q) words that no neighbouring word extends with that period. Work is about n log n for a text of n words,
    whatever it repeats.

    Result, one row per input row: `doc_id`, `n_words`, `runs` (start, length, period; by start, then period), `best` (that of the greatest
    length / period, ties by smallest start, then period, with `exponent_milli`; null without runs), `runs_sha256` (of a line
    `start,length,period` per run), `collapsed_sha256` (of the words in no run after its first period, joined by one space) and
    `collapsed_text` (these words; null without runs). A null or empty text has no words and no runs. Rows are judged alone, so null and
    repeated ids and repeated rows are like any other. No rows give no rows; other columns are not used.
    """
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]).mapInArrow(
        _scanned,
        "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
        "best struct<start: bigint, length: bigint, period: bigint, exponent_milli: bigint>, runs_sha256 string, collapsed_sha256 string, collapsed_text string",
    )
