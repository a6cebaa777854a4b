"""A small corpus with the awkward rows, and plain-Python versions of the operators."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, rep bigint, family string, name string, kept string, "
    "hashes string, n_tokens string, copies string, epochs string, mix_key string, rest string, words string, label_id bigint, page_id string, h string"
)
EXTRA = (0, 0, "f", "n", "k", "h", "t", "c", "e", "m", "r", "w", 0, "p", "h")


def rows(seed: int = 3, n: int = 120) -> list[tuple]:
    """Copies, near copies, shared passages, repeated lines, and one row of each awkward kind."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 7))) for _ in range(300)] + ["the", "of", "and", "Über", "İstanbul", "K"]

    def text(size: int) -> str:
        return "\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 14))) for _ in range(size))

    passage, boiler = text(4), text(2)
    texts: list[str | None] = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and texts:
            texts.append(rng.choice(texts[-5:]))
        elif kind == 2 and texts[-1]:
            words = texts[-1].split(" ")
            words[rng.randrange(len(words))] = "edited"
            texts.append(" ".join(words))
        elif kind == 3:
            texts.append(text(2) + "\n" + passage + "\n" + text(1))
        elif kind == 4:
            texts.append(boiler + "\n\n" + text(3) + "\n" + boiler)
        else:
            texts.append(text(rng.randint(1, 8)))
    texts += [None, None, "", "", " \t\n ", "one", "One", "two words", "three little words", "x " * 40, text(400), texts[0].upper(), "#" * 300, "a\nb\na\nb\na\nb", "\x1c\x85 nbsp inside"]
    langs, sources = ["en", "de", None, "xx"], ["a", "a", "a", "b", "c", None]
    out = [(i * 3 % 401, t, langs[i % 4], sources[i % 6], len(t or "")) + EXTRA for i, t in enumerate(texts)]
    return out


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def lower_ascii(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def near(docs: list[tuple], k: int, percent: int) -> dict[int, tuple[int, int]]:
    sets = {}
    for doc_id, text in docs:
        w = words(lower_ascii(text))
        sets[doc_id] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    component = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            old, new = component[b], component[a]
            low, high = min(old, new), max(old, new)
            component = {i: low if c == high else c for i, c in component.items()}
    return {i: (len(sets[i]), component[i]) for i in sets}


def windows(docs: list[tuple], n: int) -> dict[int, tuple[int, int, str]]:
    split = {i: words(t) for i, t in docs}
    lowest: dict[tuple, int] = {}
    for i in sorted(split):
        for j in range(len(split[i]) - n + 1):
            lowest.setdefault(tuple(split[i][j : j + n]), i)
    out = {}
    for i, w in split.items():
        gone = {j + d for j in range(len(w) - n + 1) if lowest[tuple(w[j : j + n])] < i for d in range(n)}
        out[i] = (len(w), len(gone), sha(b" ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def line_runs(docs: list[tuple], n: int) -> dict[int, tuple[int, int, str]]:
    seen: set[tuple] = set()
    out = {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        lines = (text or "").split("\n")
        full = [j for j, line in enumerate(lines) if line.strip(" \t\n\x0b\x0c\r")]
        gone: set[int] = set()
        for at in range(len(full) - n + 1):
            run = tuple(lines[j] for j in full[at : at + n])
            if run in seen:
                gone.update(full[at : at + n])
            seen.add(run)
        out[i] = (len(full), len(gone), sha("\n".join(x for j, x in enumerate(lines) if j not in gone).encode()))
    return out


def base_rules(text: str | None) -> tuple:
    w = words(text)
    decoded = [x.decode() for x in w]
    lines = [x for x in (text or "").split("\n") if words(x)]
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(triples)
    covered = {i + d for i, t in enumerate(triples) if often[t] > 1 for d in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, decoded)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def equal_texts(docs: list[tuple]) -> dict[int, tuple]:
    groups = defaultdict(list)
    for i, text in docs:
        groups[lower_ascii(text)].append(i)
    return {i: (max(g), len(g), i == max(g), sha(t.encode())) for t, g in groups.items() for i in g}
