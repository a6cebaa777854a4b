"""Licence texts, headers and statements found by the Dice coefficient of word bigrams, with DataFrame functions only."""

from __future__ import annotations

import re
from pathlib import Path

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Common licence statements, one template each.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# Headers that files of a licence begin with, and titles.
GNU_HEADER = """This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free
    Software Foundation, either version {version} of the License, or (at your option) any later version. This {what} is distributed in the hope that it will be
    useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details.
    You should have received a copy of the GNU {kind} along with this {what}"""
HEADERS = [
    *((f"{short}-{version}.0" if "." not in version else f"{short}-{version}", GNU_HEADER.format(what=what, mark=":", kind=kind, version=version))
      for short, kind, what, version in (
          ("AGPL", "Affero General Public License", "program", "3"), ("GPL", "General Public License", "program", "2"),
          ("GPL", "General Public License", "program", "3"), ("LGPL", "Lesser General Public License", "library", "2.1"),
          ("LGPL", "Lesser General Public License", "library", "3"))),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain
        a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License
        is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one
        at http://mozilla.org/MPL/2.0/."""),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]
# Whole licence texts, a file each.
TEXTS = Path(__file__).parent / "licence_texts"
MIN_DICE = 0.8


def all_templates() -> list[tuple[str, str]]:
    return [*TEMPLATES, *HEADERS, *((f.stem, f.read_text("utf-8")) for f in sorted(TEXTS.glob("*.txt")))]


def bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def bigram_hash(gram: str) -> int:
    """`xxhash64(first word, second word)` of Spark."""
    seed = 42
    for word in gram.split():
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def _longs(values: list[int]) -> str:
    return f"cast(split('{','.join(map(str, values))}', ',') as array<bigint>)"


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """The licence text, header or statement in each of `docs (doc_id, text)` that is nearest to a template.

    The whole text is normalised (lower case, all but a-z and 0-9 to single blanks) and its runs of words, across line ends, are compared with
    the templates (all of `all_templates` by default) by the Dice coefficient of their sets of word bigrams. All runs are judged but those that a
    longer one is surely as near as: a run begins where the bigram before is not in the template. It has at most b (2 / `min_dice` - 1) bigrams for a
    template of b: no longer one can reach it. Bigrams are identified by 64-bit hashes. Runs are compared where they are read; nothing is shuffled.

    Of overlapping runs for one template the nearest counts, and a run inside one for a template of twice its bigrams or more is a part of that.
    Result, one row per input row: `doc_id`, `licence` (of the best run; null if none reaches `min_dice`), `dice`, `line` (from 1, where it begins; the first of
    equals), `n_statements` (lines where a run that reaches it begins). Of equal coefficients the first licence in the alphabet is told. Null, empty and one-word
    texts have none. Repeated rows are scanned alike. No rows give no rows; other columns are not used.
    """
    grams = [(name, sorted(map(bigram_hash, bigrams(text)))) for name, text in (all_templates() if templates is None else templates)]
    grams = [(name, g) for name, g in grams if g]
    known = ", ".join(f"named_struct('id', {i}, 'name', '{name}', 'n', {len(g)}, 'grams', {_longs(g)})" for i, (name, g) in enumerate(grams))
    told = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Templates that have enough bigrams anywhere in the text.
    words = "split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ')), ' ')"
    hashes = "if(size(w) > 1, zip_with(slice(w, 1, size(w) - 1), slice(w, 2, size(w) - 1), (x, y) -> xxhash64(x, y)), cast(array() as array<bigint>))"
    shared = f"array_intersect({_let('w', words, hashes)}, {_longs(sorted(set().union(*[g for _, g in grams])))})"
    met = _let("c", shared, f"""case when size(c) > 0 then filter(array({known}),
        t -> 2 * size(array_intersect(t.grams, c)) >= {min_dice} * (size(array_intersect(t.grams, c)) + t.n) - 1e-9) end""")
    # Words with their lines, bigrams, and the place where each bigram was before.
    lined = """flatten(transform(split(text, '\n'), (l, i) -> transform(filter(split(regexp_replace(lower(l), '[^a-z0-9]+', ' '), ' '), x -> x <> ''),
        x -> struct(x as word, i + 1 as line))))"""
    pairs = "zip_with(slice(w, 1, size(w) - 1), slice(w, 2, size(w) - 1), (x, y) -> struct(xxhash64(x.word, y.word) as h, x.line as line))"
    ordered = "array_sort(transform(b, (x, p) -> struct(x.h as h, p as p)))"
    before = "array_sort(transform(o, (x, k) -> struct(x.p as p, if(get(o, k - 1).h <=> x.h, get(o, k - 1).p, -1) as last)))"
    # The run of a start that is nearest: its end is the k-th distinct bigram of the template among the a distinct ones.
    distinct = f"slice(filter(slice(places, s + 1, size(places)), m -> m.last < s), 1, cast(t.n * ({2 / min_dice} - 1) as int) + 1)"
    counted = "filter(transform(d, (m, k) -> struct(k + 1 as a, m.p as p)), m -> f[m.p])"
    nearest = _let("d", distinct, f"array_max(transform({counted}, (m, k) -> struct(2D * (k + 1) / (m.a + t.n) as dice, -m.p as back)))")
    run = f"transform(array({nearest}), r -> struct(r.dice as dice, s as s, -r.back as e))[0]"
    starts = "filter(sequence(0, size(b) - 1), p -> f[p] and not coalesce(get(f, p - 1), false))"
    hits = _let("f", "transform(b, x -> array_contains(t.grams, x.h))", f"filter(transform({starts}, s -> {run}), r -> r.dice >= {min_dice})")
    # Bigrams that the run has again later do not begin it.
    first = "aggregate(sequence(r.s, r.e), r.s, (at, p) -> if(at = p and array_contains(slice(hs, p + 2, r.e - p), hs[p]), p + 1, at))"
    told_run = f"transform(array({first}), s -> struct(r.dice as dice, t.name as name, b[s].line as line, t.id as id, t.n as n, s as s, r.e as e))[0]"
    runs = _let("hs", "transform(b, x -> x.h)", f"flatten(transform(met, t -> transform({hits}, r -> {told_run})))")
    found = _let("w", lined, _let("b", pairs, _let("o", ordered, _let("places", before, runs))))
    worse = """y.id = x.id and y.s <= x.e and x.s <= y.e and (y.dice > x.dice or (y.dice = x.dice and y.s < x.s))
        or y.n >= 2 * x.n and y.s <= x.s and x.e <= y.e"""
    hits = told.withColumn("met", F.expr(met)).select("doc_id", F.expr(f"case when size(met) > 0 then {found} end").alias("found"))
    hits = hits.select("doc_id", F.expr(f"filter(found, x -> not exists(found, y -> {worse}))").alias("hits"))
    top = F.expr("array_sort(hits, (x, y) -> case when x.dice > y.dice then -1 when x.dice < y.dice then 1 when x.name < y.name then -1 when x.name > y.name then 1 else x.line - y.line end)[0]")
    hits = hits.withColumns({"top": F.when(F.size("hits") > 0, top), "n_statements": F.expr("coalesce(size(array_distinct(transform(hits, h -> h.line))), 0)").cast("bigint")})
    return hits.select("doc_id", F.col("top.name").alias("licence"), F.col("top.dice").alias("dice"), F.col("top.line").cast("bigint").alias("line"), "n_statements")
