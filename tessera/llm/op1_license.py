"""License scans by conditional compression.

Blocks of a text are the words around cue words, as far as the longest template reaches, across line breaks; blocks that meet are
one. For each template overlapping windows of about its length cover the block, so that any wording of it lies whole in one. Every
window is compressed with zstandard alone and with the template as raw dictionary; a template may lie only where the bytes saved, as
a share of the template's own compressed size, reach a limit. Such windows are confirmed by their exact wording differences: a
word alignment, at shifts where enough words agree, whose missing and added words are returned; the saving of the wording found
must reach the limit too. Of confirmed windows that overlap the one with
the most agreeing words, less its differences, stays; all others are reported.

Defined results: a null or empty text has no block and no licence; equal windows rank by saving and template name; windows of
equal wording in a text are reported once, with their number; words are compared without case, punctuation and layout.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column_list, prepare

# Short notices by which public licences are applied to a work.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-short": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0-short": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0-short": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-short": "This work is licensed under the GNU General Public License, version 2.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "MIT-short": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_CUE = re.compile(r"licen[cs]|copyright|permission is|redistribut|public domain|creative commons|warrant|unencumbered", re.I)
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


@dataclass(frozen=True)
class Match:
    template: str
    reduction: float
    matched: int
    missing: str
    added: str
    exact: bool


class LicenseScanner:
    """Finds windows of a block where templates may lie, by conditional compression, and confirms them by their words."""

    def __init__(self, templates: dict[str, str] | None = None, least_reduction: float = 0.35, least_wording: float = 0.9, level: int = 19) -> None:
        self.least_reduction, self.least_wording = least_reduction, least_wording
        self.words: dict[str, list[str]] = {}
        self.with_template, self.own_size = {}, {}
        self.alone = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.places: dict[str, dict[str, list[int]]] = {}  # of every word in each template
        self.memo: dict[tuple[str, str], tuple | None] = {}
        for name, text in (TEMPLATES if templates is None else templates).items():
            self.words[name] = [w.lower() for w in _WORD.findall(text)]
            self.places[name] = defaultdict(list)
            for k, w in enumerate(self.words[name]):
                self.places[name][w].append(k)
            body = " ".join(text.split()).lower().encode()
            self.own_size[name] = len(self.alone.compress(body))
            body = body if len(body) >= 8 else body.ljust(8)  # the format's smallest dictionary
            data = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_template[name] = zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_dict_id=False)
        self.reach = max((len(w) + 2 * self.slack(len(w)) for w in self.words.values()), default=0)

    def slack(self, n: int) -> int:
        """Words that may be missing from or added to a template of n words."""
        return int((1 - self.least_wording) * n + 1e-9)

    def blocks(self, text: str | None) -> list[list[tuple[int, int]]]:
        """The words (begin and end in the text) around cues, as far as the longest template reaches."""
        if not text or not _CUE.search(text):
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        if not spans:
            return []
        begins = [a for a, _ in spans]
        out: list[list[int]] = []
        for cue in _CUE.finditer(text):
            at = max(0, bisect_right(begins, cue.start()) - 1)
            low, high = max(0, at - self.reach), min(len(spans), at + self.reach + 1)
            if out and low <= out[-1][1]:
                out[-1][1] = high
            else:
                out.append([low, high])
        return [spans[low:high] for low, high in out]

    def saving(self, window: str, name: str, alone: int | None = None) -> float:
        """Bytes that the template saves of a window, as a share of the template's own compressed size."""
        raw = window.lower().encode("utf-8", "surrogatepass")
        alone = len(self.alone.compress(raw)) if alone is None else alone
        return (alone - len(self.with_template[name].compress(raw))) / self.own_size[name]

    def windows(self, text: str, spans: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
        """(template, begin, end) of stretches of windows whose saving reaches the limit."""
        size: dict[tuple[int, int], int] = {}  # templates of one length have the same windows
        for name, words in self.words.items():
            # Where no word may differ every wording is a window of its own, so other words never hide its saving.
            longest, step = len(words) + self.slack(len(words)), 1 + self.slack(len(words))
            low = high = 0
            for at in range(0, max(1, len(spans) - longest + step), step):
                end = min(len(spans), at + longest + step - 1)
                window = " ".join(text[spans[at][0] : spans[end - 1][1]].split())
                if (at, end) not in size:
                    size[at, end] = len(self.alone.compress(window.lower().encode("utf-8", "surrogatepass")))
                if self.saving(window, name, size[at, end]) >= self.least_reduction:
                    if at > high:
                        if high:
                            yield name, low, high
                        low = at
                    elif not high:
                        low = at
                    high = end
            if high:
                yield name, low, high

    def candidates(self, name: str, words: list[str]) -> Iterator[tuple[int, int]]:
        """(begin, end): where least_wording of the template's words stand within the shifts that its differences allow."""
        votes: Counter[int] = Counter()
        for at, w in enumerate(words):
            votes.update(at - k for k in self.places[name].get(w, ()))
        n = len(self.words[name])
        slack = self.slack(n)
        for shift in sorted(votes):
            if sum(votes.get(shift + d, 0) for d in range(2 * slack + 1)) >= self.least_wording * n:
                yield max(0, shift), min(len(words), shift + n + 2 * slack)

    def aligned(self, name: str, words: list[str]) -> tuple[int, int, int, list[str], list[str]] | None:
        """Begin and end of the template's wording in `words`, agreeing words, missing and added ones; None if too many differ."""
        template = self.words[name]
        parts = [p for p in SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks() if p.size]
        # Single words that agree by chance far before or behind the wording don't belong to it.
        while len(parts) > 1 and parts[0].size < parts[1].b - parts[0].b - parts[0].size:
            parts.pop(0)
        while len(parts) > 1 and parts[-1].size < parts[-1].b - parts[-2].b - parts[-2].size:
            parts.pop()
        if not parts:
            return None
        begin, end, matched = parts[0].b, parts[-1].b + parts[-1].size, sum(p.size for p in parts)
        kept = {i for p in parts for i in range(p.a, p.a + p.size)}
        inside = {i for p in parts for i in range(p.b, p.b + p.size)}
        added = [words[i] for i in range(begin, end) if i not in inside]
        missing = [w for i, w in enumerate(template) if i not in kept]
        if matched < self.least_wording * len(template) or len(added) > (1 - self.least_wording) * len(template):
            return None
        return begin, end, matched, missing, added

    def scan_block(self, text: str, spans: list[tuple[int, int]]) -> list[tuple[str, Match]]:
        """Disjoint windows of the block with their confirmed templates, in the text's order."""
        words = [text[a:b].lower() for a, b in spans]
        found: dict[tuple[str, int, int], Match] = {}
        for name, low, high in ((name, a + x, a + y) for name, a, b in self.windows(text, spans) for x, y in self.candidates(name, words[a:b])):
            key = name, " ".join(words[low:high])
            if key not in self.memo:
                if len(self.memo) >= 10_000:
                    self.memo.clear()
                self.memo[key] = self.aligned(name, words[low:high])
            if (got := self.memo[key]) is None:
                continue
            begin, end, matched, missing, added = low + got[0], low + got[1], *got[2:]
            if (name, begin, end) in found:
                continue
            reduction = self.saving(" ".join(text[spans[begin][0] : spans[end - 1][1]].split()), name)
            if reduction >= self.least_reduction:
                found[name, begin, end] = Match(name, round(reduction, 6), matched, " ".join(missing), " ".join(added), not missing and not added)
        # The wording decides: the most agreeing words less the differences.
        ranked = sorted(found.items(), key=lambda f: (len(f[1].missing.split()) + len(f[1].added.split()) - f[1].matched, -f[1].reduction, f[0]))
        taken: list[tuple[int, int, Match]] = []
        for (_, begin, end), match in ranked:
            if all(end <= a or begin >= b for a, b, _ in taken):
                taken.append((begin, end, match))
        return [(" ".join(text[spans[a][0] : spans[b - 1][1]].split()), m) for a, b, m in sorted(taken, key=lambda t: t[:2])]


SCHEMA = "doc_id long, n_blocks long, licenses array<string>, matches array<struct<license: string, block: string, repeats: int, reduction: double, missing: string, added: string, exact: boolean>>"


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row for each row of docs (doc_id, text): candidate blocks, confirmed licences, and each match with its wording differences."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(templates)
        for batch in batches:
            counts, names, matches = [], [], []
            for text in column_list(batch, "text"):
                blocks = scanner.blocks(text)
                every = [found for block in blocks for found in scanner.scan_block(text, block)]
                times = Counter((block, m.template) for block, m in every)
                found = []
                for block, m in {(block, m.template): (block, m) for block, m in every}.values():
                    found.append({"license": m.template, "block": block, "repeats": times[block, m.template], "reduction": m.reduction, "missing": m.missing, "added": m.added, "exact": m.exact})
                counts.append(len(blocks))
                names.append(sorted({m["license"] for m in found}))
                matches.append(found)
            kind = pa.list_(pa.struct([("license", pa.string()), ("block", pa.string()), ("repeats", pa.int32()), ("reduction", pa.float64()), ("missing", pa.string()), ("added", pa.string()), ("exact", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(matches, kind)], names=["doc_id", "n_blocks", "licenses", "matches"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def summary(scanned: DataFrame) -> DataFrame:
    """Flat columns of `scan`: doc_id, n_blocks, licenses (joined by a comma), n_exact, best_reduction."""
    return scanned.select(
        "doc_id", "n_blocks", F.array_join("licenses", ",").alias("licenses"),
        F.size(F.filter("matches", lambda m: m["exact"])).cast("long").alias("n_exact"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["reduction"])), F.lit(0.0)).alias("best_reduction"),
    )
