"""Licence notices: exact phrases, and a search for short notices with a bounded number of edits."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_texts, worker_cache

_word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

#: Phrases whose words must stand side by side, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Short notices as words, and their labels. Words in braces tell licences apart: they bear no edits.
NOTICES = {
    "released under the {mit} license": "mit",
    "licensed under the {mit} license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "licensed under the {isc} license": "isc",
    "released under the {isc} license": "isc",
    "licensed under the {apache} license version 2 0": "apache",
    "released under the {apache} license": "apache",
    "licensed under the gnu {general} public license version": "gpl",
    "released under the gnu {general} public license": "gpl",
    "under the terms of the gnu {general} public license": "gpl",
    "under the terms of the gnu {lesser} general public license": "lgpl",
    "licensed under the gnu {lesser} general public license": "lgpl",
    "under the terms of the gnu {library} general public license": "lgpl",
    "under the terms of the gnu {affero} general public license": "agpl",
    "licensed under the gnu {affero} general public license": "agpl",
    "licensed under the {mozilla} public license version": "mpl",
    "subject to the terms of the {mozilla} public license": "mpl",
    "licensed under the {mpl} license": "mpl",
    "released under the {mpl} license": "mpl",
    "under the terms of the {eclipse} public license": "epl",
    "licensed under the {eclipse} public license": "epl",
    "subject to the terms of the common {development} and {distribution} license": "cddl",
    "licensed under the {european} {union} public licence": "eupl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "redistributions of source code must retain the above copyright notice": "bsd",
    "redistributions in binary form must reproduce the above copyright notice": "bsd",
    "neither the name of the copyright holder nor the names of its contributors may be used": "bsd",
    "licensed under the {bsd} license": "bsd",
    "released under the {bsd} license": "bsd",
    "distributed under the {boost} software license version 1 0": "boost",
    "licensed under the {artistic} license": "artistic",
    "licensed under the sil open {font} license": "ofl",
    "this software is provided as is without any express or implied warranty": "zlib",
    "this is free and unencumbered software released into the public {domain}": "unlicense",
    "dedicated to the public {domain}": "public-domain",
    "{cc0} 1 0 universal": "cc0",
    "released under {cc0} 1 0": "cc0",
    "licensed under {cc} {by} {nc} {nd} 4 0": "cc-by-nc-nd",
    "licensed under {cc} {by} {nc} {sa} 4 0": "cc-by-nc-sa",
    "licensed under {cc} {by} {nc} 4 0": "cc-by-nc",
    "licensed under {cc} {by} {nd} 4 0": "cc-by-nd",
    "licensed under {cc} {by} {sa} 4 0": "cc-by-sa",
    "licensed under {cc} {by} 4 0": "cc-by",
    "creative commons {attribution} {noncommercial} {noderivatives}": "cc-by-nc-nd",
    "creative commons {attribution} {noncommercial} {sharealike}": "cc-by-nc-sa",
    "creative commons {attribution} {noncommercial}": "cc-by-nc",
    "creative commons {attribution} {noderivatives}": "cc-by-nd",
    "creative commons {attribution} {sharealike}": "cc-by-sa",
    "creative commons {attribution}": "cc-by",
    "all rights reserved": "proprietary",
}


def edits_for(notice: str) -> int:
    """Edits that a notice may have: one for each 14 characters."""
    return len(notice) // 14


def words_of(text: str) -> list[str]:
    return _word.findall(text.encode("utf-8").lower().decode("utf-8"))  # bytes lower A-Z alone


@dataclass
class Search:
    """Automaton over the seeds: a notice with up to k edits holds one of its k + 1 parts unchanged."""

    automaton: ahocorasick.Automaton
    seeds: list[list[tuple[int, int]]]  # (notice, place of the seed in it)
    notices: list[str]
    labels: list[str]
    edits: list[int]
    patterns: list[regex.Pattern]


def bare(notice: str) -> str:
    return notice.replace("{", "").replace("}", "")


def pattern_of(notice: str, edits: int) -> regex.Pattern:
    """The first match of a stretch, with its fit improved. A match begins and ends at the ends of words, and the words
    in braces stand in it as they are; `edits` may fall on each stretch between them, on all of them by a later count."""
    parts = re.split(r"\{([^}]*)\}", notice)
    fuzzy = [f"(?:{regex.escape(x, literal_spaces=True)}){{e<={edits}}}" if x and k % 2 == 0 else "" if k % 2 == 0 else rf"(?<!\S){regex.escape(x)}(?!\S)" for k, x in enumerate(parts)]
    return regex.compile(rf"(?e)(?<!\S)(?:{''.join(fuzzy)})(?!\S)")


def search_for(notices: dict[str, str]) -> Search:
    seeds: dict[str, list[tuple[int, int]]] = {}
    names = [bare(n) for n in notices]
    for n, notice in enumerate(names):
        parts = edits_for(notice) + 1
        edges = [len(notice) * k // parts for k in range(parts + 1)]
        for a, b in zip(edges, edges[1:]):
            seeds.setdefault(notice[a:b], []).append((n, a))
    automaton = ahocorasick.Automaton()
    for k, seed in enumerate(seeds):
        automaton.add_word(seed, k)
    automaton.make_automaton()
    patterns = [pattern_of(n, edits_for(bare(n))) for n in notices]
    return Search(automaton, list(seeds.values()), names, list(notices.values()), [edits_for(n) for n in names], patterns)


def _search(notices: dict[str, str]) -> Search:
    held = worker_cache()
    key = ("notices", tuple(notices.items()))
    if key not in held:
        held[key] = search_for(notices)
    return held[key]


def verified(words: list[str], search: Search) -> list[tuple[int, int, int, int]]:
    """(notice, first word, last word, edits) of all notices found in the words of a text, joined by single spaces.

    Windows around seeds of a notice are joined where they overlap, so each stretch is verified once; a stretch is
    searched on after each match.
    """
    line = " ".join(words)
    windows: dict[int, list[list[int]]] = {}
    for end, k in search.automaton.iter(line):
        for n, at in search.seeds[k]:
            length, k_edits = len(search.notices[n]), search.edits[n]
            size = end + 1 - _seed_start(search, n, at, end)
            begin = end + 1 - size - at
            windows.setdefault(n, []).append([max(0, begin - k_edits), min(len(line), begin + length + k_edits)])
    if not windows:
        return []
    starts = np.cumsum([0, *[len(w) + 1 for w in words[:-1]]])
    out = []
    for n, stretches in windows.items():
        for lo, hi in _joined(stretches):
            at = lo
            while at < hi and (m := search.patterns[n].search(line, at, hi)) and m.end() > m.start():
                edits = sum(m.fuzzy_counts)
                if edits > search.edits[n]:
                    at = int(starts[min(np.searchsorted(starts, m.start(), side="right"), len(starts) - 1)])
                    if at <= m.start():
                        break
                    continue
                first = int(np.searchsorted(starts, m.start(), side="right")) - 1
                last = int(np.searchsorted(starts, m.end() - 1, side="right")) - 1
                out.append((n, first, last, edits))
                at = m.end()
    return out


def fuzzy_matches(words: list[str], search: Search) -> list[tuple[int, int, int, int]]:
    """The verified matches in order of their words. Of those that share words the best stays: the smallest share of
    edits, then the longest notice."""
    kept: list[tuple[int, int, int, int]] = []  # in order, sharing no words
    for m in sorted(verified(words, search), key=lambda m: (m[3] / len(search.notices[m[0]]), -len(search.notices[m[0]]), m[1], m[0])):
        at = bisect_left(kept, m[1], key=lambda k: k[1])
        if (at == 0 or kept[at - 1][2] < m[1]) and (at == len(kept) or kept[at][1] > m[2]):
            kept.insert(at, m)
    return kept


def _joined(windows: list[list[int]]) -> list[list[int]]:
    """Stretches covered by windows."""
    out: list[list[int]] = []
    for lo, hi in sorted(windows):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _seed_start(search: Search, n: int, at: int, end: int) -> int:
    parts = search.edits[n] + 1
    length = len(search.notices[n])
    edges = [length * k // parts for k in range(parts + 1)]
    return end + 1 - (edges[edges.index(at) + 1] - at)


def phrase_places(words: list[str], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand side by side."""
    out = []
    for phrase, label in phrases.items():
        parts = phrase.split()
        rarest, shift = parts[-1], len(parts) - 1
        at = -1
        while True:
            try:
                at = words.index(rarest, at + 1)
            except ValueError:
                break
            if at >= shift and words[at - shift : at + 1] == parts:
                out.append((at - shift, label))
    return sorted(out)


_MATCHES = "matches array<struct<label:string,notice:string,first_word:bigint,last_word:bigint,edits:int>>"
_TYPE = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())]))


def find_licenses(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", phrases: dict[str, str] = PHRASES,
                  notices: dict[str, str] = NOTICES) -> DataFrame:
    """`keep` columns with n_words, `places` (first_word, label) of the exact phrases, and `matches` of the notices.

    Every whole text is searched; null and empty texts have no words, places or matches. Edits are insertions,
    deletions and substitutions of characters in the words joined by single spaces. Matches begin and end with words,
    and the words that tell licences apart bear no edits. Repeated rows and ids stay; other
    columns are dropped; a kept column named like a result gives way; an empty table gives an empty one.
    """
    fields = f"n_words bigint, places array<struct<first_word:bigint,label:string>>, {_MATCHES}"

    def work(texts: list) -> list:
        search = _search(notices)
        n, places, matches = [], [], []
        for t in texts:
            words = words_of(t or "")
            n.append(len(words))
            places.append([{"first_word": w, "label": label} for w, label in phrase_places(words, phrases)])
            matches.append([{"label": search.labels[k], "notice": search.notices[k], "first_word": a, "last_word": b, "edits": e}
                            for k, a, b, e in fuzzy_matches(words, search)])
        place_type = pa.list_(pa.struct([("first_word", pa.int64()), ("label", pa.string())]))
        return [pa.array(n, pa.int64()), pa.array(places, place_type), pa.array(matches, _TYPE)]

    return map_texts(docs, work, fields, keep, text)
