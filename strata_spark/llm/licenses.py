"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

A document's shingles are cut into blocks of 4; a window is two blocks in a row, so any 4 shingles in a row lie
whole in a window. Templates are cut into pieces of up to 4 shingles. With 128 bands of one register, a window
that has one of a piece's shingles meets it with a chance of 1 - (10/11) ** 128, over 0.99999, at least.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, add_columns, mix64
from .decontam import words

#: Names and the words of their notices, public texts of the licences' own authors.
TEMPLATES = {
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0-terms": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-3-Clause-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "GPL-2.0-terms": "either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-terms": "either version 3 of the License, or (at your option) any later version.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MIT-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
}
SHINGLE, BLOCK, BANDS = 5, 4, 128
CONTAINED = 0.75

_SEEDS = mix64(np.arange(11, 11 + 2 * BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULTIPLY, _ADD = (_SEEDS[:BANDS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (_SEEDS[BANDS:] >> np.uint64(32)).astype(np.uint32)
#: Templates are held whole in each worker, so a table of them may have this many characters: some 5 million keys, 150 MB.
TEMPLATE_CHARS = 1_000_000


@lru_cache(maxsize=1)
def _hashes() -> Memo:
    import xxhash

    return Memo(lambda w: xxhash.xxh3_64_intdigest(w), 200_000)


def in_order(found: list[bytes]) -> np.ndarray:
    """64-bit hashes of runs of five words in their order; fewer words have none."""
    h = np.fromiter(map(_hashes().__getitem__, found), np.uint64, len(found))
    n = len(h) - SHINGLE + 1
    s = np.full(max(0, n), SHINGLE, np.uint64)
    for k in range(SHINGLE if n > 0 else 0):
        s = mix64(s * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return s


def block_minima(s: np.ndarray) -> np.ndarray:
    """(blocks, bands): the least hash of each block of shingles by each band's function."""
    if len(s) % BLOCK:
        s = np.concatenate([s, np.repeat(s[-1:], BLOCK - len(s) % BLOCK)])
    h = (s >> np.uint64(32)).astype(np.uint32).reshape(-1, BLOCK)
    least = h[:, :1] * _MULTIPLY + _ADD
    for k in range(1, BLOCK):
        np.minimum(least, h[:, k : k + 1] * _MULTIPLY + _ADD, out=least)
    return least


class Index:
    """Templates by the values of their pieces' bands."""

    def __init__(self, templates: dict[str, str]):
        self.names, self.sets, keys, owners = list(templates), [], [], []
        for t, text in enumerate(templates.values()):
            s = in_order(words(text))
            if not len(s):
                raise ValueError(f"{self.names[t]}: a template needs {SHINGLE} words")
            self.sets.append(np.unique(s))
            keys.append(np.unique(self._keys(block_minima(s), np.arange(BANDS))))
            owners.append(np.full(len(keys[-1]), t))
        keys, owners = np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(owners or [np.zeros(0, int)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.bits = max(22, (8 * len(keys)).bit_length())  # an eighth of the cells at most are full
        self.there = np.zeros(1 << self.bits, bool)
        self.there[self._cell(self.keys.astype(np.uint32), (self.keys >> np.uint64(32)).astype(np.uint32))] = True

    @staticmethod
    def _keys(value, band):
        """A band and its value in one number."""
        return band.astype(np.uint64) << np.uint64(32) | value

    def _cell(self, value, band):
        return (value ^ (band * np.uint32(0x9E3779B1))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - self.bits)

    def candidates(self, s: np.ndarray) -> set[int]:
        """Templates that share a band with one of the windows."""
        out: set[int] = set()
        bands = np.arange(BANDS, dtype=np.uint32)
        for at in range(0, len(s), 8192):  # blocks overlap by one
            least = block_minima(s[at : at + 8192 + BLOCK])
            window = np.minimum(least[:-1], least[1:]) if len(least) > 1 else least
            w, band = np.nonzero(self.there[self._cell(window, bands)])
            asked = np.unique(self._keys(window[w, band], band))
            first, end = np.searchsorted(self.keys, asked), np.searchsorted(self.keys, asked, "right")
            for a, b in zip(first[end > first].tolist(), end[end > first].tolist(), strict=True):
                out.update(self.owners[a:b].tolist())
        return out

    def verify(self, s: np.ndarray, t: int) -> list[tuple[int, int]]:
        """Word spans, apart, in which a stretch of 5/4 of the template's length has 3/4 of its distinct shingles."""
        template = self.sets[t]
        at = np.flatnonzero(template[np.minimum(np.searchsorted(template, s), len(template) - 1)] == s)
        most, need, out, first, seen = max(1, len(template) * 5 // 4), CONTAINED * len(template), [], 0, {}
        for k, place in enumerate(at.tolist()):
            seen[s[place]] = seen.get(s[place], 0) + 1
            while place - at[first] >= most:
                seen[s[at[first]]] -= 1
                if not seen[s[at[first]]]:
                    del seen[s[at[first]]]
                first += 1
            if len(seen) >= need:
                if out and int(at[first]) < out[-1][1]:
                    out[-1] = (out[-1][0], place + SHINGLE)
                else:
                    out.append((int(at[first]), place + SHINGLE))
        return out


@lru_cache(maxsize=4)
def _index(templates: tuple) -> Index:
    return Index(dict(templates))


def templates_of(table: DataFrame, name: str = "name", text: str = "text") -> dict[str, str]:
    """Templates from a table with one row each, in order of name; its size is checked. Without a name or text a row is left out."""
    rows = table.select(F.col(name).cast("string").alias("name"), F.col(text).alias("text")).where("name is not null and text is not null").distinct()
    total = rows.agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"), F.sum(F.length("text")).alias("size")).first()
    if total.n > total.names:
        raise ValueError("two templates of one name")
    if (total.size or 0) > TEMPLATE_CHARS:
        raise ValueError(f"templates of {total.size} characters: {TEMPLATE_CHARS} at most")
    return {r.name: r.text for r in rows.orderBy("name").collect()}


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Adds licenses, array of (name, start, end) in words, by start and name, to docs; no shuffle.

    Words are as in decontamination. Null, empty and short texts have none; a notice with more words changed
    than a quarter of its shingles allow isn't reported; repeated rows get equal results; an empty table gives
    an empty table; a column of this name is replaced.
    """
    key = tuple(templates.items())

    def make(texts):
        import pyarrow as pa

        index, out = _index(key), []
        for t in texts.to_pylist():
            s = in_order(words(t))
            spans = [(a, index.names[k], b) for k in index.candidates(s) for a, b in index.verify(s, k)] if len(s) else []
            out.append([{"name": n, "start": a, "end": b} for a, n, b in sorted(spans)])
        return [pa.array(out, pa.list_(pa.struct([("name", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))]

    return add_columns(docs, text, "licenses array<struct<name:string,start:int,end:int>>", make)


def described(scanned: DataFrame) -> DataFrame:
    """doc_id, n_licenses, licenses (names, sorted and distinct) and spans as text."""
    spans = F.transform("licenses", lambda x: F.concat_ws(":", x["name"], x["start"].cast("string"), x["end"].cast("string")))
    return scanned.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(F.array_sort(F.array_distinct("licenses.name")), ",").alias("names"), F.array_join(spans, ",").alias("spans"))
