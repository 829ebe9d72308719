"""License scans: winnowed fingerprints propose, banded alignment decides.

Templates are fingerprinted once; the inverted index (fingerprint to template and place)
is as large as the templates are and goes to every task. Fingerprints that a document
shares with a template on nearby diagonals make a candidate, which is aligned with the
template word by word within a band.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stageline.llm.common import alnum_words, gram_hashes, sliding_min, slices, text_bytes, text_rows, words

#: wording of common license notices (fixed values)
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-grant": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
}
GRAM, WINDOW, BAND, COVERAGE = 2, 2, 4, 0.75
OUT = "doc_id long, license string, start long, `end` long, matched int, words int, coverage double"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


LOWERED = {c: c + 32 for c in range(0x41, 0x5B)}


def template_words(text: str) -> list[str]:
    return WORD.findall(text.translate(LOWERED))


def prints(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed fingerprints and their places: in each window the last least gram."""
    grams = gram_hashes(hashes, GRAM)
    if len(grams) < WINDOW:
        return grams, np.arange(len(grams))
    least = sliding_min(grams, WINDOW)
    places = np.flatnonzero(np.isin(grams, least))
    chosen = np.zeros(len(grams), bool)
    for j in range(WINDOW):
        chosen[j : j + len(least)] |= grams[j : j + len(least)] == least
    places = places[chosen[places]]
    return grams[places], places


def align(template: list[str], words_: list[str], shift: int, band: int = BAND) -> tuple[int, int, int]:
    """Most words of the template that the text has in order, within ``band`` of the
    diagonal ``shift``: (matched, first word, end word). Ties take the shortest span."""
    m = len(template)
    best: dict[int, tuple[int, int, int]] = {}  # diagonal to (matched, -start, end) so far
    for i, word in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        left = (0, 0, 0)
        for d in range(shift - band, shift + band + 1):
            j = i + d
            up = best.get(d + 1, (0, 0, 0))  # the template word is missing in the text
            cell = max(up, left)  # or the text word is extra
            if 0 <= j < len(words_) and words_[j] == word:
                n, start, _ = best.get(d, (0, 0, 0))
                cell = max(cell, (n + 1, start if n else -j, j + 1))
            row[d] = left = cell
        best = row
    n, start, end = max(best.values(), default=(0, 0, 0)) if m else (0, 0, 0)
    return n, -start, end


class Index:
    """Fingerprint to (template, place) for all templates."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = [template_words(templates[n]) for n in self.names]
        self.short = [i for i, w in enumerate(self.words) if 0 < len(w) < GRAM]
        rows = []
        for t, name in enumerate(self.names):
            body = np.frombuffer(templates[name].encode(), np.uint8)
            found, _ = words(body, np.array([0, len(body)]), alnum_words())
            rows += [(int(p), t, int(at)) for p, at in zip(*prints(found), strict=True)]
        rows.sort()
        self.prints = np.array([r[0] for r in rows], np.uint64)
        self.template = np.array([r[1] for r in rows], np.int64)
        self.place = np.array([r[2] for r in rows], np.int64)

    def candidates(self, hashes: np.ndarray) -> set[tuple[int, int]]:
        """(template, diagonal): one for each cluster of shared fingerprints."""
        grams = gram_hashes(hashes, GRAM)
        at = np.flatnonzero(np.isin(grams, self.prints)) if len(self.prints) else np.zeros(0, np.int64)
        hits = set()
        low, high = np.searchsorted(self.prints, grams[at], "left"), np.searchsorted(self.prints, grams[at], "right")
        for i, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
            hits.update((int(self.template[k]), i - int(self.place[k])) for k in range(a, b))
        out, last = set(), None
        for t, d in sorted(hits):
            if last is None or last[0] != t or d - last[1] > BAND // 2:
                out.add((t, d))
                last = (t, d)
        return out


def scan_text(text: str, hashes: np.ndarray, index: Index, coverage: float) -> list[tuple]:
    """(license, start, end, matched, words, coverage) in code points. Of overlapping
    notices the best covered stays, then the longest."""
    found = index.candidates(hashes)
    if not found:
        return []
    lowered = text.translate(LOWERED)
    spans = [m.span() for m in WORD.finditer(lowered)]
    own = [lowered[a:b] for a, b in spans]
    rows = []
    for t, d in found:
        low = max(0, d - BAND)
        matched, first, end = align(index.words[t], own[low : d + len(index.words[t]) + BAND], min(d, BAND))
        share = matched / len(index.words[t])
        if share >= coverage:
            rows.append((-share, -matched, end - first, first + low, end + low, t))
    out: list[tuple] = []
    taken: list[tuple[int, int]] = []
    for share, matched, _, a, b, t in sorted(rows):
        if all(b <= x or a >= y for x, y in taken):
            taken.append((a, b))
            out.append((index.names[t], spans[a][0], spans[b - 1][1], -matched, len(index.words[t]), -share))
    return sorted(out, key=lambda r: r[1])


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per found notice: doc_id, license, start, end (code points), matched words,
    words of the template, coverage.

    A notice is found if at least ``coverage`` of its words stand in order in the text,
    with at most ``BAND`` words inserted or left out, and two neighbouring words are
    intact. Null and empty texts hold none; rows that repeat a document are answered row
    by row; other columns are not read; no templates find nothing.
    """
    index = Index(TEMPLATES if templates is None else templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = alnum_words()
        for batch in slices(batches):
            hashes, starts = words(*text_bytes(batch.column("text")), table)
            grams = gram_hashes(hashes, GRAM)
            hit = np.flatnonzero(np.isin(grams, index.prints)) if len(index.prints) else np.zeros(0, np.int64)
            rows = np.unique(np.searchsorted(starts, hit, "right") - 1)
            out = []
            for r in rows.tolist():
                key = batch.column("id")[r].as_py()
                out += [(key, *x) for x in scan_text(batch.column("text")[r].as_py(), hashes[starts[r] : starts[r + 1]], index, coverage)]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            names = [c.split()[0].strip("`") for c in OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    rows = text_rows(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(scan, OUT)
