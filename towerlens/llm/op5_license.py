"""License scan: MinHash bands over text windows retrieve templates, exact containment verifies.

Words are runs of ASCII letters, digits and non-ASCII bytes, lower-cased, so
comment marks and punctuation don't matter. A template of s five-word shingles
belongs to the class of the power of two ``stride`` >= s. A document's shingles
are cut into blocks of ``stride``; its windows are all pairs of neighbouring
blocks, so any s shingles in a row lie in one window.

A window that contains 0.75 of a template has Jaccard similarity J of at least
0.75 s / (2 stride + 0.25 s) with it. With bands of one row, b bands miss it with
probability (1 - J)**b; b is chosen for each class to make that at most ``MISS``.
A window that shares a band with a template is verified: it matches if it holds
at least 0.75 of the template's distinct shingles, counted exactly.

The templates are a parameter of fixed size, shipped with the tasks. Every window
of every text is scanned; nothing is shuffled.

Defined results: null and empty texts, and texts under five words, match nothing.
Templates under five words are refused. Each row is scanned alone, so repeated
rows and null doc_ids each return a row; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.text import Prefix, Words, chunks, documents, mix, read_table, utf8

SHINGLE = 5
CONTAINMENT = 0.75
MISS = 1e-6

#: Notices and headers of public licenses (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

GAP = np.ones(256, dtype=bool)
GAP[48:58] = GAP[65:91] = GAP[97:123] = GAP[128:] = False


def license_shingles(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the shingles of each row in order of the text."""
    words = Words(raw, offs, lower=True, gaps=GAP)
    starts = np.flatnonzero(words.room() >= SHINGLE)
    return words.row[starts], Prefix(words.hashes()).windows(SHINGLE)[starts]


class Classes:
    """Templates by stride, with their shingles, bands and the minima that retrieve them."""

    def __init__(self, templates: tuple, containment: float, miss: float):
        self.containment, self.by_stride = containment, {}
        for name, text in templates:
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            _, code = license_shingles(data, np.array([0, len(data)]))
            if not len(code):
                raise ValueError(f"template {name!r} has fewer than {SHINGLE} words")
            stride = 1 << (len(code) - 1).bit_length()
            self.by_stride.setdefault(stride, []).append((name, np.unique(code)))
        self.bands = {}
        for stride, group in self.by_stride.items():
            least = min(containment * len(c) / (2 * stride + (1 - containment) * len(c)) for _, c in group)
            self.bands[stride] = max(1, ceil(log(miss) / log(1 - least)))

    @staticmethod
    def order(code: np.ndarray, band: int) -> np.ndarray:
        """The hash of one band, by which minima are taken."""
        return mix(code ^ np.uint64(0x9E3779B97F4A7C15 * (band + 1) & 0xFFFFFFFFFFFFFFFF))

    def scan(self, row: np.ndarray, code: np.ndarray, rows: int) -> list[tuple[int, str]]:
        """(row, license) of each verified match."""
        if not len(code):
            return []
        size = np.bincount(row, minlength=rows)
        first = np.cumsum(size) - size
        index = np.arange(len(row)) - first[row]
        cells = {}
        for stride in self.by_stride:
            begin = np.flatnonzero(index % stride == 0)
            paired = np.append(row[begin[1:]] == row[begin[:-1]], False)
            cells[stride] = (begin, paired, [np.zeros(len(begin), dtype=bool) for _ in self.by_stride[stride]])
        for band in range(max(self.bands.values())):
            value = self.order(code, band)
            for stride, group in self.by_stride.items():
                if band >= self.bands[stride]:
                    continue
                begin, paired, hits = cells[stride]
                least = np.minimum.reduceat(value, begin) if stride > 1 else value
                both = least.copy()
                both[:-1] = np.where(paired[:-1], np.minimum(least[:-1], least[1:]), least[:-1])
                for hit, (_, template) in zip(hits, group):
                    hit |= both == self.order(template, band).min()
        found = []
        for stride, group in self.by_stride.items():
            begin, paired, hits = cells[stride]
            ends = np.append(begin[1:], len(row))
            for hit, (name, template) in zip(hits, group):
                for w in np.flatnonzero(hit):
                    end = ends[w + 1] if paired[w] else ends[w]
                    if np.isin(template, code[begin[w]:end]).sum() >= self.containment * len(template):
                        found.append((int(row[begin[w]]), name))
        return found


def license_scan(docs: DataFrame, templates: tuple = TEMPLATES, containment: float = CONTAINMENT,
                 miss: float = MISS) -> DataFrame:
    """(doc_id, licenses): the sorted names of the licenses that each document holds."""
    classes = Classes(templates, containment, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = utf8(b.column("text"))
            for i, j in chunks(raw, offs, 1 << 20):
                row, code = license_shingles(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                names = [set() for _ in range(j - i)]
                for r, name in classes.scan(row, code, j - i):
                    names[r].add(name)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array([sorted(x) for x in names], pa.list_(pa.string()))],
                    ["doc_id", "licenses"])

    return documents(docs).mapInArrow(run, "doc_id long, licenses array<string>")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"),
                      F.array_join("licenses", ",").alias("licenses"))
