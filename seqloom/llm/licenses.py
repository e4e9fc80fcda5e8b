"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance down the tree.

Three kinds of units of a text are compared with templates as sparse vectors of term weights: its lines and sentences
within a line; sentences of a paragraph that run over a line end; and the whole text where it holds at least
`STRONG_WORDS` of the words that licences are made of. The first two are compared with header templates, the
whole text with whole licences. Document frequencies count all lines and sentences of all files that hold a term.

A file whose whole text is like a licence (`FILE_THRESHOLD`), or of whose words `FILE_SHARE` lie in matching
units, is a licence file and speaks for its directory. A file without a licence of its own takes that of the nearest
directory above it that has a licence file.

A unit without a template word has cosine 0 with every header template: leaving it out drops nothing. Nor does leaving
out one whose cosine stays below the threshold even if its other terms weighed least. Texts are read once, in blocks of
bounded bytes; what leaves a task are its units with template words and one count for each different term.

Terms are runs of letters, digits and other characters beyond Latin-1 signs and general punctuation, without
stop words; ASCII case does not matter.

Defined results: a null or empty text has no own licence and may inherit one; a null path inherits nothing;
a whole text's match goes before those of its units; ties go to the higher cosine, then to the licence's name; of
several licence files in a directory the best match speaks, then the least path; equal rows get equal results; input
columns named like an output (`VERDICT`) are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm import tokens as T
from seqloom.llm.licence_texts import WHOLE
from seqloom.llm.lm import TASK_KEYS, merged_counts
from seqloom.llm.shipping import map_arrow
from seqloom.llm.store import REST, number_rows, pack_rest, release, rest_of, store
from seqloom.llm.words import word_count

#: Header lines and licence openings by licence id (fixed values).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the Apache License at"
                   " http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and modify it under the terms of the GNU General"
                " Public License as published by the Free Software Foundation, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
                     " that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved."),
)
STOP = frozenset(
    "a an and any are as at be by can for from have if in into is it its may no not of on or that the them they this"
    " to was were with you your all which who will under use used work source form copy file files free person".split()
) - {"all", "by"}
#: Words that licences are made of: a text with so many different ones is compared as a whole.
STRONG = (
    "license licence licenses licensed licensor licensee copyright copyrights copyrighted warranty warranties permission permissions"
    " redistribution redistributions redistribute liability liable merchantability noninfringement sublicense disclaimer"
    " disclaimed unencumbered relinquishment trademark patent conditions granted infringement distribute modify"
).split()
STRONG_WORDS = 5
THRESHOLD = 0.6
FILE_THRESHOLD = 0.5
FILE_SHARE = 0.5
#: Kinds of units.
LINE, JOINED, FILE = 0, 1, 2

_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?;")] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r")] = True


def _term_bytes(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes with a blank wherever no term is."""
    inside = _TERM[data]
    latin = np.flatnonzero(data == 0xC2)  # signs of Latin-1, no-break space among them
    wide = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80)) if len(data) > 2 else latin[:0]  # dashes, quotes
    for at in (latin, latin + 1, wide, wide + 1, wide + 2):
        inside[at[at < len(data)]] = False
    return np.where(inside, T.lower_ascii(data), np.uint8(32))


def _hashes(words) -> np.ndarray:
    raw = " ".join(words).encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = T.words(data, np.array([0, len(data)]))
    return np.unique(T.word_hashes(data, starts, ends))


_STOP_HASHES = _hashes(STOP)


def _terms(text: str) -> list[int]:
    """The hashed terms of one text, in order."""
    data = np.frombuffer(text.encode(), np.uint8)
    masked = _term_bytes(data)
    starts, ends, _ = T.words(masked, np.array([0, len(data)]))
    found = T.word_hashes(masked, starts, ends)
    return found[~np.isin(found, _STOP_HASHES)].view(np.int64).tolist()


def _cuts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running numbers of lines and sentences within them, and of sentences of whole paragraphs, at every byte."""
    line_end = data == 10
    after_stop = np.zeros(len(data), bool)
    after_stop[1:] = _STOPS[data[:-1]]
    opens = np.zeros(len(data) + 1, bool)
    opens[at[:-1]] = True
    lines = np.cumsum(line_end | (after_stop & _BLANK[data]) | opens[:-1])
    # a line end closes a paragraph if only blanks stand before the next one
    solid = np.flatnonzero(~_BLANK[data])
    following = np.searchsorted(solid, np.arange(len(data)), "right")
    next_solid = np.append(solid, len(data))[following]
    blank_line = line_end & np.append(line_end, True)[next_solid]
    joined = np.cumsum(blank_line | (after_stop & (_BLANK[data] | line_end)) | opens[:-1])
    return lines, joined


def _units(part: pa.RecordBatch, cue: np.ndarray, strong: np.ndarray):
    """(arrays of the units worth comparing, (term, units that hold it) of all lines and sentences) of a block."""
    data, at = T.texts(part.column("text"))
    masked = _term_bytes(data)
    starts, ends, of_text = T.words(masked, at)
    term = T.word_hashes(masked, starts, ends)
    real = ~np.isin(term, _STOP_HASHES)
    starts, term, text = starts[real], term[real], T.owners(of_text)[real]
    lines, joined = _cuts(data, at)
    plain_starts, _, plain_of_text = T.words(data, at)
    unit_of = {LINE: lines[starts], JOINED: joined[starts]}
    pairs = np.unique(T.mix(term) + unit_of[LINE].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)[1]
    key, count = np.unique(term[pairs], return_counts=True)
    counts = (np.append(key, np.uint64(0)), np.append(count, len(np.unique(unit_of[LINE]))))

    out = []
    cued = np.isin(term, cue)
    for kind, numbers in ((LINE, lines), (JOINED, joined)):
        unit = unit_of[kind]
        last = int(numbers[-1]) if len(numbers) else 0
        wanted = np.zeros(last + 1, bool)
        wanted[unit[cued]] = True
        if kind == JOINED and len(unit):  # those within a line are compared as such
            edge = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            ends = np.append(edge[1:], len(unit)) - 1
            inside = unit_of[LINE][ends] == unit_of[LINE][edge]
            wanted[unit[edge[inside]]] = False
        size = np.bincount(numbers[plain_starts], minlength=last + 1)
        out.append(_gathered(kind, unit, term, text, wanted, size, numbers[np.minimum(at[:-1], len(data) - 1)]))
    n, is_strong = len(at) - 1, np.isin(term, strong)
    held = np.unique(text[is_strong] * len(strong) + np.searchsorted(strong, term[is_strong]))
    whole = np.bincount(held // len(strong), minlength=n) >= STRONG_WORDS
    out.append(_gathered(FILE, text, term, text, whole, np.diff(plain_of_text), np.arange(n)))
    return out, counts


def _gathered(kind, unit, term, text, wanted, size, first):
    """(text, kind, number in the text, words, terms) of the wanted units."""
    if not wanted.any():
        return None
    keep = wanted[unit]
    unit, term, text = unit[keep], term[keep], text[keep]
    edge = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
    owner = text[edge]
    return owner, np.full(len(edge), kind, np.int8), unit[edge] - first[owner], size[unit[edge]], term, np.append(edge, len(unit))


def units_and_counts(files: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One stored table of (_row, kind, unit, words, terms) for the units to compare, and of (term, df) for all terms.

    The term 0 counts the lines and sentences that hold any term.
    """
    cue = np.unique(np.array([t for _, text in templates for t in _terms(text)], np.int64).view(np.uint64))
    strong = _hashes(STRONG)
    names = ["_row", "kind", "unit", "words", "terms", "term", "df"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def flush():
            key, n = merged_counts(keys, counts)
            none = [pa.nulls(len(key), t) for t in (pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*none, pa.array(key.view(np.int64)), pa.array(n)], names)

        for batch in batches:
            for part in T.blocks(batch, "text"):
                if not len(T.texts(part.column("text"))[0]):
                    continue
                found, (key, n) = _units(part, cue, strong)
                keys.append(key)
                counts.append(n)
                for unit in found:
                    if unit is not None:
                        text, kind, number, words, terms, edges = unit
                        none = [pa.nulls(len(text), pa.int64())] * 2
                        yield pa.RecordBatch.from_arrays(
                            [part.column("_row").take(pa.array(text)), pa.array(kind), pa.array(number), pa.array(words),
                             T.list_array(terms.view(np.int64), edges, pa.int64()), *none],
                            names,
                        )
            if sum(map(len, keys)) > TASK_KEYS:
                yield from flush()
                keys, counts = [], []
        if keys:
            yield from flush()

    schema = "_row long, kind byte, unit long, words long, terms array<bigint>, term long, df long"
    return store(map_arrow(files.select("_row", "text"), run, schema), "units")


def _shape(templates, whole: bool) -> list[tuple]:
    return [
        (f"{'file' if whole else 'unit'} {i}", name, whole, t, terms.count(t))
        for i, (name, text) in enumerate(templates)
        for terms in [_terms(text)]
        for t in sorted(set(terms))
    ]


class Weights:
    """Term weights of the templates that units of one kind are compared with; their terms are a fixed set."""

    def __init__(self, shape: list[tuple], idf: dict[int, float], threshold: float):
        names = sorted({t for t, *_ in shape})
        self.terms = np.array(sorted({term for *_, term, _ in shape}), np.int64)
        self.idf = np.array([idf[t] for t in self.terms.tolist()])
        self.of = np.zeros((len(self.terms), len(names)))
        for template, _, _, term, tf in shape:
            at = np.searchsorted(self.terms, term)
            self.of[at, names.index(template)] = (1.0 + np.log(tf)) * self.idf[at]
        self.norm = np.sqrt((self.of**2).sum(0))
        self.threshold = threshold

    def plausible(self, unit: np.ndarray, term: np.ndarray, tf: np.ndarray, n: int) -> np.ndarray:
        """Which of n units can reach the threshold: terms of no template weigh at least as if every unit held them."""
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        known = self.terms[at] == term
        weight = (1.0 + np.log(tf)) * np.where(known, self.idf[at], 1.0)
        norm = np.sqrt(np.bincount(unit, weight**2, n))
        unit, at, weight = unit[known], at[known], weight[known]
        best = np.zeros(n)
        for k in range(self.of.shape[1]):
            best = np.maximum(best, np.bincount(unit, weight * self.of[at, k], n) / self.norm[k])
        return best >= (self.threshold - 1e-9) * norm


def _plausible(units: DataFrame, headers: Weights, wholes: Weights) -> DataFrame:
    """(_row, kind, unit, words, terms, tf): the units that can reach their threshold, each term once with its count."""
    names = ["_row", "kind", "unit", "words", "terms", "tf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lists = batch.num_rows, batch.column("terms")
            count = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            unit, term = np.repeat(np.arange(n), count), lists.flatten().to_numpy(zero_copy_only=False)
            order = np.lexsort((term, unit))
            unit, term = unit[order], term[order]
            edge = np.flatnonzero(np.append(True, (unit[1:] != unit[:-1]) | (term[1:] != term[:-1])))
            tf = np.diff(np.append(edge, len(unit)))
            unit, term = unit[edge], term[edge]
            whole = batch.column("kind").to_numpy() == FILE
            good = np.where(whole, wholes.plausible(unit, term, tf, n), headers.plausible(unit, term, tf, n))
            held = good[unit]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(unit[held], minlength=n)[good])])
            kept = batch.select(names[:4]).filter(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, T.list_array(term[held], offsets, pa.int64()), T.list_array(tf[held].astype(np.int32), offsets, pa.int32())],
                names,
            )

    return map_arrow(units, run, "_row long, kind byte, unit long, words long, terms array<bigint>, tf array<int>")


def own_licences(
    files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, wholes=WHOLE, file_threshold: float = FILE_THRESHOLD
) -> DataFrame:
    """(_row, own_license, own_score, licenses, licensed_words, like_file): for files with a matching unit.

    Units that cannot reach their threshold whatever their other terms weigh are dropped first, knowing only the
    frequencies of the templates' own terms, which are a fixed set; the others are compared exactly.
    """
    spark = files.sparkSession
    told = units_and_counts(files, templates)
    release(spark)
    shape = [_shape(templates, False), _shape(wholes.items(), True)]
    wanted = spark.createDataFrame(shape[0] + shape[1], "template string, license string, whole boolean, term long, tf int")
    every = told.where("term IS NOT NULL").select("term", "df")
    of_templates = F.broadcast(wanted.select("term").distinct())
    seen = {r["term"]: r["df"] for r in every.join(of_templates, "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    many = float(told.where("term = 0").agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0])
    idf_of = {t: float(np.log((many + 1.0) / (seen.get(t, 0) + 1.0)) + 1.0) for part in shape for *_, t, _ in part}
    weights = Weights(shape[0], idf_of, threshold), Weights(shape[1], idf_of, file_threshold)
    units = told.where("kind IS NOT NULL").select("_row", "kind", "unit", "words", "terms")
    units = store(_plausible(units, *weights), "headers")

    counted = units.select("_row", "kind", "unit", F.explode(F.arrays_zip("terms", "tf")).alias("x")).select(
        "_row", "kind", "unit", F.col("x.terms").alias("term"), F.col("x.tf").alias("tf")
    )
    needed = counted.select("term").union(wanted.select("term")).distinct()
    sums = every.join(needed, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    idf = needed.join(sums, "term", "left").select(
        "term", (F.ln(F.lit(many + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)) + 1.0).alias("idf")
    )
    idf = store(idf, "idf")
    release(spark)
    weight = (F.lit(1.0) + F.ln(F.col("tf").cast("double"))) * F.col("idf")
    of_units = counted.join(idf, "term").withColumn("w", weight)
    of_templates = wanted.join(idf, "term").withColumn("v", weight)
    place = ["_row", "kind", "unit"]
    unit_norm = of_units.groupBy(*place).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("unit_norm"))
    template_norm = of_templates.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("template_norm"))
    # the templates are fixed, so what is sent of them is too
    known = F.broadcast(of_templates.select("template", "license", "whole", "term", "v"))
    dots = of_units.withColumn("whole", F.col("kind") == FILE).join(known, ["term", "whole"]).groupBy(
        *place, "template", "license"
    ).agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = dots.join(unit_norm, place).join(F.broadcast(template_norm), "template").withColumn(
        "score", F.round(F.col("dot") / (F.col("unit_norm") * F.col("template_norm")), 9)
    )
    hits = scored.where(F.col("score") >= F.when(F.col("kind") == FILE, file_threshold).otherwise(threshold))
    best = hits.groupBy(*place).agg(F.max(F.struct("score", "license")).alias("best")).join(units.select(*place, "words"), place)
    whole = F.col("kind") == FILE
    in_units = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("words"))), F.lit(0)) for k in (LINE, JOINED)]
    rank = F.struct((~whole).alias("later"), (-F.col("best.score")).alias("s"), F.col("best.license").alias("license"))
    return best.groupBy("_row").agg(
        F.min(rank).alias("first"),
        F.array_sort(F.collect_set("best.license")).alias("licenses"),
        F.greatest(*in_units).alias("licensed_words"),
        F.bool_or(whole).alias("like_file"),
    ).select(
        "_row", F.col("first.license").alias("own_license"), (-F.col("first.s")).alias("own_score"), "licenses", "licensed_words",
        "like_file",
    )


def _directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit(""))


def _ancestors(directory: Column) -> Column:
    """The directory and every one above it, up to the root, which is empty."""
    parts = F.split(directory, "/")
    return F.when(directory == "", F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    )


def inherited(directories: DataFrame, speakers: DataFrame) -> DataFrame:
    """(dir, inherited_license, inherited_from) for directories below one that has a licence file."""
    above = directories.select("dir", F.explode(_ancestors(F.col("dir"))).alias("at"))
    met = above.join(speakers, F.col("at") == F.col("of_dir"))
    return met.groupBy("dir").agg(F.max(F.struct(F.length("at").alias("n"), "license", "path")).alias("nearest")).select(
        "dir", F.col("nearest.license").alias("inherited_license"), F.col("nearest.path").alias("inherited_from")
    )


VERDICT = ("own_license", "own_score", "licenses", "is_license_file", "license", "inherited_from")


def scan_licences(
    files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, file_share: float = FILE_SHARE, wholes=WHOLE,
    file_threshold: float = FILE_THRESHOLD,
) -> DataFrame:
    """One row per row of `files` (a stored table with `path` and `text`): its other columns and its licence.

    Adds own_license, own_score, licenses (all that its units match), is_license_file, license (its own, else
    the inherited one) and inherited_from (the licence file's path). Texts are not passed on.
    """
    columns = [c for c in files.columns if c != "text" and c not in VERDICT]
    numbered = number_rows(pack_rest(files, "path", "text"))
    own = store(own_licences(numbered.select("_row", "text"), templates, threshold, wholes, file_threshold), "licences")
    release(files.sparkSession)
    words = numbered.select(REST, "path", "_row", word_count(F.col("text")).alias("_words"))
    share = F.col("like_file") | (F.col("licensed_words") >= F.col("_words") * F.lit(file_share))
    told = words.join(own, "_row", "left").withColumn("is_license_file", F.coalesce(share, F.lit(False)))
    told = store(told.withColumn("_dir", _directory(F.col("path"))), "told")
    best = F.min(F.struct((-F.col("own_score")).alias("s"), "path", "own_license")).alias("f")
    speakers = told.where("is_license_file AND path IS NOT NULL").groupBy(F.col("_dir").alias("of_dir")).agg(best)
    speakers = speakers.select("of_dir", F.col("f.own_license").alias("license"), F.col("f.path").alias("path"))
    below = told.where("_dir IS NOT NULL").select(F.col("_dir").alias("dir")).distinct()
    heirs = store(inherited(below, speakers), "heirs")
    return told.join(heirs, F.col("_dir") == F.col("dir"), "left").select(
        *rest_of(columns, ("path",)),
        *["own_license", "own_score", "licenses", "is_license_file"],
        F.coalesce("own_license", "inherited_license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("inherited_from")).alias("inherited_from"),
    )
