"""Licence scan: Dice coefficient over word bigrams against licence notices.

A text is lower-cased and cut into units (lines, and sentences within a
line).  Units and runs of neighbouring units are compared with every notice:
dice = 2 |A & B| / (|A| + |B|) over their sets of word bigrams.  The sizes
alone bound it by 2 min(a, b) / (a + b), which prunes notices, and ends the
runs that start at a unit; units without any bigram of a notice start and end
no run.  Words are runs of letters and digits (bytes over x7F count as
letters), so punctuation and line breaks inside a notice do not matter.

Whole texts are scanned in Arrow batches without a shuffle; the notices are a
fixed table.  Defined results: a null or empty text, or one without a notice,
has an empty list and a null licence.  Per text and licence the best dice
counts (ties: the earliest, then the shortest run); the best licence of a
text is the one with the highest dice (ties: first by name).  Repeated rows
and rows without doc_id are scanned like others; extra columns are ignored;
an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import wordhash as wh
from folio.llm.common import map_text, row_chunks, text_bytes

CUT = 0.8

# Public notices by SPDX identifier.
NOTICES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
STOP = np.zeros(256, bool)
STOP[list(b".!?")] = True


def _bigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of neighbouring words, their first and last byte; pairs do not
    cross rows."""
    low = wh.LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = WORD[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    pair = wh.window_hashes(wh.word_hashes(low, starts, ends), 2)
    row = np.searchsorted(offs, starts, side="right")
    same = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
    return pair[same], starts[:-1][same], ends[1:][same]


def notice_sets(notices=NOTICES) -> list[tuple[str, np.ndarray]]:
    out = []
    for name, text in notices:
        raw = np.frombuffer(text.encode(), np.uint8)
        out.append((name, np.unique(_bigrams(raw, np.array([0, len(raw)]))[0])))
    return out


def scan_chunk(data: np.ndarray, offs: np.ndarray, sets: list[tuple[str, np.ndarray]], cut: float) -> list[dict[str, tuple]]:
    """Per row the best (dice, start, end) of every licence found in it."""
    found: list[dict[str, tuple]] = [{} for _ in range(len(offs) - 1)]
    pair, begin, end = _bigrams(data, offs)
    if not len(pair):
        return found
    known = np.unique(np.concatenate([s for _, s in sets]))
    at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
    hit = known[at] == pair
    if not hit.any():
        return found
    # Units end at line breaks and after .!? before white space; rows end units.
    gap = np.zeros(len(data) + 1, bool)
    gap[offs] = True
    gap[1:] |= data == 10
    gap[1:-1] |= STOP[data[:-1]] & ~wh.WORD_BYTE[data[1:]]
    cuts = np.flatnonzero(gap)
    unit = np.searchsorted(cuts, begin, side="right") - 1  # of the pair's first word
    # A pair across a unit's end counts only in runs that hold both units.
    unit_end = np.searchsorted(cuts, end - 1, side="right") - 1
    touched = np.unique(unit[hit])
    row_of = np.searchsorted(offs, cuts, side="right") - 1
    ratio = (2 - cut) / cut
    most = ratio * max(len(s) for _, s in sets)
    first_pair = np.searchsorted(unit, np.arange(len(cuts) + 1))
    for p, u in enumerate(touched):
        for v in touched[p:]:
            if row_of[v] != row_of[u]:
                break
            a, b = first_pair[u], first_pair[v + 1]
            inside = slice(a, b)
            run = np.unique(pair[inside][unit_end[inside] <= v])
            size = len(run)
            if size > most:
                break
            for name, ref in sets:
                if size * ratio < len(ref) or len(ref) * ratio < size:
                    continue
                both = np.minimum(np.searchsorted(ref, run), len(ref) - 1)
                dice = 2 * int((ref[both] == run).sum()) / (size + len(ref))
                old = found[row_of[u]].get(name)
                if dice >= cut and (old is None or dice > old[0]):
                    row = row_of[u]
                    keep = unit_end[inside] <= v
                    found[row][name] = (dice, int(begin[inside][keep][0] - offs[row]), int(end[inside][keep][-1] - offs[row]))
    return found


def scan(docs: DataFrame, cut: float = CUT, notices=NOTICES) -> DataFrame:
    """doc_id, licenses (name, dice, start, end of the bytes; by name), and
    the best one's name and dice."""
    shared = docs.sparkSession.sparkContext.broadcast(notice_sets(notices))
    schema = ("doc_id long, licenses array<struct<name:string,dice:double,start:int,end:int>>, license string, dice double")
    item = pa.list_(pa.struct([("name", pa.string()), ("dice", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))

    def fn(batch: pa.RecordBatch):
        data, offs = text_bytes(batch.column("text"))
        rows = []
        for lo, hi in row_chunks(offs):
            rows += scan_chunk(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], shared.value, cut)
        lists = [[{"name": n, "dice": d, "start": s, "end": e} for n, (d, s, e) in sorted(r.items())] for r in rows]
        best = [max(r, key=lambda x: x["dice"]) if r else None for r in lists]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lists, item), pa.array([b and b["name"] for b in best], pa.string()),
             pa.array([b and b["dice"] for b in best], pa.float64())],
            names=["doc_id", "licenses", "license", "dice"])

    return map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), fn, schema)
