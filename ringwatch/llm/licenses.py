"""Licences in texts, recognised sentence by sentence.

A text is cut into sentences at line ends and after ``.``, ``!``, ``?``, ``;`` and ``:`` before white space. Each is
normalised (lower case, letters and digits only, single blanks, which takes comment marks away) and looked up among known
licence sentences, alone and joined with the lines after it up to the end of the sentence or an empty line; the longest
known run counts. The identifiers found, in order and without the unknown sentences between them, are
matched against ordered rules: a rule is a sequence of identifiers that follow each other, the first rule that fits at a place takes its identifiers, and the scan goes on behind it.

Sentences and rules are literals of bounded number; the scan is a narrow pass. A run of lines is followed only as long as
some known sentence begins with it.

Cases: null, empty and licence-free texts give no row; rows of one id are taken together; the same licence twice
gives one row with its first place and the number of times; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ringwatch.llm.common import batch_of, mapped, pick

# Sentences of public licences and notices, as identifier and text.
SENTENCES = [
    ("MITrel", "Released under the MIT License."),
    ("MITlic", "Licensed under the MIT License."),
    ("MITperm", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MITnotice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                  "the Software."),
    ("AsIs", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
             "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("Apache2", "Licensed under the Apache License, Version 2.0."),
    ("Apache2the", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("ApacheNot", "you may not use this file except in compliance with the License."),
    ("ApacheCopy", "You may obtain a copy of the License at"),
    ("GPL3work", "This work is licensed under the GNU General Public License, version 3."),
    ("GPLredist", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                  "later version."),
    ("GPL2redist", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                   "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                   "option) any later version."),
    ("CCBYNC4", "Licensed under CC BY-NC 4.0."),
    ("CCBY4", "Licensed under CC BY 4.0."),
    ("CCBYSA4", "Licensed under CC BY-SA 4.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("BSDredist", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                  "following conditions are met:"),
    ("BSDsource", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                  "disclaimer."),
    ("BSDbinary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSDname", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                "products derived from this software without specific prior written permission."),
    ("ISCperm", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Rights", "All rights reserved."),
]

# Rules in the order they are tried, as licence and sequence of identifiers.
RULES = [
    ("MIT", ["MITperm", "MITnotice", "AsIs"]), ("MIT", ["MITperm", "MITnotice"]),
    ("BSD-3-Clause", ["BSDredist", "BSDsource", "BSDbinary", "BSDname"]), ("BSD-2-Clause", ["BSDredist", "BSDsource", "BSDbinary"]),
    ("Apache-2.0", ["Apache2the", "ApacheNot", "ApacheCopy"]), ("Apache-2.0", ["Apache2the"]), ("Apache-2.0", ["Apache2"]),
    ("MIT", ["MITrel"]), ("MIT", ["MITlic"]), ("GPL-3.0-only", ["GPL3work"]), ("GPL-3.0-or-later", ["GPLredist"]),
    ("GPL-2.0-or-later", ["GPL2redist"]), ("CC-BY-NC-4.0", ["CCBYNC4"]), ("CC-BY-4.0", ["CCBY4"]), ("CC-BY-SA-4.0", ["CCBYSA4"]),
    ("CC0-1.0", ["CC0"]), ("ISC", ["ISCperm"]), ("MPL-2.0", ["MPL2"]), ("All-Rights-Reserved", ["Rights"]),
]

#: Ends of sentences; a full stop inside a version or an abbreviation is followed by a letter or digit.
_STOP = r"(?<=[.!?;:])[ \t]+"
_LINE = r"\r\n|\n|\r"
#: Comment marks that are words; others go with all that is no letter or digit.
_MARK = re.compile(r"[ \t]*(?:dnl|rem)[ \t]+", re.IGNORECASE)


def normalised(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip(" ")


def _parts(text: str) -> list[tuple[str, bool]]:
    """The sentences and lines of a text, and whether a sentence may go on in the next one."""
    parts: list[tuple[str, bool]] = []
    for line in re.split(_LINE, text):
        mark, found = _MARK.match(line), False
        pieces = re.split(_STOP, line[mark.end():] if mark else line)
        for i, piece in enumerate(pieces):
            if own := normalised(piece):
                parts.append((own, i == len(pieces) - 1 and piece.rstrip()[-1] not in ".!?;:"))
                found = True
        if not found and parts:
            parts[-1] = (parts[-1][0], False)
    return parts


def _codes(text: str, known: dict[str, int], heads: set[str]) -> str:
    """The identifiers in a text and their places, as " 3@17 4@18 …"."""
    parts, found, at = _parts(text), [], 0
    while at < len(parts):
        code, end, run = None, at, ""
        for k in range(at, len(parts)):
            run = f"{run} {parts[k][0]}" if run else parts[k][0]
            if run in known:
                code, end = known[run], k
            if not parts[k][1] or run not in heads:
                break
        if code is not None:
            found.append(f" {code}@{at}")
        at = end + 1
    return "".join(found)


def scan(docs: DataFrame, sentences: list[tuple[str, str]] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """doc_id, license, first_sentence (place among the text's sentences), n_found."""
    # A known sentence that is itself cut in two stands for the sequence of its parts.
    numbers: dict[str, int] = {}
    codes = {name: [numbers.setdefault(p, len(numbers)) for p, _ in _parts(text)] for name, text in sentences}
    heads = {" ".join(p.split()[:n]) for p in numbers for n in range(1, len(p.split()))}
    # The sequence of identifiers is written as text, " 3@17 4@18 …", and rules are alternatives of one pattern.
    order = [(name, "".join(rf" {c}@\d+" for s in sequence for c in codes[s])) for name, sequence in rules]
    pattern = "|".join(p for _, p in order)
    # Only texts that hold the longest word of some known sentence are cut; no other can have one.
    hint = "|".join(sorted({max(p.split(), key=len) for p in numbers}))
    own = pick(docs, "doc_id", "text").filter(F.lower("text").rlike(hint))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            written = [_codes(t, numbers, heads) for t in batch.column("text").to_pylist()]
            yield batch_of(doc_id=batch.column("doc_id"), written=pa.array(written, pa.string()))

    schema = StructType([own.schema["doc_id"]]).add("written", StringType())
    found = mapped(own, work, schema).select(
        "doc_id", F.explode(F.regexp_extract_all("written", F.lit(f"({pattern})"), F.lit(1))).alias("hit"))
    license_of = F.coalesce(*[F.when(F.col("hit").rlike(f"^{p}$"), F.lit(name)) for name, p in order])
    hits = found.select("doc_id", license_of.alias("license"), F.regexp_extract("hit", r"@(\d+)", 1).cast("long").alias("at"))
    return hits.groupBy("doc_id", "license").agg(
        F.min("at").alias("first_sentence"), F.count(F.lit(1)).alias("n_found"))
