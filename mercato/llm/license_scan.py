"""Licence scan: notices by TF-IDF cosine to templates, then inheritance along paths.

Every line and every paragraph of a file is compared with every template, and within longer
ones every window of as many terms as the template has; the best one from ``threshold`` on
is the file's licence. A template also names the terms that tell its licence from its
neighbours: without them, with those of a neighbour, or behind a negation it doesn't match.
Templates are notices, titles of licence texts and lines with short identifiers; of a line
that names several licences the best match counts. A file without one inherits from the
nearest ancestor directory in which a file declares a licence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.shared import read, small, stored, text_of



TERM = re.compile(r"\w+")


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


class Template(NamedTuple):
    """A notice. ``needs`` must all be in what matches, ``bars`` not in it or ``NEAR`` terms around.

    ``later`` and ``never`` must, or must not, be among the ``AHEAD`` terms from its start on,
    for notices that only their conditions tell apart.
    """

    name: str
    text: str
    needs: str = ""
    bars: str = ""
    later: str = ""
    never: str = ""


NEAR, AHEAD = 4, 250
# Within so many terms before the first that a template needs, these say that it doesn't hold.
NEGATIONS, NEGATED = frozenset("not never neither nor t".split()), 4  # t: as in isn't
# Says that there is no licence; gives way to any licence that a file or directory names.
NO_LICENCE = "All-Rights-Reserved"


def _creative_commons() -> Iterator[Template]:
    long = {"nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
    other = {
        "nc": "nc noncommercial commercial", "sa": "sa sharealike alike",
        "nd": "nd noderivatives noderivs derivatives derivative derivs",
    }
    for parts in ((), ("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd")):
        bars = " ".join(words for part, words in other.items() if part not in parts)
        for version in ("4.0", "3.0", "2.5", "2.0"):
            name = "-".join(["BY", *parts]).upper()
            digits = version.replace(".", " ")
            yield Template(
                f"CC-{name}-{version}", f"Licensed under CC {name} {version}.", f"cc by {' '.join(parts)} {digits}", bars
            )
            title = "-".join(["Attribution", *(long[p] for p in parts)])
            region = "International" if version == "4.0" else "Unported" if version == "3.0" else "Generic"
            yield Template(
                f"CC-{name}-{version}",
                f"This work is licensed under a Creative Commons {title} {version} {region} License.",
                f"creative commons {title.replace('-', ' ').lower()} {digits}",
                bars,
            )


def _gnu() -> Iterator[Template]:
    kinds = (
        ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library", "2"),
        ("LGPL-2.1", "Lesser", "2.1"), ("LGPL-3.0", "Lesser", "3"), ("AGPL-3.0", "Affero", "3"),
    )
    for name, kind, version in kinds:
        title = f"GNU {kind} General Public License".replace("  ", " ")
        needs = f"{kind.lower()} general public {version.replace('.', ' ')}"
        bars = " ".join({"lesser", "library", "affero"} - {kind.lower()})
        yield Template(name, f"This work is licensed under the {title}, version {version}.", needs, bars)
        yield Template(name, f"{title} Version {version}", needs, bars)  # the title of its text
        if "." not in version:
            short = name.split("-")[0].lower()
            yield Template(name, f"Released under {short}v{version}.", f"{short}v{version}")
            yield Template(name, f"Licensed under the {short} v{version}.", f"{short} v{version}")
        yield Template(
            name,
            f"This program is free software: you can redistribute it and/or modify it under the "
            f"terms of the {title} as published by the Free Software "
            f"Foundation, either version {version} of the License, or (at your option) any later version.",
            needs,
            bars,
        )


def _identifiers() -> Iterator[Template]:
    """Lines that name a licence by its short identifier."""
    names = (
        "MIT MIT-0 ISC 0BSD Apache-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 "
        "LGPL-3.0 AGPL-3.0 MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 BSL-1.0 CC0-1.0 Unlicense Zlib Artistic-2.0"
    ).split()
    names += list(dict.fromkeys(t.name for t in _creative_commons()))
    for name in names:
        own = terms(name)
        bars = {"MIT": "0"}.get(name, "")
        if "by" in own:
            bars = " ".join({"nc", "sa", "nd"} - set(own))
        yield Template(name, f"SPDX-License-Identifier: {name}", f"spdx identifier {' '.join(own)}", bars)


_BSD = (
    "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met"
)

# Names and customary notices of licences.
TEMPLATES = (
    Template("MIT", "Released under the MIT License.", "mit"),
    Template("MIT", "Licensed under the MIT License. See the LICENSE file for details.", "mit"),
    Template("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                    "software and associated documentation files (the Software), to deal in the Software "
                    "without restriction, including without limitation the rights to use, copy, modify, "
                    "merge, publish, distribute, sublicense, and/or sell copies of the Software",
             "permission granted sublicense"),
    Template("ISC", "Released under the ISC License.", "isc"),
    Template("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
                    "or without fee is hereby granted, provided that the above copyright notice and this "
                    "permission notice appear in all copies.",
             "permission fee granted appear", "documentation sell"),
    Template("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
                     "or without fee is hereby granted.",
             "permission fee granted", "provided documentation sell"),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2 0"),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                           "this file except in compliance with the License. You may obtain a copy of the "
                           "License at http://www.apache.org/licenses/LICENSE-2.0", "apache 2 0"),
    Template("Apache-2.0", "Apache License Version 2.0, January 2004", "apache version 2 0"),
    *_gnu(),
    Template("BSD-2-Clause", "Licensed under the BSD 2-Clause License.", "bsd 2 clause"),
    Template("BSD-3-Clause", "Licensed under the BSD 3-Clause License.", "bsd 3 clause"),
    Template("BSD-2-Clause", _BSD, "redistribution binary", later="reproduce", never="endorse advertising"),
    Template("BSD-3-Clause", _BSD, "redistribution binary", later="reproduce endorse", never="advertising"),
    Template("BSD-4-Clause", _BSD, "redistribution binary", later="reproduce endorse advertising"),
    Template("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
             "mozilla 2 0"),
    Template("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1",
             "mozilla 1"),
    Template("MPL-2.0", "Mozilla Public License Version 2.0", "mozilla public 2 0"),
    Template("EPL-1.0", "Eclipse Public License - v 1.0", "eclipse public 1 0"),
    Template("EPL-2.0", "Eclipse Public License - v 2.0", "eclipse public 2 0"),
    Template("BSL-1.0", "Boost Software License - Version 1.0", "boost 1 0"),
    Template("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.", "boost 1 0"),
    Template("CC0-1.0", "CC0 1.0 Universal", "cc0 1 0"),
    Template("CC0-1.0", "Creative Commons Zero v1.0 Universal", "creative commons zero universal"),
    Template("Unlicense", "This is free and unencumbered software released into the public domain.",
             "unencumbered public domain"),
    *_creative_commons(),
    *_identifiers(),
    Template(NO_LICENCE, "All rights reserved.", "all rights reserved"),
)

LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-][^/]*)?$"
PARAGRAPH = re.compile(r"\n[^\S\n]*\n")


def document_frequencies(texts: DataFrame, wanted: Iterable[str]) -> tuple[int, dict[str, int]]:
    """Number of texts, and in how many each template term occurs; one row per term comes back."""
    vocabulary = frozenset(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in small(batches):
            for text in batch.column(0).to_pylist():
                found.update(vocabulary.intersection(terms(text)))
                found[""] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
            names=["term", "n"],
        )

    rows = texts.mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in rows.collect()}
    return counts.pop("", 0), counts


class Matcher:
    """Cosine of tf-idf vectors to the templates.

    A term outside the templates weighs like one that no text has. A match shares the
    terms that its template needs, of which the rarest is looked for first. Without any,
    a match from ``threshold`` on shares a heavy term with its template: the others
    together have less than threshold squared of the template's squared length
    (Cauchy-Schwarz). Texts without any such term are passed over.
    """

    def __init__(self, templates, texts: int, frequency: dict[str, int], threshold: float):
        self.threshold = threshold
        templates = [Template(*t) for t in templates]
        self.idf = {
            t: math.log((1 + texts) / (1 + frequency.get(t, 0))) + 1
            for template in templates
            for t in terms(template.text)
        }
        self.other = math.log(1 + texts) + 1
        self.heavy: set[str] = set()
        # template, its vector, its number of terms, terms of which a match has one, needs and the rest as sets
        self.templates: list[tuple] = []
        for template in templates:
            found = terms(template.text)
            vector = self.vector(found)
            needs, *rest = (frozenset(x.split()) for x in template[2:])
            if needs:
                first = {min(needs, key=lambda t: (-vector.get(t, 0.0), t))}
            else:
                first, left = set(), 1.0
                for t in sorted(vector, key=lambda t: (-vector[t], t)):
                    if left < threshold * threshold * (1 - 1e-9):
                        break
                    first.add(t)
                    left -= vector[t] ** 2
            self.heavy |= first
            self.templates.append((template, vector, len(found), first, needs, *rest))

    def vector(self, found: list[str]) -> dict[str, float]:
        raw = {t: n * self.idf.get(t, self.other) for t, n in Counter(found).items()}
        length = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / length for t, w in raw.items()}

    def best(self, text: str) -> tuple[str, float, int] | None:
        """(licence, cosine, terms of the line, paragraph or window) of the best match."""
        every = terms(text)
        if self.heavy.isdisjoint(every):
            return None
        best = None
        begin = 0
        for paragraph in PARAGRAPH.split(text):
            units = []
            at = begin
            for line in paragraph.split("\n"):
                n = len(terms(line))
                units.append((at, at + n))
                at += n
            if len(units) > 1:
                units.append((begin, at))
            for low, high in units:
                # windows of the paragraph are those of its lines and more
                key = self.best_of(every, low, high, windows=high - low == at - begin)
                if key and (best is None or key > best):
                    best = key
            begin = at
        return (best[3], min(1.0, best[1]), -best[2]) if best else None

    def best_of(self, every: list[str], low: int, high: int, windows: bool) -> tuple | None:
        """The greatest (is a licence, cosine, minus the terms, name) of a unit of terms."""
        unit = every[low:high]
        words = frozenset(unit)
        if self.heavy.isdisjoint(words):
            return None
        best = None
        whole = self.vector(unit)
        for template, vector, size, first, needs, bars, later, never in self.templates:
            if not needs <= words or first.isdisjoint(words):
                continue
            spans = {(low, high)}
            if windows and size < high - low:
                for at, term in enumerate(unit, low):
                    if term in first:
                        spans.update((x, x + size) for x in range(max(low, at - size + 1), min(at, high - size) + 1))
            for a, b in spans:
                inside = every[a:b]
                if not needs.issubset(inside):
                    continue
                if not bars.isdisjoint(every[max(low, a - NEAR) : min(high, b + NEAR)]):
                    continue
                said = next((x for x in range(a, b) if every[x] in needs), a)
                if not NEGATIONS.isdisjoint(every[max(low, said - NEGATED) : said]):
                    continue
                if later or never:
                    ahead = every[a : b + AHEAD]
                    if not later.issubset(ahead) or not never.isdisjoint(ahead):
                        continue
                weights = whole if (a, b) == (low, high) else self.vector(inside)
                cosine = sum(w * weights.get(t, 0.0) for t, w in vector.items())
                if cosine >= self.threshold:
                    key = (template.name != NO_LICENCE, round(cosine, 9), a - b, template.name)
                    if best is None or key > best:
                        best = key
        return best


def scan(
    files: DataFrame,
    *,
    templates=TEMPLATES,
    threshold: float = 0.7,
    bulk: float = 0.1,
) -> DataFrame:
    """(id, path, license, score, origin, license_path) for each row of (id, path, text).

    ``origin`` is ``own``, ``inherited`` or null, ``license_path`` the file that says so.
    A file declares its directory's licence if it is named like a licence file or its
    notice is at least ``bulk`` of its terms; of several a licence counts before reserved
    rights, then the best score, then the smallest path. Null texts have no licence, null paths no directory. The root
    directory is the empty path. Directories, not files, look for their ancestors, and
    the last join splits a directory that holds a third of all files.
    """
    rows = files.select(
        "id", F.col("path").cast("string").alias("path"), text_of().alias("text")
    )
    n, frequency = document_frequencies(rows.select("text"), {t for x in templates for t in terms(x[1])})

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, n, frequency, threshold)
        for batch in small(batches):
            names, scores, shares = [], [], []
            for text in batch.column("text").to_pylist():
                found = matcher.best(text)
                names.append(found[0] if found else None)
                scores.append(found[1] if found else None)
                shares.append(found[2] / len(terms(text)) if found else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("path"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(shares, pa.float64())],
                names=["id", "path", "license", "score", "share"],
            )

    kind = dict(rows.dtypes)["id"]
    own = stored(
        rows.mapInArrow(match, f"id {kind}, path string, license string, score double, share double")
        .withColumn("dir", F.regexp_replace(F.regexp_extract("path", r"(?s)^(.*)/[^/]*$", 1), "/+$", ""))
        .withColumn("name", F.element_at(F.split("path", "/"), -1)),
        "licence-own",
    )
    declared = (
        own.filter(
            F.col("license").isNotNull()
            & F.col("path").isNotNull()
            & (F.col("name").rlike(LICENCE_FILE) | (F.col("share") >= bulk))
        )
        .groupBy(F.col("dir").alias("ancestor"))
        .agg(
            F.min(
                F.struct(
                    (F.col("license") == NO_LICENCE).alias("none"), (-F.col("score")).alias("minus"), "path", "license"
                )
            ).alias("of")
        )
    )
    parts = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    nearest = (
        own.select("dir")
        .filter(F.col("dir").isNotNull())
        .distinct()
        .withColumn("parts", parts)
        .withColumn("depth", F.explode(F.sequence(F.lit(0), depth)))
        .withColumn("ancestor", F.array_join(F.slice("parts", 1, F.col("depth")), "/"))
        .join(declared, "ancestor")
        .groupBy("dir")
        .agg(F.max_by("of", "depth").alias("of"))
    )
    found = own.join(nearest, "dir", "left")
    has = F.col("license").isNotNull()
    return found.select(
        "id",
        "path",
        F.coalesce("license", "of.license").alias("license"),
        F.coalesce("score", -F.col("of.minus")).alias("score"),
        F.when(has, "own").when(F.col("of").isNotNull(), "inherited").alias("origin"),
        F.when(has, F.col("path")).otherwise(F.col("of.path")).alias("license_path"),
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / thousand / fifty / id."""
    docs = read(spark, sf_dir, "documents")
    key = F.col("doc_id").cast("long")
    path = F.concat_ws(
        "/",
        F.coalesce(F.col("source").cast("string"), F.lit("unknown")),
        F.floor(key / 1000).cast("string"),
        F.floor(key / 50).cast("string"),
        key.cast("string"),
    )
    files = docs.select(key.alias("id"), path.alias("path"), "text")
    return scan(files).withColumnRenamed("id", "doc_id")
