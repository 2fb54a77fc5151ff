"""License scan: spans of words compared with license statements and whole texts by the Dice coefficient over word bigrams.

Method: a text is normalised (lower case, runs of other characters than letters and digits, line breaks among
them, become one blank) and cut into word bigrams. Dice is 2 * common / (a + b) over the distinct bigrams of a
span and of a template. Line breaks do not matter, so a wrapped statement, one behind comment marks and one
within a longer line are found. A span starts and ends with a bigram of the template, as others only lower
the coefficient, and has at most (2 - limit) / limit times the template's bigrams. At least limit / (2 - limit)
of a template's bigrams must be in a span: texts with fewer are done first, then starts from which fewer
follow. All in
built-in functions on arrays within the row, so nothing is shuffled.

All spans are compared for templates of up to 31 bigrams. For longer ones, starts are tried at every 128th and
ends at every 16th part of the template's length, which costs a copy a few hundredths of its coefficient.

Matches: of overlapping spans the one with most common bigrams counts, then the larger coefficient, the
earlier place, the name; the rest are not reported. A passage in two licenses' texts thus counts for
the license that explains more of it. `licenses` has every license of a document.

Defined results: null and empty texts and texts without a match give a row with no license and an empty list.
A text of one word has no bigram and matches nothing. `license` is the match with the largest coefficient, then
the earliest line, then the name; a mere reservation of rights only when there is no license. Repeated
rows are rows of their own. Without templates nothing matches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by"
    " the Free Software Foundation, {1}. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
    " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
)
_LATER = "either version {0} of the License, or (at your option) any later version"


def _gnu(name: str, version: str) -> list[str]:
    return [
        f"This work is licensed under the GNU {name}, version {version}.",
        f"Licensed under the GNU {name} version {version}.",
        _GNU.format(name, _LATER.format(version)),
        _GNU.format(name, f"version {version} of the License"),
    ]


def _creative(title: str, code: str) -> list[str]:
    return [f"This work is licensed under a Creative Commons {title} 4.0 International License.", f"Licensed under {code}."]


#: What only reserves rights, without granting any.
RESERVED = "LicenseRef-All-Rights-Reserved"
PROPRIETARY = "LicenseRef-Proprietary"

#: License statements as they are put into documents, by SPDX name.
STATEMENTS: dict[str, list[str]] = {
    "AGPL-3.0": _gnu("Affero General Public License", "3"),
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the"
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
        " applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language"
        " governing permissions and limitations under the License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "CC-BY-4.0": _creative("Attribution", "CC BY 4.0"),
    "CC-BY-NC-4.0": _creative("Attribution-NonCommercial", "CC BY-NC 4.0"),
    "CC-BY-NC-ND-4.0": _creative("Attribution-NonCommercial-NoDerivatives", "CC BY-NC-ND 4.0"),
    "CC-BY-NC-SA-4.0": _creative("Attribution-NonCommercial-ShareAlike", "CC BY-NC-SA 4.0"),
    "CC-BY-ND-4.0": _creative("Attribution-NoDerivatives", "CC BY-ND 4.0"),
    "CC-BY-SA-4.0": _creative("Attribution-ShareAlike", "CC BY-SA 4.0"),
    "GPL-2.0": _gnu("General Public License", "2"),
    "GPL-3.0": _gnu("General Public License", "3"),
    "ISC": ["Released under the ISC License."],
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3"),
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    PROPRIETARY: [
        "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior"
        " written permission of the publisher.",
    ],
    RESERVED: ["All rights reserved."],
}
#: Statements and the whole texts in `license_texts/`.
TEMPLATES: dict[str, list[str]] = {name: list(texts) for name, texts in STATEMENTS.items()}
for _path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
    TEMPLATES.setdefault(_path.stem, []).append(_path.read_text(encoding="utf-8"))

#: Templates of more bigrams are looked for in texts of sufficient length only.
_LONG = 400


def normalised(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


class Template:
    """A statement or text of the license `name`, and what a match at `limit` must have."""

    def __init__(self, name: str, words: list[str], limit: float):
        self.name = name
        self.pairs = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        self.need = max(1, math.ceil(limit * len(self.pairs) / (2 - limit) - 1e-6))
        self.longest = int((len(words) - 1) * (2 - limit) / limit + 1e-6) + 1


def templates_of(texts: Mapping[str, str | Sequence[str]], limit: float) -> list[Template]:
    flat = [(name, normalised(t)) for name, own in sorted(texts.items()) for t in ([own] if isinstance(own, str) else own)]
    return [Template(name, words, limit) for name, words in flat if len(words) > 1]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _hits(source: str, pairs: list[str]) -> Column:
    """The entries (i, g) of the array `source` whose bigram `g` is among the pairs."""
    return F.expr(f"filter({source}, x -> x.g IN ({','.join(repr(p) for p in pairs)}))")


def _candidates(source: str, templates: list[Template]) -> list[Column]:
    """Of every template: what a match needs, and its hits in the array `source`."""
    out = []
    for t in templates:
        n = len(t.pairs)
        lengths = sorted({*range(t.need, t.longest, max(1, n // 16)), n, t.longest})
        hits = F.when(F.size(source) >= t.need, _hits(source, t.pairs))
        values = {"license": t.name, "n": n, "need": t.need, "longest": t.longest, "step": max(1, n // 128)}
        columns = [F.lit(v).alias(k) for k, v in values.items()]
        text = F.split(F.lit(" ".join(map(str, lengths))), " ").cast("array<int>")
        out.append(F.struct(*columns, text.alias("lengths"), hits.alias("hits")))
    return out


def _spans(t: Column, grams: Column, limit: float) -> Column:
    """Spans of a candidate: (n, license, first, last, common bigrams, all bigrams)."""

    def started(near: Column) -> Column:
        def span(length: Column) -> Column:
            inside = F.filter(near, lambda h: h["i"] < F.get(near, 0)["i"] + length)
            return _let(inside, measured)

        def measured(inside: Column) -> Column:
            first, last = F.get(inside, 0)["i"], F.get(inside, F.size(inside) - 1)["i"]
            own = F.transform(F.slice(grams, first + 1, last - first + 1), lambda x: x["g"])
            return F.struct(
                F.size(F.array_distinct(F.transform(inside, lambda h: h["g"]))).alias("common"),
                F.size(F.array_distinct(own)).alias("own"),
                first.alias("first"),
                last.alias("last"),
            )

        return F.transform(t["lengths"], span)

    def best(spans: Column) -> Column:
        scored = F.transform(
            spans,
            lambda x: F.struct(
                (F.lit(-2.0) * x["common"] / (x["own"] + t["n"])).alias("d"),
                (-x["common"]).alias("c"),
                x["first"].alias("first"),
                x["last"].alias("last"),
                t["license"].alias("license"),
            ),
        )
        return F.array_min(scored)

    near = lambda k: F.filter(F.slice(t["hits"], k + 1, t["longest"]), lambda h: h["i"] < F.get(t["hits"], k)["i"] + t["longest"])
    nears = F.transform(F.sequence(F.lit(0), F.size(t["hits"]) - t["need"], t["step"]), near)
    nears = F.filter(nears, lambda x: F.size(x) >= t["need"])
    found = F.transform(F.transform(nears, started), best)
    return F.filter(found, lambda x: x["d"] <= F.lit(-limit))


_SPANS = "array<struct<c:int,d:double,first:int,last:int,license:string>>"


def scan(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", templates: Mapping[str, str | Sequence[str]] | None = None, limit: float = 0.8
) -> DataFrame:
    """One row per document: id, license, dice, line_no (from 1) of the foremost match, n_matches, and licenses, the names of all."""
    known = templates_of(TEMPLATES if templates is None else templates, limit)
    short = [t for t in known if len(t.pairs) <= _LONG]
    long = [t for t in known if len(t.pairs) > _LONG]

    df = docs.select(F.col(id_).alias("id"), F.lower(text).alias("low"))
    lines = F.split(F.regexp_replace("low", r"[^\p{L}\p{N}\n]+", " "), "\n", -1)
    df = df.select("id", lines.alias("lines"))
    worded = F.transform("lines", lambda x, i: F.transform(F.filter(F.split(x, " "), lambda w: w != ""), lambda w: F.struct(w.alias("w"), (i + 1).alias("line"))))
    df = df.select("id", F.flatten(worded).alias("words"))
    rest = F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0)))
    pair = lambda x, i: F.struct(i.alias("i"), F.concat_ws(" ", F.get("words", i)["w"], x["w"]).alias("g"))
    df = df.select("id", "words", F.transform(rest, pair).alias("grams"))
    if short:
        df = df.withColumn("near", _hits("grams", sorted({p for t in short for p in t.pairs})))
    tried = _candidates("near", short) + _candidates("grams", long)
    if tried:
        enough = F.filter(F.array(*tried), lambda t: F.size(t["hits"]) >= t["need"])
        df = df.select("id", "words", "grams", enough.alias("tried"))
        # Bound once: within lambdas the optimizer would compute the bigrams anew for every span.
        all_spans = lambda row: F.flatten(F.transform(row["tried"], lambda t: _spans(t, row["grams"], limit)))
        df = df.select("id", "words", _let(F.struct("tried", "grams"), all_spans).alias("spans"))
        strongest = lambda x: F.struct(*[x[c].alias(c) for c in ("c", "d", "first", "last", "license")])
        df = df.select("id", "words", F.array_sort(F.transform("spans", strongest)).alias("spans"))
    else:
        df = df.select("id", "words", F.array().cast(_SPANS).alias("spans"))

    # The strongest first, and then all that overlap none before.
    def add(kept: Column, x: Column) -> Column:
        clash = F.exists(kept, lambda y: (y["first"] <= x["last"]) & (x["first"] <= y["last"]))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(x)))

    df = df.select("id", "words", F.aggregate("spans", F.array().cast(_SPANS), add).alias("kept"))
    order = lambda row: F.transform(row["kept"], lambda x: F.struct(
        (x["license"] == RESERVED).alias("reserved"), x["d"].alias("d"), F.get(row["words"], x["first"])["line"].alias("line_no"), x["license"].alias("license")
    ))
    df = df.select("id", F.array_sort(_let(F.struct("kept", "words"), order)).alias("found"))
    best = F.get("found", F.lit(0))
    return df.select(
        F.col("id").alias(id_),
        best["license"].alias("license"),
        (-best["d"]).alias("dice"),
        best["line_no"].cast("long").alias("line_no"),
        F.size("found").cast("long").alias("n_matches"),
        F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"]))).alias("licenses"),
    )
