"""Operator 10 [native]: licence notices by Dice coefficient over word bigrams.

A document's units are its lines, its paragraphs (parted by blank lines), its
sentences (parted by blanks after ``.``, ``!`` or ``?``, within lines and over them)
and the whole text, normalised: lower case, runs of anything but letters and
digits one blank. A unit of n words has the bag of its n - 1 word bigrams, and

    dice(A, T) = 2 * |A and T as bags| / (|A| + |T|)

which is at least t only if t / (2 - t) * |T| <= |A| <= (2 - t) / t * |T|, and then
A misses few of T's bigrams. Key bigrams of which every such A has one, signed in the
text, and word counts by these bounds prune before a unit is normalised, and an index
from the templates' rarest bigrams leads to the few templates that a unit can reach.

Built-in functions only; the templates are a literal of fixed size in the
plan. One pass, and one small shuffle of the hits. Null or empty text: no
hits. Rows of one doc_id are reported together (null ids as one), equal units
of a row count once; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from fractions import Fraction
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import documents, id_text

#: Notices as their licences or stewards word them (fixed values).
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
            'associated documentation files (the "Software"), to deal in the Software without restriction, including '
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


#: Names of the licences as one-line notices use them.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache License v2.0"],
    "MIT": ["MIT License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPL v2", "GPL-2.0 license"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPL v3", "GPL-3.0 license"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPL v2.1", "LGPL-2.1 license"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL v3", "LGPL-3.0 license"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL v3", "AGPL-3.0 license"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "ISC": ["ISC License"],
    "Unlicense": ["Unlicense"],
}
_WORKS = ("work", "project", "software", "program", "code", "library")


def _forms(name: str) -> list[str]:
    """The usual one-line notices of a licence called ``name``. One exchanged word
    costs a name of five words or more less than 0.2 of Dice: one form does there."""
    the = "a " if name.startswith("Creative") else "" if name.startswith("CC") else "the "
    works = _WORKS[:1] if len(_normal(name).split(" ")) > 4 else _WORKS
    return [f"{verb} under {the}{name}" for verb in ("Licensed", "Released", "Distributed")] + [
        f"This {work} is {verb} under {the}{name}" for work in works
        for verb in (("licensed", "released") if work != "work" else ("licensed",))] + [
        f"Distributed under the terms of {the}{name}", f"License: {name}", name]


#: Headers and one-line notices of sibling licences, worded like those above.
_MORE = {
    **{lic: [f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {gnu} "
             f"License as published by the Free Software Foundation; either version {v} of the License, or (at your "
             "option) any later version." for what in ("program", "library")]
       for lic, gnu, v in (("GPL-2.0", "General Public", "2"), ("LGPL-2.1", "Lesser General Public", "2.1"),
                           ("LGPL-3.0", "Lesser General Public", "3"), ("AGPL-3.0", "Affero General Public", "3"))},
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                     "in binary form must reproduce the above copyright notice, this list of conditions and the "
                     "following disclaimer in the documentation and/or other materials provided with the distribution."],
}


def _normal(text: str) -> str:
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


for _lic, _texts in _MORE.items():
    TEMPLATES.setdefault(_lic, []).extend(_texts)
for _lic, _names in NAMES.items():
    _have = TEMPLATES.setdefault(_lic, [])
    _known = {_normal(t) for t in _have}
    _have += [t for n in _names for t in _forms(n) if " " in _normal(t) and _normal(t) not in _known]


def template_rows(templates: dict[str, list[str]], permille: int) -> list[tuple]:
    """(licence, bigrams, least, most, [(bigram, times)]) of each template."""
    t, out = Fraction(permille, 1000), []
    for name, texts in templates.items():
        for text in texts:
            w = _normal(text).split(" ")
            grams = Counter(f"{a} {b}" for a, b in zip(w, w[1:]))
            n = len(w) - 1
            out.append((name, n, -(-n * t // (2 - t)), n * (2 - t) // t, sorted(grams.items())))
    return out


#: Words that most texts hold, and digits.
COMMON = frozenset("a above all an and any are at be by can do either for free from in into is it later new not of option or "
                   "must that the this to under use with you work 0 1 2 3 4".split())


def key_bigrams(rows: list[tuple]) -> list[str]:
    """Bigrams of which every unit that reaches the limit has one: ``n - least + 1`` of each
    template, as in ``index_of``, but those that other texts hold least, and few in all."""
    times = Counter(g for *_, grams in rows for g, _ in grams)
    chosen: set[str] = set()
    for _, n, least, _, grams in rows:
        need = n - int(least) + 1
        for g, k in sorted(grams, key=lambda x: (sum(w in COMMON for w in x[0].split(" ")), -times[x[0]], x[0])):
            if need <= 0:
                break
            chosen.add(g)
            need -= k
    return sorted(chosen)


def _tree(words: list[str]) -> str:
    """A pattern of these sorted bigrams, with anything but a-z and 0-9 for the blank, that
    tries each of their beginnings once."""
    out = []
    for first, same in groupby((w for w in words if w), key=lambda w: w[0]):
        rest = [w[1:] for w in same]
        out.append(("[^a-z0-9]++" if first == " " else first) + _tree(rest))
    some = out[0] if len(out) == 1 else f"(?:{'|'.join(out)})" if out else ""
    return some if all(words) or not out else f"(?:{some})?"


#: Places of the literal index; a bigram's list is looked up by its checksum.
_INDEX = 4096


#: No bigrams, as a foldable expression: with a lambda in it the literal would be made anew for every use.
NO_GRAMS = "slice(array(named_struct('gram', '', 'times', 0)), 1, 0)"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _literal(rows: list[tuple]) -> str:
    """The templates, by number."""
    parts = []
    for name, n, least, most, grams in rows:
        again = ", ".join(f"named_struct('gram', {_quoted(g)}, 'times', {k})" for g, k in grams if k > 1)
        parts.append(f"named_struct('license_id', {_quoted(name)}, 'n', {n}, 'least', {least}, 'most', {most}, "
                     f"'grams', array({', '.join(_quoted(g) for g, _ in grams)}), "
                     f"'again', {f'array({again})' if again else NO_GRAMS})")
    return f"array({', '.join(parts)})"


def index_of(rows: list[tuple]) -> dict[str, list[int]]:
    """Bigram -> numbers of the templates that it leads to. A unit that reaches the limit
    misses ``n - least`` of a template's bigrams at the most, so it has one of any
    ``n - least + 1``: the rarest ones are indexed."""
    times = Counter(g for *_, grams in rows for g, _ in grams)
    out: dict[str, list[int]] = {}
    for number, (_, n, least, _, grams) in enumerate(rows, 1):
        need = n - int(least) + 1
        for g, k in sorted(grams, key=lambda x: (times[x[0]], x[0])):
            if need <= 0:
                break
            out.setdefault(g, []).append(number)
            need -= k
    return out


def _index_literal(rows: list[tuple]) -> str:
    places: list[list[str]] = [[] for _ in range(_INDEX)]
    for g, numbers in sorted(index_of(rows).items()):
        places[zlib.crc32(g.encode()) % _INDEX].append(f"named_struct('gram', {_quoted(g)}, 'at', array({', '.join(map(str, numbers))}))")
    none = "slice(array(named_struct('gram', '', 'at', array(0))), 1, 0)"
    return "array(" + ", ".join(f"array({', '.join(p)})" if p else none for p in places) + ")"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: dict[str, list[str]] | None = None, permille: int = 800) -> DataFrame:
    """doc_id, license_id, n_units, best_permille: the units of a document with
    dice of at least ``permille`` / 1000 to a template of the licence, and no more
    to another's."""
    rows = template_rows(templates or TEMPLATES, permille)
    least, most = min(r[2] for r in rows), max(r[3] for r in rows)
    # Every hit has a key bigram: documents with one go on. A sign before each, at the start of its
    # first word and no part of it, then tells the lines, sentences and so on that may hold one.
    # (Java looks behind by UTF-16 units: two reach a letter that is a surrogate pair.)
    keys = key_bigrams(rows)
    start = f"(?=[{''.join(sorted({g[0] for g in keys}))}])(?<![a-z0-9])"
    key = f"{_tree(keys)}(?![a-z0-9])"
    sign = F.lit("\x02")
    units = (id_text(docs, id_col, text_col).where("text is not null").select("doc_id", F.lower("text").alias("t"))
             .where(F.col("t").rlike(start + key))
             .select("doc_id", F.regexp_replace("t", rf"{start}(?={key})(?<![\p{{L}}\p{{N}}]{{1,2}})", sign).alias("t"))
             .select("doc_id", F.filter(F.split("t", BLOCK_END), lambda b: F.contains(b, sign)).alias("blocks"), "t")
             .select("doc_id", F.concat(F.flatten(F.transform("blocks", _parts)), F.array("t")).alias("units"))
             .select("doc_id", F.filter("units", lambda u: F.contains(u, sign) & ~F.rlike(u, F.lit(
                 rf"^(?:[^\p{{L}}\p{{N}}]*+[\p{{L}}\p{{N}}]++){{{most + 2}}}"))).alias("units"))
             .select("doc_id", F.explode(F.array_distinct(F.transform("units", _unit))).alias("unit"))
             .where(f"length(unit) - length(replace(unit, ' ', '')) between {least} and {most}")
             .selectExpr("doc_id", "split(unit, ' ') as w")
             .selectExpr("doc_id", "transform(sequence(1, size(w) - 1), "
                                   "k -> concat(w[k - 1], ' ', w[k])) as grams"))
    # The unit's bigrams lead to few templates; their bags are counted out.
    numbers = (f"array_distinct(flatten(transform(grams, g -> flatten(transform(filter(element_at({_index_literal(rows)}, "
               f"int(crc32(cast(g as binary)) % {_INDEX}) + 1), e -> e.gram = g), e -> e.at)))))")
    near = units.selectExpr("grams", "doc_id", f"transform({numbers}, k -> element_at({_literal(rows)}, k)) as near")
    # As bags: each shared bigram once, and those that the template has again as often as both do.
    both = ("(size(array_intersect(grams, t.grams)) + aggregate(t.again, 0, (sum, b) -> "
            "sum + greatest(0, least(b.times, size(filter(grams, g -> g = b.gram))) - 1)))")
    hits = (f"filter(transform(filter(near, t -> size(grams) between t.least and t.most), "
            f"t -> struct(2000 * {both} div (size(grams) + t.n) as permille, t.license_id as license_id)), "
            f"h -> h.permille >= {permille})")
    return (near.selectExpr("doc_id", f"{hits} as hits")
            .selectExpr("doc_id", "explode(array_distinct(filter(hits, "
                                  "h -> h.permille = array_max(hits).permille))) as hit")
            .groupBy("doc_id", F.col("hit.license_id").alias("license_id"))
            .agg(F.count("*").alias("n_units"), F.max("hit.permille").cast("long").alias("best_permille")))


#: Where a line, a paragraph and a sentence end together.
BLOCK_END = r"[.!?][ \t\r\f]*\n[ \t\r\f]*\n"


def _parts(b):
    """Lines, paragraphs, sentences of lines and of all of a lower-cased text's block."""
    return F.concat(F.split(b, r"\n"), F.split(b, r"\n[^\p{L}\p{N}\n]*\n"),
                    F.split(F.regexp_replace(b, r"([.!?])[ \t\r\f]+", "$1\n"), r"\n"),
                    F.split(F.regexp_replace(b, r"([.!?])[ \t\r\f\n]+", "$1\x01"), r"\x01"))


def _unit(u):
    return F.trim(F.regexp_replace(u, r"[^\p{L}\p{N}]+", " "))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    return license_scan(documents(spark, sf_dir))


def oracle() -> str:
    """The same in DuckDB, without pruning."""
    rows = []
    for name, n, _, _, grams in template_rows(TEMPLATES, 800):
        bag = ", ".join("{'gram': '" + g.replace("'", "''") + f"', 'times': {k}" + "}" for g, k in grams)
        rows.append(f"('{name}', {n}, [{bag}])")
    return f"""
with templates(license_id, n, bag) as (values {', '.join(rows)}),
low as (select doc_id, lower(text) as t from documents),
units as (select distinct doc_id, trim(regexp_replace(u, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as unit from (
  select doc_id, unnest(list_concat(list_concat(list_concat(string_split(t, chr(10)), string_split_regex(t, '\\n[^\\p{{L}}\\p{{N}}\\n]*\\n')),
    list_concat(string_split(regexp_replace(t, '([.!?])[ \\t\\r\\f]+', '\\1' || chr(10), 'g'), chr(10)),
      string_split(regexp_replace(t, '([.!?])[ \\t\\r\\f\\n]+', '\\1' || chr(1), 'g'), chr(1)))), [t])) as u from low)),
words as (select doc_id, unit, string_split(unit, ' ') as w from units
  where length(unit) - length(replace(unit, ' ', '')) >= 1),
grams as (select doc_id, unit, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) as g from words),
tried as (select distinct doc_id, unit, license_id, 2000 * cast(list_sum(list_transform(bag,
    lambda b: least(b.times, len(list_filter(g, lambda x: x = b.gram))))) as bigint) // (len(g) + n) as permille
  from grams join templates on 2 * len(g) <= 3 * n and list_has_any(g, list_transform(bag, lambda b: b.gram)))
select doc_id, license_id, count(*) as n_units, max(permille) as best_permille
from (select *, max(permille) over (partition by doc_id, unit) as top from tried)
where permille >= 800 and permille = top group by doc_id, license_id"""
