"""Licence scan: lines, runs of lines and whole texts against licence templates, by Dice over word bigrams.

Templates are notices, opening paragraphs and whole licence texts. A unit of text is normalised to lower-case words. Two units with ``a`` and ``b`` distinct bigrams
have ``2 c / (a + b)`` of ``c`` in common, at most ``2 min / (a + b)``: templates whose size rules
out the threshold are not compared, and units without any word that a match needs are not read
further. Texts that hold too few bigrams of all templates together are dropped first; lines, runs
of lines and whole texts are then read from the few that are left.
Built-in functions only, and no shuffle.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import written

#: Usual notices and short texts of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain.",
}
#: Whole texts, without title and copyright lines where these are the holder's.
TEMPLATES |= {f"{p.stem}-whole": p.read_text() for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
LEAST = 0.8


def words_of(low_text: Column) -> Column:
    """Runs of ASCII letters and digits of a lower-case text."""
    return F.array_remove(F.split(low_text, r"[^a-z0-9]+"), "")


def bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as a column that later filters read and don't evaluate again.

    Filters are pushed through a projection together with its expressions, but not through a generator.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def pairs_of(words: Column) -> Column:
    return F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))


def bigrams_of(words: Column) -> Column:
    return F.array_distinct(pairs_of(words))


def template_bigrams(templates: dict[str, str]) -> dict[str, list[str]]:
    out = {}
    for name, text in templates.items():
        words = re.findall(r"[a-z0-9]+", text.lower())
        out[name] = sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
    return out


def listed(bigrams: list[str]) -> Column:
    """A literal array, as one literal until it is folded."""
    return F.split(F.lit("\n".join(bigrams)), "\n")


def necessary_words(known: dict[str, list[str]], least: float) -> list[str]:
    """Words of which every unit that reaches ``least`` with any template holds one.

    A unit shares at least ``least / (2 - least)`` of a template's ``b`` bigrams, so it holds one
    of any choice of more than the rest of them. Words are chosen until the bigrams they are in
    are that many for each template, the word that helps most first.
    """
    left = {name: len(own) - math.ceil(len(own) * least / (2 - least) - 1e-9) + 1 for name, own in known.items()}
    open_bigrams = {name: set(own) for name, own in known.items()}
    chosen: list[str] = []
    while any(n > 0 for n in left.values()):
        gain: dict[str, int] = {}
        for name, own in open_bigrams.items():
            held: dict[str, int] = {}
            for bigram in own:
                for word in set(bigram.split()):
                    held[word] = held.get(word, 0) + 1
            for word, n in held.items():
                gain[word] = gain.get(word, 0) + max(0, min(n, left[name]))
        # long words are rare in other text; a long word with some gain comes before any short one
        best = max(sorted(gain), key=lambda w: (gain[w] > 0, len(w) > 5, gain[w] if len(w) > 5 else len(w), len(w)))
        chosen.append(best)
        for name, own in open_bigrams.items():
            hit = {b for b in own if best in b.split()}
            left[name] -= len(hit)
            open_bigrams[name] = own - hit
    return chosen


def _need(known: dict[str, list[str]], least: float) -> dict[str, int]:
    """How many bigrams of each template a unit shares that reaches ``least`` with it."""
    return {name: math.ceil(len(own) * least / (2 - least) - 1e-9) for name, own in known.items()}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``(id, line, last, licence, dice)``: units and their most similar template, if ``least`` or more.

    Units are the lines of a text, from 1, and as line 0 the whole text when it has several lines.
    Of equal scores the licence whose name sorts first is given. Runs of lines, from ``line`` to
    ``last``, are reported besides, see ``_runs``; else ``last`` is ``line``. Null and empty texts
    and units of fewer than two words have no bigram and match nothing. Repeated rows report each.
    """
    known = template_bigrams(templates)
    low = min(len(b) for b in known.values()) * least / (2 - least)
    high = max(len(b) for b in known.values()) * (2 - least) / least
    words = necessary_words(known, least)

    def hopeful(low_text: Column) -> Column:
        return reduce(lambda x, y: x | y, (F.contains(low_text, F.lit(w)) for w in words))

    texts = bound(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "low", F.lower("text"))
    texts = bound(texts.where(hopeful(F.col("low"))).select("id", "low"), "words", words_of(F.col("low"))).select("id", "low", "words")
    # a unit that reaches ``least`` holds so many bigrams of its template, and the text holds those of its units
    every = sorted({b for own in known.values() for b in own})
    held = F.array_distinct(F.filter(pairs_of(F.col("words")), lambda b: b.isin(every)))
    texts = bound(texts, "held", held).where(F.size("held") >= min(_need(known, least).values())).select("id", "low", "held")
    texts = bound(written(texts, "hopeful"), "lines", F.split("low", "\n", -1))
    runs = _runs(texts, templates, known, least)
    whole = F.when(F.size("lines") > 1, F.array("low")).otherwise(F.array(F.lit(None).cast("string")))
    units = texts.select("id", F.posexplode_outer(F.concat(whole, "lines")).alias("line", "unit"))
    # a unit of n distinct bigrams has at least 2 n + 1 characters; the number of words isn't bounded, as bigrams may repeat
    units = units.where((F.char_length("unit") > 2 * low) & hopeful(F.col("unit")))
    units = bound(units, "words", words_of(F.col("unit"))).select("id", "line", "words")
    # d distinct words make at least d - 1 distinct bigrams
    units = units.where((F.size("words") > low) & (F.size(F.array_distinct("words")) <= high + 1))
    units = bound(units, "own", bigrams_of(F.col("words"))).select("id", "line", "own")
    units = units.where(F.size("own").between(low, high))

    def dice(name: str) -> Column:
        size = len(known[name])
        fits = F.least(F.size("own"), F.lit(size)) * 2 >= least * (F.size("own") + size)
        score = F.lit(2.0) * F.size(F.array_intersect("own", listed(known[name]))) / (F.size("own") + size)
        return F.when(fits, F.struct((-score).alias("less"), F.lit(name).alias("licence")))

    best = F.array_min(F.array_compact(F.array(*map(dice, sorted(known)))))
    found = bound(units, "best", best).where(-F.col("best.less") >= least)
    return found.select("id", "line", F.col("line").alias("last"), "best.licence", (-F.col("best.less")).alias("dice")).unionByName(runs)


def _runs(texts: DataFrame, templates: dict[str, str], known: dict[str, list[str]], least: float) -> DataFrame:
    """``(id, line, last, licence, dice)`` of runs of several consecutive lines in ``(id, lines, held)``.

    A run has at most ``(2 - least) / least`` times the words of the template. Each line that
    begins one of the template's bigrams starts a run, up to the last line that gives the greatest
    Dice, the first of equals: other first lines only add bigrams the template lacks. Of a licence,
    runs are taken from the greatest Dice down (then the fewest lines, then the first) unless they
    overlap one taken before. Of those taken, single lines and the whole text are units of their own.
    """
    names = sorted(known)
    need = [_need(known, least)[n] for n in names]
    longest = [math.floor(len(re.findall(r"[a-z0-9]+", templates[n].lower())) * (2 - least) / least + 1e-9) for n in names]
    texts = texts.where(F.size("lines") > 1).select("id", "lines", "held")
    fits = [
        F.when((F.size("held") >= n) & (F.size(F.array_intersect("held", listed(known[name]))) >= n), F.lit(k))
        for k, (name, n) in enumerate(zip(names, need, strict=True), 1)
    ]
    rows = texts.select("id", "lines", F.explode(F.array_compact(F.array(*fits))).alias("k"))

    def of(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("k"))

    def shifted(name: str) -> Column:
        """The elements before those of an array."""
        return F.concat(F.array(F.lit(None)), F.slice(name, 1, F.size(name) - 1))

    def in_line(words: Column, n: Column) -> Column:
        return F.transform(words, lambda w, j: F.struct(w.alias("w"), (n + 1).alias("line"), j.alias("j"), (j == F.size(words) - 1).alias("end")))

    rows = bound(rows, "split", F.transform("lines", words_of)).select("id", "k", "split")
    rows = bound(rows, "tokens", F.flatten(F.transform("split", in_line))).select("id", "k", "tokens")
    pairs = F.zip_with(
        F.slice("tokens", 1, F.size("tokens") - 1),
        F.slice("tokens", 2, F.size("tokens")),
        # closes: the line that ends with the bigram
        lambda a, b: F.struct(F.concat_ws(" ", a["w"], b["w"]).alias("g"), a["line"].alias("line"), a["j"].alias("j"), F.when(b["end"], b["line"]).alias("closes")),
    )
    rows = bound(rows, "pairs", pairs).select("id", "k", "pairs", F.element_at("tokens", -1)["line"].alias("end"))
    rows = bound(rows, "byname", F.array_sort(F.transform("pairs", lambda x, i: F.struct(x["g"].alias("g"), i.alias("i")))))
    before = F.array_sort(F.zip_with("byname", shifted("byname"), lambda x, p: F.struct(x["i"].alias("i"), F.when(p["g"] == x["g"], p["i"]).otherwise(-1).alias("before"))))
    rows = bound(rows, "before", before)
    theirs = F.element_at(F.array(*(listed(known[n]) for n in names)), F.col("k"))
    grams = F.zip_with(
        "pairs",
        "before",
        lambda x, y: F.struct(y["i"].alias("i"), y["before"].alias("before"), x["line"].alias("line"), (y["i"] - x["j"]).alias("first"), x["closes"].alias("closes"), F.array_contains(theirs, x["g"]).alias("hit")),
    )
    rows = bound(rows, "grams", grams).select("id", "k", "end", "grams", of(need).alias("need"), of(longest).alias("longest"), of([len(known[n]) for n in names]).alias("b"))
    rows = bound(rows, "hits", F.filter("grams", lambda x: x["hit"])).where(F.size("hits") >= F.col("need"))
    # the first hit of a line starts a run if the last of the hits it needs is near enough
    near = F.zip_with("hits", F.slice("hits", F.col("need"), F.size("hits")), lambda a, z: z["i"] - a["first"] < F.col("longest") - 1)
    begins = F.zip_with("hits", shifted("hits"), lambda a, p: F.coalesce(p["line"] != a["line"], F.lit(True)))
    rows = bound(rows, "ways", F.zip_with(near, begins, lambda x, y: F.coalesce(x & y, F.lit(False))))
    starts = F.filter(F.zip_with("hits", "ways", lambda a, y: F.struct(a["line"].alias("line"), a["first"].alias("first"), y.alias("way"))), lambda s: s["way"])
    rows = bound(rows, "starts", starts).where(F.size("starts") > 0)

    def best_from(start: Column) -> Column:
        def add(state: Column, x: Column) -> Column:
            new = (x["before"] < start["first"]).cast("int")
            own, both = state["own"] + new, state["both"] + F.when(x["hit"], new).otherwise(0)
            dice = F.lit(2.0) * both / (own + F.col("b"))
            more = x["closes"].isNotNull() & (dice > state["dice"])
            return F.struct(
                own.alias("own"), both.alias("both"), F.when(more, dice).otherwise(state["dice"]).alias("dice"), F.when(more, x["closes"]).otherwise(state["last"]).alias("last")
            )

        none = F.struct(F.lit(0).alias("own"), F.lit(0).alias("both"), F.lit(0.0).alias("dice"), F.lit(0).alias("last"))
        part = F.slice("grams", start["first"] + 1, F.col("longest") - 1)
        return F.aggregate(
            part, none, add,
            lambda s: F.struct((-s["dice"]).alias("less"), (s["last"] - start["line"]).alias("more"), start["line"].alias("line"), s["last"].alias("last"), (start["first"] == 0).alias("opens")),
        )

    found = bound(rows, "found", F.array_sort(F.filter(F.transform("starts", best_from), lambda r: -r["less"] >= least)))
    taken = F.aggregate(
        F.col("found"),
        F.slice("found", 1, 0),
        lambda own, r: F.when(F.exists(own, lambda o: (o["line"] <= r["last"]) & (r["line"] <= o["last"])), own).otherwise(F.concat(own, F.array(r))),
    )
    shown = found.where(F.size("found") > 0).select("id", "end", "k", F.explode(taken).alias("r"))
    shown = shown.where((F.col("r.more") > 0) & ~(F.col("r.opens") & (F.col("r.last") == F.col("end"))))
    return shown.select("id", "r.line", "r.last", of(names).alias("licence"), (-F.col("r.less")).alias("dice"))
