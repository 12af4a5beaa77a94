"""Licences of files: headers and licence files against templates, and inheritance by directory."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import text_of
from tallyhouse.llm.sketches import let
from tallyhouse.sources.staging import stage

THRESHOLD = 0.8

# Names of licence files; the part before a dot counts, in any case.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)(\..*)?$"

TERM = r"[\p{L}0-9]+(?:[.\-][\p{L}0-9]+)*"

# The short notices of well-known licences, and the opening of their texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *[
        (name, f"{work} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} "
               f"License as published by the Free Software Foundation, either version {version} of the License, or (at your "
               "option) any later version.")
        for name, work, mark, kind, version in (
            ("GPL-2.0", "This program", ";", "General Public", "2"),
            ("GPL-3.0", "This program", ":", "General Public", "3"),
            ("LGPL-2.1", "This library", ";", "Lesser General Public", "2.1"),
            ("LGPL-3.0", "This program", ":", "Lesser General Public", "3"),
            ("AGPL-3.0", "This program", ":", "Affero General Public", "3"),
        )
    ],
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
)


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def template_terms(text: str) -> Counter:
    return Counter(re.findall(TERM.replace(r"\p{L}", "a-z"), text.lower()))


def rarity(total: int, having: int) -> float:
    return math.log((1 + total) / (1 + having)) + 1


def required_terms(templates, idf: dict[str, float], threshold: float) -> set[str]:
    """Terms of which a text must have one to reach the threshold with any template.

    Per template the heaviest terms, until what is left of the vector is shorter than the threshold:
    a text that shares only that rest has a smaller cosine, whatever else it holds.
    """
    needed: set[str] = set()
    for _, text in templates:
        weights = sorted(((n * idf[t], t) for t, n in template_terms(text).items()), reverse=True)
        rest = sum(w * w for w, _ in weights)
        limit = threshold * threshold * rest * (1 - 1e-9)
        for w, t in weights:
            if rest < limit:
                break
            needed.add(t)
            rest -= w * w
    return needed


def _windows(lines: Column, templates, idf: dict[str, float], threshold: float) -> Column:
    """Array of (``block``, ``unit``, ``terms``): runs of terms as long as a template that may be that template.

    Each term that a template requires, wherever it stands in the file, puts the template there with that term in its
    place, across line ends and comment marks. ``block`` is the line of the first term, ``unit`` tells runs apart.
    """
    places: dict[str, list[tuple[int, int]]] = {}
    for name, text in templates:
        order = re.findall(TERM.replace(r"\p{L}", "a-z"), text.lower())
        for t in required_terms([(name, text)], idf, threshold):
            places.setdefault(t, []).extend((q, len(order)) for q, x in enumerate(order) if x == t)
    listed = F.create_map(*[
        x for t, at in sorted(places.items())
        for x in (F.lit(t), F.array(*[F.struct(F.lit(q).alias("q"), F.lit(n).alias("n")) for q, n in sorted(set(at))]))
    ])
    names = sorted(places)
    terms = F.flatten(F.transform(lines, lambda x, k: F.transform(terms_of(x), lambda w: F.struct(w.alias("w"), k.alias("line")))))

    def found(all_terms: Column) -> Column:
        indexed = F.transform(all_terms, lambda x, i: F.struct(x["w"].alias("w"), i.alias("i")))
        hits = F.filter(indexed, lambda x: x["w"].isin(names))
        units = F.array_distinct(F.flatten(F.transform(hits, lambda x: F.transform(
            F.element_at(listed, x["w"]),
            lambda p: F.shiftleft(F.greatest(x["i"] - p["q"], F.lit(0)).cast("long"), 16).bitwiseOR(p["n"].cast("long")),
        ))))
        start = lambda u: F.shiftright(u, 16).cast("int")
        return F.transform(units, lambda u: F.struct(
            F.get(all_terms, start(u))["line"].alias("block"),
            u.alias("unit"),
            F.transform(F.slice(all_terms, start(u) + 1, u.bitwiseAND(F.lit(65535)).cast("int")), lambda x: x["w"]).alias("terms"),
        ))

    return let(terms, found)


def scan_licences(
    df: DataFrame, path: str, text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD, windows: bool = False
) -> DataFrame:
    """``path``, ``licence``, ``score`` and ``block`` of the files that state a licence themselves.

    Every line of a file, and the file as a whole (block -1), is a sparse vector of terms weighted by
    their rarity over all files; terms that no template has weigh as the rarest. A file's licence is
    that of the template with the greatest cosine from the threshold up; ties go to the earlier block,
    then to the first name. All lines are looked at: only blocks that cannot reach the
    threshold are left out, for lack of any of the terms it requires or for the weight of their unknown
    words, which loses nothing. What reaches the driver is a count for each template term.

    With ``windows``, runs of terms as long as a template are blocks too, numbered by the line in which they
    begin: a notice that is wrapped over commented lines, or that shares its line with other sentences.

    Missing texts are empty and state nothing. Rows that share a path are one file with several texts:
    their best block counts. Other columns are not read.
    """
    spark = df.sparkSession
    files = df.select(F.col(f"`{path}`").alias("path"), text_of(f"`{text}`").alias("text"))
    key = F.concat_ws(":", F.coalesce(F.concat(F.lit("="), F.col("path")), F.lit("")), F.hex(F.xxhash64("text")))
    vocabulary = sorted(set().union(*[template_terms(t) for _, t in templates]))
    known = F.array_distinct(F.filter(terms_of(F.col("text")), lambda w: w.isin(vocabulary)))
    # An empty term for each file counts all of them in the same pass.
    seen = files.select(F.explode(F.concat(known, F.array(F.lit("")))).alias("term")).groupBy("term").count()
    counts = {r["term"]: r["count"] for r in seen.collect()}  # at most one row for each template term
    total = counts.get("", 0)
    idf = {t: rarity(total, counts.get(t, 0)) for t in vocabulary}
    unknown = rarity(total, 0)

    needed = sorted(required_terms(templates, idf, threshold))
    has_needed = lambda t: F.exists(terms_of(t), lambda w: w.isin(needed))
    open_files = files.where(has_needed(F.col("text"))).withColumn("key", key)
    rarity_map = F.create_map(*[F.lit(x) for pair in idf.items() for x in pair])

    def can_reach(t: Column) -> Column:
        """Whether the known terms of a block are heavy enough for the threshold.

        The cosine is at most the share of the known terms in the length of the vector, and each unknown
        word adds at least its own square to that.
        """
        known = F.filter(t, lambda w: w.isin(vocabulary))
        square = F.aggregate(F.array_distinct(known), F.lit(0.0), lambda a, w: a + F.pow(
            F.size(F.filter(known, lambda x: x == w)) * F.element_at(rarity_map, w), F.lit(2.0)
        ))
        others = (F.size(t) - F.size(known)) * unknown * unknown
        return others <= square * (1 / threshold**2 - 1) * (1 + 1e-9)

    lines = open_files.select("key", "path", F.posexplode(F.split("text", "\n", -1)).alias("block", "body"))
    blocks = lines.where(has_needed(F.col("body"))).unionByName(
        open_files.select("key", "path", F.lit(-1).alias("block"), F.col("text").alias("body"))
    )
    rarities = spark.createDataFrame([(t, idf[t]) for t in vocabulary], "term string, idf double")
    vectors = []
    for n, (name, body) in enumerate(templates):
        weights = {t: c * idf[t] for t, c in template_terms(body).items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        vectors += [(t, n, name, w / length) for t, w in weights.items()]
    templated = spark.createDataFrame(vectors, "term string, template int, licence string, share double")

    blocks = blocks.select("key", "path", "block", F.lit(-1).cast("long").alias("unit"), terms_of(F.col("body")).alias("terms"))
    if windows:
        runs = _windows(F.split("text", "\n", -1), templates, idf, threshold)
        blocks = blocks.unionByName(open_files.select("key", "path", F.inline(runs)))
    blocks = blocks.where(can_reach(F.col("terms")))
    terms = stage(  # read twice below
        blocks.select("key", "path", "block", "unit", F.explode("terms").alias("term"))
        .groupBy("key", "path", "block", "unit", "term")
        .agg(F.count(F.lit(1)).alias("n")),
        "block-terms",
    )
    terms = terms.join(rarities, "term", "left").withColumn("weight", F.col("n") * F.coalesce("idf", F.lit(unknown)))
    of = ["key", "block", "unit"]
    lengths = terms.groupBy(*of).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    products = terms.join(templated, "term").groupBy(*of, "path", "template", "licence")
    products = products.agg(F.sum(F.col("weight") * F.col("share")).alias("product"))
    scored = products.join(lengths.where("length > 0"), of).select(
        "path", "block", "licence", F.round(F.col("product") / F.col("length"), 6).alias("score")
    )
    best = F.min(F.struct((-F.col("score")).alias("s"), "block", "licence")).alias("b")
    return scored.where(F.col("score") >= threshold).groupBy("path").agg(best).select(
        "path", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"), F.col("b.block").cast("long").alias("block")
    )


def directory_of(path: Column) -> Column:
    """What is before the last slash; empty for a file at the top."""
    return F.regexp_replace(path, r"(^|/)[^/]*$", "")


def licence_of_files(
    df: DataFrame, path: str, text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD, windows: bool = False
) -> DataFrame:
    """One row per path: its own licence, or that of the nearest directory above it that has a licence file.

    The licence of a directory is that of its licence files (the best score, then the first path). All
    distinct directories are resolved first, by a join of their ancestors with the directories that have
    a licence, and staged; the files then join their directory, and the adaptive plan can split one with
    very many files.

    ``origin`` is ``own``, ``inherited`` or null where there is none. Rows that share a path are one file;
    a missing path is one file without a directory, which inherits nothing.
    """
    own = stage(scan_licences(df, path, text, templates, threshold, windows), "own-licences")
    name = F.regexp_replace(F.col("path"), r"^.*/", "")
    holders = own.where(name.rlike(LICENCE_FILE)).withColumn("directory", directory_of(F.col("path")))
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("path").alias("p"), "licence")).alias("b")
    holders = holders.groupBy("directory").agg(best).select(F.col("directory").alias("above"), F.col("b.licence").alias("inherited"))

    paths = df.select(F.col(f"`{path}`").alias("path")).distinct().withColumn("directory", directory_of(F.col("path")))
    steps = F.split("directory", "/")
    ancestors = F.concat(
        F.array(F.lit("")),
        F.when(F.col("directory") == "", F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
        ),
    )
    resolved = (
        paths.select("directory").where("directory IS NOT NULL").distinct()
        .select("directory", F.posexplode(ancestors).alias("depth", "above"))
        .join(holders, "above")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "above", "inherited")).alias("b"))
        .select("directory", F.col("b.above").alias("licence_directory"), F.col("b.inherited").alias("inherited"))
    )
    resolved = stage(resolved, "directories")
    found = paths.join(own, paths["path"].eqNullSafe(own["path"]), "left").drop(own["path"]).join(resolved, "directory", "left")
    mine = F.col("licence").isNotNull()
    return found.select(
        "path",
        F.coalesce("licence", "inherited").alias("licence"),
        F.when(mine, "own").when(F.col("inherited").isNotNull(), "inherited").alias("origin"),
        "score",
        "block",
        F.when(~mine, F.col("licence_directory")).alias("licence_directory"),
    )
