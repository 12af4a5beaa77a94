import math
import re
from collections import Counter

from tests.llm.helpers import given, rows_of, with_clashing_columns

from tallyhouse.llm import licences
from tallyhouse.llm.queries import with_paths


def scan_by_hand(files, threshold=licences.THRESHOLD):
    """Cosine of every line and every whole text with every template, without leaving anything out."""
    split = lambda t: re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", t.lower())
    vocabulary = {w for _, t in licences.TEMPLATES for w in split(t)}
    having = Counter(w for _, t in files for w in set(split(t or "")) & vocabulary)
    idf = {w: licences.rarity(len(files), having[w]) for w in vocabulary}
    unknown = licences.rarity(len(files), 0)
    best = {}
    for path, text in files:
        text = text or ""
        for block, body in [(-1, text), *enumerate(text.split("\n"))]:
            tf = Counter(split(body))
            length = math.sqrt(sum((n * idf.get(w, unknown)) ** 2 for w, n in tf.items()))
            for name, template in licences.TEMPLATES:
                t = {w: n * idf[w] for w, n in Counter(split(template)).items()}
                product = sum(n * idf[w] * t[w] for w, n in tf.items() if w in t)
                score = round(product / length / math.sqrt(sum(x * x for x in t.values())), 6) if length else 0
                if score >= threshold:
                    best[path] = min(best.get(path, (0, 0, "")), (-score, block, name))
    return {p: (name, -s, block) for p, (s, block, name) in best.items()}


def inherit_by_hand(paths, own):
    holders = {}
    for path in sorted(own):
        directory, _, name = path.rpartition("/")
        if re.match(licences.LICENCE_FILE, name):
            name, score, _ = own[path]
            holders[directory] = min(holders.get(directory, (0, "", "")), (-score, path, name))
    out = {}
    for path in paths:
        if path in own:
            out[path] = (own[path][0], "own", own[path][1], own[path][2], None)
            continue
        at = path.rpartition("/")[0]
        while at not in holders and at:
            at = at.rpartition("/")[0]
        out[path] = (holders[at][2], "inherited", None, None, at) if at in holders else (None, None, None, None, None)
    return out


def found(df, **options):
    rows = rows_of(licences.licence_of_files(df, "path", **options))
    return {r["path"]: (r["licence"], r["origin"], r["score"], r["block"], r["licence_directory"]) for r in rows}


def test_given_documents_as_a_tree(spark):
    files = with_paths(given(spark))
    rows = [(r.path, r.text) for r in files.collect()]
    own = scan_by_hand(rows)
    assert own and found(files) == inherit_by_hand([p for p, _ in rows], own)


def test_headers_files_and_nearest_directories(spark):
    mit = licences.TEMPLATES[13][1]
    rows = [
        ("LICENSE", "Licensed under the Apache License, Version 2.0."),
        ("a/copying.txt", mit),
        ("a/b/c/x.py", "code"),
        ("a/b/LICENCE.md", "nothing here"),
        ("a/d.py", "# Released under the MIT License.\nimport x"),
        ("z/y.py", None),
        ("top.py", ""),
        ("a/b/é.py", "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0."),
        ("q/LICENSE", "Released under the\nMIT License."),
        ("q/r", "license " * 50),
    ]
    df = with_clashing_columns(spark.createDataFrame(rows, "file string, text string"))
    df = df.drop("path").withColumnRenamed("file", "path")
    own = scan_by_hand(rows)
    assert own["a/copying.txt"][0] == "MIT" and own["q/LICENSE"] == ("MIT", 1.0, -1)
    result = found(df)
    assert result == inherit_by_hand([p for p, _ in rows], own)
    assert result["a/b/c/x.py"][4] == "a" and result["z/y.py"][4] == "" and result["top.py"][1] == "inherited"


def test_no_rows_missing_paths_and_repeats(spark):
    schema = "path string, text string"
    assert found(spark.createDataFrame([], schema)) == {}
    rows = [(None, "Released under the MIT License."), (None, "x"), ("p", "x"), ("p", "Licensed under CC BY 4.0.")]
    result = found(spark.createDataFrame(rows, schema))
    assert set(result) == {None, "p"} and result["p"][0] == "CC-BY-4.0" and result[None][0] == "MIT"


def test_required_terms_lose_nothing():
    idf = {w: 1 + len(w) / 3 for _, t in licences.TEMPLATES for w in licences.template_terms(t)}
    needed = licences.required_terms(licences.TEMPLATES, idf, 0.8)
    for _, text in licences.TEMPLATES:
        terms = licences.template_terms(text)
        rest = sum((n * idf[t]) ** 2 for t, n in terms.items() if t not in needed)
        assert rest < 0.64 * sum((n * idf[t]) ** 2 for t, n in terms.items())


def test_wrapped_headers_and_licence_files_reach_the_threshold(spark):
    code = "\n".join(f"value_{k} = compute_{k}(argument_{k}, other_{k})" for k in range(60))
    mit = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
    bsd = """# Copyright (c) 2020, Jane Doe
# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
"""
    gpl = """/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version {0} of the License, or
 * (at your option) any later version. */
"""
    apache = """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
"""
    title = "  Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/\n"
    texts = {
        "m": mit, "b": bsd, "g3": gpl.format(3), "g2": gpl.format(2), "a": apache, "t": title,
        "l": gpl.format(3).replace("GNU General", "GNU Lesser General"),
        "c": "Copyright (c) 2020 Jane Doe. Licensed under CC BY 4.0.", "n": "nothing is said here about permission",
    }
    df = spark.createDataFrame([(k, t + "\n" + code) for k, t in texts.items()], "path string, text string").repartition(3)
    result = found(df, windows=True)
    assert {p: r[0] for p, r in result.items()} == {
        "m": "MIT", "b": "BSD-3-Clause", "g3": "GPL-3.0", "g2": "GPL-2.0", "l": "LGPL-3.0", "a": "Apache-2.0", "t": "Apache-2.0",
        "c": "CC-BY-4.0", "n": None,
    }
    assert result["b"][3] == 1 and result["m"][3] == 4 and result["c"][2:4] == (1.0, 0)


def test_windows_only_add_to_lines_and_whole_texts(spark):
    files = with_paths(given(spark))
    plain, wide = found(files), found(files, windows=True)
    own = {p: r for p, r in plain.items() if r[1] == "own"}
    assert own and all(wide[p][1] == "own" and wide[p][2] >= r[2] for p, r in own.items())
