"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory. DataFrame functions only.

Templates are the names, notices, SPDX lines and full texts of licences. Each word of a text that begins like one of STEMS is a sign. A sign meets the
templates whose own first sign has the same stem: the words around it that a template would cover if its sign lay there make a window, wherever lines
break, and window and template are compared as bags of words. A word weighs by how few licences name it, words of no template weigh most, so that another
version or name within the window lowers its cosine, while what stands around the window does not. A file takes the licence of its best window at
THRESHOLD or more; otherwise that of the licence file (LICENSE, LICENCE or COPYING) in its own directory or the nearest one above it; otherwise none.

Null texts are empty texts; null paths have no directory and inherit nothing. Of equal cosines the window that comes first in the text counts, then the
licence first by name; of several licence files in a directory the best and then the one first by path. Repeated rows give a row each. Very long texts are
cut into blocks of BLOCK words that overlap by the longest template, so every window is whole in the block of its sign.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The names under which licences go, by SPDX identifier.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "Affero General Public License 3.0"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 license"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "2-clause BSD license"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "3-clause BSD license"),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "Eclipse Public License v2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "General Public License 2.0", "Licensed under the GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "General Public License 3.0", "Licensed under the GPLv3"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "Licensed under the LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "Licensed under the LGPLv3"),
    "MIT": ("MIT License", "Released under the MIT License", "The MIT License (MIT)"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "Unlicense": ("Released under the Unlicense",),
}
#: The wording of notices and full texts, by SPDX identifier.
WORDINGS = {
    "AGPL-3.0": ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED",
        "Redistribution and use in source and binary forms are permitted under the BSD 2-Clause License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt",),
    "GPL-2.0": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",),
    "GPL-3.0": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.",),
    "LGPL-2.1": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",),
    "LGPL-3.0": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
        "This library is licensed under the GNU Lesser General Public License, version 3.",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This file is subject to the terms of the Mozilla Public License, version 2.0.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or redistribute it",),
}
#: (licence, text): an SPDX line, the names and the wordings of each.
TEMPLATES = tuple((i, t) for i in NAMES for t in (f"SPDX-License-Identifier: {i}", *NAMES[i], *WORDINGS.get(i, ())))
#: What a sign begins with, the least cosine, the words of a block.
STEMS, THRESHOLD, BLOCK = "licen|unlicen|copyright|redistribut|spdx|permission", 0.8, 1024
FILES = ("LICENSE", "LICENCE", "COPYING")
_SPLIT = r"[^a-z0-9.]+|\.(?![0-9])"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def _words(text: str) -> list[str]:
    """The words of a template, by the same rule as `words`."""
    return [w for w in re.split(_SPLIT, text.lower()) if w]


def weights(templates=TEMPLATES) -> tuple[dict[str, float], float]:
    """(weight per word, weight of a word of no template): a word weighs by the number of licences, not of forms, that name it."""
    named: dict[str, set[str]] = {}
    for name, text in templates:
        named.setdefault(name, set()).update(_words(text))
    return ({w: math.log((1 + len(named)) / (1 + sum(w in b for b in named.values()))) + 1 for b in named.values() for w in b}, math.log(1 + len(named)) + 1)


def shapes(templates=TEMPLATES) -> list[tuple[int, str, str, int, int]]:
    """(template, licence, stem, words before its first sign, words) of each template; one without a sign is an error."""
    out = []
    for i, (name, text) in enumerate(templates):
        own = _words(text)
        at, stem = next((k, m.group()) for k, w in enumerate(own) if (m := re.match(STEMS, w)))
        out.append((i, name, stem, at, len(own)))
    return out


def windows(rows: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(id, text) -> (id, template, window, at): the words each template would cover around each sign, once per file, at their first place."""
    longest = max(n for *_, n in shapes(templates))
    table = F.broadcast(rows.sparkSession.createDataFrame(shapes(templates), "template int, license string, stem string, before int, size int"))
    # Each explode keeps what follows from splitting the text again for every block and sign.
    split = rows.where(F.col("text").rlike(f"(?i){STEMS}")).select("id", F.explode(F.array(words(F.col("text")))).alias("all"))
    cut = lambda i: F.slice("all", F.greatest(i * BLOCK + 1 - longest, F.lit(1)), F.lit(BLOCK + 2 * longest))
    blocks = split.select("id", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor(F.size("all") / BLOCK).cast("int")), cut)).alias("block", "near"))
    first = F.least(F.col("block") * BLOCK, F.lit(longest))  # words of `near` that belong to the block before
    mine = F.sequence(first + 1, F.greatest(first + 1, F.least(first + BLOCK, F.size("near"))))
    signs = blocks.select("id", "block", "near", F.explode(F.filter(mine, lambda p: F.get("near", p - 1).rlike(f"^({STEMS})"))).alias("p"))
    placed = signs.withColumn("stem", F.regexp_extract(F.get("near", F.col("p") - 1), f"^({STEMS})", 1)).join(table, "stem")
    start = F.greatest(F.col("p") - F.col("before"), F.lit(1))
    covered = F.slice("near", start, F.col("size") - (start - F.col("p") + F.col("before")))
    return placed.select("id", "template", F.array_join(covered, " ").alias("window"), (F.col("block") * BLOCK - first + start).alias("at")).groupBy(
        "id", "template", "window").agg(F.min("at").alias("at"))


def similarities(pairs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(key, template, window) -> (key, license, score): the cosine of each window to its template.

    The words of a window meet those of its template and their weights through broadcast tables as large as the templates.
    """
    spark = pairs.sparkSession
    idf, other = weights(templates)
    bags = [Counter(_words(text)) for _, text in templates]
    lengths = [math.sqrt(sum((c * idf[w]) ** 2 for w, c in b.items())) for b in bags]
    entries = F.broadcast(spark.createDataFrame([(i, w, c * idf[w] / lengths[i]) for i, b in enumerate(bags) for w, c in b.items()], "template int, word string, share double"))
    weigh = F.broadcast(spark.createDataFrame(sorted(idf.items()), "word string, idf double"))
    names = F.broadcast(spark.createDataFrame([(i, name) for i, (name, _) in enumerate(templates)], "template int, license string"))
    counted = pairs.select("key", "template", F.explode(F.split("window", " ")).alias("word")).groupBy("key", "template", "word").agg(F.count(F.lit(1)).alias("n"))
    weighed = counted.join(weigh, "word", "left").withColumn("weight", F.col("n") * F.coalesce("idf", F.lit(other))).join(entries, ["template", "word"], "left")
    scores = weighed.groupBy("key", "template").agg((F.sum(F.col("weight") * F.coalesce("share", F.lit(0.0))) / F.sqrt(F.sum(F.col("weight") * F.col("weight")))).alias("score"))
    return scores.join(names, "template").select("key", "license", F.round("score", 6).alias("score"))


def directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def scan(files: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(doc_id, path, text) -> (doc_id, path, license, score, origin, from_dir), origin one of header, file, inherited, none."""
    rows = files.select("doc_id", "path", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "path", "text").alias("id"))
    is_file = F.coalesce(F.element_at(F.split("path", "/"), -1).isin(*FILES), F.lit(False))
    # Equal windows are measured once, in however many files they are.
    found = windows(rows.select("id", "text"), templates).withColumn("key", F.sha2(F.concat_ws(" ", "template", "window"), 256))
    scored = similarities(found.groupBy("key").agg(F.first("template").alias("template"), F.first("window").alias("window")), templates).where(F.col("score") >= THRESHOLD)
    own = found.select("id", "key", "at").join(scored, "key").groupBy("id").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "at", "license")).alias("b")).select("id", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))
    marked = rows.select("doc_id", "path", "id", is_file.alias("whole"), directory(F.col("path")).alias("dir")).join(own, "id", "left")
    by_dir = marked.where("whole AND license IS NOT NULL").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("b")).select(
        F.col("dir").alias("from_dir"), F.col("b.license").alias("dir_license"), (-F.col("b.s")).alias("dir_score"))
    # Each directory once: its ancestors, itself first, meet the directories that hold a licence file.
    depth = F.size(F.split("dir", "/"))
    ups = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(
        F.transform(F.sequence(depth, F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(F.split("dir", "/"), F.lit(1), n), "/")), F.array(F.lit(""))))
    above = marked.where("dir IS NOT NULL").select("dir").distinct().select("dir", F.posexplode(ups).alias("up", "from_dir"))
    nearest = above.join(by_dir, "from_dir").groupBy("dir").agg(F.min(F.struct("up", "from_dir", "dir_license", "dir_score")).alias("n"))
    joined = marked.join(nearest, "dir", "left")
    header, inherited = F.col("license").isNotNull(), F.col("n").isNotNull()
    return joined.select(
        "doc_id", "path", F.coalesce("license", "n.dir_license").alias("license"), F.coalesce("score", "n.dir_score").alias("score"),
        F.when(header & F.col("whole"), "file").when(header, "header").when(inherited, "inherited").otherwise("none").alias("origin"),
        F.when(~header & inherited, F.col("n.from_dir")).alias("from_dir"))
