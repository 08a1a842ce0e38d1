"""License scans: normalised text against license templates by the Dice coefficient of word bigrams.

The units are the lines of a text and the text as a whole. A unit's bigrams are joined with those of the templates
whose size allows the wanted coefficient: for sets of n and m bigrams it is at most ``2 min(n, m) / (n + m)``, so m must lie
between ``n t / (2 - t)`` and ``n (2 - t) / t``. Shared bigrams are counted per unit and template; units that share none, or
have no template of their size, cost one scan and are never shuffled. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twosided.llm.common import col, let, text_of

MIN_DICE = 0.8
#: Characters of all templates together; their bigrams are small enough to be broadcast below it.
MAX_TEMPLATE_CHARS = 1_000_000
#: The line number of the whole text.
WHOLE = -1

# License notices and texts: fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-notice": "This project is licensed under the terms of the MIT license.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
}


def bigrams(text: Column) -> Column:
    """Hashes of the different pairs of neighbouring words; lower case, and anything but letters and digits parts words."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")
    return let(words, lambda w: F.when(F.size(w) < 2, F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.zip_with(
        F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.xxhash64(a, b)))))


def template_bigrams(spark: SparkSession, templates: dict[str, str], min_dice: float) -> DataFrame:
    """``(license, size, least, most, bigram)``: least and most are the sizes of units that a template can match."""
    if sum(map(len, templates.values())) > MAX_TEMPLATE_CHARS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_CHARS} characters")
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    sized = rows.withColumn("bigrams", bigrams(F.col("text"))).withColumn("size", F.size("bigrams"))
    bound = min_dice / (2 - min_dice)
    return sized.select("license", "size", F.ceil(F.col("size") * bound - 1e-9).alias("least"),
                        F.floor(F.col("size") / bound + 1e-9).alias("most"), F.explode("bigrams").alias("bigram"))


def scan(docs: DataFrame, id_col: str, text_col: str, templates: dict[str, str] = TEMPLATES, min_dice: float = MIN_DICE) -> DataFrame:
    """``(id, line_no, license, dice)``: each unit and each template with a coefficient of ``min_dice`` or more.

    Lines are counted from 0; the whole text of several lines is line -1. A null or empty text and units or
    templates of fewer than two words match nothing. Rows of equal id, also null, and text give one result; rows of one id and other
    texts give theirs side by side. Several licenses may match a unit. Other columns are not looked at.
    """
    wanted = template_bigrams(docs.sparkSession, templates, min_dice)
    text, lines = text_of(text_col), F.split(text_of(text_col), "\n")
    units = docs.select(
        col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.size(lines).alias("n_lines"),
        F.posexplode(F.when(F.size(lines) > 1, F.concat(lines, F.array(text))).otherwise(lines)).alias("place", "unit"))
    least, most = wanted.agg(F.min("least"), F.max("most")).first()  # sizes that any template can match
    fitting = let(bigrams(F.col("unit")), lambda x: F.when(F.size(x).between(least or 1, most or 0), F.transform(
        x, lambda bigram: F.struct(bigram.alias("bigram"), F.size(x).alias("n")))))
    parts = units.select("id", "text_hash", F.when(F.col("place") < F.col("n_lines"), F.col("place")).otherwise(WHOLE).alias("line_no"),
                         F.explode(fitting).alias("part")).select("id", "text_hash", "line_no", "part.n", "part.bigram")
    shared = parts.join(F.broadcast(wanted), "bigram").filter(F.col("n").between(F.col("least"), F.col("most")))
    counted = shared.groupBy("id", "text_hash", "line_no", "n", "license", "size").agg(F.count_distinct("bigram").alias("shared"))
    return counted.withColumn("dice", 2 * F.col("shared") / (F.col("n") + F.col("size"))).filter(
        F.col("dice") >= min_dice).select("id", "line_no", "license", "dice")
