"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences: after ``.``, ``!``, ``?`` or ``;`` before white space, and at blank lines (without a-z, A-Z
or 0-9). A line break, a colon before white space and a list mark such as ``(a)`` may end a sentence or lie within
it, so that wrapped texts, also in comment marks, and one-line notices are both found: a known sentence must fill the words between two such
places, with line breaks, colons and list marks inside as they come; one of over ``UNMISTAKABLE`` words may start anywhere. Of several that start at one place the longest counts, and none
overlap. Words are normalised (A-Z lower-cased, everything but letters and digits one space). Each known sentence has an
identifier; notices that name a version end in it. The identifiers of a text, in its
order, are matched against the licence rules in *their* order: a rule is a sequence of identifiers that must follow each
other among the text's known sentences (other sentences between them don't matter), and the first rule that takes an
identifier keeps it, so the longer rules come first. "All rights reserved" right before a licence's sentences is part of it.

The known sentences and the rules are parameters; the search is one expression of them and the lookup a map literal, bounded
by their number. One pass over the rows, without a shuffle.

Defined cases: a null, empty or blank text has no known sentence and no licence; a sentence found twice counts twice,
its licence is listed once; repeated rows each come back; an empty table gives an empty table. Other columns play no
part. Texts are read whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorlens.llm.common import ascii_lower, whole_text

#: Known sentences as they are written, by identifier.
SENTENCES = {
    1: "Released under the MIT License.",
    2: "Licensed under the MIT License.",
    3: "Permission is hereby granted, free of charge, to any person obtaining a copy",
    4: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    5: "Licensed under the Apache License, Version 2.0.",
    6: 'Licensed under the Apache License, Version 2.0 (the "License");',
    7: "you may not use this file except in compliance with the License.",
    8: "This work is licensed under the GNU General Public License, version 3.",
    9: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    10: "Licensed under CC BY-NC 4.0.",
    11: "Licensed under CC BY 4.0.",
    12: "Licensed under CC BY-SA 4.0.",
    13: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    14: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    15: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    16: "All rights reserved.",
    17: "This work is dedicated to the public domain.",
    18: "SPDX-License-Identifier: MIT",
    19: "SPDX-License-Identifier: Apache-2.0",
    20: "SPDX-License-Identifier: GPL-3.0-only",
    21: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
    22: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    23: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, version 3.",
    24: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
}

#: (licence, kind, sequence of identifiers), in the order in which they are tried.
RULES = [
    ("MIT", "permissive", (16, 21, 4)),
    ("MIT", "permissive", (21, 4)),
    ("MIT", "permissive", (3, 4)),
    ("Apache-2.0", "permissive", (6, 7)),
    ("BSD-3-Clause", "permissive", (16, 14, 24)),
    ("BSD-3-Clause", "permissive", (14, 24)),
    ("BSD-3-Clause", "permissive", (14, 15)),
    ("BSD-2-Clause", "permissive", (16, 14)),
    ("BSD-2-Clause", "permissive", (14,)),
    ("MIT", "permissive", (1,)),
    ("MIT", "permissive", (2,)),
    ("MIT", "permissive", (18,)),
    ("Apache-2.0", "permissive", (5,)),
    ("Apache-2.0", "permissive", (19,)),
    ("GPL-3.0", "copyleft", (8,)),
    ("GPL-3.0", "copyleft", (9,)),
    ("GPL-3.0", "copyleft", (22,)),
    ("GPL-3.0", "copyleft", (23,)),
    ("GPL-3.0", "copyleft", (20,)),
    ("CC-BY-NC-4.0", "noncommercial", (10,)),
    ("CC-BY-SA-4.0", "copyleft", (12,)),
    ("CC-BY-4.0", "permissive", (11,)),
    ("CC-BY-4.0", "permissive", (13,)),
    ("public domain", "permissive", (17,)),
    ("proprietary", "restricted", (16,)),
]

#: Ends a sentence; may end one or lie within it.
HARD, SOFT = "\x01", "\x02"
END = r"[.!?;][\x20\x09-\x0D]+|\n[^a-z0-9]*\n"
PAUSE = r"\n|:[\x20\x09-\x0D]+|\(?\b[a-z0-9]{1,3}\)[\x20\x09]+"
#: A known sentence of over so many words may also follow other words, as in a licence run together on one line.
UNMISTAKABLE = 15
NOT_WORD = r"[^a-z0-9]+"


def normalise(sentence: str) -> str:
    return re.sub(NOT_WORD, " ", re.sub("[A-Z]+", lambda m: m[0].lower(), sentence)).strip()


def marked(text: Column) -> Column:
    """The words of a text, with a mark of its kind wherever a sentence ends or may end."""
    text = F.translate(ascii_lower(text), HARD + SOFT, "  ")
    text = F.concat(F.lit(HARD), F.regexp_replace(text, END, HARD), F.lit(HARD))
    text = F.regexp_replace(F.regexp_replace(text, PAUSE, SOFT + "$0" + SOFT), rf"[^a-z0-9{HARD}{SOFT}]+", " ")
    return F.regexp_replace(F.regexp_replace(text, f"[ {SOFT}]*{HARD}[ {HARD}{SOFT}]*", HARD), f" ?{SOFT}[ {SOFT}]*", SOFT)


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[int, str] = SENTENCES,
                  rules: list[tuple[str, str, tuple[int, ...]]] = RULES) -> DataFrame:
    """One row per row of ``docs``: id, sentence_ids (array, in the text's order), licences (array, in the rules' order)
    and kinds (array, sorted)."""
    names = {normalise(s): i for i, s in sentences.items() if normalise(s)}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    starts = {s: "" if s.count(" ") >= UNMISTAKABLE else f"(?<=[{HARD}{SOFT}])" for s in names}
    choices = "|".join(starts[s] + s.replace(" ", f"[ {SOFT}]") for s in sorted(names, key=lambda s: (-len(s), s)))
    parts = F.regexp_extract_all(marked(whole_text(text_col)), F.lit(f"[ {HARD}{SOFT}]({choices})(?=[{HARD}{SOFT}])"), 1)
    ids = F.transform(parts, lambda s: F.element_at(known, F.translate(s, SOFT, " ")))
    out = docs.select(F.col(id_col).alias("id"), ids.alias("sentence_ids"))
    # a rule takes its identifiers out of the line ",1,2,"; what later rules see has a bar in their place
    line = F.concat(F.lit(","), F.array_join(F.col("sentence_ids").cast("array<string>"), ",,"), F.lit(","))
    found = []
    out = out.withColumn("line", line)
    for n, (_, _, sequence) in enumerate(rules):
        mark = "".join(f",{i}," for i in sequence)
        out = out.withColumn(f"rule{n}", F.contains("line", F.lit(mark))).withColumn("line", F.replace("line", F.lit(mark), F.lit("|")))
        found.append(f"rule{n}")
    names = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(x), F.lit(r[0])) for x, r in zip(found, rules)])))
    kinds = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.col(x), F.lit(r[1])) for x, r in zip(found, rules)]))))
    return out.select(F.col("id").alias(id_col), "sentence_ids", names.alias("licences"), kinds.alias("kinds"))
