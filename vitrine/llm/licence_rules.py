"""Licence scan: sentences become identifiers of known licence sentences, and rules are sequences of them.

Only DataFrame functions, and no shuffle: a text is cut into sentences, each is normalised and looked up among the
known sentences, and the sequence of identifiers found is searched for each rule in turn. A rule fires where its
identifiers follow one another with no other known sentence between; what it takes is not open to later rules, so
a full licence text, listed first, is not reported again as its short notice.

A sentence ends with ``.``, ``!`` or ``?`` before a blank or the end, and at the end of a line; ``n_sentences`` counts
these. Normalised, it is in lower case with runs of anything but a-z and 0-9 as one space. Known sentences are also
found where lines are wrapped, with or without comment signs: they may go on over single line ends, but not over the
end of a sentence or a line without letters and digits, and they may begin after, and end before, ``;`` or ``:``, and
end before a web address. Where two known sentences begin at one place, the longer one counts.

Defined results: a NULL or empty text has no sentences, an empty sequence and no licence. Repeated rows are scanned
one by one, an empty table gives no rows. Whole texts are scanned, however long. Columns other than the key and
the text are not read, so names may clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licences and of their usual notices.
SENTENCES: dict[int, str] = {
    1: "Released under the MIT License.",
    2: "Licensed under the MIT License.",
    3: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    4: "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software.",
    5: "Licensed under the Apache License, Version 2.0.",
    6: 'Licensed under the Apache License, Version 2.0 (the "License");',
    7: "you may not use this file except in compliance with the License.",
    8: "You may obtain a copy of the License at",
    9: "This work is licensed under the GNU General Public License, version 3.",
    10: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    11: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    12: "Licensed under CC BY-NC 4.0.",
    13: "Licensed under CC BY 4.0.",
    14: "Licensed under CC BY-SA 4.0.",
    15: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    16: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:",
    17: "All rights reserved.",
}
# Rules in the order in which they are tried.
RULES: list[tuple[str, list[int]]] = [
    ("MIT", [3, 4]),
    ("Apache-2.0", [6, 7, 8]),
    ("GPL-3.0-or-later", [10, 11]),
    ("GPL-3.0-or-later", [10]),
    ("Apache-2.0", [6, 7]),
    ("Apache-2.0", [5]),
    ("MIT", [1]),
    ("MIT", [2]),
    ("GPL-3.0", [9]),
    ("CC-BY-NC-4.0", [12]),
    ("CC-BY-4.0", [13]),
    ("CC-BY-SA-4.0", [14]),
    ("CC-BY-4.0", [15]),
    ("BSD", [16]),
]

_END = "\x01"
_TAKEN = "|"


def normalised(sentence: str) -> str:
    """The form in which a known sentence is compared."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def sentences(text: Column) -> Column:
    """The text normalised, with the ends of sentences, line ends, ``;`` and ``:`` left in."""
    ended = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[.!?]+(?=\s|$)|\n[^a-z0-9]*\n", _END)
    return F.regexp_replace(ended, f"[^a-z0-9\n;:{_END}]+", " ")


def _pattern(forms: list[str]) -> str:
    """Known sentences, longest first, between ends of sentences or lines, ``;`` or ``:``."""
    known = "|".join(form.replace(" ", "[ \n;:]++") for form in sorted(forms, key=len, reverse=True))
    return f"(?:^|[\n;:{_END}]) ?({known})(?= ?(?:\\z|[\n;:{_END}]|https?:|www ))"


def _lines(known: dict[int, str]) -> dict[str, int]:
    """Normalised form to identifier; a known text that is cut in scanned texts must be listed in its parts."""
    return {normalised(text): number for number, text in known.items()}


def scan(
    documents: DataFrame,
    key: str,
    text: str,
    known: dict[int, str] = SENTENCES,
    rules: list[tuple[str, list[int]]] = RULES,
) -> DataFrame:
    """One row per document: key, n_sentences, sentence_ids (as ``<id>`` in order), licences and n_matches.

    ``licences`` names each licence once, in the order of the alphabet, comma-joined.
    """
    lookup = F.create_map(*[F.lit(x) for pair in _lines(known).items() for x in pair])
    pattern = F.lit(_pattern(list(_lines(known))))
    found = documents.select(F.col(key).alias("key"), sentences(F.col(text)).alias("all")).select(
        "key",
        F.regexp_count("all", F.lit(f"[a-z0-9][^\n{_END}]*")).cast("long").alias("n_sentences"),
        F.array_join(
            F.transform(
                # Only known sentences are turned into numbers.
                F.regexp_extract_all("all", pattern, F.lit(1)),
                lambda s: F.concat(
                    F.lit("<"), F.element_at(lookup, F.regexp_replace(s, "[ \n;:]+", " ")).cast("string"), F.lit(">")
                ),
            ),
            "",
        ).alias("sentence_ids"),
    )
    left, hits = F.col("sentence_ids"), []
    for name, sequence in rules:
        wanted = "".join(f"<{n}>" for n in sequence)
        rest = F.replace(left, F.lit(wanted), F.lit(_TAKEN))
        hits.append((name, F.length(left) - F.length(rest), len(wanted) - 1))
        left = rest
    names = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(n > 0, F.lit(name)) for name, n, _ in hits]))))
    return found.select(
        F.col("key").alias(key),
        "n_sentences",
        "sentence_ids",
        F.array_join(names, ",").alias("licences"),
        sum(((n / size).cast("long") for _, n, size in hits), F.lit(0).cast("long")).alias("n_matches"),
    )
