"""License scan: rare licence words, their places in templates, and mandatory key phrases.

The base phrases are templates too: they are found through the same postings and verified whole.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.common import map_batches, map_rows, table

#: Base phrases and their labels, fixed values.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Notices by which a licence is stated, with the phrases one of which a text must hold.
#: Wordings of the licences themselves, fixed values.
TEMPLATES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ("permission is hereby granted",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("apache", "you may not use this file except in compliance with the license", ("in compliance with the license",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license",
     ("general public license",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    ("bsd", "licensed under the bsd license", ("bsd license", "bsd 2 clause", "bsd 3 clause")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("redistribution and use in source",)),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4", "cc by 3")),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc0", "dedicated to the public domain under cc0 1 0", ("cc0",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     ("permission to use copy modify",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
    ("reserved", "all rights reserved", ("all rights reserved",)),
]

#: Licence texts that are often quoted whole: labels, texts, and phrases one of which must stand in them. Fixed values.
BODIES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""", ("permission is hereby granted", "to deal in the software")),
    ("isc", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""", ("permission to use copy modify", "the author disclaims all warranties")),
    ("bsd", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""", ("redistribution and use in source", "redistributions in binary form")),
    ("gpl", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""", ("general public license",)),
    ("apache", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. Unless required by applicable law or agreed to in writing, software distributed under the
        License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
        implied.""", ("apache license",)),
]
TEMPLATES += BODIES

#: Least share of a template's IDF that must stand at the right places.
LEAST_SCORE = 0.6

#: Bytes of words, A-Z in lower case; all other ASCII becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def license_words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and characters outside ASCII, with A-Z in lower case."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def starts_of(words: list[bytes], wanted: frozenset[bytes]) -> dict[bytes, list[int]]:
    """Places of the wanted words; most texts have none."""
    starts: dict[bytes, list[int]] = defaultdict(list)
    if not wanted.isdisjoint(words):
        for i, word in enumerate(words):
            if word in wanted:
                starts[word].append(i)
    return starts


class Index(NamedTuple):
    """Postings (entry, place) of each entry's rarest words, IDF of all, and the entries: the templates, then the base phrases.

    ``need`` tells how many posted words of an entry must agree on where it starts.
    """

    postings: dict[bytes, list[tuple[int, int]]]
    idf: dict[bytes, float]
    words: list[list[bytes]]
    labels: list[str]
    keys: list[list[list[bytes]]]
    need: list[int]


def vocabulary() -> list[bytes]:
    texts = [*(text for _, text, _ in TEMPLATES), *PHRASES]
    return sorted({w for text in texts for w in license_words(text)})


def frequencies(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """Number of rows, and of rows that hold each template word.

    Each task sums its rows, so it shuffles no more rows than there are
    template words; as many reach the driver.
    """
    known = frozenset(vocabulary())

    def rows(batches: Iterator[list[list]]) -> Iterator[list]:
        total, held = 0, defaultdict(int)
        for (texts,) in batches:
            total += len(texts)
            for text in texts:
                for word in known.intersection(license_words(text)):
                    held[word] += 1
        yield [["", *(w.decode() for w in held)], [total, *held.values()]]

    counted = map_batches(docs, ["text"], rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"].encode(): r["n"] for r in counted.collect()}
    return found.pop(b"", 0), found


def rare_places(words: list[bytes], idf: dict[bytes, float], missing: float) -> tuple[list[int], int]:
    """Places of the rarest words to post, and how many of them every match holds.

    A match may lack the share ``missing`` of the IDF. Words are taken, the highest IDF first, until all but
    the first hold more than that: a match then has two of them. Where even all words do not, it has one.
    """
    whole, rest, taken = sum(idf[w] for w in words), 0.0, []
    for place in sorted(range(len(words)), key=lambda p: (-idf[words[p]], p)):
        rest += idf[words[place]] if taken else 0.0
        taken.append(place)
        if rest > missing * whole:
            return taken, 2
    return taken, 1


def build_index(total: int, held: dict[bytes, int]) -> Index:
    """Each template and each base phrase is posted by its rarest words only (see ``rare_places``).
    A phrase must stand whole, so two words of it are enough."""
    words = [license_words(text) for text in [*(text for _, text, _ in TEMPLATES), *PHRASES]]
    idf = {w: math.log((total + 1) / (held.get(w, 0) + 1)) + 0.01 for w in vocabulary()}
    postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    need = []
    for number, entry in enumerate(words):
        posted, least = rare_places(entry, idf, 1 - LEAST_SCORE if number < len(TEMPLATES) else 0.0)
        need.append(least)
        for place in posted:
            postings[entry[place]].append((number, place))
    keys = [[license_words(k) for k in phrases] for _, _, phrases in TEMPLATES]
    labels = [*(label for label, _, _ in TEMPLATES), *PHRASES.values()]
    return Index(dict(postings), idf, words, labels, keys, need)


def candidates(starts: dict[bytes, list[int]], index: Index) -> list[tuple[int, int]]:
    """(entry, offset): where as many posted words of the entry as it needs stand at its relative places."""
    named = Counter(
        (number, i - place) for word, at in starts.items() for number, place in index.postings.get(word, ()) for i in at
    )
    return sorted(key for key, n in named.items() if n >= index.need[key[0]])


def phrases_at(words: list[bytes], at: list[tuple[int, int]], index: Index) -> list[dict]:
    """Labels and places of the base phrases among the candidates, each verified word by word."""
    places: dict[int, list[int]] = defaultdict(list)
    for number, offset in at:
        phrase = index.words[number]
        if number >= len(TEMPLATES) and offset >= 0 and words[offset : offset + len(phrase)] == phrase:
            places[number].append(offset)
    return [{"label": index.labels[n], "places": places[n]} for n in sorted(places)]


def match(words: list[bytes], starts: dict[bytes, list[int]], index: Index) -> list[dict]:
    return templates_at(words, candidates(starts, index), index)


def templates_at(words: list[bytes], at: list[tuple[int, int]], index: Index) -> list[dict]:
    """Templates found in the text, each at its best place: label, first word, score.

    The score is the share of the template's IDF that stands in place at a candidate's
    offset; it must reach ``LEAST_SCORE``, and a key phrase of the template must stand
    in that stretch. Of equal scores the first place counts.
    """
    found: dict[int, dict] = {}
    for number, offset in at:
        if number >= len(TEMPLATES):
            continue
        template = index.words[number]
        stretch = words[max(0, offset) : offset + len(template)]
        first = max(0, -offset)
        held = sum(index.idf[w] for w, seen in zip(template[first:], stretch) if w == seen)
        score = min(1.0, held / sum(index.idf[w] for w in template))
        if score < LEAST_SCORE or number in found and found[number]["score"] >= score:
            continue
        joined = b" " + b" ".join(stretch) + b" "
        if any(b" " + b" ".join(k) + b" " in joined for k in index.keys[number]):
            found[number] = {"label": index.labels[number], "first_word": max(0, offset), "score": score}
    return [found[n] for n in sorted(found)]


def scan(docs: DataFrame, keep: list[str], index: Index) -> DataFrame:
    """Columns ``keep`` of ``docs``; ``n_words``; ``phrases`` (label and places); ``licenses`` (matched templates).

    Each row is scanned whole and by itself. A null or empty text has no words and no licence.
    """
    wanted = frozenset(index.postings)

    def rows(texts):
        for text in texts:
            words = license_words(text)
            at = candidates(starts_of(words, wanted), index)
            yield len(words), phrases_at(words, at, index), templates_at(words, at, index)

    ddl = (
        "n_words long, phrases array<struct<label:string,places:array<long>>>, "
        "licenses array<struct<label:string,first_word:long,score:double>>"
    )
    return map_rows(docs, keep, ["text"], rows, ddl)


def summary(found: DataFrame, keep: list[str]) -> DataFrame:
    starts = F.flatten("phrases.places")
    base = F.array_sort(F.array_distinct("phrases.label"))
    both = F.array_sort(F.array_distinct(F.concat("phrases.label", "licenses.label")))
    best = F.array_max(F.concat(F.col("licenses.score"), F.when(F.size("phrases") > 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(0.0)))))
    return found.select(
        *keep,
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        best.alias("score"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return summary(scan(docs, ["doc_id"], build_index(*frequencies(docs))), ["doc_id"])
