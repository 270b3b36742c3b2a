"""License scan with a positional rare-token index, in SQL functions only.

A license is a word sequence (template) with mandatory key phrases in it. Its postings are the
two key words rarest in the corpus, each with its place in the template. The scan looks up the
places of these words in a file, turns each into the place where the template would start, and
intersects the starts of the two words: what both agree on is a candidate. A candidate's key
phrases are then verified word by word and its overlap with the whole template is counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.base import lower_ascii, text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words of a license text and the parts of it (start, length) that must be there exactly."""
    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, int], ...]
    base: bool = False

    @staticmethod
    def of(label: str, text: str, *phrases: str, base: bool = False) -> Template:
        words, keys = tuple(text.split()), []
        for phrase in phrases or (text,):
            part = tuple(phrase.split())
            keys.append((next(i for i in range(len(words)) if words[i:i + len(part)] == part), len(part)))
        return Template(label, words, tuple(sorted(keys)), base)

    def key_words(self) -> list[tuple[int, str]]:
        """The mandatory words with their places in the template."""
        return sorted({(i, self.words[i]) for start, size in self.keys for i in range(start, start + size)})

    def rarest(self, idf: dict[str, float], count: int = 2) -> list[tuple[int, str]]:
        """Up to ``count`` different key words of highest IDF, each with its first place."""
        first = {w: i for i, w in reversed(self.key_words())}
        return [(first[w], w) for w in sorted(first, key=lambda w: (-idf[w], w))[:count]]


#: The phrases of the contract.
BASE = (
    Template.of("mit", "mit license", base=True),
    Template.of("apache", "apache license", base=True),
    Template.of("gpl", "general public license", base=True),
)
#: Opening words of widely used licenses; the mandatory phrases tell them apart.
NOTICES = (
    Template.of("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
                "free of charge to any person obtaining a copy"),
    Template.of("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template.of("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template.of("agpl", "gnu affero general public license", "affero general public license"),
    Template.of("mpl", "mozilla public license version 2 0", "mozilla public license"),
    Template.of("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
                "redistribution and use in source and binary forms"),
    Template.of("isc", "permission to use copy modify and or distribute this software for any purpose",
                "use copy modify and or distribute this software"),
    Template.of("unlicense", "this is free and unencumbered software released into the public domain",
                "free and unencumbered software"),
    Template.of("cc", "licensed under a creative commons attribution license", "creative commons attribution"),
)
#: Whole texts of short licenses and whole notices of long ones, without names and years.
TEXTS = (
    Template.of("mit-text", """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation
        the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to
        permit persons to whom the software is furnished to do so subject to the following conditions the above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        software the software is provided as is without warranty of any kind express or implied including but not
        limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no
        event shall the authors or copyright holders be liable for any claim damages or other liability whether in
        an action of contract tort or otherwise arising from out of or in connection with the software or the use
        or other dealings in the software""",
                "free of charge to any person obtaining a copy",
                "this permission notice shall be included in all copies or substantial portions"),
    Template.of("isc-text", """
        permission to use copy modify and or distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies the
        software is provided as is and the author disclaims all warranties with regard to this software including
        all implied warranties of merchantability and fitness in no event shall the author be liable for any
        special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data
        or profits whether in an action of contract negligence or other tortious action arising out of or in
        connection with the use or performance of this software""",
                "use copy modify and or distribute this software", "this permission notice appear in all copies"),
    Template.of("bsd-text", """
        redistribution and use in source and binary forms with or without modification are permitted provided that
        the following conditions are met 1 redistributions of source code must retain the above copyright notice
        this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the
        above copyright notice this list of conditions and the following disclaimer in the documentation and or
        other materials provided with the distribution""",
                "redistribution and use in source and binary forms", "redistributions of source code must retain"),
    Template.of("apache-notice", """
        licensed under the apache license version 2 0 the license you may not use this file except in compliance
        with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless
        required by applicable law or agreed to in writing software distributed under the license is distributed
        on an as is basis without warranties or conditions of any kind either express or implied see the license
        for the specific language governing permissions and limitations under the license""",
                "apache license version 2 0", "you may not use this file except in compliance with the license"),
    Template.of("gpl-notice", """
        this program is free software you can redistribute it and or modify it under the terms of the gnu general
        public license as published by the free software foundation either version 2 of the license or at your
        option any later version this program is distributed in the hope that it will be useful but without any
        warranty without even the implied warranty of merchantability or fitness for a particular purpose see the
        gnu general public license for more details""",
                "you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template.of("unlicense-text", """
        this is free and unencumbered software released into the public domain anyone is free to copy modify
        publish use compile sell or distribute this software either in source code form or as a compiled binary
        for any purpose commercial or non commercial and by any means""",
                "free and unencumbered software", "anyone is free to copy modify publish use compile sell or distribute"),
)


def words_of(text: Column) -> Column:
    """Lower-cased words of a text, in order."""
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def word_idf(documents: DataFrame, vocabulary: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency of the given words over all documents, up to a constant.

    The vocabulary is the templates' key words, so the rows that return do not grow with the
    corpus; counts are combined in every task before they shuffle.
    """
    found = F.array_intersect(words_of(text_or_empty()), F.array(*[F.lit(w) for w in vocabulary]))
    seen = documents.select(F.explode(found).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in seen.collect()}
    return {w: -math.log(counts.get(w, 0) + 1) for w in vocabulary}


def scan_licenses(documents: DataFrame, templates: Sequence[Template] = BASE + NOTICES + TEXTS, coverage: float = 0.5) -> DataFrame:
    """License places of every document.

    Takes doc_id and text; other columns are ignored. Returns doc_id, n_words and places: an
    array of (start, label, base, coverage) sorted by start and label, with one entry per
    place where all mandatory phrases of a template stand at their relative positions and at
    least ``coverage`` of its words do. Starts count words from 0; a template cut off at the
    beginning of a file has its first word that can be there as start.

    A file in which a template can stand has all its key words, so the file's rarest words of
    that template are the template's rarest key words. They depend on the corpus and only
    change the cost, never the places. Null and empty texts have no words and no places.
    Repeated rows give repeated results. No row moves but the word counts of the first pass.
    """
    idf = word_idf(documents, sorted({w for t in templates for _, w in t.key_words()}))
    looked_up = [t.rarest(idf) for t in templates]
    split = documents.select("doc_id", words_of(text_or_empty()).alias("_words"))
    at = F.transform("_words", lambda w, i: F.when(
        w.isin(*sorted({w for pair in looked_up for _, w in pair})), F.struct(w.alias("w"), i.alias("i"))))
    hits = split.select("doc_id", "_words", F.size("_words").cast("long").alias("n_words"),
                        F.filter(at, lambda x: x.isNotNull()).alias("_at"))

    def starts(place: int, word: str) -> Column:
        """Where the template would start, by every place of one of its words."""
        return F.transform(F.filter("_at", lambda x: x["w"] == word), lambda x: x["i"] - place)

    def agreed(number: int, pair: list[tuple[int, str]]) -> Column:
        """Where both words say that the template starts."""
        common = F.array_intersect(*[starts(i, w) for i, w in pair]) if len(pair) > 1 else starts(*pair[0])
        return F.transform(common, lambda s: F.struct(F.lit(number).alias("t"), s.alias("from")))

    candidates = hits.select("doc_id", "_words", "n_words", F.when(
        F.size("_at") > 0, F.concat(*[agreed(n, pair) for n, pair in enumerate(looked_up)])).alias("_found"))

    index = F.array(*[F.struct(
        F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.array(*map(F.lit, t.words)).alias("words"),
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in t.key_words()]).alias("keys")) for t in templates])

    def there(x: Column, i: Column, w: Column) -> Column:
        return F.coalesce(F.get("_words", x["from"] + i) == w, F.lit(False))

    def intact(x: Column) -> Column:
        keys = F.get(index, x["t"])["keys"]
        return F.forall(keys, lambda k: there(x, k["i"], k["w"]))

    def overlap(x: Column) -> Column:
        words = F.get(index, x["t"])["words"]
        return F.size(F.filter(words, lambda w, i: there(x, i, w))) / F.size(words).cast("double")

    places = F.transform(F.filter("_found", intact), lambda x: F.struct(
        F.greatest(x["from"], F.lit(0)).cast("long").alias("start"), F.get(index, x["t"])["label"].alias("label"),
        F.get(index, x["t"])["base"].alias("base"), overlap(x).alias("coverage")))
    none = F.array().cast("array<struct<start:bigint,label:string,base:boolean,coverage:double>>")
    return candidates.select("doc_id", "n_words", F.when(
        F.size("_found") > 0, F.sort_array(F.filter(places, lambda p: (p["coverage"] >= coverage) & (p["coverage"] > 0)))).otherwise(none).alias("places"))


def license_summary(scanned: DataFrame) -> DataFrame:
    """One row of counts, ends and labels per document; the score is the best coverage."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])

    def joined(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["coverage"])), F.lit(0.0)).alias("score"))
