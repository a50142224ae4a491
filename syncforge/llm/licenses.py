"""Licence scan by a positional rare-token index, in DataFrame expressions only.

Each template is a licence statement as a row of words, with a mandatory key
phrase inside it. The document frequency of every key-phrase word is counted
over all documents; the ``RARE`` words of a template's phrase with the highest
inverse document frequency go to the index, which maps a word to its postings
(template, position). A file's words that the index knows are its licence
words of highest IDF: they are looked up with their places, each posting gives
an offset of its template (place minus position), and the offsets of a
template's rare words are intersected. Where all agree, the key phrase is
verified word by word; the score is the share of the template's words that
stand at their places.

Index, phrases and texts are literals of one expression, whose size does not
depend on the number of templates but for these tables. Every place of a key
phrase holds its rare words, so no place is missed, whatever the frequencies.
Only a bounded table (one row a key-phrase word) reaches the driver, and no
text is shuffled.

A-Z are lower-cased; other letters may be lower-cased too, which changes no
word boundary and no match of the key phrases. Words are runs of 0-9, a-z
and all characters from U+0080 on. Null and empty texts have 0 words, no
place, empty labels and score 0. Rows are judged one by one (ties, repeated
rows); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE = 2
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        """Place of the key phrase in the template."""
        k = self.key_words
        return next(i for i in range(len(self.words)) if self.words[i : i + len(k)] == k)


# Wording of licence statements.
STATEMENTS = (
    Template("mit", "released under the mit license", "under the mit license", base=True),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2", base=True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "this permission notice shall be included"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "nor the names of its contributors"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "in no event will the authors be held liable"),
    Template("mpl-1-1", "subject to the mozilla public license version 1 1", "mozilla public license version 1 1"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("epl-1", "made available under the terms of the eclipse public license v1 0", "eclipse public license v1 0"),
    Template("epl-2", "made available under the terms of the eclipse public license 2 0", "eclipse public license 2 0"),
    Template("cddl", "subject to the terms of the common development and distribution license", "common development and distribution license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template("boost-1", "distributed under the boost software license version 1 0", "boost software license version 1 0"),
    Template("artistic-2", "under the terms of the artistic license version 2 0", "artistic license version 2 0"),
    Template("ofl-1-1", "this font software is licensed under the sil open font license version 1 1", "sil open font license"),
    Template("postgresql", "released under the postgresql license a liberal open source license", "postgresql license"),
    Template("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to public license"),
    Template("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    Template("eupl", "licensed under the european union public licence", "european union public licence"),
    Template("ms-pl", "this license governs use of the accompanying software microsoft public license", "microsoft public license"),
    Template("odbl", "made available under the open database license", "open database license"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


def _gnu() -> Iterator[Template]:
    """Each licence of the family in each version, alone and with later ones."""
    for label, name in (("gpl", "gnu general public license"), ("lgpl", "gnu lesser general public license"), ("agpl", "gnu affero general public license")):
        yield Template(label, f"this work is licensed under the {name}", name)
        for v in (1, 2, 3):
            yield Template(f"{label}-{v}", f"this work is licensed under the {name} version {v}", f"{name} version {v}")
            published = f"{name} as published by the free software foundation"
            yield Template(f"{label}-{v}", f"{published} version {v} of the license", f"foundation version {v} of the license")
            yield Template(f"{label}-{v}-or-later", f"{published} either version {v} of the license or at your option any later version", f"{published} either version {v}")


def _creative_commons() -> Iterator[Template]:
    """Each licence in each version, by its code and by its name."""
    word = {"by": "attribution", "nc": "noncommercial", "nd": "noderivatives", "sa": "sharealike"}
    for code in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"):
        label = f"cc-{code.replace(' ', '-')}"
        name = " ".join(word[w] for w in code.split())
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            version = v.replace(" ", "-")
            yield Template(f"{label}-{version}", f"licensed under cc {code} {v}", f"cc {code} {v}")
            yield Template(f"{label}-{version}", f"licensed under the creative commons {name} {v}", f"creative commons {name} {v}")
            yield Template(f"{label}-{version}", f"under a creative commons {name} {v} international license", f"{name} {v} international license")


TEMPLATES = (*STATEMENTS, *_gnu(), *_creative_commons())


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(_WORD), F.lit(0))


def document_frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """In how many documents each word occurs: one row a word reaches the driver."""
    hits = F.array_intersect(words_of(F.col(text)), F.array(*map(F.lit, vocabulary)))
    rows = docs.select(F.explode(hits).alias("word")).groupBy("word").count().collect()
    return {w: 0 for w in vocabulary} | {r["word"]: r["count"] for r in rows}


def rare_words(template: Template, frequency: dict[str, int], n: int = RARE) -> list[tuple[str, int]]:
    """The key phrase's ``n`` rarest words and their places in the template."""
    at = {w: template.key_at + i for i, w in reversed(list(enumerate(template.key_words)))}
    return [(w, at[w]) for w in sorted(at, key=lambda w: (frequency.get(w, 0), w))[:n]]


def _index(entries: list[list[tuple[str, int]]], nth: int) -> dict[str, list[tuple[int, int]]]:
    """Postings of the templates' nth rare words (of their last one where there are fewer): word to (template, position)."""
    out: dict[str, list[tuple[int, int]]] = {}
    for t, e in enumerate(entries):
        word, at = e[min(nth, len(e) - 1)]
        out.setdefault(word, []).append((t, at))
    return out


def _offsets(words: Column, index: dict[str, list[tuple[int, int]]]) -> Column:
    """Template and offset (t, s) of every posting of the words that the index knows."""
    table = F.create_map(*chain.from_iterable((F.lit(w), F.array(*(F.struct(F.lit(t).alias("t"), F.lit(at).alias("at")) for t, at in p))) for w, p in sorted(index.items())))
    known = sorted(index)
    places = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(known), F.struct(w.alias("w"), i.alias("i")))))
    return F.flatten(F.transform(places, lambda p: F.transform(F.element_at(table, p["w"]), lambda e: F.struct(e["t"].alias("t"), (p["i"] - e["at"]).alias("s")))))


def _texts(rows: Iterable[list[str]]) -> Column:
    return F.array(*(F.array(*map(F.lit, r)) for r in rows))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES, rare: int = RARE) -> DataFrame:
    """Per document: key, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``."""
    vocabulary = sorted({w for t in templates for w in t.key_words})
    frequency = document_frequencies(docs, vocabulary, text)
    entries = [rare_words(t, frequency, rare) for t in templates]
    words = F.col("words")
    rows = docs.select(F.col(key).cast("long").alias(key), words_of(F.col(text)).alias("words"))
    nothing = F.array().cast("array<struct<t:int,s:int>>")
    # only documents that hold a rarest word of some template are looked at place by place
    agreed = _offsets(words, _index(entries, 0))
    for nth in range(1, rare):
        agreed = F.array_intersect(agreed, _offsets(words, _index(entries, nth)))
    rows = rows.withColumn("agreed", F.when(F.arrays_overlap("words", F.array(*map(F.lit, sorted(_index(entries, 0))))), agreed).otherwise(nothing))
    phrases, full = _texts(t.key_words for t in templates), _texts(t.words for t in templates)
    key_at, labels, base = (F.array(*(F.lit(getattr(t, name)) for t in templates)) for name in ("key_at", "label", "base"))

    def verified(c: Column) -> Column:
        start, phrase = c["s"] + F.get(key_at, c["t"]), F.get(phrases, c["t"])
        return (start >= 0) & (F.slice(words, F.greatest(start, F.lit(0)) + 1, F.size(phrase)) == phrase)

    def share(c: Column) -> Column:
        own = F.get(full, c["t"])
        right = F.filter(F.transform(own, lambda w, j: (c["s"] + j >= 0) & F.get(words, F.greatest(c["s"] + j, F.lit(0))).eqNullSafe(w)), lambda x: x)
        return F.size(right).cast("double") / F.size(own).cast("double")

    def joined(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda c: F.get(labels, c["t"])))), ",")

    rows = rows.withColumn("found", F.filter(F.array_distinct("agreed"), verified))
    rows = rows.withColumn("base", F.filter("found", lambda c: F.get(base, c["t"])))
    places = F.transform("base", lambda c: c["s"] + F.get(key_at, c["t"]))
    return rows.select(
        key,
        F.size("words").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", share)), F.lit(0.0)).alias("score"),
    )
