"""Find licence texts in documents by a positional index of their rare words.

1. **Rarity.** One pass counts in how many documents each word of the licence
   templates occurs. A template's rarest words (highest IDF) become its postings:
   words with their positions in the template. The rarest word that its key phrases
   hold is its anchor.
2. **Look-up.** In each document the places of anchors are looked up; every one
   proposes a start of its template there (document position less template position).
3. **Intersection.** The template's other postings must stand at the same relative
   position: at least ``share`` of them.
4. **Verification.** All words of the template's key phrases must stand consecutively at
   their places. A template without key phrases is one itself: all its words must stand.

Since key phrases must stand whole, no place lacks its anchor: none is missed.
Only SQL expressions over a document's own words; nothing is shuffled but counts.
Null and empty texts have no words and no licence; repeated rows are judged each
for itself. Words are runs of ASCII letters, digits and anything beyond ASCII,
A-Z lower-cased.
"""

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from barforge.llm.words import plain_words


@dataclass(frozen=True)
class Template:
    """A licence text; ``keys`` are phrases of it that must stand whole."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def key_positions(self) -> list[int]:
        """Positions that verification looks at; all of them without key phrases."""
        if not self.keys:
            return list(range(len(self.words)))
        out = set()
        for key in self.keys:
            part = key.split()
            at = next(i for i in range(len(self.words)) if self.words[i:i + len(part)] == part)
            out.update(range(at, at + len(part)))
        return sorted(out)


# Phrases that name a licence.
PHRASES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)

# Wording of public licences, in words as they are indexed, with their key phrases.
TEMPLATES = PHRASES + (
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("epl-2", "eclipse public license v 2"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
             "is hereby granted", ("permission to use copy modify",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
             "compliance with the license", ("apache license version 2",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
             "general public license", ("gnu general public license",)),
)

_SCHEMA = ("array<struct<label:string,base:boolean,anchor:string,at:int,need:int,"
           "rare:array<struct<at:int,word:string>>,keys:array<struct<at:int,word:string>>>>")


def document_counts(docs: DataFrame, words: Sequence[str], text: str = "text") -> dict[str, int]:
    """In how many rows each of ``words`` occurs; the answer has a row per word at most."""
    held = F.array_distinct(F.filter(plain_words(F.col(text)), lambda w: w.isin(list(words))))
    # Outer: else the optimizer would compute the array a second time, to filter by its size.
    counted = docs.select(F.explode_outer(held).alias("word")).where("word is not null").groupBy("word").count()
    return {r["word"]: r["count"] for r in counted.collect()}


def postings(template: Template, counts: dict[str, int], rare_words: int, share: float) -> dict:
    """The template with its rarest words and the places that must be verified."""
    words = template.words
    order = sorted(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))
    rare = order[:rare_words]
    need = -(-len(rare) * share // 1)
    keys = template.key_positions()
    anchor = next(i for i in order if i in set(keys))
    return {
        "label": template.label, "base": template.base, "anchor": words[anchor], "at": anchor, "need": int(need),
        "rare": [{"at": i, "word": words[i]} for i in rare],
        "keys": [{"at": i, "word": words[i]} for i in keys],
    }


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, *, text: str = "text",
                  rare_words: int = 8, share: float = 0.7, words_out: str = "n_words",
                  out: str = "licenses") -> DataFrame:
    """``docs`` with its number of words and array<struct<label, base, start, score>> of places.

    ``start`` counts words from 0; ``score`` is the share of the template's rare words
    that stand at their places. The two columns replace columns of their names.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    counts = document_counts(docs, vocabulary, text) if vocabulary else {}
    index = [postings(t, counts, rare_words, share) for t in templates if t.words]
    anchors = sorted({t["anchor"] for t in index})
    told = F.from_json(F.lit(json.dumps(index)), _SCHEMA)
    kept = [c for c in docs.columns if c not in (words_out, out)]
    worded = docs.select(*kept, plain_words(F.col(text)).alias("__w"))
    w = F.col("__w")

    def stands(start: Column, posting: Column) -> Column:
        return F.get(w, start + posting["at"]).eqNullSafe(posting["word"])

    def place(i: Column, t: Column) -> Column:
        found = F.size(F.filter(t["rare"], lambda p: stands(i - t["at"], p)))
        return F.struct(t["label"].alias("label"), t["base"].alias("base"), (i - t["at"]).alias("start"),
                        (found / F.size(t["rare"])).alias("score"), (found >= t["need"]).alias("enough"))

    def fits(i: Column, t: Column) -> Column:
        return (t["anchor"] == F.get(w, i)) & (i >= t["at"]) & F.forall(
            t["keys"], lambda p: stands(i - t["at"], p))

    every = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1)).otherwise(F.array().cast("array<int>"))
    places = F.filter(every, lambda i: F.get(w, i).isin(anchors)) if anchors else F.array().cast("array<int>")
    proposed = F.flatten(F.transform(places, lambda i: F.transform(
        F.filter(told, lambda t: fits(i, t)), lambda t: place(i, t))))
    enough = F.filter(proposed, lambda p: p["enough"])
    return worded.select(*kept, F.size(w).cast("bigint").alias(words_out), F.transform(
        enough, lambda p: F.struct(p["label"], p["base"], p["start"], p["score"])).alias(out))
