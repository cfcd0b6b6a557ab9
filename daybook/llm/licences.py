"""Licences of files: sparse TF-IDF cosine to templates, then inheritance from the nearest directory that has a licence file.

Every line of a file is compared with the templates, and a licence file (LICENSE, COPYING, ...) as a whole too. Weights are tf * idf with
idf over the templates, words that no template has get the highest idf. A file takes its best match of at least ``THRESHOLD``; a file
without one takes the licence of the nearest directory above it, its own first, that holds a matched licence file.

Only DataFrame and SQL functions run. A line can reach the threshold only if it shares a word with the ``gate``: for each template
the words of most weight, so many that the others together stay below the threshold. Of the lines left, those whose shared words
cannot reach it either go next; all that remains is scored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import settle

#: Notices and openings of public licences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Proprietary", "All rights reserved."),
]
THRESHOLD = 0.6
#: Words that tell nothing; they count neither in templates nor in files.
STOP_WORDS = tuple("a all an and any are as be by for from in is it may no not of on or other that the this to under use with without you".split())
WORD = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
LICENCE_FILE = "^(licen[cs]e|copying|unlicense)([.-].*)?$"  # of a lower-case file name


def _counts() -> list[Counter]:
    return [Counter(w for w in re.findall(WORD, text.lower()) if w not in STOP_WORDS) for _, text in TEMPLATES]


def idf() -> dict[str, float]:
    held = Counter(word for words in _counts() for word in words)
    return {word: math.log((1 + len(TEMPLATES)) / (1 + n)) + 1 for word, n in held.items()}


UNKNOWN = math.log(1 + len(TEMPLATES)) + 1  # idf of words without a template


def template_weights() -> list[tuple[int, str, str, float]]:
    """number, licence, word and weight of every template word; the weights of a template have norm 1."""
    known = idf()
    rows = []
    for number, ((licence, _), words) in enumerate(zip(TEMPLATES, _counts(), strict=True)):
        norm = math.sqrt(sum((n * known[w]) ** 2 for w, n in words.items()))
        rows += [(number, licence, w, n * known[w] / norm) for w, n in sorted(words.items())]
    return rows


def gate(threshold: float = THRESHOLD) -> str:
    """Pattern for lower-case lines that share a word of weight with some template."""
    words = set()
    for number in range(len(TEMPLATES)):
        weights = sorted(((-x, w) for n, _, w, x in template_weights() if n == number))
        rest = 1.0
        for x, word in weights:
            if math.sqrt(max(0.0, rest)) < threshold - 1e-9:
                break
            words.add(word)
            rest -= x * x
    return "(?<![a-z0-9])(?:" + "|".join(sorted(map(re.escape, words))) + ")(?![a-z0-9])"


def reachable(words: str, threshold: float = THRESHOLD) -> str:
    """SQL condition: can a unit with these words reach the threshold?

    Its squared cosine is at most the shared words' squared weights times the template words' part of the unit's squared norm. That
    part is at most S / (S + R): S as if every template word, repeated ones too, were one word of the highest idf, R for the distinct others.
    """
    bounds = []
    for number in range(len(TEMPLATES)):
        own = {w: x * x for n, _, w, x in template_weights() if n == number}
        weight = "map(" + ", ".join(f"'{w}', {x!r}D" for w, x in own.items()) + ")"
        names = "array(" + ", ".join(f"'{w}'" for w in own) + ")"
        bounds.append(f"aggregate(array_intersect({words}, {names}), 0D, (total, w) -> total + {weight}[w])")
    known = "array(" + ", ".join(f"'{w}'" for w in sorted(idf())) + ")"
    silent = "array(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"
    most = f"pow(size(filter({words}, w -> array_contains({known}, w))) * {max(idf().values())!r}D, 2)"
    others = f"size(array_except({words}, concat({known}, {silent}))) * {UNKNOWN ** 2!r}D"
    return f"greatest({', '.join(bounds)}) * {most} >= {threshold * threshold - 1e-9!r}D * ({most} + {others})"


def matches(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """path, licence, score of the best unit of each file that reaches ``threshold``; of equal ones the first template's."""
    pattern = gate(threshold).replace("\\", "\\\\").replace("'", "\\'")
    files = files.select("path", "named", F.lower("text").alias("t")).filter(F.expr(f"t rlike '{pattern}'"))
    units = files.select("path", F.explode(F.expr(
        f"concat(array_distinct(filter(split(t, '\\n'), l -> l rlike '{pattern}')), if(named, array(t), array()))")).alias("t"))
    # a unit is known by its path and a hash: equal lines of a repeated path count together, which leaves their cosine as it is
    units = units.select("path", F.xxhash64("t").alias("unit"), F.expr(f"regexp_extract_all(t, '{WORD}', 0)").alias("words"))
    words = units.filter(F.expr(reachable("words", threshold))).select("path", "unit", F.explode("words").alias("word"))
    # norms and products both read the counts: written once, so that the texts are read once
    counted = settle(words.filter(~F.col("word").isin(*STOP_WORDS)).groupBy("path", "unit", "word").agg(F.count("*").alias("n")))
    spark = files.sparkSession
    inverse = spark.createDataFrame(sorted(idf().items()), "word string, idf double")
    weighted = counted.join(F.broadcast(inverse), "word", "left").withColumn("x", F.col("n") * F.coalesce("idf", F.lit(UNKNOWN)))
    norms = weighted.groupBy("path", "unit").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    templates = spark.createDataFrame(template_weights(), "number int, licence string, word string, weight double")
    dots = weighted.join(F.broadcast(templates), "word").groupBy("path", "unit", "number", "licence").agg(
        F.sum(F.col("x") * F.col("weight")).alias("dot"))
    scores = dots.join(norms, ["path", "unit"]).select("path", "number", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    best = F.max_by(F.struct("licence", "score"), F.struct("score", -F.col("number")))
    return scores.filter(F.col("score") >= threshold).groupBy("path").agg(best.alias("b")).select("path", "b.licence", "b.score")


def scanned(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """path, licence, score, origin (header, licence file, inherited or null) and source (the path it comes from) for the columns path, text.

    Paths use / and have no leading one; the empty directory is the root. A null text matches nothing and inherits, a null path
    matches nothing and has no directory. Rows that repeat a path are one file, of which the best match counts, and give one row each. Among
    the matched licence files of a directory the best counts, of equal ones the first path. Other columns are not read; an empty
    table gives an empty result.
    """
    rows = files.select("path", "text").withColumn("named", F.coalesce(
        F.lower(F.element_at(F.split("path", "/"), -1)).rlike(LICENCE_FILE), F.lit(False))).withColumn(
        "dir", F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), "")))
    own = settle(matches(rows.filter("path is not null"), threshold))  # a row per matched file; texts are read once
    # one row per directory with a matched licence file: few against the files
    holders = (own.filter(F.lower(F.element_at(F.split("path", "/"), -1)).rlike(LICENCE_FILE))
               .withColumn("above", F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise(""))
               .groupBy("above").agg(F.min(F.struct((-F.col("score")).alias("less"), "path", "licence")).alias("b"))
               .select("above", F.struct("b.path", "b.licence", (-F.col("b.less")).alias("score")).alias("from")))
    steps = "transform(sequence(0, size(split(dir, '/'))), i -> concat_ws('/', slice(split(dir, '/'), 1, i)))"
    dirs = rows.filter("dir is not null").select("dir").distinct()
    above = dirs.select("dir", F.posexplode(F.expr(f"array_distinct({steps})")).alias("depth", "above"))
    nearest = above.join(holders, "above").groupBy("dir").agg(F.max_by("from", "depth").alias("from"))
    found = rows.select("path", "dir", "named").join(own, "path", "left").join(nearest, "dir", "left")
    mine = F.col("licence").isNotNull()
    return found.select(
        "path", F.coalesce("licence", "from.licence").alias("licence"), F.coalesce("score", "from.score").alias("score"),
        F.when(mine & F.col("named"), "licence file").when(mine, "header").when(F.col("from").isNotNull(), "inherited").alias("origin"),
        F.when(mine, F.col("path")).otherwise(F.col("from.path")).alias("source"))


#: A file tree over the documents: source, language and thousands of the id are directories; every twentieth document stands as a licence
#: file in one of them, at a depth that its id decides, the others as text files.
_TREE = """concat_ws('/', coalesce(source, 'none'), {middle}
  case when doc_id % 20 = 0 then concat('LICENSE.', doc_id) else concat(doc_id, '.txt') end)"""
_DIRS = """case when doc_id % 400 = 0 then null else coalesce(lang, 'none') end,
  case when doc_id % 20 = 0 and (doc_id % 400 = 0 or doc_id % 100 = 0) then null else cast({thousands}) end,"""
PATH_SQL = _TREE.format(middle=_DIRS.format(thousands="doc_id div 1000 as string"))


def document_licences(docs: DataFrame) -> DataFrame:
    """doc_id, path, licence, score, origin of the documents as files of a tree. Ids are taken to be distinct; a null id is no file."""
    files = docs.filter("doc_id is not null").select(F.expr(PATH_SQL).alias("path"), "text")
    return scanned(files).select(F.regexp_extract("path", r"(\d+)[^/]*$", 1).cast("long").alias("doc_id"), "path", "licence", "score", "origin")


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE_SQL = f"""
with templates(number, licence, body) as (values {", ".join(f"({i}, {_literal(a)}, {_literal(b)})" for i, (a, b) in enumerate(TEMPLATES))}),
tw as (select number, word, count(*) as n from (select number, unnest(regexp_extract_all(lower(body), '{WORD}')) as word from templates)
       where word not in {STOP_WORDS} group by all),
idf as (select word, ln({1 + len(TEMPLATES)}.0 / (1 + count(*))) + 1 as idf from tw group by word),
weights as (select number, word, n * idf / sqrt(sum(n * idf * n * idf) over (partition by number)) as w from tw join idf using (word)),
files as (select doc_id, {_TREE.format(middle=_DIRS.format(thousands="doc_id // 1000 as varchar"))} as path, lower(coalesce(text, '')) as t from documents where doc_id is not null),
parts as (select *, doc_id % 20 = 0 as named, regexp_replace(path, '/[^/]*$', '') as dir from files),
units as (select distinct path, unit from (select path, unnest(string_split(t, chr(10))) as unit from parts union all select path, t from parts where named)),
terms as (select path, unit, word, count(*) as n from (select path, unit, unnest(regexp_extract_all(unit, '{WORD}')) as word from units)
          where word not in {STOP_WORDS} group by all),
x as (select path, unit, word, n * coalesce(idf, ln({1 + len(TEMPLATES)}.0) + 1) as x from terms left join idf using (word)),
norms as (select path, unit, sqrt(sum(x * x)) as norm from x group by all),
scores as (select path, number, round(sum(x * w) / any_value(norm), 6) as score from x join weights using (word) join norms using (path, unit)
           group by path, unit, number),
own as (select path, licence, score from (select path, licence, score, row_number() over (partition by path order by score desc, number) as r
        from scores join templates using (number) where score >= {THRESHOLD}) where r = 1),
holders as (select * from (select dir, path, licence, score, row_number() over (partition by dir order by score desc, path) as r
            from own join parts using (path) where named) where r = 1),
nearest as (select * from (select p.path, h.licence, h.score, row_number() over (partition by p.path order by length(h.dir) desc) as r
            from parts p join holders h on p.dir = h.dir or starts_with(p.dir, h.dir || '/')) where r = 1)
select p.doc_id, p.path, coalesce(o.licence, n.licence) as licence, coalesce(o.score, n.score) as score,
       case when o.licence is not null and named then 'licence file' when o.licence is not null then 'header'
            when n.licence is not null then 'inherited' end as origin
from parts p left join own o using (path) left join nearest n using (path)
"""
