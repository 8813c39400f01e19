"""License detection by ordered signature rules.

Most rules are generated from a list of licenses (id, name as a pattern, versions) and of
phrasings around a name, a few hundred in all; rules for license texts, notices, addresses and
exceptions are written by hand. Each carries a keyword and a priority (0 is the strongest). Only
documents that a rule could match at all are examined, and there only the rules whose keyword
occurs. A match contained in the interval of a match of stronger
priority, or of equal priority and greater length, is suppressed; equal intervals of equal
priority keep the rule that comes first. The base phrases of the contract are counted apart and
always keep their labels.

Cases: null text is empty; a document without matches has empty labels, null places and score 0;
rows that repeat a document are scanned each by itself; matches do not overlap within a rule.
Places of matches are code points.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import LETTER_GAP, LETTER_WORD, places

# ---- fixed values: base phrases and their labels ----
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# ---- fixed values: license ids, names as patterns, versions ----
NAMES = [
    ("mit", r"MIT|Expat", []),
    ("apache", r"Apache(?: Software)?", ["1.0", "1.1", "2.0"]),
    ("gpl", r"GNU General Public|GPL|GNU GPL", ["1", "2", "3"]),
    ("lgpl", r"GNU (?:Lesser|Library) General Public|LGPL|GNU LGPL", ["2", "2.1", "3"]),
    ("agpl", r"GNU Affero General Public|AGPL|GNU AGPL", ["1", "3"]),
    ("gfdl", r"GNU Free Documentation|GFDL", ["1.1", "1.2", "1.3"]),
    ("mpl", r"Mozilla Public|MPL", ["1.0", "1.1", "2.0"]),
    ("epl", r"Eclipse Public|EPL", ["1.0", "2.0"]),
    ("eupl", r"European Union Public|EUPL", ["1.0", "1.1", "1.2"]),
    ("cddl", r"Common Development and Distribution|CDDL", ["1.0", "1.1"]),
    ("cpl", r"Common Public|CPL", ["1.0"]),
    ("osl", r"Open Software|OSL", ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", r"Academic Free|AFL", ["1.1", "2.0", "2.1", "3.0"]),
    ("bsd-2", r"BSD 2-Clause|Simplified BSD|FreeBSD", []),
    ("bsd-3", r"BSD 3-Clause|(?:New|Modified|Revised) BSD", []),
    ("bsd", r"BSD", []),
    ("isc", r"ISC", []),
    ("zlib", r"zlib|zlib/libpng", []),
    ("boost", r"Boost Software|BSL", ["1.0"]),
    ("artistic", r"Artistic", ["1.0", "2.0"]),
    ("python", r"Python Software Foundation|PSF", ["2"]),
    ("php", r"PHP", ["3.0", "3.01"]),
    ("ofl", r"SIL Open Font|OFL", ["1.0", "1.1"]),
    ("odbl", r"Open Data Commons Open Database|ODbL", ["1.0"]),
    ("unlicense", r"Unlicense", []),
    ("wtfpl", r"WTFPL", ["1", "2"]),
    ("ms-pl", r"Microsoft Public|MS-PL", []),
    ("ms-rl", r"Microsoft Reciprocal|MS-RL", []),
    ("cc0", r"CC0|Creative Commons Zero", ["1.0"]),
    ("cc-by", r"CC[ -]BY|Creative Commons Attribution", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-sa", r"CC[ -]BY[ -]SA|Creative Commons Attribution[ -]Share-?Alike", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc", r"CC[ -]BY[ -]NC|Creative Commons Attribution[ -]Non-?Commercial", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nd", r"CC[ -]BY[ -]ND|Creative Commons Attribution[ -]NoDerivatives", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc-sa", r"CC[ -]BY[ -]NC[ -]SA|Creative Commons Attribution[ -]Non-?Commercial[ -]Share-?Alike", ["2.0", "2.5", "3.0", "4.0"]),
]
# ---- fixed values: phrasings; N the name, V the version; priority, score ----
GRANTS = [
    (r"SPDX-License-Identifier: *N(?:[- ]V)?", 0, 1.0),
    (r"(?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?N(?: Licen[sc]e)?,?(?: version| v\.?)? ?V", 1, 1.0),
    (r"N Licen[sc]e,? (?:version|v\.?) ?V", 2, 0.9),
    (r"(?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?N(?: Licen[sc]e)?", 3, 0.8),
    (r"N Licen[sc]e", 4, 0.6),
]
# label, keyword, pattern, priority, score
OTHERS = [
    ("all-rights-reserved", "all rights reserved", r"All rights reserved", 4, 0.5),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|to|into) the public domain", 3, 0.8),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential", 4, 0.5),
    ("permissive", "permission is hereby granted", r"Permission is hereby granted, free of charge", 2, 0.9),
    ("redistribution", "redistribution and use", r"Redistribution and use in source and binary forms", 2, 0.9),
]
PRIORITIES = 5
# ---- fixed values: license texts, notices and exceptions, each written by hand; label, keyword, pattern, priority, score ----
NOTICES = [
    ("mit", "hereby granted", r"Permission is hereby granted, free of charge, to any person obtaining a copy of this software", 1, 1.0),
    ("boost", "hereby granted", r"Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software", 1, 1.0),
    ("isc", "with or without fee", r"Permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee", 1, 1.0),
    ("bsd", "redistribution and use", r"Redistribution and use in source and binary forms, with or without modification, are permitted", 1, 0.9),
    ("bsd-3", "neither the name", r"Neither the name of .{1,80}? nor the names of its contributors may be used", 1, 1.0),
    ("bsd-4", "advertising materials", r"All advertising materials mentioning features or use of this software must display", 1, 1.0),
    ("apache-2", "apache.org/licenses", r"https?://(?:www\.)?apache\.org/licenses/LICENSE-2\.0", 0, 1.0),
    ("apache-2", "in compliance with the license", r"you may not use this file except in compliance with the License", 2, 0.9),
    ("gpl", "gnu general public", r"redistribute it and/or modify it under the terms of the GNU General Public License", 1, 1.0),
    ("lgpl", "gnu lesser general public", r"redistribute it and/or modify it under the terms of the GNU Lesser General Public License", 1, 1.0),
    ("agpl", "gnu affero general public", r"redistribute it and/or modify it under the terms of the GNU Affero General Public License", 1, 1.0),
    ("gpl-2-or-later", "any later version", r"either version 2 of the License, or \(at your option\) any later version", 1, 1.0),
    ("gpl-3-or-later", "any later version", r"either version 3 of the License, or \(at your option\) any later version", 1, 1.0),
    ("gpl", "gnu.org/licenses", r"https?://(?:www\.)?gnu\.org/licenses/gpl", 0, 1.0),
    ("lgpl", "gnu.org/licenses", r"https?://(?:www\.)?gnu\.org/licenses/lgpl", 0, 1.0),
    ("agpl", "gnu.org/licenses", r"https?://(?:www\.)?gnu\.org/licenses/agpl", 0, 1.0),
    ("classpath-exception", "special exception", r"As a special exception, the copyright holders of this library give you permission to link", 1, 1.0),
    ("gcc-exception", "runtime library exception", r"GCC Runtime Library Exception", 1, 1.0),
    ("llvm-exception", "llvm exception", r"Apache License v2\.0 with LLVM Exceptions?", 0, 1.0),
    ("mpl-2", "mozilla public", r"This Source Code Form is subject to the terms of the Mozilla Public License, v\. 2\.0", 1, 1.0),
    ("mpl-2", "mozilla.org/mpl", r"https?://(?:www\.)?mozilla\.org/MPL/2\.0", 0, 1.0),
    ("epl", "eclipse public", r"are made available under the terms of the Eclipse Public License", 1, 1.0),
    ("cddl", "common development and distribution", r"subject to the terms of the Common Development and Distribution License", 1, 1.0),
    ("zlib", "'as-is'", r"This software is provided 'as-is', without any express or implied warranty", 1, 0.9),
    ("unlicense", "unencumbered software", r"This is free and unencumbered software released into the public domain", 1, 1.0),
    ("cc0", "creativecommons.org", r"https?://creativecommons\.org/publicdomain/zero/1\.0", 0, 1.0),
    ("cc-by-sa", "creativecommons.org", r"https?://creativecommons\.org/licenses/by-sa/[0-9.]+", 0, 1.0),
    ("cc-by-nc-sa", "creativecommons.org", r"https?://creativecommons\.org/licenses/by-nc-sa/[0-9.]+", 0, 1.0),
    ("cc-by-nc", "creativecommons.org", r"https?://creativecommons\.org/licenses/by-nc/[0-9.]+", 0, 1.0),
    ("cc-by-nd", "creativecommons.org", r"https?://creativecommons\.org/licenses/by-nd/[0-9.]+", 0, 1.0),
    ("cc-by", "creativecommons.org", r"https?://creativecommons\.org/licenses/by/[0-9.]+", 0, 1.0),
    ("ofl", "font software is licensed", r"This Font Software is licensed under the SIL Open Font License", 1, 1.0),
    ("artistic", "artistic license", r"may be (?:distributed|used) under the (?:terms of the )?Artistic License", 1, 0.9),
    ("psf", "python software foundation", r"Python Software Foundation License Version 2", 1, 1.0),
    ("openssl", "openssl project", r"This product includes software developed by the OpenSSL Project", 1, 1.0),
    ("x11", "except as contained in this notice", r"Except as contained in this notice, the name of .{1,60}? shall not be used in advertising", 1, 1.0),
    ("no-warranty", "without warranty of any kind", r"provided \W?as is\W?,? without warranty of any kind", 4, 0.3),
]


# ---- fixed values: words without which no phrasing around a license's name matches ----
GRANT_WORDS = ["license", "licence", "spdx-", "released under", "distributed under", "published under", "available under"]
_CC_BY_NC = "(?i)cc" + LETTER_GAP + "by" + LETTER_GAP + "nc"


def _says(lower: Column, words: Iterable[str]) -> Column:
    """Whether a lower-cased text holds one of the words."""
    return reduce(or_, [F.contains(lower, F.lit(w)) for w in dict.fromkeys(words)])


def gate(text: Column) -> Column:
    """False only where neither a rule nor a base phrase can match: each needs one of these words."""
    words = [*GRANT_WORDS, *(key for _, key, _, _, _ in OTHERS), *(key for _, key, _, _, _ in NOTICES)]
    # The text is lower-cased once: it is the only element of the array.
    return F.exists(F.array(F.lower(text)), lambda lower: _says(lower, words)) | F.rlike(text, F.lit(_CC_BY_NC))


def keywords(text: Column) -> Column:
    """Array of the keywords in a text without which no rule of a license, phrase or notice can match."""
    names = [F.when(F.rlike(text, F.lit(f"(?i){name}")), F.lit(label)) for label, name, _ in NAMES]
    own = dict.fromkeys([key for _, key, _, _, _ in OTHERS] + [key for _, key, _, _, _ in NOTICES])
    held = F.flatten(F.transform(F.array(F.lower(text)), lambda lower: F.array(
        *[F.when(F.contains(lower, F.lit(key)), F.lit(key)) for key in own])))
    return F.array_compact(F.concat(F.array(*names), held))


def rules() -> list[tuple[int, str, str, str, int, float]]:
    """(order, label, keyword, pattern, priority, score) of every rule, in order."""
    out = []
    edge = lambda body: rf"(?i)(?<![\p{{L}}\p{{N}}]){body}(?![\p{{L}}\p{{N}}])"
    for phrase, priority, score in GRANTS:
        for label, name, versions in NAMES:
            if "V" in phrase.replace("SPDX", "") and versions and not phrase.startswith("SPDX"):
                for v in versions:
                    number = v.removesuffix(".0").replace(".", r"\.") + (r"(?:\.0)?" if v.endswith(".0") or "." not in v else "")
                    out.append((label + "-" + v.removesuffix(".0"), label, edge(_fill(phrase, name, number)), priority, score))
            elif phrase.startswith("SPDX"):
                out.append((label, label, edge(_fill(phrase, name, r"[0-9.]+(?:-only|-or-later)?")), priority, score))
            elif "V" not in phrase:
                out.append((label, label, edge(_fill(phrase, name, "")), priority, score))
    out += [(label, key, edge(body), priority, score) for label, key, body, priority, score in OTHERS]
    out += [(label, key, "(?i)" + body, priority, score) for label, key, body, priority, score in NOTICES]
    return [(k, *r) for k, r in enumerate(out)]


def _fill(phrase: str, name: str, version: str) -> str:
    marked = phrase.replace("SPDX", "\0").replace("N", f"(?:{name})", 1).replace("\0", "SPDX")
    return marked[:-1] + version if marked.endswith("V") else marked.replace("[- ]V", f"[- ]{version}")


def _base_pattern(phrase: str) -> str:
    return rf"(?i)(?<![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])" + LETTER_GAP.join(phrase.split()) + rf"(?![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])"


def detections(gated: DataFrame, spark: SparkSession) -> DataFrame:
    """id, label, priority, score, start, end of the matches of all rules in (id, text), suppressed ones left out."""
    table = spark.createDataFrame(rules(), "rule int, label string, keyword string, pattern string, priority int, score double")
    words = F.explode(keywords(F.col("text")))
    found = (gated.select("id", "text", words.alias("keyword")).join(F.broadcast(table), "keyword")  # a few hundred rows, fixed
             .where(F.rlike("text", F.col("pattern"))).select("id", "rule", "label", "priority", "score", F.explode(places(F.col("text"), F.col("pattern"))).alias("span"))
             .select("id", "rule", "label", "priority", "score", "span.start", "span.end"))
    order = Window.partitionBy("id").orderBy("start", F.desc("end"), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    for p in range(PRIORITIES):
        found = found.withColumn(f"reach_{p}", F.max(F.when(F.col("priority") <= p, F.col("end"))).over(order))
    contained = F.lit(False)
    for p in range(PRIORITIES):
        contained = contained | ((F.col("priority") == p) & (F.coalesce(F.col(f"reach_{p}"), F.lit(-1)) >= F.col("end")))
    return found.where(~contained).select("id", "rule", "label", "priority", "score", "start", "end")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of every row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.struct("doc_id", F.xxhash64(text).alias("tk")).alias("id"))
    counted = rows.select("doc_id", "id", F.regexp_count("text", F.lit(LETTER_WORD)).cast("long").alias("n_words"))
    gated = rows.where(gate(F.col("text"))).select("id", "text").dropDuplicates(["id"])
    spans = F.concat(*[F.transform(places(F.col("text"), _base_pattern(p)), lambda s: F.struct(s["start"].alias("start"), F.lit(label).alias("label")))
                       for p, label in BASE.items()])
    based = gated.select("id", F.transform(spans, lambda s: F.struct(F.regexp_count(
        F.substring("text", F.lit(1), s["start"]), F.lit(LETTER_WORD)).cast("long").alias("word"), s["label"].alias("label"))).alias("base"))
    based = based.where(F.size("base") > 0)
    found = detections(gated, spark).groupBy("id").agg(
        F.collect_set("label").alias("found"), F.max("score").alias("score"),
        F.sort_array(F.collect_list(F.struct("start", "end", "label", "rule"))).alias("spans"))
    marks = based.join(found, "id", "full")
    label_of = F.transform("base", lambda b: b["label"])
    none = F.array().cast("array<string>")
    marks = marks.select(
        "id", F.size("base").cast("long").alias("n_base"), F.array_min(F.transform("base", lambda b: b["word"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["word"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.coalesce(label_of, none))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(F.coalesce(label_of, none), F.coalesce("found", none)))), ",").alias("labels"),
        F.when(F.col("base").isNotNull(), 1.0).otherwise(F.col("score")).alias("score"), "spans")
    return counted.join(marks, "id", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans")
