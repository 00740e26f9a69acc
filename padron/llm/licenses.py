"""License scan in Spark's own expressions: ordered signature rules.

Three phrases are always looked for, and so is a list of rules: signatures of license texts, SPDX
identifiers, notices and bare names. A rule's pattern runs only if the text holds the rule's own
keyword, which every match of the pattern holds. Of overlapping detections, one that
lies inside another of at least its priority is suppressed; equal intervals of equal priority
stay together.

Patterns see the text as its words (runs of letters A-Z, digits and characters beyond ASCII)
joined by single spaces. Nulls and empty texts have no words and no labels. Columns pass through.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.common import text_of

# What is no word, and the phrases with their labels.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
PHRASE = "(?i)(?<= )(?:" + "|".join(PHRASES) + ")(?= )"

SIGNATURE, IDENTIFIER, NOTICE, NAME, HINT = 5, 4, 3, 2, 1
CONFIDENCE = {SIGNATURE: 1.0, IDENTIFIER: 0.95, NOTICE: 0.9, NAME: 0.7, HINT: 0.4}

# Texts that only one license has: label, keyword, pattern.
SIGNATURES = (
    ("mit", "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "substantial portions", r"shall be included in all copies or substantial portions of the software"),
    ("mit-0", "without restriction", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("isc", "with or without fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", "with or without fee", r"for any purpose with or without fee is hereby granted the software is provided as is"),
    ("bsd-2-clause", "binary forms", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", r"neither the names? of .{1,80}? nor the names of its contributors may be used to endorse or promote"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-1.1", "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("apache-2.0", "apache", r"licensed under the apache license version 2 0"),
    ("apache-2.0", "in compliance with", r"you may not use this file except in compliance with the license"),
    ("gpl-2.0-or-later", "version 2", r"gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "version 3", r"gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0-only", "version 2", r"gnu general public license version 2 only"),
    ("gpl-3.0-only", "version 3", r"gnu general public license version 3 only"),
    ("gpl", "everyone is permitted", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("lgpl-2.1-or-later", "lesser", r"gnu lesser general public license as published by the free software foundation either version 2 1"),
    ("lgpl-3.0-or-later", "lesser", r"gnu lesser general public license as published by the free software foundation either version 3"),
    ("lgpl-2.0-or-later", "library general", r"gnu library general public license as published by the free software foundation"),
    ("agpl-3.0-or-later", "affero", r"gnu affero general public license as published by the free software foundation either version 3"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", "eclipse", r"made available under the terms of the eclipse public license v ?1 0"),
    ("epl-2.0", "eclipse", r"made available under the terms of the eclipse public license (?:v )?2 0"),
    ("cddl-1.0", "common development", r"subject to the terms of the common development and distribution license"),
    ("bsl-1.0", "boost", r"distributed under the boost software license version 1 0"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("wtfpl", "do what the", r"do what the f\w+ you want to public license"),
    ("cc0-1.0", "neighboring rights", r"to the extent possible under law .{1,120}? waived all copyright and related or neighboring rights"),
    ("artistic-2.0", "artistic", r"the artistic license 2 0"),
    ("psf-2.0", "python software foundation", r"python software foundation license version 2"),
    ("ofl-1.1", "open font", r"licensed under the sil open font license version 1 1"),
    ("postgresql", "written agreement", r"for any purpose without fee and without a written agreement is hereby granted"),
    ("x11", "x consortium", r"except as contained in this notice the name of the x consortium shall not be used"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("php-3.01", "php", r"subject to version 3 01 of the php license"),
    ("ms-pl", "microsoft public", r"microsoft public license ms pl"),
    ("jquery", "jquery", r"jquery foundation and other contributors released under the mit license"),
    ("beerware", "buy me a beer", r"you can buy me a beer in return"),
)

# Licenses by name: label, keyword, pattern of the name, SPDX identifier as words.
NAMES = (
    ("mit", "mit", r"mit", "mit"),
    ("x11", "x11", r"x11", "x11"),
    ("isc", "isc", r"isc", "isc"),
    ("bsd", "bsd", r"(?:new |simplified |modified |revised )?bsd", "bsd"),
    ("bsd-2-clause", "bsd 2", r"bsd 2 clause", "bsd 2 clause"),
    ("bsd-3-clause", "bsd 3", r"bsd 3 clause", "bsd 3 clause"),
    ("bsd-4-clause", "bsd 4", r"bsd 4 clause", "bsd 4 clause"),
    ("apache-1.1", "apache", r"apache (?:software )?(?:license )?(?:version |v ?)?1 1", "apache 1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?(?:license )?(?:version |v ?)?2(?: 0)?", "apache 2 0"),
    ("apache", "apache", r"apache", "apache"),
    ("gpl-1.0", "gpl", r"gpl ?v?1(?: 0)?", "gpl 1 0"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl ?v?2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl ?v?3(?: 0)?", "gpl 3 0"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public license (?:version |v ?)?2(?: 0)?", "gpl 2 0 only"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public license (?:version |v ?)?3(?: 0)?", "gpl 3 0 only"),
    ("gpl", "general public", r"(?:gnu )?general public", "gpl"),
    ("gpl-2.0-or-later", "gpl", r"gpl ?v?2(?: 0)? or later", "gpl 2 0 or later"),
    ("gpl-3.0-or-later", "gpl", r"gpl ?v?3(?: 0)? or later", "gpl 3 0 or later"),
    ("lgpl-2.0", "lgpl", r"lgpl ?v?2(?: 0)?", "lgpl 2 0"),
    ("lgpl-2.1", "lgpl", r"lgpl ?v?2 1", "lgpl 2 1"),
    ("lgpl-3.0", "lgpl", r"lgpl ?v?3(?: 0)?", "lgpl 3 0"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public", "lgpl"),
    ("agpl-3.0", "agpl", r"agpl ?v?3(?: 0)?", "agpl 3 0"),
    ("agpl", "affero", r"(?:gnu )?affero general public", "agpl"),
    ("mpl-1.1", "mpl", r"mpl ?v?1 1", "mpl 1 1"),
    ("mpl-2.0", "mpl", r"mpl ?v?2(?: 0)?", "mpl 2 0"),
    ("mpl", "mozilla", r"mozilla public", "mpl"),
    ("epl-1.0", "epl", r"epl ?v?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "epl", r"epl ?v?2(?: 0)?", "epl 2 0"),
    ("epl", "eclipse", r"eclipse public", "epl"),
    ("eupl-1.2", "european union", r"european union public(?: licence)?(?: v ?1 2)?", "eupl 1 2"),
    ("cddl-1.0", "cddl", r"cddl ?(?:v ?)?1?(?: 0)?", "cddl 1 0"),
    ("cpl-1.0", "common public", r"common public", "cpl 1 0"),
    ("bsl-1.0", "boost", r"boost software", "bsl 1 0"),
    ("busl-1.1", "business source", r"business source", "busl 1 1"),
    ("sspl-1.0", "server side", r"server side public", "sspl 1 0"),
    ("elastic-2.0", "elastic", r"elastic", "elastic 2 0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", "unlicense"),
    ("zlib", "zlib", r"zlib(?: libpng)?", "zlib"),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl"),
    ("artistic-1.0", "artistic", r"artistic (?:license )?1 0", "artistic 1 0"),
    ("artistic-2.0", "artistic", r"artistic (?:license )?2 0", "artistic 2 0"),
    ("psf-2.0", "python software", r"python software foundation", "psf 2 0"),
    ("ofl-1.1", "open font", r"(?:sil )?open font", "ofl 1 1"),
    ("postgresql", "postgresql", r"postgresql", "postgresql"),
    ("openssl", "openssl", r"openssl", "openssl"),
    ("php-3.01", "php", r"php", "php 3 01"),
    ("ruby", "ruby", r"ruby", "ruby"),
    ("ms-pl", "microsoft public", r"microsoft public", "ms pl"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal", "ms rl"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", "ncsa"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?", "cc0 1 0"),
    ("cc-by-3.0", "cc by", r"cc by 3 0", "cc by 3 0"),
    ("cc-by-4.0", "cc by", r"cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-3.0", "cc by sa", r"cc by sa 3 0", "cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa", r"cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "cc by nc", r"cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "cc by nd", r"cc by nd 4 0", "cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa", r"cc by nc sa 4 0", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd", r"cc by nc nd 4 0", "cc by nc nd 4 0"),
    ("cc-by", "attribution", r"creative commons attribution(?: international)?", "cc by"),
    ("cc-by-sa", "share", r"creative commons attribution share ?alike(?: international)?", "cc by sa"),
    ("cc-by-nc", "commercial", r"creative commons attribution non ?commercial(?: international)?", "cc by nc"),
    ("cc-by-nd", "deriv", r"creative commons attribution no ?deriv\w*(?: international)?", "cc by nd"),
    ("odbl-1.0", "open database", r"open database", "odbl 1 0"),
    ("gfdl-1.3", "free documentation", r"(?:gnu )?free documentation", "gfdl 1 3"),
)

# Neither text nor name of a license, but a statement about one.
HINTS = (
    ("public-domain", "public domain", r"(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", "rights reserved", r"all rights reserved"),
    ("proprietary", "confidential", r"proprietary and confidential"),
    ("proprietary", "unauthorized", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("creative-commons", "creative commons", r"creative commons licen[cs]e"),
    ("see-license", "license", r"see (?:the )?license (?:file )?for (?:the )?(?:full )?(?:details|terms|license)"),
)


def rules() -> list[dict]:
    """All rules in order of priority; each name gives an identifier, notices and a mention."""
    out = [(label, SIGNATURE, keyword, p) for label, keyword, p in SIGNATURES]
    out += [(label, IDENTIFIER, "spdx", rf"spdx license identifier {spdx}") for label, _, _, spdx in NAMES]
    notice = r"(?:licen[cs]ed|released|distributed|available|published|provided|covered) (?:under|by)(?: the terms of)?(?: the| an?)? "
    # A name that is its keyword stands there as whole words.
    whole = lambda keyword, name: f" {keyword} " if keyword == name else keyword
    out += [(label, NOTICE, whole(keyword, name), rf"{notice}{name}(?: licen[cs]e)?") for label, keyword, name, _ in NAMES]
    out += [(label, NAME, whole(keyword, name), rf"{name} licen[cs]e") for label, keyword, name, _ in NAMES]
    out += [(label, HINT, keyword, p) for label, keyword, p in HINTS]
    return [{"label": a, "priority": b, "keyword": c, "pattern": rf"(?<= ){p}(?= )"} for a, b, c, p in out]


RULE = "array<struct<label:string,priority:int,keyword:string,pattern:string>>"
DETECTION = "array<struct<start:bigint,back:bigint,priority:int,label:string>>"


def tidy(text: Column) -> Column:
    """Words joined by single spaces, with one before and one after."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, GAP, " ")), F.lit(" "))


def words_in(part: Column) -> Column:
    inner = F.trim(part)
    return F.when(inner == "", 0).otherwise(F.octet_length(inner) - F.octet_length(F.replace(inner, F.lit(" "), F.lit(""))) + 1).cast("long")


def detections(text: Column, rule: Column) -> Column:
    """Intervals (start, minus end) of one rule, as running sums of gaps and matches."""
    facts = F.zip_with(
        F.split(text, rule["pattern"], -1), F.regexp_extract_all(text, rule["pattern"], F.lit(0)),
        lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size")),
    )

    def step(state: Column, x: Column) -> Column:
        start = state["pos"] + x["gap"]
        stop = start + F.coalesce(x["size"], F.lit(0))
        one = F.struct(start.alias("start"), (-stop).alias("back"), rule["priority"].alias("priority"), rule["label"].alias("label"))
        return F.struct(stop.alias("pos"), F.when(x["size"].isNotNull(), F.concat(state["out"], F.array(one))).otherwise(state["out"]).alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast(DETECTION).alias("out"))
    return F.aggregate(facts, first, step, lambda s: s["out"])


def surviving(found: Column) -> Column:
    """Labels and highest priority of the detections not inside another of at least their priority.

    In order of start and falling end, whatever contains a detection comes before it, so the
    furthest end seen per priority decides: one pass.
    """
    levels = F.array(*[F.lit(0).cast("long")] * (SIGNATURE + 1))
    first = F.struct(
        levels.alias("ends"), F.lit(-1).cast("long").alias("start"), F.lit(0).cast("long").alias("stop"), F.lit(0).alias("level"),
        F.array().cast("array<string>").alias("labels"), F.lit(0).alias("best"),
    )

    def step(s: Column, d: Column) -> Column:
        stop, level = -d["back"], d["priority"]
        inside = F.exists(F.slice(s["ends"], level + 1, SIGNATURE + 1), lambda e: e >= stop)
        twin = (s["start"] == d["start"]) & (s["stop"] == stop) & (s["level"] == level)
        stays = ~inside | twin
        ends = F.transform(s["ends"], lambda e, i: F.when(i == level, F.greatest(e, stop)).otherwise(e))
        pick = lambda new, old: F.when(stays, new).otherwise(s[old]).alias(old)
        return F.struct(
            ends.alias("ends"), pick(d["start"], "start"), pick(stop, "stop"), pick(level, "level"),
            pick(F.array_union(s["labels"], F.array(d["label"])), "labels"), pick(F.greatest(s["best"], level), "best"),
        )

    ordered = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), d["back"].alias("back"), (-d["priority"]).alias("low"), d["label"].alias("label"), d["priority"].alias("priority"))))
    return F.aggregate(ordered, first, step, lambda s: F.struct(s["labels"].alias("labels"), s["best"].alias("best")))


ADDED = {"n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "_tidy", "_gaps", "_found", "_base", "_ruled", "_low", "_asked"}


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score.

    Columns of these names, and ``_tidy _low _asked _gaps _found _base _ruled``, are replaced.
    """
    marked = docs.withColumn("_tidy", tidy(text_of())).withColumn("n_words", words_in(F.col("_tidy")))
    text = F.col("_tidy")
    gaps, found = F.split(text, PHRASE, -1), F.regexp_extract_all(text, F.lit(PHRASE), F.lit(0))
    here = text.rlike(PHRASE)
    marked = (
        marked.withColumn("_gaps", F.when(here, gaps))
        .withColumn("_found", F.when(here, F.transform(found, lambda x: F.lower(x))))
        .withColumn("n_base", F.coalesce(F.size("_found"), F.lit(0)).cast("long"))
        .withColumn("first_word", F.when(here, words_in(F.get("_gaps", F.lit(0)))))
        .withColumn(
            "last_word",
            F.when(here, F.col("n_words") - words_in(F.element_at("_gaps", -1)) - words_in(F.element_at("_found", -1))),
        )
    )
    labels = F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair])
    none = F.array().cast("array<string>")
    base = F.coalesce(F.array_sort(F.array_distinct(F.transform("_found", lambda x: F.element_at(labels, x)))), none)
    table = F.from_json(F.lit(json.dumps(rules())), RULE)
    # Each keyword is looked for once; what a lambda holds would be computed anew for each rule.
    keywords = list(dict.fromkeys(r["keyword"] for r in rules()))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("_low"), F.lit(k)), F.lit(k)) for k in keywords]))
    asked = F.filter(table, lambda r: F.array_contains("_asked", r["keyword"]))
    ruled = surviving(F.flatten(F.transform(asked, lambda r: detections(F.col("_low"), r))))
    marked = marked.withColumn("_base", base).withColumn("_low", F.lower(text)).withColumn("_asked", held)
    marked = marked.withColumn("_ruled", F.when(F.size("_asked") > 0, ruled))
    score = F.element_at(F.create_map(*[F.lit(x) for pair in CONFIDENCE.items() for x in pair]), F.col("_ruled.best"))
    of_base = F.when(F.col("n_base") > 0, F.lit(CONFIDENCE[NAME])).otherwise(0.0)
    return marked.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ADDED],
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.col("_base").alias("base_labels"),
        F.array_sort(F.array_union("_base", F.coalesce("_ruled.labels", none))).alias("labels"),
        F.greatest(of_base, F.coalesce(score, F.lit(0.0))).alias("score"),
    )
