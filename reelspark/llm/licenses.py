"""License scans by ordered signature rules, in column expressions only.

A rule is a regular expression over the words of a text (lower case, one blank between them), with a
keyword that its every match contains. Texts without any licence word are passed over by one look; of
the others only rules whose keyword occurs are tried. Detections then resolve: one that lies inside
another is suppressed by it (of equal ranges the earlier rule stays), and of two that overlap in part
the one of the earlier rule stays. Base detections (plain phrases) are always reported.

Rules are ordered from the most to the least certain: identifiers, grants ("licensed under ..."),
versions, names.

Defined cases: a null or empty text has no words and no detections; keys may be null or repeat, each row
gives one row; other columns are not read. Nothing is capped: every match of every rule is a detection.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions.text import let, once

from .common import lower_ascii

#: Phrases that are always reported, with their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Label, keyword, name as words, versions as words ("" for none).
FAMILIES: list[tuple[str, str, str, list[str]]] = [
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e", ["3 0", "3", "1 0"]),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e", ["2 1", "3 0", "3"]),
    ("lgpl-library", "library general", r"(?:gnu )?library general public licen[cs]e", ["2 0", "2"]),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e", ["1 0", "2 0", "3 0", "1", "2", "3"]),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[cs]e", ["1 1", "1 2", "1 3"]),
    ("apache", "apache", r"apache (?:software )?licen[cs]e", ["1 0", "1 1", "2 0", "2"]),
    ("mit", "mit", r"mit (?:x11 )?licen[cs]e", [""]),
    ("x11", "x11", r"x11 licen[cs]e", [""]),
    ("bsd-2-clause", "bsd", r"(?:2|two) clause bsd(?: licen[cs]e)?|simplified bsd licen[cs]e", [""]),
    ("bsd-3-clause", "bsd", r"(?:3|three) clause bsd(?: licen[cs]e)?|(?:new|modified|revised) bsd licen[cs]e", [""]),
    ("bsd-4-clause", "bsd", r"(?:4|four) clause bsd(?: licen[cs]e)?|original bsd licen[cs]e", [""]),
    ("bsd", "bsd", r"bsd (?:style )?licen[cs]e", [""]),
    ("isc", "isc", r"isc licen[cs]e", [""]),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse", r"eclipse public licen[cs]e", ["1 0", "2 0"]),
    ("edl", "eclipse distribution", r"eclipse distribution licen[cs]e", ["1 0"]),
    ("cddl", "common development", r"common development and distribution licen[cs]e", ["1 0", "1 1"]),
    ("cpl", "common public", r"common public licen[cs]e", ["1 0"]),
    ("eupl", "european union", r"european union public licen[cs]e", ["1 0", "1 1", "1 2"]),
    ("artistic", "artistic", r"artistic licen[cs]e", ["1 0", "2 0"]),
    ("boost", "boost", r"boost software licen[cs]e", ["1 0"]),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", [""]),
    ("libpng", "libpng", r"libpng licen[cs]e", [""]),
    ("unlicense", "unlicense", r"(?:the )?unlicense", [""]),
    ("wtfpl", "what the fuck", r"do what the fuck you want to public licen[cs]e", ["2"]),
    ("python", "python", r"python (?:software foundation )?licen[cs]e", ["2", "2 0"]),
    ("php", "php", r"php licen[cs]e", ["3 0", "3 01"]),
    ("ruby", "ruby", r"ruby licen[cs]e", [""]),
    ("perl", "same terms as perl", r"under the same terms as perl(?: itself)?", [""]),
    ("openssl", "openssl", r"openssl licen[cs]e", [""]),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", [""]),
    ("sil-ofl", "open font", r"(?:sil )?open font licen[cs]e", ["1 0", "1 1"]),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e", [""]),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[cs]e", [""]),
    ("cecill", "cecill", r"cecill(?: free software)? licen[cs]e(?: agreement)?", ["1 0", "2 0", "2 1"]),
    ("odbl", "open database", r"open database licen[cs]e", ["1 0"]),
    ("odc-by", "open data commons", r"open data commons attribution licen[cs]e", ["1 0"]),
    ("pddl", "public domain dedication", r"public domain dedication and licen[cs]e", ["1 0"]),
    ("ogl-uk", "open government", r"open government licen[cs]e", ["1 0", "2 0", "3 0"]),
    ("osl", "open software", r"open software licen[cs]e", ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", "academic free", r"academic free licen[cs]e", ["1 2", "2 0", "2 1", "3 0"]),
    ("qpl", "q public", r"q public licen[cs]e", ["1 0"]),
    ("npl", "netscape", r"netscape public licen[cs]e", ["1 0", "1 1"]),
    ("apsl", "apple public", r"apple public source licen[cs]e", ["1 0", "1 1", "1 2", "2 0"]),
    ("ipl", "ibm public", r"ibm public licen[cs]e", ["1 0"]),
    ("lppl", "latex project", r"latex project public licen[cs]e", ["1 0", "1 2", "1 3"]),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e", [""]),
    ("w3c", "w3c", r"w3c (?:software (?:notice and )?)?licen[cs]e", [""]),
    ("vim", "vim", r"vim licen[cs]e", [""]),
    ("beerware", "beer", r"beer ?ware licen[cs]e", [""]),
    ("bsl", "business source", r"business source licen[cs]e", ["1 0", "1 1"]),
    ("sspl", "server side", r"server side public licen[cs]e", ["1", "1 0"]),
    ("elastic", "elastic", r"elastic licen[cs]e", ["2 0", "2"]),
    ("openrail", "rail", r"open ?rail (?:m )?licen[cs]e", [""]),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by", "creative commons", r"creative commons attribution", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc0", "creative commons", r"creative commons (?:zero|cc0)", ["1 0"]),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "cc by", r"cc by nc", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "cc by", r"cc by nd", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "cc by", r"cc by sa", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by", "cc by", r"cc by", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc0", "cc0", r"cc0", ["1 0"]),
]

#: Label, keyword, words of notices that stand without a name.
NOTICES: list[tuple[str, str, str]] = [
    ("mit", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("zlib", "as is without any", r"this software is provided as is without any express or implied warranty"),
    ("mit", "shall be included", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd", "redistributions of", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "neither the name", r"neither the names? of (?:the )?(?:copyright holders?|author|[0-9a-z]+ [0-9a-z]+|[0-9a-z]+) nor the names of (?:its|their|any) contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "origin of this", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("isc", "author disclaims", r"the author disclaims all warranties with regard to this software including all implied warranties"),
    ("gpl", "free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "free software", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("gpl", "without any warranty", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "without any warranty", r"this library is distributed in the hope that it will be useful but without any warranty"),
    ("apache-2.0", "except in compliance", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2.0", "agreed to in writing", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis"),
    ("apache-2.0", "irrevocable copyright", r"perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[cs]e"),
    ("patent-grant", "irrevocable", r"perpetual worldwide non exclusive no charge royalty free irrevocable (?:except as stated in this section )?patent licen[cs]e"),
    ("mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? 2 0"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "free to copy", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc-by", "attribution", r"this work is licen[cs]ed under a creative commons attribution (?:[0-9] [0-9] )?(?:international |unported )?licen[cs]e"),
    ("warranty-disclaimer", "without warranty", r"(?:provided as is without warranty of any kind express or implied|as is without warranty of any kind)"),
    ("warranty-disclaimer", "express or implied", r"any express or implied warranties including but not limited to the implied warranties"),
    ("warranty-disclaimer", "merchantability", r"(?:implied )?warrant(?:y|ies) of merchantability"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"(?:is|are) in the public domain"),
    ("all-rights-reserved", "all rights", r"all rights reserved"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("permissive", "see license", r"see license (?:file )?for (?:more )?(?:details|information)"),
    ("copyright-notice", "copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]"),
]

#: Identifiers of the registry of licences, as words.
IDENTIFIERS = ("mit", "isc", "zlib", "unlicense", "wtfpl", "ncsa", "vim", "ruby", "x11", "openssl", "postgresql", "beerware",
               "0bsd", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "apache 1 0", "apache 1 1", "apache 2 0",
               "gpl 1 0", "gpl 2 0", "gpl 3 0", "lgpl 2 0", "lgpl 2 1", "lgpl 3 0", "agpl 1 0", "agpl 3 0", "mpl 1 0", "mpl 1 1",
               "mpl 2 0", "epl 1 0", "epl 2 0", "cddl 1 0", "cddl 1 1", "cpl 1 0", "eupl 1 1", "eupl 1 2", "artistic 1 0",
               "artistic 2 0", "bsl 1 0", "bsl 1 1", "ofl 1 0", "ofl 1 1", "ms pl", "ms rl", "osl 3 0", "afl 3 0", "lppl 1 3c",
               "php 3 01", "psf 2 0", "cc0 1 0", "cc by 3 0", "cc by 4 0", "cc by sa 3 0", "cc by sa 4 0", "cc by nc 4 0",
               "cc by nd 4 0", "cc by nc sa 4 0", "cc by nc nd 4 0", "odbl 1 0", "sspl 1 0", "elastic 2 0")

GRANT = r"(?:re)?(?:licen[cs]ed|released|distributed|published|provided|available|redistribute it and or modify it) under (?:the )?(?:terms of )?(?:the )?"

#: No further part of the version follows; a year, or a day and its month, is none.
END = (r"(?! [0-9]{1,2} (?!(?:january|february|march|april|may|june|july|august|september|october|november|december"
       r"|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec) ))")

#: Results gathered by one inner fold.
RUN = 256

#: Every match of every rule has one of these; blanks may be any characters that are no words.
GATE = r"(?i)licen[cs]e|copyright|rights|spdx|public|cc0|cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by|commons|perl|proprietary|permission|redistribution|express|clause|warrant|free[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+software|misrepresented|contributors|acknowledge?ment|free[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+to[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+copy"


def rules() -> list[tuple[str, str, str, float, bool]]:
    """(label, keyword, regex over words, certainty, base), the first rule being the strongest."""
    made = [(f"spdx:{name.replace(' ', '-')}", "spdx license identifier", f"spdx license identifier {name}(?: only| or later)?", 1.0, False)
            for name in IDENTIFIERS]
    made += [(label, key, words, 1.0, False) for label, key, words in NOTICES if len(words) > 70]
    for certainty, before in ((0.9, GRANT), (0.7, "")):
        for label, key, name, versions in FAMILIES:
            for version in versions:
                if version:
                    tag = f"{label}-{version.replace(' ', '.')}"
                    made.append((tag, key, rf"{before}(?:{name}) (?:version |v |ver |v)?{version}{END}", certainty, False))
    for certainty, before in ((0.8, GRANT), (0.5, "")):
        made += [(f"{label}-named", key, f"{before}(?:{name})", certainty, False) for label, key, name, _ in FAMILIES]
    made += [(label, key, words, 0.4, False) for label, key, words in NOTICES if len(words) <= 70]
    made += [(label, phrase.split()[0], phrase, 0.5, True) for phrase, label in BASE]
    return list(dict.fromkeys(made))


def _spaces(part: Column) -> Column:
    return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))


def _running(rows: Column, state: Column, after, out, kind: str) -> Column:
    """out(state, row) for every row in turn, the state being after(state, row) of the rows before. Results are
    gathered in runs of RUN, so that no step copies all results so far."""
    def run(at: Column, part: Column) -> Column:
        none = F.array().cast(f"array<{kind}>")
        return F.aggregate(part, F.struct(at.alias("state"), none.alias("out")), lambda acc, row: F.struct(
            after(acc.state, row).alias("state"), F.array_append(acc.out, out(acc.state, row)).alias("out")))

    def whole(all_rows: Column) -> Column:
        last = ((F.size(all_rows) - 1) / RUN).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_rows, i * RUN + 1, RUN))
        start = F.struct(F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out")).alias("last"),
                         F.array().cast(f"array<array<{kind}>>").alias("done"))
        return F.flatten(F.aggregate(
            parts, start, lambda acc, part: F.struct(run(acc.last.state, part).alias("last"),
                                                     F.array_append(acc.done, acc.last.out).alias("done")),
            lambda acc: F.array_append(acc.done, acc.last.out)))
    return let(rows, whole)


def _places(words: Column, rule: Column) -> Column:
    """Detections of one rule: word ranges, by the blanks before and in every match."""
    pattern = F.concat(F.lit(" (?:"), rule.pattern, F.lit(")(?= )"))
    gaps = F.call_function("split", words, pattern, F.lit(-1))
    hits = F.call_function("regexp_extract_all", words, pattern, F.lit(0))
    steps = F.filter(F.zip_with(hits, gaps, lambda hit, gap: F.struct(_spaces(gap).alias("gap"), _spaces(hit).alias("hit"))),
                     lambda s: s.hit.isNotNull())
    ranges = _running(steps, F.lit(0), lambda at, s: at + s.gap + s.hit,
                      lambda at, s: F.struct((at + s.gap).alias("start"), (at + s.gap + s.hit).alias("end")), "struct<start:int,end:int>")
    return F.when(F.instr(words, rule.keyword) > 0, F.transform(
        ranges, lambda p: F.struct(p.start.alias("start"), (-p.end).alias("minus_end"), rule.rank.alias("rank"), p.end.alias("end"),
                                   rule.label.alias("label"), rule.certainty.alias("certainty"), rule.base.alias("base"))))


def _resolved(found: Column) -> Column:
    """Marks kept detections, in time proportional to their number. In order of start, longest first, a detection
    lies inside another if and only if an earlier one reaches as far. Of those left ends rise with starts, so one
    pass each way meets all overlaps, holding only the ranges that are still open: they start at different words
    of one match, so the longest rule bounds them."""
    kind = "struct<start:int,end:int,rank:int,label:string,certainty:double,base:boolean,kept:boolean,beaten:boolean>"
    ranges = "array<struct<start:int,end:int,rank:int>>"

    def marked(d: Column, kept: Column, beaten: Column) -> Column:
        return F.struct(d.start.alias("start"), d.end.alias("end"), d["rank"].alias("rank"), d.label.alias("label"),
                        d.certainty.alias("certainty"), d.base.alias("base"), kept.alias("kept"), beaten.alias("beaten"))

    def meets(o: Column, d: Column) -> Column:
        return (o.start < d.end) & (d.start < o.end)

    def opened(others: Column, d: Column) -> Column:
        own = F.struct(d.start.alias("start"), d.end.alias("end"), d["rank"].alias("rank"))
        return F.array_append(F.filter(others, lambda o: meets(o, d)), own)

    def beaten(others: Column, d: Column) -> Column:
        return F.exists(others, lambda o: meets(o, d) & (o["rank"] < d["rank"]))
    none = F.array().cast(ranges)
    forth = _running(
        F.sort_array(found), F.struct(F.lit(-1).alias("reach"), none.alias("others")),
        lambda at, d: F.struct(F.greatest(at.reach, d.end).alias("reach"),
                               F.when(d.end > at.reach, opened(at.others, d)).otherwise(at.others).alias("others")),
        lambda at, d: marked(d, d.end > at.reach, beaten(at.others, d)), kind)
    back = _running(
        F.reverse(forth), none, lambda others, d: F.when(d.kept, opened(others, d)).otherwise(others),
        lambda others, d: marked(d, d.kept & ~d.beaten & ~beaten(others, d), d.beaten), kind)
    return F.transform(F.reverse(back), lambda d: F.struct(
        *[d[f].alias(f) for f in ("start", "end", "rank", "label", "certainty", "base", "kept")]))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, detections): word ranges from 0, end not included; kept is the verdict of the rules' order."""
    table = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(label).alias("label"), F.lit(keyword).alias("keyword"),
                               F.lit(pattern).alias("pattern"), F.lit(certainty).alias("certainty"), F.lit(base).alias("base"))
                      for i, (label, keyword, pattern, certainty, base) in enumerate(rules())])
    word = r"[0-9A-Za-z\x80-\x{10FFFF}]+"
    body = F.col("text")
    flat = F.regexp_replace(lower_ascii(body), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = once(rows.select("key", F.regexp_count(body, F.lit(word)).cast("long").alias("n_words"),
                            F.when(body.rlike(GATE), F.concat(F.lit(" "), F.trim(flat), F.lit(" "))).alias("flat")),
                found=F.when(F.col("flat").isNotNull(), F.flatten(F.filter(
                    F.transform(table, lambda rule: _places(F.col("flat"), rule)), lambda d: d.isNotNull()))))
    none = F.array().cast("array<struct<start:int,end:int,rank:int,label:string,certainty:double,base:boolean,kept:boolean>>")
    return rows.select(F.col("key").alias(key), "n_words",
                       F.when(F.size("found") > 0, _resolved(F.col("found"))).otherwise(none).alias("detections"))
