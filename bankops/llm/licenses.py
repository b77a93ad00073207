"""License scan by ordered signature rules, with built-in functions only.

The text becomes a line of lower-cased words. A rule has a keyword, a pattern over that line, a label and a priority. Texts
without any root keyword are done after a few substring searches; in the others a rule runs only if its own keyword is there.
Detections may overlap: one that lies inside a detection of better or the same priority is suppressed (of two of one place and
priority the first label stays), so "GNU Lesser General Public License
version 3" is no GPL and "Apache License, Version 2.0" is not the unversioned name. Everything is an expression on the row, so
there is no shuffle, and repeated rows or ids need no care.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankops.llm.spans import match_spans

# fixed: what counts as a word, and the base phrases
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

TAG, GRANT, NAME, HINT = 1, 2, 3, 4  # priorities
CONFIDENCE = {TAG: 1.0, GRANT: 0.95, NAME: 0.8, HINT: 0.4}

_V = "(version )?v?"
# label, keyword, pattern of the name over words, identifiers as words
FAMILIES = [
    ("mit", "mit", "mit( x11)? license", "mit"),
    ("mit", "expat", "expat( x11)? license", None),
    ("mit-0", "mit", "mit no attribution( license)?", "mit 0"),
    ("apache-2.0", "apache", f"apache( software)? license( {_V}2( 0)?)", "apache 2 0"),
    ("apache-1.1", "apache", f"apache( software)? license {_V}1 1", "apache 1 1"),
    ("apache-1.0", "apache", f"apache( software)? license {_V}1 0", "apache 1 0"),
    ("apache", "apache", "apache( software)? license", None),
    ("gpl-3.0", "public license", f"(gnu )?general public license( gpl)? {_V}3( 0)?", "gpl 3 0( only| or later)?"),
    ("gpl-2.0", "public license", f"(gnu )?general public license( gpl)? {_V}2( 0)?", "gpl 2 0( only| or later)?"),
    ("gpl-1.0", "public license", f"(gnu )?general public license( gpl)? {_V}1( 0)?", "gpl 1 0( only| or later)?"),
    ("gpl", "public license", "(gnu )?general public license", None),
    ("lgpl-3.0", "lesser", f"(gnu )?lesser general public license( lgpl)? {_V}3( 0)?", "lgpl 3 0( only| or later)?"),
    ("lgpl-2.1", "lesser", f"(gnu )?lesser general public license( lgpl)? {_V}2 1", "lgpl 2 1( only| or later)?"),
    ("lgpl-2.0", "library", f"(gnu )?library general public license( lgpl)? {_V}2( 0)?", "lgpl 2 0( only| or later)?"),
    ("lgpl", "lesser", "(gnu )?lesser general public license", None),
    ("agpl-3.0", "affero", f"(gnu )?affero general public license( agpl)? {_V}3( 0)?", "agpl 3 0( only| or later)?"),
    ("agpl-1.0", "affero", f"affero general public license {_V}1( 0)?", "agpl 1 0( only| or later)?"),
    ("agpl", "affero", "(gnu )?affero general public license", None),
    ("gfdl-1.3", "documentation", f"(gnu )?free documentation license {_V}1 3", "gfdl 1 3( only| or later)?"),
    ("gfdl-1.2", "documentation", f"(gnu )?free documentation license {_V}1 2", "gfdl 1 2( only| or later)?"),
    ("gfdl", "documentation", "(gnu )?free documentation license", None),
    ("bsd-2-clause", "bsd", "(bsd 2 clause|2 clause bsd|simplified bsd|freebsd)( license)?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)( license)?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(bsd 4 clause|4 clause bsd|original bsd)( license)?", "bsd 4 clause"),
    ("0bsd", "bsd", "(0bsd|zero clause bsd)( license)?", "0bsd"),
    ("bsd", "bsd", "bsd( style)? license", None),
    ("mpl-2.0", "mozilla", f"mozilla public license {_V}2( 0)?", "mpl 2 0"),
    ("mpl-1.1", "mozilla", f"mozilla public license {_V}1 1", "mpl 1 1"),
    ("mpl", "mozilla", "mozilla public license", None),
    ("epl-2.0", "eclipse", f"eclipse public license {_V}2( 0)?", "epl 2 0"),
    ("epl-1.0", "eclipse", f"eclipse public license {_V}1( 0)?", "epl 1 0"),
    ("cddl-1.1", "common development", f"common development and distribution license( cddl)? {_V}1 1", "cddl 1 1"),
    ("cddl-1.0", "common development", f"common development and distribution license( cddl)? {_V}1 0", "cddl 1 0"),
    ("cpl-1.0", "common public", f"common public license( {_V}1 0)?", "cpl 1 0"),
    ("isc", "isc", "isc license", "isc"),
    ("zlib", "zlib", "zlib( libpng)? license", "zlib"),
    ("libpng", "libpng", "libpng license", "libpng( 2 0)?"),
    ("bsl-1.0", "boost", f"boost software license( {_V}1 0)?", "bsl 1 0"),
    ("artistic-2.0", "artistic", f"artistic license {_V}2( 0)?", "artistic 2 0"),
    ("artistic-1.0", "artistic", f"artistic license {_V}1( 0)?", "artistic 1 0( perl)?"),
    ("artistic", "artistic", "artistic license", None),
    ("psf-2.0", "python", "python software foundation license( 2)?", "psf 2 0"),
    ("python-2.0", "python", f"python license( {_V}2( 0)?)?", "python 2 0"),
    ("php-3.01", "php", f"php license( {_V}3 01)?", "php 3 01"),
    ("ruby", "ruby", "ruby license", "ruby"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("wtfpl", "do what the", "do what the fuck you want to public license", None),
    ("unlicense", "unlicense", "(the )?unlicense", "unlicense"),
    ("cc0-1.0", "cc0", f"cc0( {_V}1 0)?( universal)?", "cc0 1 0"),
    ("cc0-1.0", "creative commons", f"creative commons zero( {_V}1 0)?( universal)?", None),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl"),
    ("eupl-1.2", "european union", f"european union public licen[cs]e {_V}1 2", "eupl 1 2"),
    ("eupl-1.1", "european union", f"european union public licen[cs]e {_V}1 1", "eupl 1 1"),
    ("ofl-1.1", "open font", f"(sil )?open font license( {_V}1 1)?", "ofl 1 1"),
    ("osl-3.0", "open software", f"open software license( {_V}3 0)?", "osl 3 0"),
    ("afl-3.0", "academic free", f"academic free license( {_V}3 0)?", "afl 3 0"),
    ("ecl-2.0", "educational community", f"educational community license( {_V}2 0)?", "ecl 2 0"),
    ("ncsa", "ncsa", "(university of illinois )?ncsa( open source)? license", "ncsa"),
    ("x11", "x11", "x11 license", "x11"),
    ("openssl", "openssl", "openssl license", "openssl"),
    ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql"),
    ("upl-1.0", "universal permissive", f"universal permissive license( {_V}1 0)?", "upl 1 0"),
    ("vim", "vim", "vim license", "vim"),
    ("w3c", "w3c", "w3c( software)?( notice and)? license", "w3c"),
    ("zpl-2.1", "zope", f"zope public license( {_V}2 1)?", "zpl 2 1"),
    ("odbl-1.0", "open database", f"open database license( {_V}1 0)?", "odbl 1 0"),
    ("odc-by-1.0", "open data", "open data commons attribution license", "odc by 1 0"),
    ("pddl-1.0", "public domain", "public domain dedication and license", "pddl 1 0"),
    ("sspl-1.0", "server side", f"server side public license( {_V}1)?", "sspl 1 0"),
    ("busl-1.1", "business source", f"business source license( {_V}1 1)?", "busl 1 1"),
    ("elastic-2.0", "elastic", f"elastic license( {_V}2( 0)?)?", "elastic 2 0"),
    ("openrail-m", "rail", "(creativeml )?open( )?rail m( license)?", None),
    ("llama", "llama", "llama( [0-9])? community license( agreement)?", None),
]
# the six Creative Commons kinds in their four numbered versions: words that follow "cc by", and those of the long name
CC_KINDS = {
    "by": ("by", "attribution"),
    "by-sa": ("by sa", "attribution share ?alike"),
    "by-nd": ("by nd", "attribution no ?deriv(atives|s)"),
    "by-nc": ("by nc", "attribution non ?commercial"),
    "by-nc-sa": ("by nc sa", "attribution non ?commercial share ?alike"),
    "by-nc-nd": ("by nc nd", "attribution non ?commercial no ?deriv(atives|s)"),
}
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
# single signs that speak of rights without naming a license
HINTS = [
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
    ("public-domain", "public domain", "(in|into|to) the public domain"),
    ("proprietary", "proprietary", "proprietary( and confidential)?( software)? license"),
    ("permission-notice", "permission is hereby granted", "permission is hereby granted free of charge"),
    ("redistribution", "redistribution and use", "redistribution and use in source and binary forms"),
    ("as-is", "warranty", "as is without warranty of any kind"),
    ("non-commercial", "non commercial", "non commercial use only"),
    ("see-license", "license", "see (the )?license( file)? for details"),
]
_UNDER = "(licensed|released|distributed|available|published|provided|covered|made available) under( the)?( terms of)?( the)?( gnu)?"
ROOTS = ["licen", "spdx", "rights reserved", "public domain", "wtfpl", "cc0", "cc by", "creative commons", "bsd", "permission", "redistribution", "warranty", "non commercial", "rail", "mit no attribution"]


def rules() -> list[tuple[str, str, str, str, int]]:
    """(keyword, second keyword, pattern, label, priority), best priority first. A match holds both keywords and a root."""
    out = []
    families = list(FAMILIES)
    for kind, (short, long) in CC_KINDS.items():
        for name, keyword in ((f"cc {short}", f"cc {short}"), (f"creative commons {long}( license)?", "creative commons")):
            for v in CC_VERSIONS:
                label = f"cc-{kind}-{v.replace(' ', '.')}"
                identifier = f"cc {short} {v}" if keyword != "creative commons" else None
                families.append((label, keyword, f"{name}( license)?( international)? {_V}{v}", identifier))
            families.append((f"cc-{kind}", keyword, f"{name}( license)?", None))
    for label, keyword, name, identifier in families:
        if identifier:
            word = re.match("[a-z0-9]+", identifier).group()
            out.append(("spdx", word, f"spdx license identifier {identifier}", label, TAG))
            out.append(("opensource", word, f"opensource org licenses? {identifier}", label, GRANT))
        out.append((keyword, "under", f"{_UNDER} {name}", label, GRANT))
        out.append((keyword, "", name, label, NAME))
    out += [(keyword, "", name, label, HINT) for label, keyword, name in HINTS]
    return sorted(out, key=lambda r: r[4])


def words_in(piece: Column) -> Column:
    """Blanks of a piece of the line: words that begin after its first."""
    return (F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))).cast("int")


def scan(docs: DataFrame, keep: dict[str, str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (new name: column), n_words, base (array of label, start, end), found (what the rules keep, with
    priority), for every row. Positions are words from 0; a null text is an empty one and has none.
    """
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), upper, lower)
    rows = docs.select(*(F.col(old).alias(new) for new, old in keep.items()), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"))
    rows = rows.withColumn("_line", F.array_join("_words", " "))
    line = F.col("_line")
    gate = F.lit(False)
    for root in ROOTS:
        gate = gate | F.contains(line, F.lit(root))
    kinds = "array<struct<start:int,end:int,priority:int,label:string>>"
    empty = F.array().cast(kinds)

    def found(pattern: Column, label: Column, priority: Column) -> Column:
        # names stand between blanks or ends of the line
        whole = F.concat(F.lit("(?<![^ ])(?:"), pattern, F.lit(")(?![^ ])"))
        return F.transform(
            match_spans(line, whole, words_in),
            lambda x: F.struct(x["s"].alias("start"), (x["e"] + 1).alias("end"), priority.alias("priority"), label.alias("label")),
        )

    base = F.concat(*(
        F.when(F.contains(line, F.lit(phrase)), found(F.lit(phrase), F.lit(label), F.lit(0))).otherwise(empty)
        for phrase, label in BASE.items()
    ))
    names = ("keyword", "second", "pattern", "label", "priority")
    listed = json.dumps([dict(zip(names, r)) for r in rules()])
    table = F.from_json(F.lit(listed), "array<struct<keyword:string,second:string,pattern:string,label:string,priority:int>>")
    gated = F.filter(table, lambda r: F.contains(line, r["keyword"]) & F.contains(line, r["second"]))
    every = F.flatten(F.transform(gated, lambda r: found(r["pattern"], r["label"], r["priority"])))
    # containers first: by start, then longest, then best priority
    order = F.array_sort(F.transform(every, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["priority"].alias("priority"), x["label"].alias("label"))))
    start = F.struct(*(F.lit(-1).alias(f"end{p}") for p in (TAG, GRANT, NAME)), empty.alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        end = -x["back"]
        inside = F.lit(False)
        for p in (TAG, GRANT, NAME):
            inside = inside | ((x["priority"] >= p) & (acc[f"end{p}"] >= end))
        one = F.array(F.struct(x["start"].alias("start"), end.alias("end"), x["priority"].alias("priority"), x["label"].alias("label")))
        ends = [F.when(x["priority"] == p, F.greatest(acc[f"end{p}"], end)).otherwise(acc[f"end{p}"]).alias(f"end{p}") for p in (TAG, GRANT, NAME)]
        return F.struct(*ends, F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], one)).alias("kept"))

    kept = F.aggregate(order, start, step, lambda acc: acc["kept"])
    return rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.when(gate, base).otherwise(empty).alias("base"),
        F.when(gate, kept).otherwise(empty).alias("found"),
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    ``score`` is the confidence of the best detection kept; of detections at one place the longest counts, then the one of the better
    priority. A null text is an empty one without places; a null id is kept; repeated rows are scanned each, and alike. Long texts are
    scanned whole. Other columns are not read, whatever their names. An empty table gives no rows.
    """
    rows = scan(docs, {"doc_id": id_col}, text_col)
    starts = F.transform("base", lambda x: x["start"].cast("long"))
    labels = lambda c: F.transform(c, lambda x: x["label"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    best = F.array_min(F.transform("found", lambda x: x["priority"]))
    sure = F.lit(0.0)
    for p, value in CONFIDENCE.items():
        sure = F.when(best == p, value).otherwise(sure)
    sure = F.greatest(sure, F.when(F.size("base") > 0, CONFIDENCE[NAME]).otherwise(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(labels("base")).alias("base_labels"),
        joined(F.concat(labels("base"), labels("found"))).alias("labels"),
        sure.alias("score"),
    )
