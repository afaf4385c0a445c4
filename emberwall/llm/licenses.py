"""License scan by ordered signature rules.

A rule has a hand-written pattern, a label and a rank. The literals that each
match must contain follow from the pattern. A text is tried against the rules
whose literals it contains, and only if it has one of the gate words, which
follow from the literals. Of two detections of which one's interval contains the
other's, the one of lower rank goes; at equal rank the contained one goes, and
of equal intervals the later rule's. Only DataFrame operations.
"""

from __future__ import annotations

from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import ascii_lower, match_spans, table

#: Ranks: an identifier line, a notice in full, a grant by name, a bare name, a hint; and how sure each makes.
IDENTIFIER, NOTICE, GRANT, NAME, HINT = range(1, 6)
SURE = {IDENTIFIER: 0.99, NOTICE: 0.97, GRANT: 0.95, NAME: 0.8, HINT: 0.3}

_V = r"(?:,?\s*(?:version|v|ver\.?)?\s*"  # an optional version, to be closed
_GRANTED = (r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|issued|offered|shared|governed)"
            r"\s+(?:to\s+\w+\s+)?(?:under|by|with)\s+(?:the\s+|a\s+|an\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+(?:the\s+)?)?")

# Names, identifiers and addresses of public licenses.
# label, name, SPDX identifier, address (None: none of its own)
FAMILIES = (
    ("mit", r"(?:mit|expat|x11)(?:[-/]x11)?", r"mit(?:-0)?", r"opensource\.org/licenses/mit"),
    ("apache-2.0", r"(?:apache|asl)(?:\s+software)?(?:\s+foundation)?(?:\s+licen[cs]e)?" + _V + r"2(?:\.0)?)",
     r"apache-2\.0", r"apache\.org/licenses/license-2\.0"),
    ("apache-1.1", r"apache(?:\s+software)?(?:\s+licen[cs]e)?" + _V + r"1\.[01])", r"apache-1\.[01]",
     r"apache\.org/licenses/license-1\.1"),
    ("gpl-2.0", r"(?:gnu\s+)?(?:general\s+public\s+licen[cs]e|gpl)" + _V + r"2(?:\.0)?)", r"gpl-2\.0(?:-only|-or-later|\+)?",
     r"gnu\.org/licenses/(?:old-licenses/)?gpl-2"),
    ("gpl-3.0", r"(?:gnu\s+)?(?:general\s+public\s+licen[cs]e|gpl)" + _V + r"3(?:\.0)?)", r"gpl-3\.0(?:-only|-or-later|\+)?",
     r"gnu\.org/licenses/gpl-3"),
    ("gpl", r"(?:gnu\s+)?(?:general\s+public\s+licen[cs]e|gpl)", r"gpl", r"gnu\.org/licenses/gpl"),
    ("lgpl-2.1", r"(?:gnu\s+)?(?:(?:lesser|library)\s+general\s+public\s+licen[cs]e|lgpl)" + _V + r"2(?:\.[01])?)",
     r"lgpl-2\.[01](?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2"),
    ("lgpl-3.0", r"(?:gnu\s+)?(?:lesser\s+general\s+public\s+licen[cs]e|lgpl)" + _V + r"3(?:\.0)?)",
     r"lgpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/lgpl-3"),
    ("lgpl", r"(?:gnu\s+)?(?:(?:lesser|library)\s+general\s+public\s+licen[cs]e|lgpl)", r"lgpl", r"gnu\.org/licenses/lgpl"),
    ("agpl-3.0", r"(?:gnu\s+)?(?:affero\s+general\s+public\s+licen[cs]e|agpl)(?:" + _V + r"3(?:\.0)?))?",
     r"agpl-(?:1|3)\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/agpl"),
    ("gfdl", r"(?:gnu\s+)?free\s+documentation\s+licen[cs]e", r"gfdl-1\.[123](?:-only|-or-later)?", r"gnu\.org/licenses/fdl"),
    ("bsd-2-clause", r"(?:2-clause|two-clause|simplified|freebsd)\s+bsd|bsd\s*(?:2-clause|two-clause|-2-clause)",
     r"bsd-2-clause(?:-\w+)?", r"opensource\.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", r"(?:3-clause|three-clause|new|revised|modified)\s+bsd|bsd\s*(?:3-clause|three-clause|-3-clause)",
     r"bsd-3-clause(?:-\w+)?", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", r"(?:4-clause|original|old)\s+bsd|bsd\s*4-clause", r"bsd-4-clause(?:-\w+)?", None),
    ("bsd", r"(?:berkeley|bsd)(?:-style)?", r"0bsd", r"opensource\.org/licenses/bsd-license"),
    ("mpl-2.0", r"(?:mozilla\s+public\s+licen[cs]e|mpl)" + _V + r"2(?:\.0)?)", r"mpl-2\.0(?:-\w+)*", r"mozilla\.org/mpl/2\.0"),
    ("mpl-1.1", r"(?:mozilla\s+public\s+licen[cs]e|mpl)" + _V + r"1\.[01])", r"mpl-1\.[01]", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    ("epl-2.0", r"(?:eclipse\s+public\s+licen[cs]e|epl)" + _V + r"2(?:\.0)?)", r"epl-2\.0", r"eclipse\.org/legal/epl-2\.0"),
    ("epl-1.0", r"(?:eclipse\s+public\s+licen[cs]e|epl)" + _V + r"1(?:\.0)?)", r"epl-1\.0", r"eclipse\.org/legal/epl-v10"),
    ("cddl", r"common\s+development\s+and\s+distribution\s+licen[cs]e|cddl", r"cddl-1\.[01]", r"opensource\.org/licenses/cddl"),
    ("cpl-1.0", r"common\s+public\s+licen[cs]e", r"cpl-1\.0", r"opensource\.org/licenses/cpl1"),
    ("isc", r"isc", r"isc", r"opensource\.org/licenses/isc"),
    ("zlib", r"zlib(?:/libpng)?", r"zlib(?:-\w+)?", r"opensource\.org/licenses/zlib"),
    ("boost-1.0", r"boost\s+software", r"bsl-1\.0", r"boost\.org/license_1_0"),
    ("artistic-2.0", r"(?:perl\s+)?artistic(?:\s+licen[cs]e)?(?:" + _V + r"[12](?:\.0)?))?",
     r"artistic-[12]\.0(?:-\w+)?", r"opensource\.org/licenses/artistic"),
    ("python-2.0", r"python(?:\s+software\s+foundation)?", r"(?:python-2\.0|psf-2\.0)(?:\.\d)?", r"docs\.python\.org/3/license"),
    ("php-3.0", r"php", r"php-3\.0[1]?", r"php\.net/license/3"),
    ("ruby", r"ruby", r"ruby", r"ruby-lang\.org/en/about/license"),
    ("postgresql", r"postgresql", r"postgresql", r"postgresql\.org/about/licen[cs]e"),
    ("openssl", r"openssl", r"openssl", r"openssl\.org/source/license"),
    ("unlicense", r"(?:the\s+)?unlicense", r"unlicense", r"unlicense\.org"),
    ("wtfpl", r"wtfpl", r"wtfpl", r"wtfpl\.net"),
    ("eupl", r"european\s+union\s+public\s+licen[cs]e|eupl", r"eupl-1\.[012]", r"joinup\.ec\.europa\.eu/\S*eupl"),
    ("ms-pl", r"microsoft\s+public\s+licen[cs]e|ms-pl", r"ms-pl", r"opensource\.org/licenses/ms-pl"),
    ("ms-rl", r"microsoft\s+reciprocal\s+licen[cs]e|ms-rl", r"ms-rl", r"opensource\.org/licenses/ms-rl"),
    ("osl-3.0", r"open\s+software\s+licen[cs]e|osl", r"osl-3\.0", r"opensource\.org/licenses/osl"),
    ("afl-3.0", r"academic\s+free\s+licen[cs]e|afl", r"afl-[23]\.[01]", r"opensource\.org/licenses/afl"),
    ("ofl-1.1", r"(?:sil\s+)?open\s+font\s+licen[cs]e|(?:sil\s+)?ofl", r"ofl-1\.[01](?:-\w+)?", r"scripts\.sil\.org/ofl"),
    ("cecill", r"cecill(?:-[bc])?", r"cecill-\w+(?:\.\w)?", r"cecill\.info"),
    ("qpl", r"q\s+public\s+licen[cs]e|qpl", r"qpl-1\.0", None),
    ("ncsa", r"(?:university\s+of\s+illinois(?:/ncsa)?|ncsa)(?:\s+open\s+source)?", r"ncsa", r"opensource\.org/licenses/ncsa"),
    ("json", r"json", r"json", r"json\.org/license"),
    ("ecl-2.0", r"educational\s+community", r"ecl-[12]\.0", r"opensource\.org/licenses/ecl"),
    ("upl-1.0", r"universal\s+permissive", r"upl-1\.0", r"opensource\.org/licenses/upl"),
    ("odbl", r"open\s+(?:database|data\s+commons\s+open\s+database)|odbl", r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by", r"(?:open\s+data\s+commons\s+attribution|odc-by)", r"odc-by-1\.0", r"opendatacommons\.org/licenses/by"),
    ("pddl", r"public\s+domain\s+dedication\s+and\s+licen[cs]e|pddl", r"pddl-1\.0", r"opendatacommons\.org/licenses/pddl"),
    ("sspl", r"server\s+side\s+public\s+licen[cs]e|sspl", r"sspl-1\.0", r"mongodb\.com/licensing/server-side-public"),
    ("busl-1.1", r"business\s+source", r"busl-1\.1", r"mariadb\.com/bsl"),
    ("elastic-2.0", r"elastic(?:\s+licen[cs]e)?(?:" + _V + r"2(?:\.0)?))?", r"elastic-2\.0", r"elastic\.co/licensing"),
)

# Creative Commons: its kinds, from which names, identifiers and addresses follow.
CREATIVE_COMMONS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
_CC_WORDS = {"by": "attribution", "sa": r"share\s*-?\s*alike", "nc": r"non\s*-?\s*commercial", "nd": r"no\s*-?\s*deriv(?:ative)?s?(?:\s+works)?"}

# Sentences of the licenses themselves and usual notices. pattern, label, rank
SENTENCES = (
    (r"permission is hereby granted, free of charge, to any person obtaining a copy", "mit", NOTICE),
    (r"permission to use, copy, modify,? and/?(?:or)? distribute this software (?:and its documentation )?for any purpose", "isc", NOTICE),
    (r"redistribution and use in source and binary forms, with or without\s+modification", "bsd", NOTICE),
    (r"neither the names? of .{1,80}? nor the names of its contributors may be used", "bsd-3-clause", NOTICE),
    (r"all advertising materials mentioning features or use of this software", "bsd-4-clause", NOTICE),
    (r"you may not use this file except in compliance with the licen[cs]e", "apache-2.0", NOTICE),
    (r"under the terms of the gnu (?:affero |lesser |library )?general public licen[cs]e as\s+published by the free software foundation", "gpl", NOTICE),
    (r"either version 3 of the license, or", "gpl-3.0", NOTICE),
    (r"either version 2 of the license, or", "gpl-2.0", NOTICE),
    (r"this source code form is subject to the terms of the mozilla public", "mpl-2.0", NOTICE),
    (r"this software is provided ['\"]as-is['\"], without any express or implied", "zlib", NOTICE),
    (r"permission is hereby granted, .{0,80}the software and accompanying documentation covered by this licen[cs]e", "boost-1.0", NOTICE),
    (r"this is free and unencumbered software released into the public domain", "unlicense", NOTICE),
    (r"do what the f\w+ you want to public licen[cs]e", "wtfpl", NOTICE),
    (r"(?:released|placed|dedicated|is|are)\s+(?:in(?:to)?|to)\s+the\s+public\s+domain", "public-domain", GRANT),
    (r"\bpublic\s+domain\b", "public-domain", NAME),
    (r"creativecommons\.org/publicdomain/zero", "cc0-1.0", IDENTIFIER),
    (r"\bcc0(?:[- ]1\.0)?\b", "cc0-1.0", NAME),
    (r"all rights reserved", "all-rights-reserved", NAME),
    (r"proprietary\s+(?:and\s+confidential|licen[cs]e|software)", "proprietary", NAME),
    (r"(?:strictly\s+)?confidential\s+and\s+proprietary", "proprietary", NAME),
    (r"trade secrets? of", "proprietary", NAME),
    (r"unauthorized copying of this file", "proprietary", NOTICE),
    (r"commercial\s+licen[cs]e\s+agreement", "commercial", NAME),
    (r"end[- ]user\s+licen[cs]e\s+agreement", "commercial", NAME),
    (r"for non-?commercial use only", "non-commercial", NAME),
    (r"for (?:academic|research) purposes only", "research-only", NAME),
    (r"copyright\s+(?:\(c\)|©|\d{4})", "copyright", HINT),
    (r"\bcopyleft\b", "copyleft", HINT),
    (r"\bdual[- ]licen[cs]ed\b", "dual", HINT),
    (r"\bopen\s+source\s+licen[cs]e\b", "open-source", HINT),
)


_PRODUCTS = 64
#: Literals that most texts have; a set with one of them tells little.
_COMMON = {"by", "the", "and", "of", " of", "in", "to"}


def _literals(parsed) -> tuple[set[str] | None, list[set[str]]]:
    """Of a parsed pattern: all it can match, if few, and sets of literals of which each match contains one."""
    runs, clauses, whole = {""}, [], True

    def close():
        if "" not in runs:
            clauses.append(set(runs))

    for op, value in parsed:
        exact, inner = None, []
        if op is _parser.LITERAL:
            exact = {chr(value)}
        elif op is _parser.IN and all(o is _parser.LITERAL for o, _ in value):
            exact = {chr(v) for _, v in value}
        elif op is _parser.SUBPATTERN:
            exact, inner = _literals(value[-1])
        elif op is _parser.BRANCH:
            parts = [_literals(x) for x in value[1]]
            if all(x is not None for x, _ in parts):
                exact = set().union(*(x for x, _ in parts))
            if all(c for _, c in parts):
                inner = [set().union(*(_telling(c)[0] for _, c in parts))]
        elif op in (_parser.AT, _parser.ASSERT, _parser.ASSERT_NOT):
            exact = {""}
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT, _parser.POSSESSIVE_REPEAT) and value[0] > 0:
            inner = _literals(value[2])[1]
        if exact is not None and len(runs) * len(exact) <= _PRODUCTS:
            runs = {x + y for x in runs for y in exact}
            continue
        close()
        clauses += inner
        runs, whole = {""}, False
    close()
    return (runs if whole else None), clauses


def _telling(clauses: list[set[str]]) -> list[set[str]]:
    """The sets, those of longer literals first, and of common words last."""
    return sorted(clauses, key=lambda c: (bool(c & _COMMON), -min(map(len, c)), len(c), sorted(c)))


def needed(pattern: str) -> list[tuple[str, ...]]:
    """Sets of literals: each match of the pattern contains one of every set; the most telling set first."""
    clauses = [{x for x in c if not any(y != x and y in x for y in c)} for c in _literals(_parser.parse(pattern))[1]]
    return [tuple(sorted(c)) for c in _telling(clauses) if min(map(len, c)) > 1]


def rules() -> list[tuple[str, str, str, int]]:
    """(keywords, pattern, label, rank) of all rules, in order; patterns are for lower-cased text.

    The keywords, joined by ``|``, are the most telling of the sets of ``needed``.
    """
    out = []
    for label, name, spdx, address in FAMILIES:
        out.append((rf"spdx-license-identifier:\s*\(?(?:[\w.+-]+\s+(?:or|and|with)\s+)*{spdx}(?![\w.-])", label, IDENTIFIER))
        if address:
            out.append((address, label, NOTICE))
        out.append((rf"{_GRANTED}(?:{name})(?![\w-])(?:\s+licen[cs]e)?", label, GRANT))
        out.append((rf"(?<![\w-])(?:{name})(?![\w-])\s*[-,]?\s*licen[cs]ed?\b", label, NAME))
    for kind in CREATIVE_COMMONS:
        words = r"[\s-]+".join(_CC_WORDS[x] for x in kind.split("-"))
        version = r"(?:[\s-]*[1-4]\.0)?"
        short = rf"cc[\s-]+{kind.replace('-', '[ -]')}(?![\w-]*[ -](?:sa|nc|nd)\b){version}"
        long = rf"(?:creative\s+commons|cc)[\s-]+{words}(?![\s-]*(?:share|non|no\b|no-?deriv))(?:\s+\d\.\d)?"
        out += [(rf"spdx-license-identifier:\s*cc-{kind}-[1-4]\.0", f"cc-{kind}", IDENTIFIER),
                (rf"creativecommons\.org/licenses/{kind}/", f"cc-{kind}", NOTICE),
                (rf"{_GRANTED}(?:{short}|{long})", f"cc-{kind}", GRANT),
                (rf"(?<![\w-]){short}(?![\w-])", f"cc-{kind}", NAME),
                (rf"\b{long}", f"cc-{kind}", NAME)]
    return [("|".join(needed(x[0])[0]), *x) for x in (*out, *SENTENCES)]


#: Parts that many keywords share; a text with the keyword has the part too, so the gate needs the part only.
_STEMS = ("licen", "spdx", "creativecommons", "opensource.org", "opendatacommons.org", "gnu.org", "proprietary", "public domain")
#: Any rule's match contains one of these: every keyword, or its stem.
GATE = tuple(sorted({next((s for s in _STEMS if s in w), w) for r in rules() for w in r[0].split("|")}))


_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]++"
#: The same of text that is not lower-cased yet.
_ANY_CASE_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]++"
_DETECTION = "array<struct<start:int,end:int,label:string,rank:int,rule:int>>"


def _places(text: Column, rule: Column) -> Column:
    """Intervals of a rule's matches."""
    return F.transform(match_spans(text, rule["pattern"]), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), rule["label"].alias("label"), rule["rank"].alias("rank"),
        rule["rule"].alias("rule")))


def _unsuppressed(found: Column) -> Column:
    def beaten(d):
        def by(e):
            over, under = (e["start"] <= d["start"]) & (e["end"] >= d["end"]), (e["start"] >= d["start"]) & (e["end"] <= d["end"])
            return (e["rule"] != d["rule"]) & (((over | under) & (e["rank"] < d["rank"]))
                                               | (over & (e["rank"] == d["rank"]) & (~under | (e["rule"] < d["rule"]))))
        return F.exists(found, by)

    return F.filter(found, lambda d: ~beaten(d))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``licenses`` = struct(n_words, base, detections).

    ``base`` lists the places of the three fixed phrases as (start word,
    label); ``detections`` the rules' (start, end, label, rank, rule) in code
    points, end exclusive, by start. A null text is empty; texts without any
    have empty lists. Repeated rows repeat, an empty table stays empty, and
    columns of ``docs`` keep their names and values.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # lower-cased once for all the gate words
    loose = F.col("__loose")
    gate = loose.contains(GATE[0])
    for word in GATE[1:]:
        gate = gate | loose.contains(word)
    all_rules = rules()
    sets = [needed(p) for _, p, _, _ in all_rules]
    literals = sorted({w for c in sets for x in c for w in x})
    at = {w: i for i, w in enumerate(literals)}
    table_of_rules = F.array(*[
        F.struct(F.array(*[F.array(*[F.lit(at[w]) for w in x]) for x in c]).alias("needed"), F.lit(p).alias("pattern"),
                 F.lit(label).alias("label"), F.lit(rank).alias("rank"), F.lit(n).alias("rule"))
        for n, (c, (_, p, label, rank)) in enumerate(zip(sets, all_rules, strict=True))])
    table_of_literals = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in enumerate(literals)])
    # beyond the gate `__low` is null, and so is all that follows from it
    step = docs.withColumn("__loose", F.lower(body)).withColumns({"__low": F.when(gate, ascii_lower(body)),
                             "__n": F.regexp_count(body, F.lit(_ANY_CASE_WORD)).cast("long")})
    low = F.col("__low")
    step = step.withColumns({
        "__words": F.when(low.contains("license"), F.regexp_extract_all(low, F.lit(_WORD), F.lit(0))),
        # each literal is looked for once, whatever the number of rules that need it
        "__has": F.when(low.isNotNull(), F.transform(
            F.filter(table_of_literals, lambda x: low.contains(x["w"])), lambda x: x["i"]))})
    # named twice, `__has` stays a column of its own; inside the lambda alone it would be made anew for each rule
    step = step.withColumn("__found", F.when(F.size("__has") > 0, F.flatten(F.transform(
        F.filter(table_of_rules, lambda r: F.forall(r["needed"], lambda c: F.arrays_overlap(c, F.col("__has")))),
        lambda r: _places(low, r)))))
    words = F.col("__words")

    def phrase(w, i):
        before, first = F.get(words, i - 1), F.get(words, i - 2)
        return F.when(w == "license", F.when(before.isin("mit", "apache"), F.struct((i - 1).alias("start"), before.alias("label")))
                      .when((before == "public") & (first == "general"),
                            F.struct((i - 2).alias("start"), F.lit("gpl").alias("label"))))

    base = F.coalesce(F.filter(F.transform(words, phrase), lambda x: x.isNotNull()),
                      F.array().cast("array<struct<start:int,label:string>>"))
    found = F.coalesce(F.sort_array(_unsuppressed(F.col("__found"))), F.array().cast(_DETECTION))
    return step.withColumn("licenses", F.struct(F.col("__n").alias("n_words"), base.alias("base"), found.alias("detections"))
                           ).drop("__loose", "__low", "__n", "__words", "__has", "__found")


def _joined(labels: Column) -> Column:
    return F.array_join(F.sort_array(F.array_distinct(labels)), ",")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed phrases and rule detections in all documents."""
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, found = F.col("licenses.base"), F.col("licenses.detections")
    starts, sure = F.transform(base, lambda x: x["start"]), F.array(*[F.lit(SURE[r]) for r in sorted(SURE)])
    doubt = F.aggregate(found, F.lit(1.0), lambda a, d: a * (1 - F.get(sure, d["rank"] - 1)))
    doubt = doubt * F.pow(F.lit(1 - SURE[GRANT]), F.size(base))
    return out.select(
        "doc_id", "licenses.n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        _joined(F.transform(base, lambda x: x["label"])).alias("base_labels"),
        _joined(F.concat(F.transform(base, lambda x: x["label"]), F.transform(found, lambda x: x["label"]))).alias("labels"),
        F.greatest(F.lit(0.0), 1 - doubt).alias("score"),
        F.array_join(F.transform(found, lambda d: F.concat_ws(":", d["label"], d["start"], d["end"])), ",").alias("detections"))


QUERIES = {"op7_license_scan": op7_license_scan}
ORACLE = {}
