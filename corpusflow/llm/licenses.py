"""License scans by ordered signature rules.

A text is scanned in lower case with its white space collapsed to single spaces. An
Aho-Corasick pass over the rules' literal keywords tells which rules can match at all - every
text that a rule accepts has one of its keywords - and only their regular expressions run. Detections are then taken in order of priority, length and
place; one that overlaps a detection already taken - mostly one contained in it - is
suppressed, so "gnu lesser general public license" isn't also the plain license.

Rules come from three tables: licenses with their names, the phrases in which names stand,
and sentences that only a license's own text has. SPDX ids are looked up where they stand for a
license: after an identifier tag, there in whole expressions, and after "licensed under".
"""

from __future__ import annotations

import re
from bisect import bisect
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusflow.llm.common import id_text

# The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: An optional word before the number of a version.
_V = r",? (?:\(?(?:version|v\.?) ?)?"
#: label, keywords of which any text naming it has one (split by "|"), name as a regular expression.
LICENSES = (
    ("apache-1.1", "apache", rf"apache (?:software )?licen[sc]e{_V}1\.1|apache-1\.1"),
    ("apache-2.0", "apache", rf"apache (?:software )?licen[sc]e{_V}2(?:\.0)?|apache-2\.0|apache 2(?:\.0)?(?: licen[sc]e)?"),
    ("apache", "apache", r"apache (?:software )?licen[sc]e"),
    ("mit", "mit|expat", r"mit licen[sc]e|mit/x11 licen[sc]e|expat licen[sc]e"),
    ("mit-0", "mit", r"mit no attribution(?: licen[sc]e)?|mit-0"),
    ("x11", "x11", r"x11 licen[sc]e"),
    ("gpl-1.0", "general public|gpl", rf"(?:gnu )?general public licen[sc]e{_V}1(?:\.0)?|gpl-1\.0(?:-only|-or-later|\+)?"),
    ("gpl-2.0", "general public", rf"(?:gnu )?general public licen[sc]e{_V}2(?:\.0)?"),
    ("gpl-3.0", "general public", rf"(?:gnu )?general public licen[sc]e{_V}3(?:\.0)?"),
    ("gpl-2.0", "gpl", rf"(?:gnu )?gpl(?:[- ]?v?|{_V})2(?:\.0)?(?:-only|-or-later|\+)?"),
    ("gpl-3.0", "gpl", rf"(?:gnu )?gpl(?:[- ]?v?|{_V})3(?:\.0)?(?:-only|-or-later|\+)?"),
    ("gpl", "general public|gpl", r"(?:gnu )?general public licen[sc]e|gnu gpl"),
    ("lgpl-2.1", "lgpl", r"lgpl[- ]?v?2\.1(?:-only|-or-later|\+)?"),
    ("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public licen[sc]e{_V}2\.1"),
    ("lgpl-3.0", "lgpl", r"lgpl[- ]?v?3(?:\.0)?(?:-only|-or-later|\+)?"),
    ("lgpl-3.0", "lesser", rf"(?:gnu )?lesser general public licen[sc]e{_V}3(?:\.0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[sc]e"),
    ("lgpl-2.0", "library general", r"(?:gnu )?library general public licen[sc]e"),
    ("agpl-3.0", "affero", rf"(?:gnu )?affero general public licen[sc]e(?:{_V}3(?:\.0)?)?"),
    ("agpl-3.0", "agpl", r"agpl[- ]?v?3(?:\.0)?(?:-only|-or-later|\+)?"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified|2-clause|two-clause|freebsd) bsd licen[sc]e|bsd[- ]2[- ]clause(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(?:new|revised|modified|3-clause|three-clause) bsd licen[sc]e|bsd[- ]3[- ]clause(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", r"(?:original|4-clause|four-clause) bsd licen[sc]e|bsd[- ]4[- ]clause(?: licen[sc]e)?"),
    ("0bsd", "bsd", r"zero-clause bsd(?: licen[sc]e)?|0bsd"),
    ("bsd", "bsd", r"bsd(?:-style)? licen[sc]e"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("mpl-1.1", "mozilla", rf"mozilla public licen[sc]e{_V}1\.1"),
    ("mpl-2.0", "mozilla", rf"mozilla public licen[sc]e{_V}2(?:\.0)?"),
    ("mpl-2.0", "mpl", r"mpl[- ]?v?2(?:\.0)?"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("epl-1.0", "eclipse|epl", r"eclipse public licen[sc]e,? (?:(?:-|version|v\.?) ?)?(?:v ?)?1(?:\.0)?|epl-1\.0"),
    ("epl-2.0", "eclipse|epl", r"eclipse public licen[sc]e,? (?:(?:-|version|v\.?) ?)?(?:v ?)?2(?:\.0)?|epl-2\.0"),
    ("epl", "eclipse", r"eclipse public licen[sc]e"),
    ("cddl-1.0", "common development and distribution", r"common development and distribution licen[sc]e"),
    ("cpl-1.0", "common public", r"common public licen[sc]e"),
    ("cecill", "cecill", r"cecill(?:-[bc])?(?: licen[sc]e)?"),
    ("eupl-1.2", "european union public", r"european union public licen[sc]e"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e,? (?:version )?2(?:\.0)?|artistic-2\.0"),
    ("artistic", "artistic", r"artistic licen[sc]e"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e"),
    ("libpng", "libpng|png reference", r"(?:lib)?png reference library licen[sc]e|libpng licen[sc]e"),
    ("boost-1.0", "boost", r"boost software licen[sc]e(?:,? (?:-|version) ?(?:version )?1\.0)?"),
    ("unlicense", "unlicen", r"the unlicen[sc]e|unlicen[sc]e"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("cc0-1.0", "cc0", r"cc0(?:[- ]1\.0)?(?: universal)?"),
    ("cc-by-4.0", "cc", r"cc[- ]by[- ]4\.0"),
    ("cc-by-3.0", "cc", r"cc[- ]by[- ]3\.0"),
    ("cc-by-sa-4.0", "cc", r"cc[- ]by-sa[- ]4\.0"),
    ("cc-by-sa-3.0", "cc", r"cc[- ]by-sa[- ]3\.0"),
    ("cc-by-nc-4.0", "cc", r"cc[- ]by-nc[- ]4\.0"),
    ("cc-by-nc-sa-4.0", "cc", r"cc[- ]by-nc-sa[- ]4\.0"),
    ("cc-by-nd-4.0", "cc", r"cc[- ]by-nd[- ]4\.0"),
    ("cc-by-nc-nd-4.0", "cc", r"cc[- ]by-nc-nd[- ]4\.0"),
    ("cc-by", "creative commons", r"creative commons attribution(?: [0-9.]+)?(?: international| unported)? licen[sc]e"),
    ("cc-by-sa", "creative commons", r"creative commons attribution[- ]share ?-?alike(?: [0-9.]+)?(?: international| unported)? licen[sc]e"),
    ("cc-by-nc", "creative commons", r"creative commons attribution[- ]non-?commercial(?: [0-9.]+)?(?: international| unported)? licen[sc]e"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[sc]e(?:,? (?:version )?1\.1)?"),
    ("odbl-1.0", "open database", r"open database licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("php-3.01", "php", r"php licen[sc]e(?:,? (?:version )?3\.0?1)?"),
    ("psf-2.0", "python software foundation", r"python software foundation licen[sc]e"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa open source licen[sc]e"),
    ("ms-pl", "microsoft public", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[sc]e"),
    ("sspl-1.0", "server side public", r"server side public licen[sc]e"),
    ("busl-1.1", "business source", r"business source licen[sc]e(?:,? (?:version )?1\.1)?"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(?:,? (?:version )?2\.0)?"),
    ("afl-3.0", "academic free", r"academic free licen[sc]e"),
    ("osl-3.0", "open software", r"open software licen[sc]e"),
    ("upl-1.0", "universal permissive", r"universal permissive licen[sc]e"),
    ("blueoak-1.0.0", "blue oak", r"blue oak model licen[sc]e"),
    ("proprietary", "rights reserved", r"all rights reserved"),
    ("public-domain", "public domain", r"(?:in|to|into) the public domain"),
)
#: priority, phrase around a name: a grant outweighs a reference, a reference a bare name.
PHRASES = (
    (90, r"spdx-licen[sc]e-identifier ?: ?(?:{})"),
    (80, r"(?:licen[sc]ed|released|distributed|published|provided|available|redistributed)(?: to you)? under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:{})"),
    (70, r"(?:subject to|governed by|covered by|in accordance with) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:{})"),
    (60, r"(?:see|read|copy of|terms of) the (?:{})"),
    (40, r"(?:{})"),
)
#: SPDX ids (without -only, -or-later and +) and short names that "licensed under" may stand before, with their labels.
IDS = {i: i for i in (
    "0bsd", "afl-3.0", "agpl-3.0", "apache-1.1", "apache-2.0", "artistic-2.0", "blueoak-1.0.0", "bsd", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "busl-1.1",
    "cc-by-3.0", "cc-by-4.0", "cc-by-nc-4.0", "cc-by-nc-nd-4.0", "cc-by-nc-sa-4.0", "cc-by-nd-4.0", "cc-by-sa-3.0", "cc-by-sa-4.0", "cc0-1.0", "cddl-1.0", "cecill",
    "cpl-1.0", "elastic-2.0", "epl", "epl-1.0", "epl-2.0", "eupl-1.2", "gfdl", "gpl", "gpl-1.0", "gpl-2.0", "gpl-3.0", "isc", "lgpl", "lgpl-2.0", "lgpl-2.1", "lgpl-3.0",
    "libpng", "mit", "mit-0", "mpl", "mpl-1.1", "mpl-2.0", "ms-pl", "ms-rl", "ncsa", "odbl-1.0", "ofl-1.1", "openssl", "osl-3.0", "php-3.01", "postgresql", "psf-2.0",
    "ruby", "sspl-1.0", "unlicense", "upl-1.0", "wtfpl", "x11", "zlib")}
IDS |= {"agpl": "agpl-3.0", "artistic-1.0": "artistic", "artistic-1.0-perl": "artistic", "bsl-1.0": "boost-1.0", "cecill-2.0": "cecill", "cecill-2.1": "cecill",
        "cecill-b": "cecill", "cecill-c": "cecill", "gfdl-1.1": "gfdl", "gfdl-1.2": "gfdl", "gfdl-1.3": "gfdl", "libpng-2.0": "libpng", "mpl-1.0": "mpl"}
#: Ids that are programs as well: only "licensed under" names them as licenses.
PROGRAMS = {"libpng", "openssl", "postgresql", "ruby", "x11", "zlib"}
#: priority, keyword, expression with the ids as its group ``ids``.
ID_PHRASES = (
    (90, "spdx-licen", r"(?<!\w)spdx-licen[sc]e-identifier ?: ?(?P<ids>\(*[\w.+-]+\)*(?: (?:or|and|with) \(*[\w.+-]+\)*)*)"),
    (80, " under ", r"(?<!\w)(?P<verb>licen[sc]ed|released|distributed|published|provided|available|redistributed)(?: to you)? under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?P<ids>[\w.+-]+)"),
)
#: label, sentence of the license's own text (priority 75); its first words are the keyword.
SENTENCES = (
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", "permission to use, copy, modify, and/or distribute this software for any purpose"),
    ("isc", "permission to use, copy, modify, and distribute this software for any purpose"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software"),
    ("zlib", "this software is provided 'as-is', without any express or implied warranty"),
    ("boost-1.0", "permission is hereby granted, free of charge, to any person or organization"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the fuck you want to"),
    ("gpl", "this program is free software; you can redistribute it and/or modify"),
    ("gpl", "this program is free software: you can redistribute it and/or modify"),
    ("lgpl", "this library is free software; you can redistribute it and/or modify"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing, software distributed under the license"),
)
#: label, address of its text (priority 85).
ADDRESSES = (
    ("apache-2.0", "apache.org/licenses/license-2.0"),
    ("gpl", "gnu.org/licenses/gpl"),
    ("lgpl", "gnu.org/licenses/lgpl"),
    ("agpl-3.0", "gnu.org/licenses/agpl"),
    ("mit", "opensource.org/licenses/mit"),
    ("bsd", "opensource.org/licenses/bsd"),
    ("mpl-2.0", "mozilla.org/mpl/2.0"),
    ("cc-by-4.0", "creativecommons.org/licenses/by/4.0"),
    ("cc-by-sa-4.0", "creativecommons.org/licenses/by-sa/4.0"),
    ("cc-by-nc-4.0", "creativecommons.org/licenses/by-nc/4.0"),
    ("cc0-1.0", "creativecommons.org/publicdomain/zero/1.0"),
    ("unlicense", "unlicense.org"),
)

_WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@lru_cache(maxsize=1)
def rules() -> tuple[list[tuple[int, str, tuple[str, ...], re.Pattern]], ahocorasick.Automaton]:
    """The rules ``(priority, label, keywords, pattern)`` in order, and the automaton of their keywords.
    The last ones, with an empty label, find ids."""
    out = [(priority, label, tuple(key.split("|")), rf"(?<!\w){phrase.format(name)}(?!\w)") for priority, phrase in PHRASES for label, key, name in LICENSES]
    out += [(75, label, (" ".join(s.split()[:4]),), re.escape(s)) for label, s in SENTENCES]
    out += [(85, label, (a,), re.escape(a)) for label, a in ADDRESSES]
    out.sort(key=lambda r: -r[0])
    out = [(p, label, keys, re.compile(text)) for p, label, keys, text in [*out, *((p, "", (key,), text) for p, key, text in ID_PHRASES)]]
    words = ahocorasick.Automaton()
    for key in {key for r in out for key in r[2]}:
        words.add_word(key, key)
    words.make_automaton()
    return out, words


def _ids(m: re.Match) -> list[tuple[int, int, str]]:
    """``(start, end, label)`` of the known ids in a match: the first with the phrase before it, if it is the first word."""
    out = []
    for word in re.finditer(r"[\w.+-]+", m["ids"]):
        name = word[0].rstrip(".-")
        key = re.sub(r"(?:-only|-or-later|\+)\Z", "", name)
        if key in IDS and (key not in PROGRAMS or m.groupdict().get("verb", "licensed") in ("licensed", "licenced")):
            at = m.start("ids") + word.start()
            out.append((at if out or word.start() > 1 else m.start(), at + len(name), IDS[key]))
    return out


def detections(text: str) -> list[tuple[int, int, str, int]]:
    """``(start, end, label, priority)`` over the normalised text, in order of place; none overlap."""
    known, words = rules()
    text = " ".join(text.lower().split())
    keys = {key for _, key in words.iter(text)}
    if not keys:
        return []
    found = [(-p, start - end, start, k, name) for k, (p, label, own, pattern) in enumerate(known) if not keys.isdisjoint(own)
             for m in pattern.finditer(text) for start, end, name in ([(*m.span(), label)] if label else _ids(m))]
    taken: list[tuple[int, int, str, int]] = []  # disjoint, so sorted by start and by end alike
    for priority, size, start, _, label in sorted(found):
        i = bisect(taken, (start,))
        end = start - size
        if (i == 0 or taken[i - 1][1] <= start) and (i == len(taken) or taken[i][0] >= end):
            taken.insert(i, (start, end, label, -priority))
    return taken


def base_places(text: str) -> tuple[int, list[tuple[int, str]]]:
    """Number of words, and ``(word index, label)`` of each place of a base phrase."""
    words = text.encode().lower().translate(_WORD).split()
    joined, places = b" " + b" ".join(words) + b" ", []
    if b" license " in joined:
        for phrase, label in BASE:
            key, at = f" {phrase} ".encode(), -1
            last, index = 0, 0
            while (at := joined.find(key, at + 1)) >= 0:
                index += joined.count(b" ", last, at)
                last = at
                places.append((index, label))
    return len(words), sorted(places)


def _scan(batches):
    for batch in batches:
        columns: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
        for text in batch.column("text"):
            text = text.as_py()
            n, places = base_places(text)
            spans = detections(text)
            base = {label for _, label in places}
            columns["n_words"].append(n)
            columns["n_base"].append(len(places))
            columns["first_word"].append(places[0][0] if places else None)
            columns["last_word"].append(places[-1][0] if places else None)
            columns["base_labels"].append(",".join(sorted(base)))
            columns["labels"].append(",".join(sorted(base.union(label for _, _, label, _ in spans))))
            columns["score"].append(max([p / 100 for _, _, _, p in spans] + [0.4 * bool(places)]))
            columns["spans"].append([{"start": a, "end": b, "label": label, "priority": p} for a, b, label, p in spans])
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("priority", pa.int64())])
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(v, k) for v, k in zip(columns.values(), kinds)]], ["doc_id", *columns])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    ``n_base``: all places of the base phrases, ``first_word``/``last_word`` their least and
    greatest start (null for none). ``labels``: base labels and those of the rules, distinct,
    sorted, comma-joined; empty for none. ``score``: the highest priority found, by 100, 0.4 for
    a base phrase alone and 0 for nothing. ``spans``: detections in the text in lower case with
    white space collapsed. Null texts are empty; repeated rows each give a row.
    """
    rows = id_text(docs, id_col, text_col)
    schema = (f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              "score double, spans array<struct<start:long,end:long,label:string,priority:long>>")
    return rows.mapInArrow(_scan, schema)
