"""License scans: ordered signature rules behind a keyword filter."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from reviewloom.llm.batches import add_columns

#: Phrases that always count, with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Label, short code, and name of each license over normal words, as regexes.
LICENSES = [
    ("mit", "mit", "(?:mit|expat) licen[sc]e"),
    ("apache-1.1", "apache 1 1", "apache (?:software )?licen[sc]e (?:version |v)?1 1"),
    ("apache-2", "apache 2(?: 0)?", "apache (?:software )?licen[sc]e (?:version |v)?2(?: 0)?"),
    ("gpl-2", "gpl(?: 2 0|v2| v2)(?: only)?", "(?:gnu )?(?:general public licen[sc]e|gpl) (?:version |v)2(?: 0)?"),
    ("gpl-2-or-later", "gpl 2 0 or later", "(?:gnu )?general public licen[sc]e .{0,80}?version 2(?: of the licen[sc]e)? or (?:at your option )?any later version"),
    ("gpl-3", "gpl(?: 3 0|v3| v3)(?: only)?", "(?:gnu )?(?:general public licen[sc]e|gpl) (?:version |v)3(?: 0)?"),
    ("gpl-3-or-later", "gpl 3 0 or later", "(?:gnu )?general public licen[sc]e .{0,80}?version 3(?: of the licen[sc]e)? or (?:at your option )?any later version"),
    ("lgpl-2", "lgpl(?: 2 0|v2| v2)", "(?:gnu )?(?:library|lesser) general public licen[sc]e (?:version |v)2(?: 0)?"),
    ("lgpl-2.1", "lgpl(?: 2 1|v2 1| v2 1)", "(?:gnu )?lesser general public licen[sc]e (?:version |v)2 1"),
    ("lgpl-3", "lgpl(?: 3 0|v3| v3)", "(?:gnu )?lesser general public licen[sc]e (?:version |v)3(?: 0)?"),
    ("agpl-3", "agpl(?: 3 0|v3| v3)", "(?:gnu )?affero general public licen[sc]e(?: (?:version |v)3(?: 0)?)?"),
    ("gfdl", "gfdl(?: 1 [123])?", "gnu free documentation licen[sc]e"),
    ("bsd-2", "bsd 2 clause", "(?:simplified|2 clause|two clause|freebsd) (?:bsd )?licen[sc]e"),
    ("bsd-3", "bsd 3 clause", "(?:new|modified|revised|3 clause|three clause) bsd licen[sc]e"),
    ("bsd-4", "bsd 4 clause", "(?:original|4 clause|four clause) bsd licen[sc]e"),
    ("bsd", "bsd", "bsd (?:style )?licen[sc]e"),
    ("mpl-1.1", "mpl 1 1", "mozilla public licen[sc]e (?:version |v)?1 1"),
    ("mpl-2", "mpl 2 0", "mozilla public licen[sc]e (?:version |v)?2(?: 0)?"),
    ("epl-1", "epl 1 0", "eclipse public licen[sc]e (?:version |v)?1(?: 0)?"),
    ("epl-2", "epl 2 0", "eclipse public licen[sc]e (?:version |v)?2(?: 0)?"),
    ("cddl", "cddl(?: 1 [01])?", "common development and distribution licen[sc]e"),
    ("cpl", "cpl 1 0", "common public licen[sc]e"),
    ("eupl", "eupl(?: 1 [12])?", "european union public licen[sc]e"),
    ("isc", "isc", "isc licen[sc]e"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
    ("boost", "bsl 1 0", "boost software licen[sc]e"),
    ("artistic", "artistic [12] 0", "artistic licen[sc]e"),
    ("unlicense", "unlicense", "the unlicense"),
    ("wtfpl", "wtfpl", "do what the f\\w+ you want to public licen[sc]e"),
    ("ofl", "ofl 1 1", "(?:sil )?open font licen[sc]e"),
    ("openssl", "openssl", "openssl licen[sc]e"),
    ("php", "php 3 01?", "php licen[sc]e"),
    ("python", "psf 2 0|python 2 0", "python (?:software foundation )?licen[sc]e"),
    ("ruby", "ruby", "ruby licen[sc]e"),
    ("postgresql", "postgresql", "postgresql licen[sc]e"),
    ("ms-pl", "ms pl", "microsoft public licen[sc]e"),
    ("w3c", "w3c", "w3c (?:software (?:notice and )?)?licen[sc]e"),
    ("odbl", "odbl 1 0", "open (?:data commons )?(?:open )?database licen[sc]e"),
    ("cc0", "cc0(?: 1 0)?", "(?:creative commons (?:zero|cc0)|cc0)(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc by(?: [1234] [05])?(?! (?:nc|nd|sa))", "creative commons attribution(?: [1234] [05])?(?! (?:non|no |share))"),
    ("cc-by-sa", "cc by sa(?: [1234] [05])?", "creative commons attribution share ?alike(?: [1234] [05])?"),
    ("cc-by-nd", "cc by nd(?: [1234] [05])?", "creative commons attribution no ?deriv\\w*(?: [1234] [05])?"),
    ("cc-by-nc", "cc by nc(?: [1234] [05])?(?! (?:nd|sa))", "creative commons attribution non ?commercial(?: [1234] [05])?(?! (?:no|share))"),
    ("cc-by-nc-sa", "cc by nc sa(?: [1234] [05])?", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?"),
    ("cc-by-nc-nd", "cc by nc nd(?: [1234] [05])?", "creative commons attribution non ?commercial no ?deriv\\w*(?: [1234] [05])?"),
]

LICENSE = ["license", "licence"]

#: Words of which every match of a name holds one, where that is not LICENSE.
NAME_KEYWORDS = {
    "gpl-2": [*LICENSE, "gpl"],
    "gpl-3": [*LICENSE, "gpl"],
    "unlicense": ["unlicense"],
    "cc0": ["creative", "cc0"],
    "cc-by": ["creative"],
    "cc-by-sa": ["creative"],
    "cc-by-nd": ["creative"],
    "cc-by-nc": ["creative"],
    "cc-by-nc-sa": ["creative"],
    "cc-by-nc-nd": ["creative"],
}

#: Forms in which a license is stated, most telling first: regex, keywords, score.
#: NAME and CODE stand for a license's own; keywords are words of which a text must hold one, and
#: None stands for those of the license's name.
FORMS = [
    ("spdx licen[sc]e identifier (?:CODE)", ["spdx"], 1.0),
    (
        "(?:licen[sc]ed|released|distributed|published|provided|available|redistribute it)(?: and or modify it)? "
        "under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:NAME)",
        None,
        1.0,
    ),
    ("under (?:the )?(?:terms of )?(?:the )?(?:NAME)", None, 0.95),
    ("licen[sc]ed under (?:the )?(?:CODE)(?: licen[sc]e)?", ["licensed", "licenced"], 0.95),
    ("licen[sc]e (?:CODE)", LICENSE, 0.85),
    ("(?:NAME)", None, 0.7),
]

LATER = "of the licen[sc]e or at your option any later version"
PUBLISHED = "as published by the free software foundation"

#: Sentences of notices and license texts themselves: label, regex, keywords, score.
NOTICES = [
    ("gpl-2-or-later", f"gnu general public licen[sc]e {PUBLISHED} either version 2 {LATER}", ["foundation"], 1.0),
    ("gpl-3-or-later", f"gnu general public licen[sc]e {PUBLISHED} either version 3 {LATER}", ["foundation"], 1.0),
    ("lgpl-2.1-or-later", f"gnu lesser general public licen[sc]e {PUBLISHED} either version 2 1 {LATER}", ["lesser"], 1.0),
    ("lgpl-3-or-later", f"gnu lesser general public licen[sc]e {PUBLISHED} either version 3 {LATER}", ["lesser"], 1.0),
    ("agpl-3-or-later", f"gnu affero general public licen[sc]e {PUBLISHED} either version 3 {LATER}", ["affero"], 1.0),
    ("gpl-2", f"gnu general public licen[sc]e (?:version 2 )?{PUBLISHED}(?: version 2)?(?: of the licen[sc]e)?(?! (?:either|version 3))", ["foundation"], 0.9),
    ("apache-2", "licen[sc]ed under the apache licen[sc]e version 2 0 the licen[sc]e", ["apache"], 1.0),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis", ["applicable"], 0.9),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public licen[sc]e version 1 1", ["mozilla"], 1.0),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0", ["mozilla"], 1.0),
    ("epl-2", "accompanying materials are made available under the terms of the eclipse public licen[sc]e (?:v|version )2 0", ["eclipse"], 1.0),
    ("cddl", "subject to the terms of the common development and distribution licen[sc]e", ["development"], 1.0),
    ("bsd-4", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", ["advertising"], 0.95),
    ("bsd-3", "neither the name of .{1,120}? nor the names of (?:its|their) contributors may be used to endorse or promote products derived from this software", ["endorse"], 0.95),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ["redistributions"], 0.9),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", ["redistributions"], 0.9),
    ("boost", "granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e", ["organization"], 1.0),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software", ["liable"], 0.95),
    ("postgresql", "without fee and without a written agreement is hereby granted provided that the above copyright notice", ["fee"], 0.95),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered"], 1.0),
    ("cc0", "has waived all copyright and related or neighbou?ring rights", ["waived"], 1.0),
    ("cc", "you are free to share copy and redistribute the material in any medium or format", ["redistribute"], 0.8),
    ("cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same licen[sc]e as the original", ["remix"], 0.85),
    ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material", ["remix"], 0.85),
    ("ofl", "this font software is licen[sc]ed under the sil open font licen[sc]e", ["font"], 1.0),
    ("eula", "end user licen[sc]e agreement", ["agreement"], 0.9),
    ("eula", "by installing copying or otherwise using (?:the|this) software(?: product)? you agree to be bound by the terms", ["installing"], 0.95),
    ("eula", "you (?:may|shall|must) not reverse engineer decompile or disassemble", ["decompile"], 0.85),
    ("proprietary", "unauthori[sz]ed copying of this file via any medium is strictly prohibited", ["prohibited"], 0.95),
]

#: Single rules: label, regex, keywords, score.
SINGLE = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ["granted"], 1.0),
    ("mit", "opensource org licenses mit", ["opensource"], 0.9),
    ("apache-2", "(?:www )?apache org licenses license 2 0", ["apache"], 0.95),
    ("apache-2", "you may not use this file except in compliance with the licen[sc]e", ["compliance"], 0.9),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution"], 0.95),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", ["permission"], 0.95),
    ("gpl", "(?:gnu )?general public licen[sc]e|gnu gpl|gplv[123]", ["public", "gpl", "gplv1", "gplv2", "gplv3"], 0.6),
    ("lgpl", "(?:library|lesser) general public licen[sc]e|gnu lgpl", ["lesser", "library", "lgpl"], 0.65),
    ("mpl", "mozilla public licen[sc]e", ["mozilla"], 0.6),
    ("apache", "apache (?:software )?licen[sc]e", ["apache"], 0.6),
    ("cc-by-nc", "cc by nc(?! (?:nd|sa))", ["cc"], 0.8),
    ("cc-by-sa", "cc by sa", ["cc"], 0.8),
    ("cc-by-nd", "cc by nd", ["cc"], 0.8),
    ("cc-by-nc-sa", "cc by nc sa", ["cc"], 0.85),
    ("cc-by-nc-nd", "cc by nc nd", ["cc"], 0.85),
    ("cc", "creativecommons org licen[sc]es by(?: n[cd])?(?: (?:sa|nd))? [1234] [05]", ["creativecommons"], 0.8),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", ["domain"], 0.8),
    ("proprietary", "all rights reserved", ["reserved"], 0.5),
    ("proprietary", "proprietary and confidential", ["proprietary"], 0.8),
]


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    keywords: frozenset[bytes]
    score: float


def _rule(label: str, pattern: str, keywords: list[str], score: float) -> Rule:
    whole = f"(?<![^ ])(?:{pattern})(?![^ ])".encode()
    return Rule(label, re.compile(whole), frozenset(k.encode() for k in keywords), score)


def rules() -> list[Rule]:
    """Some 320 rules in order of priority: notices, each form for each license, then the single ones."""
    made = [_rule(*r) for r in NOTICES]
    made += [
        _rule(
            label,
            form.replace("NAME", name).replace("CODE", code),
            NAME_KEYWORDS.get(label, LICENSE) if keywords is None else keywords,
            score,
        )
        for form, keywords, score in FORMS
        for label, code, name in LICENSES
    ]
    return made + [_rule(*single) for single in SINGLE]


#: Lower-cases A-Z; every other ASCII character but letters and digits becomes a space.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


class Scanner:
    def __init__(self):
        self.by_keyword: dict[bytes, list[int]] = defaultdict(list)
        self.rules = rules()
        for i, rule in enumerate(self.rules):
            for word in rule.keywords:
                self.by_keyword[word].append(i)
        self.base = [(f" {p} ".encode(), len(p.split()), label) for p, label in BASE.items()]
        self.gate = {*self.by_keyword, *(p.split()[-1].encode() for p in BASE), b"2"}

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int, int, float, bool]]]:
        """Number of words, and (label, first word, word after the last, score, base) of detections."""
        words = text.translate(NORMAL).split()
        if self.gate.isdisjoint(words):
            return len(words), []
        joined = b" " + b" ".join(words) + b" "
        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)  # the i-th stands before word i
        found = []
        for phrase, n, label in self.base:
            at = joined.find(phrase)
            while at >= 0:
                start = int(np.searchsorted(spaces, at))
                found.append((label, start, start + n, 1.0, True))
                at = joined.find(phrase, at + 1)
        present = self.by_keyword.keys() & set(words)
        ordered = sorted({i for word in present for i in self.by_keyword[word]})
        kept = np.zeros((0, 2), np.int64)  # accepted spans by start
        reach = kept[:, 1]  # the furthest end so far
        for i in ordered:  # in order of priority: a place inside an accepted one adds nothing
            rule = self.rules[i]
            spans = [m.span() for m in rule.pattern.finditer(joined, 1, len(joined) - 1)]
            if not spans:
                continue
            own = np.array(spans, np.int64)
            before = np.searchsorted(kept[:, 0], own[:, 0], side="right")
            own = own[(before == 0) | (reach[before - 1] < own[:, 1])] if len(kept) else own
            if not len(own):
                continue
            first, last = np.searchsorted(spaces, own[:, 0]) - 1, np.searchsorted(spaces, own[:, 1])
            found += [(rule.label, x, y, rule.score, False) for x, y in zip(first.tolist(), last.tolist())]
            kept = np.concatenate([kept, own])
            kept = kept[np.argsort(kept[:, 0], kind="stable")]
            reach = np.maximum.accumulate(kept[:, 1])
        return len(words), sorted(found, key=lambda d: (d[1], -d[2], d[0], not d[4]))


DETECTION = StructType(
    [
        StructField("label", StringType()),
        StructField("start", LongType()),
        StructField("end", LongType()),
        StructField("score", DoubleType()),
        StructField("base", BooleanType()),
    ]
)

_scanner: list[Scanner] = []


def scan_licenses(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words`` and ``detections``: label, word span, score and whether it is a base phrase.

    Words are runs of digits, letters and non-ASCII characters; A-Z count as a-z. Rules run only on
    texts that hold one of their keywords, in order of priority; a detection inside an accepted one
    is dropped, equal spans included. Base phrases are always reported, all their places. The
    detections of a text are ordered by place. A null or empty text has 0 words and no detections.
    Whole texts are read, without a shuffle, in time that grows with the text and its detections;
    repeated rows give equal results, an empty table none. Columns with the new names are replaced.
    """

    def make():
        if not _scanner:
            _scanner.append(Scanner())
        scan, kind = _scanner[0].scan, pa.list_(
            pa.struct(
                [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]
            )
        )
        names = DETECTION.fieldNames()

        def compute(texts: pa.Array) -> list[pa.Array]:
            n, found = [], []
            for t in texts.cast(pa.binary()).to_pylist():
                words, detections = scan(t or b"")
                n.append(words)
                found.append([dict(zip(names, d)) for d in detections])
            return [pa.array(n, pa.int64()), pa.array(found, kind)]

        return compute

    fields = [StructField("n_words", LongType()), StructField("detections", ArrayType(DETECTION))]
    return add_columns(df, [text], fields, make)
