"""Notices with an example and a near miss each, a plain scan of all rules, and very long texts."""

import random
import re
import time

import pytest

from reviewloom.llm import licenses
from reviewloom.llm.licenses import LICENSES, NORMAL, Scanner

PUBLISHED = "License as published by the Free Software Foundation"
LATER = "of the License, or (at your option) any later version."
EXAMPLES = [
    ("gpl-2-or-later", f"GNU General Public {PUBLISHED}; either version 2 {LATER}", "either version 2 or", "neither version nor"),
    ("gpl-3-or-later", f"GNU General Public {PUBLISHED}, either version 3 {LATER}", "any later version", "no later version"),
    ("lgpl-2.1-or-later", f"GNU Lesser General Public {PUBLISHED}; either version 2.1 {LATER}", "at your option", "at my option"),
    ("lgpl-3-or-later", f"GNU Lesser General Public {PUBLISHED}; either version 3 {LATER}", "either", "neither"),
    ("agpl-3-or-later", f"GNU Affero General Public {PUBLISHED}, either version 3 {LATER}", "version 3 of", "version 3 beside"),
    ("apache-2", "software distributed under the License is distributed on an AS IS BASIS".replace("software", "Unless required by applicable law or agreed to in writing, software"), "applicable law", "applicable lore"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "v. 2.0", "v. 9"),
    ("mpl-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1", "1.1", "7.1"),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0", "Eclipse Public License v2.0", "Eclipse Public House v2.0"),
    ("cddl", "subject to the terms of the Common Development and Distribution License", "Common Development", "Uncommon Development"),
    ("bsd-4", "All advertising materials mentioning features or use of this software must display the following acknowledgement", "must display", "may display"),
    ("bsd-3", "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software", "may be used", "may be sung"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "must retain", "need not retain"),
    ("boost", "granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "covered by", "praised by"),
    ("zlib", "In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software", "held liable", "held high"),
    ("postgresql", "without fee, and without a written agreement is hereby granted, provided that the above copyright notice", "without fee", "with a fee"),
    ("unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered", "encumbered"),
    ("cc0", "Ann has waived all copyright and related or neighboring rights", "waived", "kept"),
    ("cc", "You are free to share, copy and redistribute the material in any medium or format", "in any medium", "in one medium"),
    ("cc-by-sa", "If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original.", "must distribute", "may keep"),
    ("cc-by-nd", "If you remix, transform, or build upon the material, you may not distribute the modified material.", "may not", "may"),
    ("ofl", "This Font Software is licensed under the SIL Open Font License", "SIL Open Font License", "SIL Open Font"),
    ("eula", "END-USER LICENSE AGREEMENT", "AGREEMENT", "TABLE"),
    ("eula", "By installing, copying, or otherwise using the software you agree to be bound by the terms", "agree", "decline"),
    ("eula", "You may not reverse engineer, decompile, or disassemble", "decompile", "compile"),
    ("proprietary", "Unauthorized copying of this file, via any medium, is strictly prohibited", "strictly prohibited", "warmly welcomed"),
]
SCAN = Scanner().scan


@pytest.mark.parametrize("label, example, part, other", EXAMPLES)
def test_examples_and_near_misses(label, example, part, other):
    assert label in {d[0] for d in SCAN(f"before {example} after".encode())[1]}
    miss = example.replace(part, other)
    if miss != example:
        whole = " ".join(example.encode().translate(NORMAL).decode().split())
        spans = [d for d in SCAN(miss.encode())[1] if d[0] == label and d[2] - d[1] == len(whole.split())]
        assert not spans


def plain(text):
    """The rules tried one by one on every text, without keywords, words counted from the start each time."""
    words = text.translate(NORMAL).split()
    joined = b" " + b" ".join(words) + b" "
    found, kept = [], []
    for phrase, label in licenses.BASE.items():
        n = len(phrase.split())
        found += [(label, i, i + n, 1.0, True) for i in range(len(words)) if b" ".join(words[i : i + n]) == phrase.encode()]
    for rule in licenses.rules():
        for m in rule.pattern.finditer(joined, 1, len(joined) - 1):
            a, z = m.span()
            if not any(x <= a and z <= y for x, y in kept):
                kept.append((a, z))
                start = joined[:a].count(b" ") - 1
                found.append((rule.label, start, start + joined[a:z].count(b" ") + 1, rule.score, False))
    return len(words), sorted(found, key=lambda d: (d[1], -d[2], d[0], not d[4]))


@pytest.mark.parametrize("seed", range(8))
def test_scan_equals_plain_rules(seed):
    rng = random.Random(seed)
    parts = [e for _, e, _, _ in EXAMPLES] + list(licenses.BASE) + ["under the", "license", "version 2", "gpl", "cc by nc sa 4.0", "MIT", "released under the terms of the"]
    parts += [re.sub(r"\(\?[:!][^()]*\)\??|[\\?]|\[sc\]|\.\{0,80\}", "", name) for _, _, name in LICENSES]
    text = " ".join(rng.choice(parts) for _ in range(rng.randrange(60))).encode()
    assert SCAN(text) == plain(text)


def test_a_long_text_takes_time_in_proportion():
    one = "Licensed under the MIT license. See cc by nc 4.0, or the GNU General Public License version 2. Other words follow here. "
    times = []
    for n in (2000, 43_000):  # a quarter of a MB, and 5 MB
        start = time.process_time()
        n_words, found = SCAN((one * n).encode())
        times.append(time.process_time() - start)
        assert n_words == n * len(one.encode().translate(NORMAL).split()) and len(found) >= 3 * n
    assert times[1] < 60 * max(times[0], 0.05)
