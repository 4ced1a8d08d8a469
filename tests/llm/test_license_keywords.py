"""Keywords of license rules only save work: a scan without them finds the same."""

import random
import re
import re._parser as parser

from reviewloom.llm import licenses


def example(parsed, rng):
    """A random text that the parsed regex matches."""
    out = ""
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(value)
        elif name == "ANY":
            out += rng.choice("xyz ")
        elif name == "IN":
            out += "e" if str(value[0][0]) == "CATEGORY" else chr(rng.choice(value)[1])
        elif name == "BRANCH":
            out += example(rng.choice(value[1]), rng)
        elif name == "SUBPATTERN":
            out += example(value[3], rng)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, what = value
            out += "".join(example(what, rng) for _ in range(rng.randint(least, min(int(most), least + 2))))
        else:
            assert name == "ASSERT_NOT", name
    return out


def test_keywords_lose_nothing():
    rng, scanner, open_scanner = random.Random(4), licenses.Scanner(), licenses.Scanner()
    n = 0
    for rule in scanner.rules:
        inner = rule.pattern.pattern.decode().removeprefix("(?<![^ ])").removesuffix("(?![^ ])")
        for _ in range(20):
            text = f"so {example(parser.parse(inner), rng)} end".encode()
            words = text.translate(licenses.NORMAL).split()
            n += bool(re.search(rule.pattern, b" " + b" ".join(words) + b" "))
            open_scanner.by_keyword = {w: range(len(scanner.rules)) for w in words}
            open_scanner.gate = set(words)
            assert scanner.scan(text) == open_scanner.scan(text), (rule.label, text)
    assert n > 15 * len(scanner.rules)


def test_names_without_the_word_license():
    scan = licenses.Scanner().scan
    for text, label in [
        (b"Released under the GPL version 2", "gpl-2"),
        (b"released under the unlicense", "unlicense"),
        (b"available under creative commons attribution 4.0", "cc-by"),
    ]:
        assert [(d[0], d[3]) for d in scan(text)[1]] == [(label, 1.0)]
