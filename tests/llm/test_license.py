"""Op 5 against Dice coefficients in plain Python."""

import re

from panelspark.llm import op5_license as op
from llm_fixtures import docs_of  # noqa: F401


def grams(s):
    w = re.findall("[a-z0-9]+", s.lower())
    return {(a, b) for a, b in zip(w, w[1:])}


def brute(rows, templates=op.NOTICES, threshold=op.THRESHOLD):
    out = []
    for key, text in rows:
        if text is None:
            continue
        lines = text.split("\n")
        for line, unit in [*([(0, text)] if len(lines) > 1 else []), *enumerate(lines, 1)]:
            a, best = grams(unit), None
            for i, (name, t) in enumerate(templates):
                b = grams(t)
                if a and b and (d := 2.0 * len(a & b) / (len(a) + len(b))) >= threshold and (best is None or d > best[0]):
                    best = (d, name, i)
            if best:
                out.append((key, line, best[1], best[2], best[0]))
    return sorted(out, key=str)


def mine(df, **options):
    return sorted(((r.doc_id, r.line, r.license, r.template, r.dice) for r in op.scan(df, **options).collect()), key=str)


def test_rows(docs_of):
    mit, apache = op.NOTICES[11][1], op.NOTICES[1][1]
    rows = [(1, "text\n" + mit), (2, mit.upper().replace(" ", "  ")), (3, "released under the new MIT license"), (4, None), (5, ""), (6, "word"), (None, mit), (1, "text\n" + mit),
            (7, "x " * 100_000 + "\n" + apache), (8, apache.replace("Unless", "\nUnless")), (9, "\n\n"), (10, "all rights reserved all rights reserved"), (11, op.NOTICES[9][1] + " and more words after it")]
    got = mine(docs_of(rows))
    assert got == brute(rows) and {r[0] for r in got} >= {1, 2, None, 7, 8, 10, 11}
    assert mine(docs_of([])) == []


def test_templates_of_ones_own(spark, docs_of):
    own = [(0, "B", "a b c d"), (1, "A", "a b c d"), (2, "none", "a"), (3, "null", None)]
    t = spark.createDataFrame(own, "template int, license string, text string")
    rows = [(1, "a b c d"), (2, "a b c"), (3, "a b a b c d")]
    assert mine(docs_of(rows), templates=t) == brute(rows, [("B", "a b c d"), ("A", "a b c d")])
    assert mine(docs_of(rows), templates=t, threshold=0.3) == brute(rows, [("B", "a b c d"), ("A", "a b c d")], 0.3)
    assert mine(docs_of(rows), templates=t.limit(0)) == []


def brute_spans(text, templates, threshold=op.THRESHOLD):
    """Spans of all windows by plain loops, merged by license."""
    w = re.findall("[a-z0-9]+", text.lower())
    g, hits = list(zip(w, w[1:])), {}
    for name, t in templates:
        b = grams(t)
        low, high = len(b) * threshold / (2 - threshold), len(b) * (2 - threshold) / threshold
        for s in range(len(g)):
            ends = [(2.0 * len(b & set(g[s:e])) / (len(b) + len(set(g[s:e]))), -e) for e in range(s + 1, min(len(g), int(s + high + 1e-9)) + 1) if e - s >= low - 1e-9]
            if g[s] in b and ends and max(ends)[0] >= threshold:
                hits.setdefault(name, []).append((s, 1 - max(ends)[1], max(ends)[0]))
    out = []
    for name, found in hits.items():
        merged = []
        for s, e, dice in sorted(found):
            if merged and s < merged[-1][1] - 1:
                merged[-1] = [merged[-1][0], max(e, merged[-1][1]), max(dice, merged[-1][2])]
            else:
                merged.append([s, e, dice])
        out += [(s, e, name, dice) for s, e, dice in merged]
    return sorted(out)


def test_spans_inside_lines_and_over_lines(docs_of):
    import textwrap
    code, cc = "\n".join(f"value{i} = call(value{i + 1})" for i in range(30)), op.NOTICES[3][1]
    texts = ["/*\n * " + "\n * ".join(textwrap.wrap(op.NOTICES[1][1], 76)) + "\n */\n" + code, "Photos by the author. " + cc + " Please see the notes below for more about this and other things.",
             "MIT License\n\nCopyright (c) 2020 A B\n\n" + "\n".join(textwrap.wrap(op.FULL_TEXTS[0][1], 70)) + "\n" + code, "all rights reserved " * 9, cc + "\n" + code + "\n" + cc, code, "", "word"]
    rows = [*enumerate(texts), (90, None), (None, texts[1]), (1, texts[1])]
    got = sorted(((r.doc_id, r.start, r.end, r.license, r.dice) for r in op.spans(docs_of(rows)).collect()), key=str)
    want = sorted(((k, *x) for k, t in rows if t for x in brute_spans(t, (*op.NOTICES, *op.FULL_TEXTS))), key=str)
    assert got == want and {(r[0], r[3]) for r in got} >= {(0, "Apache-2.0"), (1, "CC-BY-4.0"), (None, "CC-BY-4.0"), (2, "MIT"), (3, "all-rights-reserved")}
    assert max(r[4] for r in got if r[0] == 2) == 1.0 and sum(r[0] == 4 for r in got) == 2
    assert op.spans(docs_of([])).count() == 0
