import re

from tablespoon.llm import licenses

from .conftest import prose


def pairs(text):
    words = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    return set(zip(words, words[1:]))


def words_of(text):
    return re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")


def brute(text):
    """All units against all templates; no telling words but for what a run is made of."""
    blocks, telling, out = re.split(r"\n[ \t\r\f\x0b]*(?:\n[ \t\r\f\x0b]*)+", text), set(licenses.telling_words()), []
    units = [("line", i, 1, u) for i, u in enumerate(text.split("\n"))] + [("block", i, 1, u) for i, u in enumerate(blocks) if "\n" in u]
    for i in range(len(blocks)):
        for j in range(i + 1, len(blocks)):
            run = blocks[i : j + 1]
            if all(telling & set(words_of(b)) for b in run) and sum(len(words_of(b)) for b in run) <= licenses.RUN_WORDS:
                units.append(("run", i, j - i + 1, " ".join(run)))
    for kind, i, n, unit in units:
        own, best = pairs(unit), None
        for name, body in licenses.TEMPLATES:
            other = pairs(body)
            dice = 2 * len(own & other) / max(1, len(own) + len(other))
            if dice >= licenses.THRESHOLD and (best is None or (-dice, name) < best):
                best = (-dice, name)
        if best:
            out.append((kind, i, n, best[1], -best[0], len(own)))

    def beaten(a):
        others = [b for b in out if b[0] != "line" and b != a and a[1] < b[1] + b[2] and b[1] < a[1] + a[2]]
        return any((-b[4], b[2], b[1]) < (-a[4], a[2], a[1]) for b in others)

    return [(*x[:4], round(x[4], 9), x[5]) for x in out if x[0] != "run" or not beaten(x)]


def test_as_brute_force(spark, make):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 500)
    words = mit.split()
    texts = [
        "Released under the MIT License.",
        "released   under THE mit license",
        "This is released under the MIT License, see below.",
        "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9)),
        "intro\n\n" + "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12)) + "\n \ncode",
        mit.replace("charge", "cost"),
        prose(1, 300) + "\nLicensed under CC BY-NC 4.0.\n" + prose(2, 10),
        "license",
        "under the",
        prose(3, 150),
        FILE.format("2020 A Person"),
        prose(4, 40) + "\n\n" + FILE.format("B") + "\n\n" + prose(5, 40) + "\n\n" + FILE.format("C").replace("to deal", "for use"),
        "Licensed under\n\nCC BY-SA 4.0.",
    ]
    got = licenses.scanned(make(list(enumerate(texts)))).collect()
    mine = sorted((r.doc_id, r.kind, r.unit_no, r.n_blocks, r.license, round(r.dice, 9), r.n_pairs) for r in got)
    assert mine == sorted((i, *x) for i, t in enumerate(texts) for x in brute(t))
    assert {r.doc_id for r in got} >= {0, 1, 3, 4, 5, 6}


FILE = """MIT License

Copyright (c) {}

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


def test_a_licence_file_of_several_paragraphs(spark, make):
    rows = licenses.scanned(make([(1, FILE.format("2020 A Person"))])).where("kind = 'run'").collect()
    assert [(r.license, r.unit_no, r.n_blocks, r.dice > 0.98) for r in rows] == [("MIT", 2, 3, True)]


def test_whole_texts_are_found_by_paragraph_and_by_run(spark, make):
    """Every template of 50 words or more, cut into paragraphs of three sentences, after a title."""
    texts = [(name, re.split(r"(?<=[.:;]) ", text)) for name, text in licenses.TEMPLATES if len(text.split()) >= 50]
    assert len(texts) >= 12
    cut = ["\n\n".join([f"{name} license"] + [" ".join(parts[i : i + 3]) for i in range(0, len(parts), 3)]) for name, parts in texts]
    found = {}
    for r in licenses.scanned(make(list(enumerate(cut)))).collect():
        found.setdefault(r.doc_id, set()).add((r.license, r.dice >= 0.95))
    assert all((texts[i][0], True) in found[i] for i in range(len(texts)))


def test_telling_words_are_needed():
    """A unit without them shares too little with any template."""
    telling = set(licenses.telling_words())
    for _, text in licenses.TEMPLATES:
        own = pairs(text)
        left = {p for p in own if not telling & set(p)}
        assert len(left) < licenses.THRESHOLD / (2 - licenses.THRESHOLD) * len(own)


def test_odd_rows(spark, make, messy, empty):
    assert licenses.scanned(messy).count() == 0 and licenses.scanned(empty).count() == 0
    rows = [(None, "Released under the MIT License."), (1, "Released under the MIT License."), (1, "Released under the MIT License.")]
    assert sorted(str(r.doc_id) for r in licenses.scanned(make(rows)).collect()) == ["1", "1", "None"]
