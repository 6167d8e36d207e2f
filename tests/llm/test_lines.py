import random

from tablespoon.llm import lines

from .conftest import prose


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, shortest):
    """Texts by key after removal, by comparing every line with every earlier one."""
    order = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows if r[1] is not None})
    seen, out = [], {}
    for none, doc_id, text in order:
        left = []
        for line in text.split("\n"):
            if not line.strip(" \t\n\x0b\x0c\r"):
                left.append(line)
                continue
            gone = any(line == x or (min(len(x), len(line)) >= shortest and abs(len(x) - len(line)) <= 1 and edits(x, line) <= 1) for x in seen)
            seen.append(line)
            if not gone:
                left.append(line)
        out[None if none else doc_id, text] = "\n".join(left)
    return out


def change(line, draw):
    i, c = draw.randrange(len(line)), draw.choice("abcé")
    return draw.choice([line[:i] + line[i + 1 :], line[:i] + c + line[i:], line[:i] + c + line[i + 1 :]])


def test_variants_meet():
    draw = random.Random(1)
    for _ in range(50):
        line = prose(draw.randrange(99), 4)
        own, without = lines.variants(line)
        for i in range(len(line)):
            assert int(without[i]) == lines.variants(line[:i] + line[i + 1 :])[0]


def test_as_brute_force(spark, make):
    draw = random.Random(3)
    pool = [prose(i, 6) for i in range(12)] + ["short", "shore", "aaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaab"]
    rows = []
    for i in range(60):
        some = [change(x, draw) if draw.random() < 0.4 else x for x in draw.sample(pool, 3)]
        rows.append((i, "\n".join([*some, "", prose(1000 + i, 8)])))
    got = {(r.doc_id, i): r.text for i, r in enumerate(lines.deduplicated(make(rows))[0].orderBy("doc_id").collect())}
    want = brute(rows, lines.SHORTEST)
    # order within a document id follows the text's hash, so ids are distinct here
    assert {i: t for (i, _), t in got.items()} == {i: t for (i, _), t in want.items()}


def test_one_popular_line(spark, make):
    """A line with very many one-edit relatives: nobody pairs them all, all but the first go."""
    base = prose(5, 10)
    draw = random.Random(8)
    rows = [(i, base if i == 0 else base[:20] + f"{i:04d}"[draw.randrange(4)] + base[21:]) for i in range(300)]
    got = {r.doc_id: r.text for r in lines.deduplicated(make(rows))[0].collect()}
    assert got[0] == base and all(got[i] == "" for i in range(1, 300))


def test_odd_rows(spark, messy, empty):
    out, n_lines, n_removed = lines.deduplicated(messy)
    rows = out.collect()
    assert len(rows) == messy.count() and out.columns[: len(messy.columns)] == messy.columns
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[3].text is None and by[4].text == "" and by[5].text == " \n\t\n " and by[2].text == ""
    assert by[8].text.count("\n") == 0 and by[8][n_removed] == 2 and by[8][n_lines] == 3
    assert [r.text for r in rows if r.doc_id == 1] == [by[1].text] * 2 != [""] * 2
    stage = lines.dedup_lines(spark, messy, "")
    assert stage.columns == messy.columns and stage.where("n_chars <> length(text)").count() == 0
    assert lines.deduplicated(empty)[0].count() == 0
