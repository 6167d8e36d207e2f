import random

import numpy as np

from tablespoon.llm import paragraphs as p

from .conftest import prose


def sets_of(line):
    words = line.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_lines(texts):
    """Clusters of (text number, line number) with similar lines, single ones left out."""
    units = [(i, j, sets_of(x)) for i, t in enumerate(texts) for j, x in enumerate(t.split("\n")) if len(x.split()) >= p.WORDS]
    label = list(range(len(units)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(units)):
        for b in range(a):
            both = len(units[a][2] & units[b][2])
            if both >= p.SIMILARITY * (len(units[a][2]) + len(units[b][2]) - both):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    out = {}
    for a, (i, j, _) in enumerate(units):
        out.setdefault(find(a), set()).add((i, j))
    return sorted(sorted(x) for x in out.values() if len(x) > 1)


def clusters(rows):
    out = {}
    for r in rows:
        if r.line is not None:
            out.setdefault(r.cluster, set()).add((r.doc_id, r.line))
    return sorted(sorted(x) for x in out.values())


def near(line, draw, changes):
    words = line.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"w{draw.randrange(999)}"
    return " ".join(words)


def family(seed, groups, each, words):
    draw = random.Random(seed)
    texts = []
    for g in range(groups):
        base = prose(seed * 100 + g, words)
        texts += [near(base, draw, draw.randint(0, 2)) for _ in range(each)]
    return texts


def check(spark, make, texts, **options):
    got = p.repeats(make(list(enumerate(texts))), **options).collect()
    assert clusters(got) == brute_lines(texts)
    return got


def test_lines_as_brute_force(spark, make):
    texts = [a + "\n" + b for a, b in zip(family(1, 6, 5, 80), family(2, 10, 3, 60))] + [prose(900 + i, 50) for i in range(20)]
    check(spark, make, texts)


def test_large_groups_are_cut(spark, make):
    got = check(spark, make, family(3, 2, 30, 90), bucket=6)
    assert len(got) >= 40


def test_passages_of_fifty_words_are_found(spark, make):
    draw = random.Random(4)
    rows, planted = [], set()
    for i in range(60):
        passage = prose(5000 + i, 51)
        for j in range(2):
            before, after = prose(9000 + 2 * i + j, draw.randint(0, 80)), prose(7000 + 2 * i + j, draw.randint(5, 80))
            rows.append((2 * i + j, f"{before} {passage} {after}"))
            planted.add(2 * i + j)
    rows += [(1000 + i, prose(20_000 + i, 150)) for i in range(60)]
    got = p.repeats(make(rows)).collect()
    assert {r.doc_id for r in got} == planted
    assert all(r.removed == (r.doc_id % 2 == 1) and r.first_doc_id == r.doc_id // 2 * 2 and 20 <= r.n_words <= 51 for r in got)
    texts = dict(rows)
    for r in got:
        own = " ".join(texts[r.doc_id].split()[r.start_word : r.start_word + r.n_words])
        assert own in texts[r.first_doc_id]


def test_places_depend_on_their_own_words_alone():
    draw = np.random.default_rng(1)
    passage = draw.integers(0, 1 << 63, 60, dtype=np.uint64)
    chosen = []
    for _ in range(20):
        before = draw.integers(0, 1 << 63, draw.integers(0, 200), dtype=np.uint64)
        runs = np.concatenate([before, passage, draw.integers(0, 1 << 63, 50, dtype=np.uint64)])
        places = p.chosen(runs, np.zeros(len(runs), int)) - len(before)
        chosen.append({int(x) for x in places if p.REACH - 1 <= x <= 60 - p.REACH})
        assert any(0 <= x < p.REACH for x in places)
    assert all(c == chosen[0] for c in chosen)


def test_chosen_as_brute_force():
    draw = np.random.default_rng(2)
    doc = np.repeat(np.arange(40), draw.integers(1, 120, 40))
    runs = draw.integers(0, 1 << 20, len(doc), dtype=np.uint64)
    want = set()
    for d in range(40):
        own = np.flatnonzero(doc == d)
        for i in range(max(1, len(own) - p.REACH + 1)):
            some = own[i : i + p.REACH]
            want.update(int(x) for x in some[runs[some] == runs[some].min()][: None if len(own) >= p.REACH else 1])
    assert set(p.chosen(runs, doc).tolist()) == want


def test_texts_hashed_together_are_hashed_alike():
    texts = [b"", prose(1, 100).encode(), b"\n\n a\n" + prose(2, 25).encode() + b"\nb", b"x", prose(3, 70).encode(), "é \u00a0 ö ".encode() * 30]
    together = p._paragraphs([None] * len(texts), list(range(len(texts))), texts).to_pylist()
    apart = [r for i, t in enumerate(texts) if (b := p._paragraphs([None], [i], [t])) is not None for r in b.to_pylist()]
    key = lambda r: (r["row"], r["line"], r["start"])
    assert sorted(together, key=key) == sorted(apart, key=key)
    assert [(r["line"], r["start"], r["words"]) for r in together if r["row"] == 2 and r["line"] >= 0] == [(3, 1, 25)]


def test_odd_rows(spark, messy, empty):
    got = p.repeats(messy).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.removed)
    assert 3 not in by and 4 not in by and 5 not in by
    assert by[1] == [False] and by[2] == [True] and None not in by  # rows that repeat are one document
    assert by[6] == [False] and by[7] == [True] and sorted(by[8]) == [False, True, True]
    assert p.repeats(empty).count() == 0
    assert p.repeats(messy.where("doc_id = 3")).count() == 0


def wrapped(text, width):
    words = text.split()
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_paragraphs_over_several_lines(spark, make):
    draw, rows = random.Random(6), []
    for i in range(60):
        words = prose(30_000 + i, 60).split()
        other = words.copy()
        other[draw.randrange(10, 50)] = "changed"
        for j, own in enumerate((words, other)):
            around = [wrapped(prose(40_000 + 4 * i + 2 * j + k, 40), 12) for k in range(2)]
            rows.append((2 * i + j, "\n\n".join([around[0], wrapped(" ".join(own), 12 if j else 9), around[1]])))
    got = [r for r in p.repeats(make(rows)).collect() if r.line is not None]
    assert sorted((r.doc_id, r.line, r.n_lines, r.n_words, r.removed) for r in got) == sorted(
        (2 * i + j, 5, 5 if j else 7, 60, j == 1) for i in range(60) for j in range(2)
    )
    assert all(r.first_doc_id == r.doc_id // 2 * 2 for r in got)


def test_longer_and_blank_lines_end_a_paragraph():
    short, long = prose(1, 11), prose(2, 25)
    text = "\n".join([short, short, long, short, "", short, short, " \t", short])
    cut = p._paragraphs([1], [1], [text.encode()]).to_pylist()
    assert [(r["line"], r["n_lines"], r["words"]) for r in cut if r["line"] >= 0] == [(0, 2, 22), (2, 1, 25), (5, 2, 22)]


def longest_common(own, others):
    """Places (start, end) of the longest run of words of ``own`` in each of ``others``."""
    out = []
    for other in others:
        best, last = (0, 0), [0] * (len(other) + 1)
        for i, w in enumerate(own):
            now = [0] * (len(other) + 1)
            for j, v in enumerate(other):
                if w == v:
                    now[j + 1] = last[j] + 1
                    if now[j + 1] > best[1] - best[0]:
                        best = (i + 1 - now[j + 1], i + 1)
            last = now
        out.append(best)
    return out


def test_passages_are_removed_in_one_piece(spark, make):
    draw, rows, want = random.Random(7), [], {}
    for i, words in enumerate([50, 51, 60, 75, 100, 150, 200, 300, 400, 500]):
        passage = prose(50_000 + i, words)
        texts = [f"{prose(60_000 + 2 * i + j, draw.randint(0, 150))} {passage} {prose(70_000 + 2 * i + j, draw.randint(words, words + 200))}" for j in range(2)]
        rows += [(2 * i + j, t) for j, t in enumerate(texts)]
        (want[2 * i + 1],) = longest_common(texts[1].split(), [texts[0].split()])
        assert want[2 * i + 1][1] - want[2 * i + 1][0] >= words
    got = p.repeats(make(rows)).collect()
    assert sorted((r.doc_id, r.start_word, r.start_word + r.n_words) for r in got if r.removed) == sorted((d, *at) for d, at in want.items())
    kept = {r.doc_id: r.n_words for r in got if not r.removed}
    assert kept == {d - 1: b - a for d, (a, b) in want.items()}


def test_a_kept_line_hides_no_passage(spark, make):
    passage = prose(1, 80)
    line = f"{prose(2, 100)} {passage} {prose(3, 100)}"
    got = p.repeats(make([(1, f"{prose(4, 70)} {passage} {prose(5, 90)}"), (2, line), (3, line)])).collect()
    removed = {(r.doc_id, r.line, r.start_word, r.n_words, r.first_doc_id) for r in got if r.removed}
    assert removed == {(2, None, 100, 80, 1), (3, 0, 0, 280, 2)}
    assert {(r.doc_id, r.line) for r in got if not r.removed} == {(1, None), (2, 0)}


def test_repeats_within_a_text_keep_one(spark, make):
    passage = prose(9, 45)
    (removed,) = [r for r in p.repeats(make([(1, " ".join([passage] * 4))])).collect() if r.removed]
    assert (removed.start_word, removed.n_words) == (45, 135)
