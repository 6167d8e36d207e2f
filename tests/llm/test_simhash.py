import random

import numpy as np
import xxhash

from tablespoon.llm import simhash
from tablespoon.llm.components import components

from .conftest import prose


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    runs = [words[i : i + 4] for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least index reachable, for each of a list of fingerprints."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= 4:
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def clusters_of_bits(seed, centres, each, flips):
    draw = random.Random(seed)
    out = []
    for _ in range(centres):
        c = draw.getrandbits(64)
        for _ in range(each):
            x = c
            for b in draw.sample(range(64), draw.randint(0, flips)):
                x ^= 1 << b
            out.append(x)
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_as_brute_force():
    texts = ["", None, "a", "A b\tC", "a b c d", "Ä b c d e", "a b c d e f g a b c d", prose(1, 500), "x y z  \n w v", " \n "]
    for t in texts:
        assert simhash.fingerprint(t) == brute_fingerprint(t), t


def test_the_code_covers():
    every = np.arange(1 << 15)
    words = simhash._decode(every)
    assert (np.bitwise_count(words ^ every) <= 1).all() and len(np.unique(words)) == 1 << 11


def test_near_halves_share_an_anchor():
    draw = np.random.default_rng(2)
    a = draw.integers(0, 1 << 32, 3000)
    for flips, reach in ((2, 1), (4, 2)):
        b = a.copy()
        for _ in range(flips):
            b ^= 1 << draw.integers(0, 32, len(b))
        mine, theirs = ({(int(r), int(k)) for r, k in zip(*simhash.half_anchors(x, reach))} for x in (a, b))
        assert len({r for r, _ in mine & theirs}) == len(a)
    rows, _ = simhash.half_anchors(a, 1)
    assert np.bincount(rows).max() <= 17


def linked(spark, prints, bucket):
    table = spark.createDataFrame([(signed(x),) for x in set(prints)], "fp long")
    return {r.node: r.root for r in components(simhash.links(table, bucket)).collect()}


def check_links(spark, prints, bucket):
    prints = list(dict.fromkeys(prints))
    roots = linked(spark, prints, bucket)
    mine = {}
    for i, x in enumerate(prints):
        mine.setdefault(roots.get(signed(x), signed(x)), set()).add(i)
    theirs = {}
    for i, r in enumerate(brute_components(prints)):
        theirs.setdefault(r, set()).add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_links_as_brute_force(spark):
    check_links(spark, clusters_of_bits(1, 40, 12, 3) + [random.Random(9).getrandbits(64) for _ in range(300)], simhash.BUCKET)


def test_large_anchors_are_dealt_again(spark):
    """Fingerprints that share one half crowd its anchors; a low bound sends them to the second deal."""
    draw = random.Random(4)
    crowd = [(0x1234_5678 << 32) | draw.getrandbits(32) for _ in range(400)]
    near = [x ^ (1 << draw.randrange(32)) ^ (1 << draw.randrange(32)) for x in crowd[:60]]
    check_links(spark, crowd + near, bucket=40)


def test_components(spark):
    draw = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101 + i) for i in range(50)] + [(7, 7), (200, 201), (200, 201)]
    draw.shuffle(edges)
    df = spark.createDataFrame(edges + [(None, 5)], "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 151)}, 200: 200, 201: 200}
    assert components(df.limit(0)).count() == 0


def test_near_duplicates(spark, make):
    base = prose(5, 400)
    words = base.split()
    copy = " ".join(["changed", *words[1:]])
    rows = [(10, base), (11, base), (12, copy), (3, prose(6, 400)), (20, None), (21, ""), (22, "  \n ")]
    got = {r.doc_id: r for r in simhash.near_duplicates(make(rows)).collect()}
    prints = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(prints)
    for i, (doc_id, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if roots[j] == roots[i]]
        assert got[doc_id].component_id == min(members) and got[doc_id].fingerprint == f"{prints[i]:016x}"


def test_odd_rows(spark, messy, empty):
    rows = simhash.near_duplicates(messy).collect()
    assert len(rows) == messy.count()
    by = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by[1] == 1 and by[2] == 1 and by[3] == by[4] == by[5] == 3
    kept = simhash.keep_first(spark, messy, "")
    left = [r.doc_id for r in kept.collect()]
    assert kept.columns == messy.columns and left.count(1) == 1 and left.count(None) == 1 and 2 not in left
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(spark, empty, "").count() == 0


def test_stage_drops_what_is_similar_in_five_words(spark, make):
    """Whatever has a Jaccard coefficient of 0.8 goes, though hardly a pair is within 4 bits; what has less stays."""

    def shingles(text):
        words = text.split()
        return set(zip(*(words[i:] for i in range(5))))

    draw = random.Random(11)
    rows, want, far = [], set(), 0
    for i in range(120):
        base = prose(3000 + i, 300)
        words = base.split()
        for at in draw.sample(range(300), draw.randint(3, 12)):
            words[at] = f"new{at}"
        copy = " ".join(words)
        both = len(shingles(base) & shingles(copy))
        jaccard = both / (len(shingles(base)) + len(shingles(copy)) - both)
        rows += [(2 * i, base), (2 * i + 1, copy)]
        want |= {2 * i} if jaccard >= 0.8 else {2 * i, 2 * i + 1}
        far += jaccard >= 0.8 and (simhash.fingerprint(base) ^ simhash.fingerprint(copy)).bit_count() > simhash.THRESHOLD
    left = [r.doc_id for r in simhash.keep_first(spark, make(rows), "").collect()]
    assert len(left) == len(set(left)) and want <= set(left)
    # a pair at exactly 0.8 shares a band with probability 0.997
    assert far > 20 and len(left) <= len(want) + 2


def test_linked_fingerprints_are_candidates_of_the_stage(spark):
    """Texts that share no band are compared if SimHash links them, and checked exactly."""
    words = prose(71, 900).split()
    texts = [" ".join(words), " ".join([*words[:-1], "changed"]), prose(72, 900)]
    prints = [simhash.fingerprint(t) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= simhash.THRESHOLD
    rows = [(i, i, [i], signed(prints[0] if i == 2 else p)) for i, p in enumerate(prints)]  # the last one is linked, but not similar
    classes = spark.createDataFrame(rows, "node long, row long, bands array<long>, fp long")
    written = spark.createDataFrame(list(enumerate(texts)), "row long, written string")
    assert {r.node: r.root for r in simhash.similar_texts(classes, written).collect()} == {0: 0, 1: 0}
