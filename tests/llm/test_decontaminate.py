import hashlib
import re

import pyarrow as pa
import pytest

from tablespoon.llm import decontaminate as d
from tests.compare import connect, difference

from .conftest import prose

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    fold = str.maketrans(d.UPPER, d.LOWER)
    return WORD.findall((text or "").translate(fold))


def brute(text, items, words=10):
    own, hit, ids = words_of(text), set(), set()
    for item_id, item in items:
        w = words_of(item)
        k = min(words, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            for at in range(len(own) - k + 1):
                if own[at : at + k] == w[i : i + k]:
                    hit.update(range(at, at + k))
                    if item_id is not None:
                        ids.add(str(item_id))
    return len(own), len(hit), sorted(ids)


ITEMS = [
    (1, prose(50, 25)),
    (2, prose(51, 10)),
    (3, "Été, 42 naïve ÉTÉ!"),
    (3, prose(52, 12)),
    (10, prose(50, 25).upper()),
    (4, None),
    (5, ""),
    (6, " .,! "),
    (None, prose(53, 11)),
    (7, "one"),
    (7, "one"),
    (8, prose(50, 25) + " more"),
]
TEXTS = [
    prose(1, 30) + " " + prose(50, 25) + " " + prose(2, 30),
    prose(50, 9),
    " ".join(prose(50, 25).split()[5:16]) + ".\n" + prose(51, 10).replace(" ", ", -"),
    prose(51, 9) + " " + prose(51, 10),
    "xÉté Été 42 naïve ÉTÉ y",
    "a one b ONE",
    prose(53, 11) + " " + prose(53, 11),
    "",
    None,
    " \n\t ",
    "ones",
    " ".join([prose(50, 25)] * 30) + prose(3, 20_000),
]
TEXTS[7:7] = [t.title() for t in TEXTS[:3]]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def rows(df, name):
    return {r.doc_id: (r[name].n_words, r[name].n_hit, r[name]["items"]) for r in df.collect()}


@pytest.mark.parametrize("held", [d.HELD, 0])
def test_as_brute_force_by_set_and_by_join(spark, make, benchmark, held):
    docs = make([(i, t) for i, t in enumerate(TEXTS)])
    found, name = d.leaks(docs, benchmark, held=held, slots=1 << 12)
    assert set(docs.columns) < set(found.columns)
    assert rows(found, name) == {i: brute(t, ITEMS) for i, t in enumerate(TEXTS)}


def test_texts_do_not_run_into_each_other():
    halves = prose(51, 10).split()
    texts = pa.array([" ".join(halves[:5]), " ".join(halves[5:]), prose(51, 10), None, "", prose(51, 10)])
    known = d.Known([prose(51, 10)], [["2"]], 10)
    assert [r["n_hit"] for r in d.scan(texts, known).to_pylist()] == [0, 0, 10, 0, 0, 10]
    assert [r["n_hit"] for r in d.scan(texts.slice(2, 3), known).to_pylist()] == [10, 0, 0]


def test_equal_hashes_are_told_apart(monkeypatch):
    """With every hash the same only the comparison of words is left."""
    monkeypatch.setattr(d, "word_hashes", lambda c: (c.starts * 0).astype("uint64"))
    texts = [t for _, t in ITEMS if t]
    known = d.Known(texts, [[str(i)] for i in range(len(texts))], 10)
    own = [(str(i), t) for i, t in enumerate(texts)]
    got = d.scan(pa.array(TEXTS[:9]), known).to_pylist()
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in got] == [brute(t, own) for t in TEXTS[:9]]


def test_blocks_change_nothing(monkeypatch):
    known = d.Known([t for _, t in ITEMS if t], [[str(i)] for i, (_, t) in enumerate(ITEMS) if t], 10)
    whole = d.scan(pa.array(TEXTS), known).to_pylist()
    monkeypatch.setattr(d, "BLOCK", 50)
    assert d.scan(pa.array(TEXTS), known).to_pylist() == whole


@pytest.mark.parametrize("held", [d.HELD, 0])
def test_spans_and_documents_go(spark, make, benchmark, held):
    leak = prose(50, 25)
    docs = make([(1, "Ähem: " + leak + ". Rest"), (2, "clean ü"), (3, None), (4, "ü" + leak.replace(" ", "\n")), (2, "clean ü")])
    kept = d.clean_documents(docs, benchmark, held=held)
    assert kept.columns == docs.columns
    # the first word has grown, so the window starts after it
    first = leak.split()[0]
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, "Ähem: . Rest"), (2, "clean ü"), (2, "clean ü"), (3, ""), (4, f"ü{first}\n")]
    whole = d.clean_documents(docs, benchmark, documents=True, held=held)
    assert sorted(r.doc_id for r in whole.collect()) == [2, 2, 3]


def test_odd_rows(spark, messy, empty, benchmark):
    for held in (d.HELD, 0):
        found, name = d.leaks(messy, benchmark, held=held)
        assert found.count() == messy.count() and found.where(f"{name}.n_hit > 0").count() == 0
        assert d.leaks(empty, benchmark, held=held)[0].count() == 0
    found, name = d.leaks(messy, benchmark.limit(0))
    assert found.where(f"{name}.n_hit > 0").count() == 0


def test_a_common_passage(spark, make, benchmark):
    """Two thirds of all documents hold the same item."""
    found, name = d.leaks(make([(i, prose(1000 + i, 20) + " " + prose(51, 10) if i % 3 else prose(1000 + i, 20)) for i in range(300)]), benchmark, held=0)
    assert found.where(f"{name}.n_hit >= 10").count() == 200 and found.count() == 300


def test_query_as_sql(spark):
    assert difference(d.op12_decontaminate(spark, SF_DIR), connect(SF_DIR), d.OP12_SQL) is None
    digest = hashlib.sha256(b"").hexdigest()
    clean = d.op12_decontaminate(spark, SF_DIR).where("not contaminated").select("items_sha256").distinct().collect()
    assert [r[0] for r in clean] == [digest]
