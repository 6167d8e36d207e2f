import os
import random
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from tablespoon.llm import common, lines, packing, queries
from tests.compare import connect, difference

from .conftest import prose
from .test_lines import brute as brute_lines
from .test_mixing import brute_targets

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_matches_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE[name]) is None


def test_queries_are_numbered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline(spark, tmp_path):
    """Each stage works on all that the one before it kept, and the last holds every kept word."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        seen.append(docs.count())
    assert 200 > seen[0] == seen[1] > seen[2] > 0
    assert docs.select("doc_id").distinct().count() <= seen[2]
    words = sum(len(r.text.encode().split()) for r in docs.select("text").collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).toPandas()
    assert packed.n_tokens.sum() == words
    whole = corpus_pipeline.run(spark, SF_DIR).toPandas()
    key = ["doc_id", "copy", "piece"]
    assert whole.sort_values(key).reset_index(drop=True).equals(packed.sort_values(key).reset_index(drop=True))


def planted():
    """Documents of four sources: junk, short and empty ones, lines that repeat nearly, texts that do but for a few words."""
    draw, rows = random.Random(21), []
    shared = [prose(500 + i, 7) for i in range(4)]
    for i in range(60):
        own = [prose(i, draw.randint(25, 60)), prose(100 + i, 12)]
        line = draw.choice(shared)
        rows.append((i, "\n".join([own[0], line if i % 3 else line + "x", "", own[1]]), "en", f"s{i % 3}"))
    for i in range(12):  # one long line with other words in up to two places: near, yet no near line
        words = prose(900 + i % 4, 150).split()
        if i > 3:
            words[20 + i], words[90 + i] = f"new{i}", f"other{i}"
        rows.append((100 + i, " ".join(words), "en", None))
    junk = [" ".join(w + "$$" for w in prose(41, 60).split()), prose(42, 60).upper(), prose(43, 8), "", None, " ".join([prose(44, 10)] * 6)]
    return rows + [(200 + i, text, "en", "s1") for i, text in enumerate(junk)] + [(0, rows[0][1], "en", "s0")]


def brute_similar(texts):
    """The ids of ``texts`` that stay: the least of each group linked by a Jaccard coefficient of 0.8 over five words."""
    words = {i: t.lower().split() for i, t in texts.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    label = {i: i for i in texts}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in texts:
        for b in texts:
            if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i for i in texts if find(i) == i}


def test_pipeline_as_brute_force(spark, make, tmp_path):
    """Filtering stages by SQL and by comparing everything with everything; the mix by its targets, the packing by its bins."""
    make(planted()).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    kept = {i for i, ok in con.sql(queries.ORACLE["op2_quality_rules"]).project("doc_id, kept").fetchall() if ok}
    rows = {r[0]: r for r in planted() if r[0] in kept}
    assert 60 <= len(rows) < len(planted()) - 6
    texts = {i: text for (i, _), text in brute_lines([(r[0], r[1]) for r in rows.values()], lines.SHORTEST).items()}
    stay = brute_similar(texts)
    assert 3 <= len(texts) - len(stay) <= 12
    sizes = {i: len(texts[i].split()) for i in stay}

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    whole = Counter()
    for r in got:
        whole[r.doc_id, r.copy] += r.n_tokens
    assert {i for i, _ in whole} <= stay and all(n == sizes[i] for (i, _), n in whole.items())
    # a source whose words are all taken at its target's rate, but for half a document
    copies, source = Counter(i for i, _ in whole), {i: rows[i][3] for i in stay}
    of, taken = Counter(), Counter()
    for i in stay:
        of[source[i]] += sizes[i]
        taken[source[i]] += sizes[i] * copies[i]
    want = brute_targets(of)
    assert all(abs(taken[s] - want[s]) <= max(sizes.values()) / 2 + 1e-6 for s in want) and max(copies.values()) <= 3
    assert all(copies[i] >= int(want[source[i]] / of[source[i]]) for i in stay)
    bins = {}
    for r in got:
        bins.setdefault((r.bin_id, r.bin_capacity, r.bin_tokens), []).append((r.bin_start, r.n_tokens))
    assert len({b for b, _, _ in bins}) == len(bins)
    for (_, capacity, tokens), inside in bins.items():
        ends = [0]
        for start, n in sorted(inside):
            assert start == ends[-1]
            ends.append(start + n)
        assert ends[-1] == tokens and capacity == min(c for c in packing.CAPACITIES if c >= tokens)


def test_stages_clear_what_stages_before_stored(spark, make):
    """What is read still stays, and nothing else of the earlier stages."""
    seen = []

    @common.stage
    def keeps(spark, docs, sf_dir):
        out = common.stored(docs)
        seen.append(out.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])
        return out

    outside = common.stored(make([(1, "a")]))
    first = keeps(spark, outside, "")
    second = keeps(spark, first, "")  # reads the first one's table, which was not written again
    assert [os.path.exists(p) for p in seen] == [True, True] and second.count() == 1
    third = keeps(spark, outside, "")
    assert [os.path.exists(p) for p in seen] == [False, False, True]
    assert outside.count() == third.count() == 1


def test_odd_tables_go_through_all_stages(spark, messy, empty, tmp_path):
    for number, docs in enumerate((messy, empty)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            out.write.parquet(f"{tmp_path}/{number}-{name}")
            docs = spark.read.schema(out.schema).parquet(f"{tmp_path}/{number}-{name}")
            assert name == "best_fit_packing" or docs.columns == columns
        assert docs.count() > 0 if number == 0 else docs.count() == 0
