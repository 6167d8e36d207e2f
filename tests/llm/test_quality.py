import random
from collections import Counter

from pyspark.sql import functions as F

from tablespoon.llm import quality

from .conftest import prose


def brute_repeats(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(covered)


def test_repeated_words_as_brute_force():
    draw = random.Random(3)
    for n in [0, 1, 7, 8, 9, 16, 17, 40, 200]:
        for kinds in (1, 2, 3, 50):
            words = [str(draw.randrange(kinds)).encode() for _ in range(n)]
            assert quality.repeated_words(words) == brute_repeats(words), (n, kinds)


def test_counts():
    text = "Ab #c é\n\nAb #c é\n \t\nx$ x$"
    words = text.split()
    got = dict(zip(quality.COUNTS, quality.measure(text)))
    assert got["n_words"] == len(words) and got["word_chars"] == sum(map(len, words))
    assert got["n_symbols"] == 4 and got["n_lines"] == 3 and got["n_dup_lines"] == 1
    assert got["n_upper"] == 2 and got["n_stutter"] == 1
    assert quality.measure(None) == quality.measure("") == (0,) * len(quality.COUNTS)
    # a no-break space is part of a word
    assert quality.measure("a b c")[0] == 2


def test_sketch_quantiles_are_close(spark):
    values = [random.Random(5).lognormvariate(0, 2) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", quality.value_of(quality.bucket(F.col("v"))).alias("up"))
    for r in df.collect():
        assert r.v <= r.up * (1 + 1e-9) and r.up <= max(r.v * quality.GROWTH, quality.START) * (1 + 1e-9)


def test_sketches_merge(spark):
    """Thresholds come from sums of counts, so any split of the rows gives the same."""
    rows = [(i % 2, float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "half int, v double").withColumn("b", quality.bucket(F.col("v")))
    whole = {tuple(r) for r in df.groupBy("b").count().collect()}
    parts = df.groupBy("half", "b").count().groupBy("b").agg(F.sum("count"))
    assert whole == {tuple(r) for r in parts.collect()}


def test_junk_goes_and_clean_stays(spark, make):
    rows = [(i, prose(i, 120), "en" if i % 3 else "de", f"s{i % 4}") for i in range(120)]
    junk = {
        1000: " ".join(w + "$$$" for w in prose(7, 100).split()),
        1001: prose(8, 100).upper(),
        1002: " ".join(w for w in prose(9, 30).split() for _ in range(5)),
        1003: " | ".join(prose(10, 100).split()),
    }
    out, m, failed, kept = quality.judged(make(rows + [(i, t, "en", "s1") for i, t in junk.items()]))
    got = {r.doc_id: r[kept] for r in out.collect()}
    assert not any(got[i] for i in junk) and all(got[i] for i in range(120))


def test_each_measure_alone_rejects(spark, make):
    """Outliers in one measure each; the others stay within any fence. Repeats have none: the base rule ends below their fence."""
    draw, words = random.Random(11), prose(12, 120).split()
    kinds, lines = ["ka", "ke", "ki", "ko", "ku"], []
    while len(lines) < 80:
        word = draw.choice(kinds)
        if lines[-1:] != [word]:
            lines.append(word)
    outliers = {
        "symbols": " ".join(w + "$" * (i % 3 == 0) for i, w in enumerate(words)),
        "upper": " ".join(w.upper() if i % 2 else w for i, w in enumerate(words)),
        "dup_lines": "\n".join(x for i, w in enumerate(lines) for x in ([w, f"own{i}"] if i % 4 == 0 else [w])),
        "stutter": " ".join(w for w in words for _ in range(2)),
        "word_length": " ".join((w * 9)[:14] for w in words),
    }
    for name, text in outliers.items():
        m = dict(zip(quality.COUNTS, quality.measure(text)))
        share = {
            "symbols": m["n_symbols"] / m["n_words"], "upper": m["n_upper"] / max(m["n_letters"], 1), "dup_lines": m["n_dup_lines"] / m["n_lines"],
            "repeats": m["n_repeat_words"] / m["n_words"], "stutter": m["n_stutter"] / m["n_words"], "word_length": m["word_chars"] / m["n_words"] - 5,
        }
        assert [k for k, v in share.items() if v > quality.FENCE * quality.SPREADS[k]] == [name], share
    rows = [(i, prose(i, 120), "en", f"s{i % 4}") for i in range(120)] + [(1000 + i, t, "en", "s1") for i, t in enumerate(outliers.values())]
    out, m, failed, kept = quality.judged(make(rows))
    for r in out.collect():
        assert not r[failed] and r[kept] == (r.doc_id < 1000), r.doc_id


def test_odd_rows(spark, messy, empty):
    out, m, failed, kept = quality.judged(messy)
    rows = out.collect()
    assert len(rows) == messy.count() and set(messy.columns) < set(out.columns)
    by = {r.doc_id: r for r in rows}
    assert by[3][failed] and by[4][failed] and by[5][failed] and not by[3][kept]
    assert by[6][m].n_words == 30_000 and by[6][kept] and not by[1][failed]
    assert quality.judged(empty)[0].count() == 0
    assert quality.quality_filter(spark, messy, "").columns == messy.columns
