import random

from tablespoon.llm import packing

from .conftest import prose


def price(c):
    return 1 + c + c * c / 20


def total(found):
    return sum(map(price, found[2]))


def test_best_fit_as_brute_force():
    draw = random.Random(1)
    for lengths, openings in (([8], [8]), ([4, 8, 16], [4, 8, 16]), ([10, 11, 40], [10, 11]), ([4, 8, 16], [16])):
        sizes = sorted((draw.randint(1, max(lengths)) for _ in range(300)), reverse=True)
        bins, starts, final = packing.best_fit(sizes, lengths, openings, price)
        held, rooms = [0] * len(final), {}
        for at, (size, b, start) in enumerate(zip(sizes, bins, starts)):
            fits = [r for r in rooms.values() if r >= size]
            if b in rooms:  # the fullest open bin that has room
                assert rooms[b] == min(fits)
            else:
                assert not fits
                hold = lambda c: size + min(c - size, sum(x for x in sizes[at + 1 :] if x <= c - size))  # noqa: B023
                allowed = [c for c in openings if c >= size] or [min(c for c in lengths if c >= size)]
                rooms[b] = min(allowed, key=lambda c: (price(c) / hold(c), c))
            assert start == held[b]
            held[b] += size
            rooms[b] -= size
        assert [min(c for c in lengths if c >= h) for h in held] == final


def cheapest(sizes, lengths):
    """The exact optimum over all ways to put the sizes together."""

    def best(rest, sums):
        if not rest:
            return sum(price(min(c for c in lengths if c >= s)) for s in sums)
        now, tried, found = rest[0], set(), []
        for i, s in enumerate(sums):
            if s + now <= max(lengths) and s not in tried:
                tried.add(s)
                found.append(best(rest[1:], sums[:i] + [s + now] + sums[i + 1 :]))
        return min([*found, best(rest[1:], [*sums, now])])

    return best(sizes, [])


def test_joint_choice_against_the_exact_optimum():
    draw, lost, used = random.Random(3), [], set()
    for _ in range(60):
        lengths = draw.choice([[4, 8, 16], [5, 12], [3, 6, 12, 24]])
        sizes = sorted((draw.randint(1, draw.choice([4, max(lengths)])) for _ in range(7)), reverse=True)
        sizes = [min(s, max(lengths)) for s in sizes]
        found = packing.joint_fit(sizes, lengths, price)
        used |= {(tuple(lengths), c) for c in found[2]}
        least = cheapest(sizes, lengths)
        assert total(found) >= least - 1e-9
        assert all(total(found) <= total(packing.best_fit(sizes, lengths, [c], price)) for c in lengths)
        lost.append(total(found) / least - 1)
    assert max(lost) <= 0.25 and sum(lost) / len(lost) <= 0.03
    assert len(used) == 9  # every length is of use


def test_several_lengths_are_used():
    draw = random.Random(4)
    sizes = sorted((min(8192, int(draw.lognormvariate(6, 1.2)) + 1) for _ in range(4000)), reverse=True)
    bins, _, final = packing.joint_fit(sizes)
    assert len(set(final)) >= 4
    spent = sum(map(packing.cost, final))
    assert all(spent <= sum(map(packing.cost, packing.best_fit(sizes, opened_at=[c])[2])) for c in packing.CAPACITIES)
    assert sum(sizes) >= 0.97 * sum(final)


def test_no_token_is_lost(spark, make):
    draw = random.Random(2)
    rows = [(i, prose(i, draw.choice([1, 10, 100, 9000, 20_000]))) for i in range(40)]
    got = packing.packed(make(rows), shard=16).toPandas()
    for doc_id, text in rows:
        own = got[got.doc_id == doc_id].sort_values("piece")
        assert own.n_tokens.sum() == len(text.split()) and list(own.piece) == list(range(len(own)))
    for _, b in got.groupby("bin_id"):
        b = b.sort_values("bin_start")
        assert list(b.bin_start) == [0, *b.n_tokens.cumsum()[:-1]]
        assert b.n_tokens.sum() == b.bin_tokens.iloc[0] <= b.bin_capacity.iloc[0]
        assert all(c >= b.bin_capacity.iloc[0] for c in packing.CAPACITIES if c >= b.bin_tokens.iloc[0])


def test_reruns_agree(spark, make):
    rows = [(i, prose(i % 7, 50 + i % 3)) for i in range(60)]
    one, two = (packing.packed(d, shard=8).toPandas().sort_values(["doc_id", "piece"]).reset_index(drop=True) for d in (make(rows), make(rows[::-1]).repartition(3)))
    assert one.equals(two)


def test_odd_rows(spark, messy, empty):
    got = packing.packed(messy).toPandas()
    assert set(got.doc_id.dropna()) == {1, 2, 6, 7, 8}
    assert sorted(got[got.doc_id == 1]["copy"]) == [1, 2] and got.doc_id.isna().sum() == 2
    assert packing.packed(empty).count() == 0
