from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import mixing


def highest_quotients(weights, seats, caps):
    quota = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if weights[i] > 0 and quota[i] < caps[i]]
        if not open_:
            break
        best = max(open_, key=lambda i: (weights[i] / (2 * quota[i] + 1), -i))
        quota[best] += 1
    return quota


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 100), st.integers(0, 30)), min_size=1, max_size=8), st.integers(0, 60))
def test_divisor_gives_the_quotients_seats(entries, seats):
    weights, caps = [w for w, _ in entries], [c for _, c in entries]
    got = mixing.sainte_lague(weights, seats, caps)
    assert sum(got) == sum(highest_quotients(weights, seats, caps)) and all(g <= c for g, c in zip(got, caps))


def test_sainte_lague_example():
    assert mixing.sainte_lague([53, 24, 23], 7) == [3, 2, 2]


def build(spark):
    r, rows, n = random.Random(5), [], 0
    for source, count in (("big", 1500), ("small", 60), ("tiny", 25), ("other", 50), (None, 20)):
        for _ in range(count):
            rows.append((n, source, " ".join(r.choice("alpha beta gamma delta".split()) for _ in range(r.randrange(5, 60)))))
            n += 1
    rows += [(n, "big", None), (n + 1, "small", ""), (n + 2, "tiny", "alpha " * 40), (n + 2, "tiny", "alpha " * 40)]
    documents = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 AS shard", "2 AS cap", "3 AS quota", "4 AS n_tokens")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.25, 4), ("tiny", 0.1, 3), ("absent", 0.05, 2), (None, 0.1, 1), ("off", None, None)], "source_name string, target_share double, max_repeats int")
    return documents, targets


def test_mix(spark):
    documents, targets = build(spark)
    mixture, report = mixing.mix(documents, targets)
    shares = {r["source_name"]: r for r in report.collect()}
    assert set(shares) == {"big", "small", "tiny", "absent", "off"} and shares["absent"]["reached_share"] == 0
    for name, share in (("big", 0.6), ("small", 0.25), ("tiny", 0.1)):
        assert abs(shares[name]["reached_share"] - share / 0.95) < 0.02
        assert shares[name]["most_uses"] <= shares[name]["max_repeats"]
    used = mixture.collect()
    assert {r["source"] for r in used} == {"big", "small", "tiny"} and all(r["n_tokens"] > 0 for r in used)
    again = mixing.mix(documents, targets)[0]
    assert sorted(map(tuple, used)) == sorted(map(tuple, again.collect()))
    other = mixing.mix(documents, targets, seed=8)[0]
    assert sorted(map(tuple, used)) != sorted(map(tuple, other.collect()))


def test_wish_and_empty_tables(spark):
    documents, targets = build(spark)
    report = {r["source_name"]: r for r in mixing.mix(documents, targets, total_tokens=2000)[1].collect()}
    assert abs(sum(r["mixed_tokens"] for r in report.values()) - 2000) < 200
    mixture, report = mixing.mix(documents.where("false"), targets)
    assert mixture.count() == 0 and {r["reached_share"] for r in report.collect()} == {0.0}
    assert mixing.mix(documents, targets.where("false"))[1].count() == 0


def test_blocks_quotas_and_caps(spark):
    documents, targets = build(spark)
    for total in (None, 3000, 700):
        mixture, report = mixing.mix(documents, targets, total_tokens=total)
        shares = {r["source_name"]: r for r in report.collect()}
        all_quota = sum(r["quota_tokens"] for r in shares.values())
        for name, share in (("big", 0.6), ("small", 0.25), ("tiny", 0.1)):
            r = shares[name]
            assert abs(r["quota_tokens"] - all_quota * share / 0.95) <= max(1, all_quota / mixing.BLOCKS)  # integer quotas of blocks
            assert abs(r["mixed_tokens"] - r["quota_tokens"]) <= 3  # whole documents, the last one chosen to fit
            assert r["most_uses"] <= r["max_repeats"]
        used = mixture.collect()
        assert abs(sum(r["n_tokens"] * r["uses"] for r in used) - all_quota) <= 9 and all(r["block"] >= 0 for r in used)
        assert abs(sum(r["reached_share"] for r in shares.values()) - 1) < 1e-9


def test_a_full_shard_passes_its_seats_on():
    assert mixing.sainte_lague([50, 30, 20], 10, [2, 9, 9]) == highest_quotients([50, 30, 20], 10, [2, 9, 9]) == [2, 5, 3]
