from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as M


def plain_targets(sizes):
    """Shares by weight, with what exceeds three times a size reshared until none is above."""
    weights = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in sizes if s not in full]
        level = left / sum(weights[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weights[s] > 3 * sizes[s]]
        if not over:
            return target | {s: level * weights[s] for s in open_}
        for s in over:
            full.add(s)
            target[s] = 3.0 * sizes[s]
            left -= target[s]


def results(frame, **settings):
    sizes = M.sized(frame, M.word_count(F.col("text")), None)
    return M.mixed(sizes, **settings).collect()


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_sources_reach_their_targets(spark, scale):
    documents = spark.read.parquet(f"/root/testdata/sf{scale}/documents.parquet")
    rows = results(documents)
    by_source, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        by_source[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    wanted = plain_targets(by_source)
    assert target == pytest.approx(wanted)
    assert sum(target.values()) == pytest.approx(sum(by_source.values()))
    largest = defaultdict(int)
    for r in rows:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in target)
    assert sorted(map(tuple, results(documents))) == sorted(map(tuple, rows))


def test_a_source_that_is_too_small_stops_at_three_times_its_size(spark):
    rows = [(i, "word " * 100, "b") for i in range(50)] + [(100, "one two", "c"), (101, "x", None)]
    got = results(spark.createDataFrame(rows, "doc_id int, text string, source string"))
    assert {r["source"]: (r["target"], r["taken"]) for r in got if r["source"] != "b"} == {
        "c": (6.0, 6), None: (3.0, 3),
    }
    assert sum(r["taken"] for r in got) == pytest.approx(5003, abs=100)


def plain_taken(rows, seed):
    """Rank order, in rounds, and the closing document, for rows (doc_id, source, size) of one weight and equal chances."""
    import hashlib

    words = defaultdict(int)
    for _, source, size in rows:
        words[source] += size
    taken = {}
    for source, target in plain_targets(words).items():
        own = [(i, size) for i, s, size in rows if s == source]
        whole = int(target / words[source] + 1e-9)
        chance = target / words[source] - whole
        taken |= {i: whole * size for i, size in own}
        if chance <= 1e-9:
            continue
        ranks = {}
        for i, _ in own:
            u = (int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            ranks[i] = (u / (1 - u)) * ((1 - chance) / chance)
        gap, left = target - whole * words[source], sorted(own, key=lambda x: ranks[x[0]])
        for _ in range(4):
            upto, went = 0, []
            for i, size in [x for x in left if x[1] <= gap]:
                if upto + size > gap:
                    break
                upto += size
                went.append((i, size))
            gap -= upto
            left = [x for x in left if x not in set(went)]
            for i, size in went:
                taken[i] += size
        near = [(abs(gap - size), ranks[i], i, size) for i, size in left if abs(gap - size) < gap]
        if near:
            *_, i, size = min(near)
            taken[i] += size
    return taken


def test_sources_of_giants_come_near_their_targets(spark):
    """Ten sources, each of 3000 short documents and two of a third of its words."""
    rows = [(10_000 * k + i, f"s{k}", 20 if i < 3000 else 60_000) for k in range(10) for i in range(3002)]
    sizes = spark.createDataFrame([(*r, 0) for r in rows], "doc_id int, source string, size bigint, class int")
    got = M.mixed(sizes).collect()
    assert {r["doc_id"]: r["taken"] for r in got} == plain_taken(rows, "mix")
    taken, target = defaultdict(int), {r["source"]: r["target"] for r in got}
    for r in got:
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)


def test_unequal_chances(spark):
    rows = [(i, "a b c d", "s", 4.0 if i % 2 else 1.0) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string, w double")
    four = F.lit(4).cast("bigint").alias("size")
    classed = frame.select("doc_id", "source", four, M.weight_class(F.col("w")).alias("class"))
    got = M.mixed(classed).join(frame, "doc_id").groupBy("w").agg(F.avg("copies").alias("m")).collect()
    mean = {r["w"]: r["m"] for r in got}
    assert mean == pytest.approx({4.0: 1.6, 1.0: 0.4}, abs=0.05)


def test_odd_rows(odd, empty):
    rows = results(odd)
    assert len(rows) == odd.count() and all(r["taken"] == 0 for r in rows if r["doc_id"] in (1, 2, 4))
    assert results(empty) == [] and M.mix(empty).count() == 0
    clashing = odd.withColumn("size", F.lit("s")).withColumn("class", F.lit("c")).withColumn("_row", F.lit(1))
    mixed = M.mix(clashing)
    assert mixed.columns == clashing.columns and {r["size"] for r in mixed.collect()} == {"s"}
