"""Operators against other forms of the same stage, balanced joins on skewed data, and properties of the network.

Runs on the sf0.001 log with null actors injected (every user id divisible by 11), so the null rules are exercised.
"""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from refnet.operators import cites, core, normalize, relational
from refnet.plans.network import ReferenceNetwork
from refnet.plans.skew import balanced_join, hot_keys
from refnet.sources.fixture import raw_log


@pytest.fixture(scope="module")
def raw(spark):
    return raw_log(spark, SF_SMALL, null_actor_every=11).cache()


@pytest.fixture(scope="module")
def log(raw):
    return normalize.normalize_log(raw)


@pytest.fixture(scope="module")
def net(raw):
    return ReferenceNetwork(raw)


@pytest.fixture(scope="module")
def dealt(raw):
    return ReferenceNetwork(raw, shares=5000)  # every key is hot


def test_nulls_present(log):
    assert log.filter(F.col("actor_id").isNull()).count() > 0


def test_core_forms_agree(log, net, dealt):
    expect = rows(core.core_by_outer_join(log))
    assert expect == rows(net.core_contributors) == rows(dealt.core_contributors)
    assert expect == rows(core.core_by_window(core.push_activity(log), buckets=3).select("repo_id", "actor_id"))


@pytest.mark.parametrize("stage", ["focal_refs", "citations", "citation_counts", "theta_pair_counts", "reference_actors", "j_edges", "actual_i_edges"])
def test_dealing_keys_out_changes_nothing(net, dealt, stage):
    expect = rows(getattr(net, stage))
    assert expect and rows(getattr(dealt, stage)) == expect


def test_counts_equal_counts_over_pairs(net):
    assert rows(net.citation_counts) == rows(cites.citation_counts_from_edges(net.citation_edges))
    assert rows(cites.citations_plain(net.core_contributors, net.distinct_pull_pairs)) == rows(net.citations)
    members = Counter(r["repo_id"] for r in net.core_contributors.collect())
    expect = Counter()
    for r in net.citation_edges.collect():
        expect[r["focal_repo_id"]] += sum(members.values()) - members[r["source_repo_citing_focal_repo"]]
    assert {r["focal_repo_id"]: r["pair_count"] for r in net.theta_pair_counts.collect()} == dict(expect)


def test_actual_i_by_null_test(net):
    j = net.j_edges.select("source_repo_citing_focal_repo")
    found = relational.unmatched(net.citation_edges, j, "source_repo_citing_focal_repo").distinct()
    assert rows(found, *net.citation_edges.columns) == rows(net.actual_i_edges, *net.citation_edges.columns)


# --- balanced joins ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 has a third of both sides, key 1 a third of the left one, null keys are there."""
    rng = random.Random(1)
    left = [(rng.choice([0, 1, rng.randrange(2, 40), None]), f"l{i}") for i in range(600)]
    right = [(rng.choice([0, rng.randrange(2, 60), rng.randrange(2, 60), None]), f"r{i}") for i in range(300)]
    return left, right, spark.createDataFrame(left, "k long, v string"), spark.createDataFrame(right, "k long, w string")


@pytest.mark.parametrize("shares", [1, 7, 64, 100_000])
def test_balanced_inner_join(skewed, shares):
    left, right, a, b = skewed
    expect = sorted((k, v, w) for k, v in left for m, w in right if k is not None and k == m)
    joined = balanced_join(a, b, ["k"], shares=shares)
    assert joined.columns == ["k", "v", "w"] and rows(joined) == expect
    some = balanced_join(a, b, ["k"], condition=lambda: F.col("v") < F.col("w"), left_salt=["v"], right_salt=["w"], shares=shares)
    assert rows(some) == [t for t in expect if t[1] < t[2]]


@pytest.mark.parametrize("shares", [1, 64])
def test_balanced_joins_with_a_set(skewed, shares):
    left, right, a, b = skewed
    keys, have = b.select("k").distinct(), {k for k, _ in right if k is not None}
    by_null = lambda t: tuple((x is None, x) for x in t)
    assert rows(balanced_join(a, keys, ["k"], "left_semi", shares=shares)) == sorted(((k, v) for k, v in left if k in have), key=by_null)
    assert rows(balanced_join(a, keys, ["k"], "left_anti", shares=shares)) == sorted(((k, v) for k, v in left if k not in have), key=by_null)
    once = b.groupBy("k").agg(F.max("w").alias("w"))
    first = {k: max(w for m, w in right if m == k) for k in have}
    assert rows(balanced_join(a, once, ["k"], "left", shares=shares)) == sorted(((k, v, first.get(k)) for k, v in left), key=by_null)


def test_hot_keys_are_few_and_cells_even(skewed):
    left, right, a, b = skewed
    for shares in (4, 16, 64):
        hot = {r["k"]: r for r in hot_keys(a, b, ["k"], shares).collect()}
        l, r = Counter(k for k, _ in left if k is not None), Counter(k for k, _ in right if k is not None)
        work = {k: l[k] * r[k] for k in l if k in r}
        total = sum(work.values())
        assert set(hot) == {k for k in work if work[k] * shares >= total} and len(hot) <= shares
        for k, h in hot.items():
            cells = h["_rows"] * h["_cols"]
            assert work[k] * shares / total <= cells <= 2 * work[k] * shares / total + 2 * max(h["_rows"], h["_cols"])
            assert h["_rows"] > 1 and h["_cols"] > 1 or cells < 16  # large on both sides: a grid, not a line
    assert hot_keys(a.limit(0), b, ["k"]).count() == 0


def test_a_hot_key_meets_in_many_tasks(spark):
    """The final plan's largest join task holds a small part of the pairs of a key that is large on both sides; other keys
    meet in a join of their own."""
    a = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    b = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = balanced_join(a, b, ["k"], shares=64).groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(pairs) == 16 and max(r["count"] for r in pairs) < 0.4 * sum(r["count"] for r in pairs)


# --- properties ------------------------------------------------------------------------------------------------


def test_j_sources_and_actual_i_sources_disjoint(net):
    j_src = net.j_edges.select("source_repo_citing_focal_repo")
    i_src = net.actual_i_edges.select("source_repo_citing_focal_repo")
    assert j_src.intersect(i_src).count() == 0


def test_focal_differs_from_destination(net):
    assert net.focal_edges.filter(F.col("focal_repo_id") == F.col("destination_repo_id")).count() == 0
    assert net.citations.filter(F.col("source_repo_citing_focal_repo") == F.col("focal_repo_id")).count() == 0


def test_core_subset_of_pushers(log, net):
    pushers = normalize.push_events(log).select("repo_id", "actor_id")
    outside = net.core_contributors.join(pushers, ["repo_id", "actor_id"], "left_anti")
    assert outside.filter(F.col("actor_id").isNotNull()).count() == 0


def test_every_repo_without_null_pushers_has_a_core_contributor(log, net):
    push = normalize.push_events(log)
    clean = push.groupBy("repo_id").agg(F.count_if(F.col("actor_id").isNull()).alias("nulls")).filter("nulls = 0")
    assert clean.join(net.core_contributors, "repo_id", "left_anti").count() == 0


def test_j_focal_equals_source(net):
    assert net.j_edges.filter(F.col("focal_repo_id") != F.col("source_repo_citing_focal_repo")).count() == 0
