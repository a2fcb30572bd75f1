"""Hand-made 19-row log with the expected output of every stage (FIXTURES.md section 3)."""

from __future__ import annotations

import pytest
from conftest import rows

from refnet.operators import cites, core, normalize
from refnet.plans.network import ReferenceNetwork
from refnet.schema import RAW_LOG_SCHEMA

GOLDEN = """\
1,1,PushEvent,2016-01-01 10:00:00 UTC
1,1,PushEvent,2016-01-05 10:00:00 UTC
1,1,PushEvent,2016-01-09 10:00:00 UTC
1,2,PushEvent,2016-01-02 10:00:00 UTC
2,2,PushEvent,2016-01-03 10:00:00 UTC
2,2,PushEvent,2016-01-07 10:00:00 UTC
3,3,PushEvent,2016-01-04 10:00:00 UTC
3,4,PushEvent,2016-01-06 10:00:00 UTC
4,5,PushEvent,2016-01-05 10:00:00 UTC
6,,PushEvent,2016-01-05 11:00:00 UTC
6,6,PushEvent,2016-01-05 12:00:00 UTC
2,1,PullRequestEvent,2016-01-06 10:00:00 UTC
3,1,PullRequestEvent,2016-01-20 10:00:00 UTC
3,2,PullRequestEvent,2016-01-07 10:00:00 UTC
1,3,PullRequestEvent,2016-01-04 10:00:00 UTC
3,4,PullRequestEvent,2016-01-06 10:00:00 UTC
5,5,PullRequestEvent,2016-01-09 10:00:00 UTC
1,6,IssuesEvent,2016-01-05 12:00:00 UTC
1,1,PushEvent,2016-01-01 10:00:00 UTC"""


def golden_raw(spark):
    data = []
    for line in GOLDEN.splitlines():
        repo, actor, typ, ts = line.split(",")
        data.append((int(repo), "org/r", int(actor) if actor else None, typ, ts))
    return spark.createDataFrame(data, RAW_LOG_SCHEMA)


@pytest.fixture(scope="module", params=[1, 40], ids=["hardly-any-hot-key", "all-keys-hot"])
def net(spark, request):
    return ReferenceNetwork(golden_raw(spark), shares=request.param)


def test_normalised_log(spark):
    log = normalize.normalize_log(golden_raw(spark))
    assert log.count() == 18
    assert log.columns == ["repo_id", "repo_name", "actor_id", "Type", "created_at"]


def test_core_contributors(net):
    assert rows(net.core_contributors, "repo_id", "actor_id") == [(1, 1), (2, 2), (3, 3), (3, 4), (4, 5)]


def test_core_contributors_all_forms(spark):
    log = normalize.normalize_log(golden_raw(spark))
    expect = [(1, 1), (2, 2), (3, 3), (3, 4), (4, 5)]
    assert rows(core.core_contributors(log), "repo_id", "actor_id") == expect
    assert rows(core.core_by_outer_join(log), "repo_id", "actor_id") == expect
    assert rows(core.core_by_window(core.push_activity(log), buckets=2), "repo_id", "actor_id") == expect


def test_focal_refs(net):
    assert rows(net.focal_refs) == [(1, 2), (2, 3), (3, 1)]


def test_distinct_pull_pairs(net):
    assert rows(net.distinct_pull_pairs) == [(1, 3), (2, 1), (3, 1), (3, 2), (3, 4), (5, 5)]


def test_citations(net):
    got = rows(net.citations, "source_repo_citing_focal_repo", "actor_id", "focal_repo_id")
    assert got == [(1, 1, 2), (1, 1, 3), (2, 2, 3), (3, 3, 1), (4, 5, 5)]


def test_citation_counts(net):
    assert rows(net.citation_counts) == [(1, 1), (2, 1), (3, 2), (5, 1)]
    assert rows(cites.citation_counts_from_edges(net.citation_edges)) == [(1, 1), (2, 1), (3, 2), (5, 1)]


def test_source_actors(net):
    assert rows(net.source_actors) == [(1, 1, 1), (2, 2, 2), (3, 3, 3), (3, 3, 4), (4, 4, 5)]


def test_reference_actors(net):
    assert rows(net.reference_actors) == [(1, 2, 1), (2, 3, 1), (2, 3, 2), (2, 3, 4), (3, 1, 3)]


def test_j(net):
    assert rows(net.j_edges) == [(1, 1, 2), (1, 1, 3), (2, 2, 3), (3, 3, 1), (3, 3, 3)]
    assert rows(net.j_counts) == [(1, 2), (2, 1), (3, 2)]


def test_actual_i(net):
    assert rows(net.actual_i_edges) == [(5, 4, 5)]
    assert rows(net.actual_i_counts) == [(5, 1)]
