"""The network as a run: reads of the log, interval matching, counts by words, filters, buckets, restart, counts."""

from __future__ import annotations

import os
import random
import re

import pytest
from conftest import SF_MID, rows
from pyspark.sql import functions as F
from test_golden import golden_raw

from refnet.operators import activity, cites, core, disrupt, normalize, refs
from refnet.plans import reduce
from refnet.plans.handoff import Store
from refnet.plans.network import STAGES, ReferenceNetwork, run_network, stage_counts
from refnet.plans.views import register_functions, sql_repo_profile
from refnet.session import work_dir
from refnet.sources.fixture import raw_log


@pytest.fixture(scope="module")
def written_log(spark):
    path = work_dir(spark, "test-log")
    raw_log(spark, SF_MID, null_actor_every=11).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# --- one read of the log -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("stage", ["core_contributors", "focal_refs", "theta_pair_counts", "reference_actors", "j_counts", "actual_i_counts"])
def test_a_query_reads_the_log_once(spark, written_log, stage):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    n = written_log.count()
    found = getattr(ReferenceNetwork(written_log.mapInArrow(counted, written_log.schema)), stage)
    assert found.count() > 0 and read.value == n


def test_activity_agrees_with_the_stages_by_definition(spark, written_log):
    log = normalize.normalize_log(written_log)
    table = activity.activity(written_log).cache()
    assert rows(activity.pushes(table)) == rows(core.push_activity(log))
    assert rows(activity.pull_pairs(table)) == rows(cites.distinct_pull_pairs(log))
    assert rows(activity.pull_rows(table)) == rows(refs.pull_times(log).select("pr_repo_id", "actor_id", "pr_at"))
    spans = activity.pull_spans(activity.pull_rows(table))
    assert rows(spans.select("pr_repo_id", "actor_id", F.explode("times").alias("pr_at"))) == rows(refs.pull_times(log)) and spans.filter("last <= before or first <= before").count() == 0
    every = activity.activity(written_log, every=True).cache()
    assert every.agg(F.sum("n")).first()[0] == log.count()
    assert rows(activity.pushes(every)) == rows(activity.pushes(table)) and rows(activity.pull_pairs(every)) == rows(activity.pull_pairs(table))


def test_pull_rows_bring_no_other_columns(spark, written_log):
    """Copies of a pull request that differ elsewhere collapse before the shuffle."""
    wide = activity._narrow(written_log).filter("Type = 'PullRequestEvent'")
    assert wide.filter("event_id is not null or repo_name is not null").count() == 0 < wide.count()


# --- interval matching ---------------------------------------------------------------------------------------------


def moment(s):
    return f"20{10 + s // 31_000_000:02d}-{1 + s // 2_600_000 % 11:02d}-{1 + s // 86_400 % 27:02d} {s // 3600 % 24:02d}:{s // 60 % 60:02d}:{s % 60:02d} UTC"


def test_intervals_against_all_events(spark):
    rng = random.Random(8)
    data = []
    for actor in range(1, 30):
        for repo in rng.sample(range(40), rng.randrange(1, 6)):
            data += [(repo, "r", actor, "PushEvent", moment(rng.randrange(200_000_000))) for _ in range(2)]
        for repo in rng.sample(range(40), rng.randrange(1, 6)):
            data += [(repo, "r", actor, "PullRequestEvent", moment(rng.randrange(200_000_000))) for _ in range(rng.randrange(1, 4))]
    data += [(501, "r", 99, "PushEvent", "2015-01-01 00:00:00 UTC"), (502, "r", 99, "PullRequestEvent", "2015-01-01 00:00:00 UTC"), (503, "r", 99, "PullRequestEvent", "2015-01-01 00:00:01 UTC"), (504, "r", 99, "PullRequestEvent", "2014-12-31 23:59:59 UTC")]
    raw = spark.createDataFrame(data, "repo_id long, repo_name string, actor_id long, Type string, created_at string")
    log = normalize.normalize_log(raw)
    expect = rows(refs.focal_refs(log))
    assert len(expect) > 30 and (501, 502) in expect and not {(501, 503), (501, 504)} & set(expect)
    for shares in (1, 10_000):
        assert rows(ReferenceNetwork(raw, shares=shares).focal_refs) == expect


def test_a_bot_with_many_events_leaves_one_row_for_a_tenure_and_repository(spark):
    """60,000 pull requests in three repositories over several spans, against 40 tenures: 120 rows, not events x tenures."""
    at = lambda seconds: F.date_format(F.timestamp_seconds(F.lit(1_400_000_000) + seconds), "yyyy-MM-dd HH:mm:ss")
    pulls = spark.range(60_000).select((F.col("id") % 3).alias("repo_id"), F.lit("r").alias("repo_name"), F.lit(5).cast("long").alias("actor_id"), F.lit("PullRequestEvent").alias("Type"), at(F.col("id") * 500).alias("created_at"))
    push = spark.range(80).select((100 + F.expr("id div 2")).alias("repo_id"), F.lit("r").alias("repo_name"), F.lit(5).cast("long").alias("actor_id"), F.lit("PushEvent").alias("Type"), at(F.when(F.col("id") % 2 == 0, 0).otherwise(20_000_000) + F.col("id")).alias("created_at"))
    net = ReferenceNetwork(pulls.unionAll(push))
    assert net.pull_spans.count() > 9
    met = refs.tenure_spans(net.core_tenure, net.pull_spans, net.hot_actors)
    assert met.count() == 120 == net.focal_refs.count()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 100])
def test_binary_search(spark, n):
    times = list(range(0, 2 * n, 2))
    found = spark.createDataFrame([(times, a) for a in range(-1, 2 * n + 2)], "t array<int>, a int").select("a", activity.first_from(F.col("t"), F.col("a")).alias("f")).collect()
    assert {r["a"]: r["f"] for r in found} == {a: min((t for t in times if t >= a), default=None) for a in range(-1, 2 * n + 2)}


# --- counts by words -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shares", [1, 50_000])
def test_word_counts_equal_counts_over_pairs(spark, written_log, shares):
    net = ReferenceNetwork(written_log, shares=shares)
    pairs = disrupt.j_edges(net.source_actors, net.destination_pullers, net.hot_actors)
    assert rows(net.j_counts) == rows(disrupt.j_counts(pairs)) != []
    assert rows(net.j_edges) == rows(pairs)
    assert rows(net.actual_i_counts) == rows(disrupt.actual_i_counts(net.actual_i_edges)) != []


def test_words_hold_many_repositories(spark):
    """Actors that pull in the same repositories: those have neighbouring codes and fill the words."""
    members = spark.range(20_000).select((F.col("id") % 5000).alias("repo_id"), (F.expr("id % 5000 div 500") * 4 + F.expr("id div 5000")).alias("actor_id"))
    codes = Store(spark, work_dir(spark, "codes")).keep("codes", lambda: disrupt.repo_codes(members, "repo_id"))
    assert codes.select("code").distinct().count() == 5000
    words = disrupt.word_sets(members, codes, "repo_id")
    assert words.count() * 4 < members.count()
    actors = members.select((F.col("actor_id") % 8).alias("k"), "actor_id").distinct()
    assert rows(disrupt.union_counts(actors, "k", words, "n")) == [(k, 2500) for k in range(8)]


def test_counts_build_no_pairs(spark, written_log):
    net = ReferenceNetwork(written_log, shares=1)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    distinct_pairs = re.compile(r"Aggregate \[[^\]]*(destination_repo_id|source_repo_citing_focal_repo)#")
    assert distinct_pairs.search(plan(disrupt.j_edges(net.source_actors, net.destination_pullers, net.hot_actors)))
    assert "bit_or" in plan(net._j_words) and not distinct_pairs.search(plan(net._j_words)) and not distinct_pairs.search(plan(net.j_edges))
    for name in ("j_counts", "actual_i_counts"):
        found = plan(getattr(net, name))
        assert "bit_count" in found and not distinct_pairs.search(found) and "Distinct" not in found


def test_second_theta_step(spark, written_log):
    """Against the sums over its three tables, pair by pair."""
    net = ReferenceNetwork(written_log, shares=200)
    cited = [r["source_repo_citing_focal_repo"] for r in net.citation_edges.collect()]
    reached = {}
    for r in net.reference_actors.collect():
        reached[r["actor_id"]] = reached.get(r["actor_id"], 0) + 1
    own = {s: cited.count(s) for s in set(cited)}
    expect = {}
    for r in net.core_contributors.filter("actor_id is not null").collect():
        n = (len(cited) - own.get(r["repo_id"], 0)) * reached.get(r["actor_id"], 0)
        expect[r["repo_id"]] = expect.get(r["repo_id"], 0) + n
    assert rows(net.theta_reference_counts) == sorted((k, v) for k, v in expect.items() if v)


# --- reduced pulls -------------------------------------------------------------------------------------------------


def test_the_filter_lets_all_keys_and_few_others_through(spark, no_broadcast):
    keys = spark.range(0, 2000, 2).withColumnRenamed("id", "k")
    many = spark.range(100_000).select(F.when(F.col("id") % 97 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    bits = 1 << 14
    passed = reduce.may_hold(many, reduce.bloom_words(keys, "k", bits), "k", bits)
    held = {r["k"] for r in passed.collect()}
    assert {k for k in range(0, 2000, 2) if k % 97} <= held and len(held) < 0.12 * 100_000
    expect = sorted((k, k) for k in range(0, 2000, 2) if k % 97)
    assert rows(reduce.reduced(many, keys, "k", 1000, ["v"])) == expect
    assert rows(reduce.reduced(many, keys, "k", 1000, ["v"], most_bits=64)) == expect  # more keys than the filter takes
    assert reduce.reduced(many, keys.limit(0), "k", 0, ["v"]).count() == 0
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(reduce.reduced(many, keys, "k", 1000, ["v"])) == expect  # few enough to be sent whole


def test_pulls_meet_the_filter_before_their_join(spark, written_log, no_broadcast):
    net = ReferenceNetwork(written_log)
    spans = net.pull_spans
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "_word" in plan and "BroadcastHashJoin" in plan
    core_actors = {r["actor_id"] for r in net.core_contributors.collect()}
    all_pairs = rows(net.distinct_pull_pairs)
    assert rows(net.core_pulls, "repo_id", "actor_id") == [p for p in all_pairs if p[1] in core_actors and None not in p]
    assert net.core_pulls.count() < len(all_pairs)


# --- handed-on tables ----------------------------------------------------------------------------------------------


def test_bucketed_tables_are_not_shuffled_again(spark, written_log, no_broadcast):
    net = run_network(spark, written_log, work_dir(spark, "bucketed"), shares=1, skip=STAGES)
    assert net.hot_actors.isEmpty()  # nobody holds all pairs
    for name in ("_j_words", "citations"):
        plan = final_plan(getattr(net, name))
        assert "Bucketed: true" in plan and "hashpartitioning(actor_id" not in plan, name
    assert rows(net.j_edges) == rows(ReferenceNetwork(written_log).j_edges)
    net.store.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(net.store._prefix)]


class Killed(Exception):
    pass


def test_a_killed_run_goes_on_after_its_last_whole_table(spark):
    """Killed after each table and output in turn; what was whole is not made again, and the outputs are the same."""
    raw, out = golden_raw(spark), work_dir(spark, "restart")
    whole = run_network(spark, raw, work_dir(spark, "whole"), fmt="csv")
    order, made = list(whole.store.made), []

    def kill_after(last):
        def after(name):
            made.append(name)
            if name == last:
                raise Killed

        return after

    for name in order[:-1:3]:  # every third, to keep the test short
        with pytest.raises(Killed):
            run_network(spark, raw, out, fmt="csv", resume=True, after=kill_after(name))
    again = run_network(spark, raw, out, fmt="csv", resume=True, after=made.append)
    assert made == order  # each once, in one order over all the runs
    assert again.counts.items() <= whole.counts.items() and {f"out-{n}" for n in STAGES} <= set(made)
    for name in STAGES:
        files = [spark.read.option("header", True).csv(f"{folder}/{name}") for folder in (out, whole.store.root)]
        assert rows(files[0]) == rows(files[1]), name
    third = run_network(spark, raw, out, fmt="csv", resume=True)
    assert third.store.made == [] and rows(third.j_edges) == rows(again.j_edges)


def test_a_table_without_a_marker_is_made_again(spark):
    out = work_dir(spark, "half")
    half = Store(spark, out)
    with pytest.raises(Exception, match="division|DIVIDE"):
        half.keep("t", lambda: spark.range(100).select(F.assert_true(F.col("id") < 99, F.lit("division")).alias("x")))
    again = Store(spark, out, resume=True)
    assert again.keep("t", lambda: spark.range(3)).count() == 3 and again.made == ["t"] and again.counts == {"t": 3}


def test_another_run_is_not_resumed(spark):
    out = work_dir(spark, "other")
    run_network(spark, golden_raw(spark), out, skip=STAGES)
    with pytest.raises(ValueError, match="another log"):
        run_network(spark, golden_raw(spark), out, skip=STAGES, shares=7, resume=True)


def test_counts_come_with_the_run(spark):
    net = run_network(spark, golden_raw(spark), work_dir(spark, "counts"), count_log=True)
    for name in STAGES:
        assert net.counts[name] == getattr(net, name).count(), name
    assert net.counts["activity"] == net.log.count() == 18
    jobs = len(net.store.made)
    assert rows(stage_counts(net)) == [("core_contributors", 5), ("distinct_pull_pairs", 6), ("focal_refs", 3), ("normalized_log", 18)]
    assert net.store.made[jobs:] == ["pull_pairs"]


def test_a_run_on_another_file_system(spark, tmp_path):
    """Log and outputs by paths that only Hadoop's file systems know (a mount table here, an object store elsewhere)."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.refnet.link./store", f"file://{tmp_path}")
    golden_raw(spark).write.option("header", True).csv("viewfs://refnet/store/log")
    from refnet.sources import read_activity_log

    raw = read_activity_log(spark, "viewfs://refnet/store/log")
    net = run_network(spark, raw, "viewfs://refnet/store/out", fmt="csv")
    assert rows(net.j_counts) == [(1, 2), (2, 1), (3, 2)] and os.path.isdir(tmp_path / "out" / "j_counts")
    assert run_network(spark, raw, "viewfs://refnet/store/out", fmt="csv", resume=True).store.made == []


def test_no_python_worker(spark):
    """The network has no Python in its plans."""
    net = ReferenceNetwork(golden_raw(spark))
    for name in STAGES:
        assert "Python" not in getattr(net, name)._jdf.queryExecution().executedPlan().toString(), name


def test_stages_as_table_functions(spark, written_log):
    """With and without a repository, and in the body of another function."""
    net = ReferenceNetwork(written_log)
    names = register_functions(spark, {n: getattr(net, n) for n in ("focal_refs", "citation_edges", "actual_i_edges")}, "t_")
    assert names == ["t_focal_refs", "t_citation_edges", "t_actual_i_edges"]
    assert rows(spark.sql("SELECT * FROM t_focal_refs()")) == rows(net.focal_refs)
    one = net.focal_refs.agg(F.min("focal_repo_id")).first()[0]
    assert rows(spark.sql(f"SELECT repo_id FROM t_focal_refs({one})")) == rows(net.focal_refs.filter(F.col("focal_repo_id") == one).select("repo_id"))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION t_both(r BIGINT) RETURNS TABLE (n BIGINT) RETURN SELECT count(*) FROM t_focal_refs() f JOIN t_citation_edges() c ON c.focal_repo_id = f.repo_id WHERE f.focal_repo_id = r")
    cited = {}
    for r in net.citation_edges.collect():
        cited[r["focal_repo_id"]] = cited.get(r["focal_repo_id"], 0) + 1
    expect = sum(cited.get(r["repo_id"], 0) for r in net.focal_refs.collect() if r["focal_repo_id"] == one)
    assert spark.sql(f"SELECT n FROM t_both({one})").first()[0] == expect
    profile = {r["focal_repo_id"]: r for r in sql_repo_profile(spark, "t_").collect()}
    assert len(profile) == net.focal_counts.count() and all(p["citing_sources"] >= p["outside"] for p in profile.values())
