"""Edge cases of FIXTURES.md section 4, and the file sources and sinks."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refnet.functions.columns import timestamp_key, timestamp_text
from refnet.operators import core, normalize
from refnet.plans.network import STAGES, ReferenceNetwork, run_network
from refnet.schema import FOCAL_EDGE_SCHEMA, RAW_LOG_SCHEMA
from refnet.session import work_dir
from refnet.sources import delimited

WITH_ID = T.StructType([T.StructField("event_id", T.LongType())] + list(RAW_LOG_SCHEMA.fields))


def raw(spark, data, schema=WITH_ID):
    return spark.createDataFrame(data, schema)


def test_rows_equal_on_five_columns_are_both_counted(spark):
    r = raw(
        spark,
        [
            (1, 1, "r", 7, "PushEvent", "2016-01-01 10:00:00 UTC"),
            (2, 1, "r", 7, "PushEvent", "2016-01-01 10:00:00 UTC"),  # differs only in event_id
            (3, 1, "r", 7, "PushEvent", "2016-01-01 10:00:00.5 UTC"),  # differs in the fraction of a second
            (3, 1, "r", 7, "PushEvent", "2016-01-01 10:00:00.5 UTC"),  # exact copy: removed
        ],
    )
    log = normalize.normalize_log(r)
    assert log.count() == 3
    assert rows(core.push_counts(log)) == [(7, 1, 3)]


def test_all_push_actors_null_gives_no_core_and_no_error(spark):
    r = raw(spark, [(1, 9, "r", None, "PushEvent", "2016-01-01 10:00:00 UTC"), (2, 9, "r", None, "PushEvent", "2016-01-02 10:00:00 UTC")])
    log = normalize.normalize_log(r)
    assert rows(core.avg_push(log)) == [(9, None)]
    assert core.core_contributors(log).count() == core.core_by_outer_join(log).count() == 0
    assert core.core_by_window(core.push_activity(log)).count() == 0


def test_unparseable_time_counts_as_push_but_matches_no_tenure(spark):
    r = raw(
        spark,
        [
            (1, 1, "r", 5, "PushEvent", "not a time"),
            (2, 1, "r", 5, "PushEvent", "2016-01-05 10:00:00 UTC"),
            (3, 2, "r", 5, "PullRequestEvent", "garbage"),
            (4, 2, "r", 5, "PullRequestEvent", "2016-01-05 10:00:00 UTC"),
        ],
    )
    net = ReferenceNetwork(r)
    log = normalize.normalize_log(r)
    assert log.filter(F.col("created_at").isNull()).count() == 2
    assert rows(core.push_counts(log)) == [(5, 1, 2)]
    assert rows(net.focal_refs) == [(1, 2)]


def test_null_repo_never_core_nor_reference(spark):
    r = raw(
        spark,
        [
            (1, None, "r", 5, "PushEvent", "2016-01-05 10:00:00 UTC"),
            (2, 1, "r", 5, "PushEvent", "2016-01-05 10:00:00 UTC"),
            (3, None, "r", 5, "PullRequestEvent", "2016-01-05 10:00:00 UTC"),
        ],
    )
    net = ReferenceNetwork(r)
    assert rows(net.core_contributors) == [(1, 5)]
    assert net.focal_refs.count() == 0


def test_lower_case_type_header(spark):
    schema = T.StructType([T.StructField("type" if f.name == "Type" else f.name, f.dataType) for f in WITH_ID.fields])
    r = raw(spark, [(1, 1, "r", 5, "PushEvent", "2016-01-05 10:00:00 UTC")], schema)
    log = normalize.normalize_log(r)
    assert "Type" in log.columns
    assert rows(core.core_contributors(log)) == [(1, 5)]


def test_results_do_not_depend_on_the_session_zone(spark, zone):
    # 02:30 on this day does not exist in New York.
    data = [
        (1, 1, "r", 5, "PushEvent", "2016-03-13 02:00:00 UTC"),
        (2, 1, "r", 5, "PushEvent", "2016-03-13 03:00:00 UTC"),
        (3, 2, "r", 5, "PullRequestEvent", "2016-03-13 02:30:00 UTC"),
    ]
    seen = []
    for name in ("UTC", "America/New_York", "Asia/Kathmandu"):
        zone(name)
        log = normalize.normalize_log(raw(spark, data))
        seen.append((rows(ReferenceNetwork(raw(spark, data)).focal_refs), rows(log.select(timestamp_text("created_at").alias("t")))))
        assert spark.conf.get("spark.sql.session.timeZone") == name
    assert seen == [([(1, 2)], [("2016-03-13 02:00:00",), ("2016-03-13 02:30:00",), ("2016-03-13 03:00:00",)])] * 3


def test_bad_times_are_null(spark):
    data = [(i, 1, "r", 5, "PushEvent", t) for i, t in enumerate(["2016-02-30 10:00:00 UTC", "2016-02-01", "2016-02-01T10:00:00Z", "", None, "2016-02-01 10:00:00.5 UTC"])]
    times = [r["t"] for r in normalize.normalize_log(raw(spark, data)).select(timestamp_text("created_at").alias("t")).collect()]
    assert sorted(t for t in times if t) == ["2016-02-01 10:00:00"] and times.count(None) == 5


def test_empty_log_gives_empty_stages_with_schema(spark):
    net = ReferenceNetwork(raw(spark, []))
    for name in STAGES:
        df = getattr(net, name)
        assert df.count() == 0, name
        assert df.columns, name


def test_timestamp_key(spark):
    df = spark.createDataFrame([("2016-01-15 18:39:47 UTC",), ("2016-01-15",), (None,)], "s string")
    got = [r[0] for r in df.select(timestamp_key("s")).collect()]
    assert got == ["2016-01-15_18:39:47", None, None]


# --- sources and sinks -----------------------------------------------------------------------------------------


def test_csv_log_round_trip_with_schema(spark):
    from test_golden import golden_raw

    path = work_dir(spark, "log")
    delimited.write_dataset(golden_raw(spark), path, fmt="csv")
    back = delimited.read_activity_log(spark, path)
    assert back.schema == RAW_LOG_SCHEMA
    assert rows(back) == rows(golden_raw(spark))


def test_csv_log_is_read_by_header(spark):
    path = work_dir(spark, "other-order")
    data = [("PushEvent", "2016-01-15 18:39:47 UTC", 1, "r", 7, p) for p in ("x", "y", "y")]
    delimited.write_dataset(spark.createDataFrame(data, "type string, created_at string, repo_id long, repo_name string, actor_id long, payload string"), path, fmt="csv")
    back = delimited.read_activity_log(spark, path)
    assert back.columns == ["repo_id", "repo_name", "actor_id", "Type", "created_at", "payload"]
    # The rows with payload y are copies of one; payload x is another event.
    assert rows(core.push_counts(normalize.normalize_log(back))) == [(7, 1, 2)]


def test_csv_log_without_a_column_is_an_error(spark):
    path = work_dir(spark, "no-actor")
    delimited.write_dataset(spark.createDataFrame([(1, "r", "PushEvent", "t")], "repo_id long, repo_name string, Type string, created_at string"), path, fmt="csv")
    with pytest.raises(ValueError, match="actor_id"):
        delimited.read_activity_log(spark, path)


def test_work_dir_needs_a_shared_folder_beyond_one_machine(spark, monkeypatch):
    class Cluster:
        class sparkContext:
            master = "yarn"

            @staticmethod
            def getConf():
                return {}

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Cluster, "x")


def test_run_network_honours_skip(spark):
    from test_golden import golden_raw

    out = work_dir(spark, "skip")
    run_network(spark, golden_raw(spark), out, skip=("citations", "j_edges", "source_actors"))
    assert not {"citations", "j_edges", "source_actors"} & set(os.listdir(out))
    assert {"citation_edges", "j_counts", "actual_i_counts", "theta_pair_counts"} <= set(os.listdir(out))


def test_inferred_and_pipe_delimited(spark):
    df = spark.createDataFrame([(1, "x|y?"), (2, "z")], "dept_id int, name string")
    path = work_dir(spark, "dept")
    delimited.write_dataset(df, path, fmt="csv", sep="|", few_files=True)
    back = delimited.read_pipe_delimited(spark, path)  # inference, as the original did
    assert dict(back.dtypes)["dept_id"] == "int"
    assert rows(back) == rows(df)


def test_run_network_matches_lazy_network(spark):
    from test_golden import golden_raw

    out = work_dir(spark, "run")
    written = run_network(spark, golden_raw(spark), out, fmt="csv")
    lazy = ReferenceNetwork(golden_raw(spark))
    for name in ("focal_refs", "j_edges", "actual_i_edges", "source_actors", "distinct_pull_pairs"):
        assert rows(getattr(written, name)) == rows(getattr(lazy, name)), name
    edges = delimited.read_edges(spark, os.path.join(out, "focal_edges"), fmt="csv", schema=FOCAL_EDGE_SCHEMA)
    assert rows(edges) == rows(lazy.focal_edges)
    counts = spark.read.option("header", "true").option("inferSchema", "true").csv(os.path.join(out, "actual_i_counts"))
    assert rows(counts) == [(5, 1)]


def test_files_of_different_headers_and_broken_rows(spark):
    path = work_dir(spark, "drift")
    header = "repo_id,repo_name,actor_id,Type,created_at"
    texts = {
        "a": [header, "1,r,5,PushEvent,2016-01-01 10:00:00 UTC", '2,"a, b",6,PushEvent,never', "3,r,,PushEvent,t", "x,r,5,PushEvent,t", "4,r,5,PushEvent", "5,r,5,PushEvent,t,more"],
        "b": ["payload,TYPE,Created_At,actor_id,Repo_Name,repo_id", "p,PushEvent,t,7,r,8", "p,PushEvent,t,7,r,9.5"],
        "c": ["repo_id,actor_id", "1,2"],
        "d": [header],
    }
    for name, lines in texts.items():
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{path}/{name}")
    spark.createDataFrame([("",)], "value string").limit(0).write.text(f"{path}/e")
    log, broken = delimited.read_drifting_log(spark, [f"{path}/{n}" for n in "abcde"])
    assert log.columns == [f.name for f in RAW_LOG_SCHEMA] + ["payload"] and log.schema[:5] == RAW_LOG_SCHEMA[:5]
    assert rows(log, "repo_id", "repo_name", "actor_id", "created_at", "payload") == [(1, "r", 5, "2016-01-01 10:00:00 UTC", None), (2, "a, b", 6, "never", None), (3, "r", None, "t", None), (8, "r", 7, "t", "p")]
    assert rows(broken, "reason", "record") == sorted([("fields", "4,r,5,PushEvent"), ("fields", "5,r,5,PushEvent,t,more"), ("no repo_name", "1,2"), ("repo_id", "p,PushEvent,t,7,r,9.5"), ("repo_id", "x,r,5,PushEvent,t")])
    assert all(any(f"/{n}/" in r["file"] for n in "abc") for r in broken.collect())
    assert [df.count() for df in delimited.read_drifting_log(spark, f"{path}/e")] == [0, 0]


def test_few_files_without_one_task(spark):
    df = spark.range(0, 300_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    files = lambda path: [f for f in os.listdir(path) if f.startswith("part-")]
    small, large, bounded = (work_dir(spark, n) for n in ("small", "large", "bounded"))
    delimited.write_dataset(df.limit(1000), small, few_files=True)
    delimited.write_dataset(df, bounded, few_files=True, records_per_file=50_000)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        delimited.write_dataset(df, large, few_files=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(small)) == 1 and len(files(large)) >= 3 and len(files(bounded)) >= 6
    assert spark.read.parquet(large).count() == spark.read.parquet(bounded).count() == 300_000
