"""

Every query reads the whole test tables of ``sf_dir`` (the activity log is derived from ``events``, see
``refnet.sources.fixture``) and returns a DataFrame. Timestamps are returned as ``yyyy-MM-dd HH:mm:ss`` text so that
they compare across engines. ``oracle_sql`` gives, for each key, DuckDB SQL written from the stage's definition.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from refnet.functions.columns import timestamp_key, timestamp_text  # noqa: E402
from refnet.operators import cites, core, normalize, refs, relational  # noqa: E402
from refnet.plans.network import ReferenceNetwork, stage_counts  # noqa: E402
from refnet.plans.views import register_functions, register_views, sql_focal_counts, sql_repo_profile  # noqa: E402
from refnet.schema import CORE_SCHEMA, FOCAL_EDGE_SCHEMA  # noqa: E402
from refnet.session import work_dir  # noqa: E402
from refnet.sources import delimited, fixture  # noqa: E402

try:  # the training-data operators are optional: without their folder the other queries stay
    import corpus_pipeline
    import refnet.llm.queries as llm_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("refnet.llm", "corpus_pipeline")):
        raise
    corpus_pipeline = llm_queries = None

SF_SMOKE = "/root/testdata/sf0.001"


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.raw_log(spark, sf_dir)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_log(_raw(spark, sf_dir))


def _ts_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: timestamp_text(c) for c in cols})


def _net(spark: SparkSession, sf_dir: str) -> ReferenceNetwork:
    """All stages over the log of ``sf_dir``, lazily; a query takes the stage it needs."""
    return ReferenceNetwork(_raw(spark, sf_dir))


def _stage(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(_net(spark, sf_dir), name)


# The file queries write before they return: a reader needs its files when the plan is made.
def _scan_log_csv(spark, sf_dir):
    """The log through CSV, its columns in another order and with one more."""
    path = work_dir(spark, "log-csv")
    raw = _raw(spark, sf_dir)
    delimited.write_dataset(raw.select("Type", "created_at", "event_id", "actor_id", "repo_name", "repo_id"), path, fmt="csv")
    return delimited.read_activity_log(spark, path).withColumn("event_id", F.col("event_id").cast("long"))


def _scan_schema_csv(spark, sf_dir):
    path = work_dir(spark, "core-csv")
    cc = _net(spark, sf_dir).core_contributors.select(F.col("repo_id").alias("cc_repo_id"), "actor_id")
    delimited.write_dataset(cc, path, fmt="csv", header=False)
    return delimited.read_with_schema(spark, CORE_SCHEMA, path, header=False)


def _scan_pipe_csv(spark, sf_dir):
    customer = fixture.read_table(spark, sf_dir, "customer")
    path = work_dir(spark, "customer-pipe")
    delimited.write_dataset(customer, path, fmt="csv", sep="|")
    return delimited.read_pipe_delimited(spark, path, schema=customer.schema)


def _drifting_csv(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The log in files of two headers, every seventh event's row once more without its last field, every eleventh's with a
    word for its actor, and a file without actors."""
    path, raw = work_dir(spark, "drifting-csv"), _raw(spark, sf_dir)
    named = raw.withColumn("actor_id", F.col("actor_id").cast("string"))
    named = named.unionByName(named.filter("event_id % 11 = 0").withColumn("actor_id", F.concat(F.lit("user "), "actor_id")))
    delimited.write_dataset(named.filter("event_id % 2 = 0").select("Type", "created_at", "event_id", "actor_id", "repo_name", "repo_id"), f"{path}/a", fmt="csv")
    columns = ["repo_id", "REPO_NAME", "actor_id", "type", "created_at", "event_id"]
    lines = named.filter("event_id % 2 = 1").select(F.concat_ws(",", *columns).alias(",".join(columns)))
    short = raw.filter("event_id % 7 = 0").select(F.concat_ws(",", *columns[:-1]).alias(",".join(columns)))
    delimited.write_dataset(lines.union(short), f"{path}/b", fmt="csv", sep="\x01")
    delimited.write_dataset(raw.filter("event_id % 13 = 0").select("event_id", "repo_id"), f"{path}/c", fmt="csv")
    log, quarantine = delimited.read_drifting_log(spark, [f"{path}/a", f"{path}/b", f"{path}/c"])
    return log.withColumn("event_id", F.col("event_id").cast("long")), quarantine.drop("file")


def _sql_functions(spark, sf_dir):
    net = _net(spark, sf_dir)
    register_functions(spark, {name: getattr(net, name) for name in ("focal_refs", "citation_edges", "actual_i_edges")})
    return sql_repo_profile(spark)


def _roundtrip_edges(spark, sf_dir, few_files=False):
    path = work_dir(spark, "focal-edges")
    delimited.write_dataset(_net(spark, sf_dir).focal_edges, path, fmt="csv", few_files=few_files)
    return delimited.read_edges(spark, path, fmt="csv", schema=FOCAL_EDGE_SCHEMA)


def _sql_surface(spark, sf_dir):
    register_views({"refnet_focal_refs": _net(spark, sf_dir).focal_refs})
    return sql_focal_counts(spark, "refnet_focal_refs")


def _anti_via_null(net: ReferenceNetwork) -> DataFrame:
    """Actual I by the outer join and null test over J."""
    j = net.j_edges.select("source_repo_citing_focal_repo")
    return relational.unmatched(net.citation_edges, j, "source_repo_citing_focal_repo").distinct().select(*net.citation_edges.columns)


def _left_anti(spark, sf_dir):
    """Documents without a label."""
    return relational.left_anti(fixture.read_table(spark, sf_dir, "documents"), fixture.read_table(spark, sf_dir, "labels"), "doc_id")


def _case_label(spark, sf_dir):
    log = _log(spark, sf_dir)
    labelled = relational.with_case_label(
        log,
        "kind",
        [(F.col("Type") == "PushEvent", "push"), (F.col("Type") == "PullRequestEvent", "pull")],
        otherwise="other",
    )
    return labelled.select("repo_id", "actor_id", "Type", "kind")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dedup_raw": lambda s, d: normalize.dedup_raw(_raw(s, d)),
    "normalized_log": lambda s, d: _ts_text(_log(s, d), "created_at"),
    "timestamp_key": lambda s, d: _raw(s, d).select("event_id", "created_at", timestamp_key("created_at").alias("ts_key")),
    "filter_push": lambda s, d: _ts_text(normalize.push_events(_log(s, d)), "created_at"),
    "filter_pull": lambda s, d: _ts_text(normalize.pull_events(_log(s, d)), "created_at"),
    "case_label": _case_label,
    "push_counts": lambda s, d: core.push_counts(_log(s, d)),
    "avg_push": lambda s, d: core.avg_push(_log(s, d)),
    "join_left_filter": lambda s, d: core.core_by_outer_join(_log(s, d)),
    "core_contributors": _stage("core_contributors"),
    "core_contributors_window": lambda s, d: core.core_by_window(core.push_activity(_log(s, d))).select("repo_id", "actor_id"),
    "push_tenure": lambda s, d: _ts_text(core.push_tenure(_log(s, d)), "min_d", "max_d"),
    "core_tenure": lambda s, d: _ts_text(_net(s, d).core_tenure, "min_d", "max_d"),
    "focal_refs": _stage("focal_refs"),
    "focal_edges": _stage("focal_edges"),
    "focal_counts": _stage("focal_counts"),
    "top_focal": lambda s, d: refs.top_focal(_net(s, d).focal_counts, 20),
    "distinct_pull_pairs": _stage("distinct_pull_pairs"),
    "citations": _stage("citations"),
    "citations_broadcast": _stage("citations_broadcast"),
    "citation_edges": _stage("citation_edges"),
    "citation_counts": _stage("citation_counts"),
    "source_actors": _stage("source_actors"),
    "reference_actors": _stage("reference_actors"),
    "j_edges": _stage("j_edges"),
    "j_counts": _stage("j_counts"),
    "actual_i_edges": _stage("actual_i_edges"),
    "actual_i_counts": _stage("actual_i_counts"),
    "anti_via_null": lambda s, d: _anti_via_null(_net(s, d)),
    "left_anti": _left_anti,
    "theta_pair_counts": _stage("theta_pair_counts"),
    "theta_reference_counts": lambda s, d: _net(s, d).theta_reference_counts.withColumn("row_count", F.col("row_count").cast("long")),
    "stage_counts": lambda s, d: stage_counts(ReferenceNetwork(_raw(s, d), count_log=True)),
    "sql_surface": _sql_surface,
    "scan_log_csv": _scan_log_csv,
    "scan_drifting_csv": lambda s, d: _drifting_csv(s, d)[0],
    "quarantine_csv": lambda s, d: _drifting_csv(s, d)[1],
    "sql_functions": _sql_functions,
    "scan_schema_csv": _scan_schema_csv,
    "scan_pipe_csv": _scan_pipe_csv,
    "roundtrip_edges": _roundtrip_edges,
    "few_files_csv": lambda s, d: _roundtrip_edges(s, d, few_files=True),
    "to_width": lambda s, d: relational.to_width(_net(s, d).distinct_pull_pairs, 12, "actor_id"),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: actual-I counts (the last stage, built on every other one) on the sf0.001 data."""
    return _QUERIES["actual_i_counts"](spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_QUERIES)
    if llm_queries is not None:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


# --- oracle ------------------------------------------------------------------------------------------------------
# Each stage written from its definition; the stages below are shared by the statements.

_STAGES = """
shaped AS (
  SELECT event_id, (user_id // 3) * 40 + CAST(json_extract_string(props, '$.k') AS BIGINT) % 40 AS repo_id, user_id AS actor_id,
    CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'purchase' THEN 'PullRequestEvent' ELSE event_type END AS "Type",
    strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS created_at,
    unnest(range(CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END)) AS copy
  FROM events),
raw AS (SELECT event_id, repo_id, 'org/repo_' || CAST(repo_id AS VARCHAR) AS repo_name, actor_id, "Type", created_at FROM shaped),
log AS (
  SELECT repo_id, repo_name, actor_id, "Type", CAST(left(created_at, 19) AS TIMESTAMP) AS created_at
  FROM raw GROUP BY event_id, repo_id, repo_name, actor_id, "Type", raw.created_at),
pusher AS (
  SELECT repo_id, actor_id, count(*) AS pushes, min(created_at) AS min_d, max(created_at) AS max_d
  FROM log WHERE "Type" = 'PushEvent' GROUP BY repo_id, actor_id),
member AS (
  SELECT repo_id, actor_id, min_d, max_d FROM pusher
  QUALIFY repo_id IS NOT NULL AND count(actor_id) OVER (PARTITION BY repo_id) > 0
    AND pushes * count(actor_id) OVER (PARTITION BY repo_id) >= sum(pushes) OVER (PARTITION BY repo_id)),
puller AS (SELECT repo_id, actor_id FROM log WHERE "Type" = 'PullRequestEvent' GROUP BY ALL),
reference AS (
  SELECT m.repo_id AS focal, p.repo_id AS destination
  FROM log p JOIN member m USING (actor_id)
  WHERE p."Type" = 'PullRequestEvent' AND p.created_at >= m.min_d AND p.created_at <= m.max_d AND p.repo_id <> m.repo_id
  GROUP BY ALL),
citing AS (
  SELECT m.repo_id AS source, actor_id, p.repo_id AS focal FROM puller p JOIN member m USING (actor_id) WHERE p.repo_id <> m.repo_id),
citer AS (SELECT repo_id, actor_id FROM member WHERE repo_id IN (SELECT source FROM citing)),
j AS (
  SELECT c.repo_id AS source, p.repo_id AS destination FROM puller p JOIN citer c USING (actor_id)
  WHERE p.repo_id IN (SELECT destination FROM reference) GROUP BY ALL),
outside AS (SELECT focal, source FROM citing c WHERE NOT EXISTS (FROM j WHERE j.source = c.source) GROUP BY ALL)
"""

_TS = "strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
_EVENTS = f"SELECT repo_id, repo_name, actor_id, \"Type\", {_TS.format(c='created_at')} FROM log"
_CORE = "SELECT repo_id, actor_id FROM member"
_REFERENCES = "SELECT focal AS focal_repo_id, destination AS repo_id FROM reference"
_EDGES = "SELECT focal AS focal_repo_id, focal AS source_repo, destination AS destination_repo_id FROM reference"
_REFERENCE_COUNTS = "SELECT focal AS focal_repo_id, count(*) AS count_focal_repo_id FROM reference GROUP BY focal"
_CITING = "SELECT source AS source_repo_citing_focal_repo, actor_id, focal AS focal_repo_id FROM citing"
_OUTSIDE = "SELECT focal AS focal_repo_id, source AS source_repo_citing_focal_repo, focal AS destination_focal_repo FROM outside"

_FINAL = {
    "dedup_raw": "FROM raw GROUP BY ALL",
    "normalized_log": _EVENTS,
    "timestamp_key": "SELECT event_id, created_at, regexp_extract(created_at, '^([^ ]*) ([^ ]*)', 1) || '_' || regexp_extract(created_at, '^([^ ]*) ([^ ]*)', 2) AS ts_key FROM raw",
    "filter_push": f"{_EVENTS} WHERE \"Type\" = 'PushEvent'",
    "filter_pull": f"{_EVENTS} WHERE \"Type\" = 'PullRequestEvent'",
    "case_label": """SELECT repo_id, actor_id, "Type", coalesce(map {'PushEvent': 'push', 'PullRequestEvent': 'pull'}["Type"], 'other') AS kind FROM log""",
    "push_counts": "SELECT actor_id, repo_id, pushes AS NO_OF_PUSH_EVENT FROM pusher",
    "avg_push": "SELECT repo_id, CAST(sum(pushes) AS DOUBLE) / nullif(count(actor_id), 0) AS AVG_PUSH_EVENT FROM pusher GROUP BY repo_id",
    "join_left_filter": _CORE,
    "core_contributors": _CORE,
    "core_contributors_window": _CORE,
    "push_tenure": f"SELECT repo_id, actor_id, {_TS.format(c='min_d')}, {_TS.format(c='max_d')} FROM pusher",
    "core_tenure": f"SELECT repo_id AS focal_repo_id, actor_id, {_TS.format(c='min_d')}, {_TS.format(c='max_d')} FROM member WHERE actor_id IS NOT NULL",
    "focal_refs": _REFERENCES,
    "focal_edges": _EDGES,
    "focal_counts": _REFERENCE_COUNTS,
    "top_focal": f"{_REFERENCE_COUNTS} ORDER BY 2 DESC, 1 LIMIT 20",
    "distinct_pull_pairs": "FROM puller",
    "citations": _CITING,
    "citations_broadcast": _CITING,
    "citation_edges": "SELECT focal AS focal_repo_id, source AS source_repo_citing_focal_repo, focal AS destination_focal_repo FROM citing",
    "citation_counts": "SELECT focal AS focal_repo_id, count(*) AS \"COUNT\" FROM citing GROUP BY focal",
    "source_actors": "SELECT repo_id AS focal_repo_id, repo_id AS source_repo_citing_focal_repo, actor_id FROM citer",
    "reference_actors": "SELECT r.focal AS focal_repo_id, r.destination AS destination_repo_id, p.actor_id FROM puller p JOIN reference r ON p.repo_id = r.destination",
    "j_edges": "SELECT source AS focal_repo_id, source AS source_repo_citing_focal_repo, destination AS destination_repo_id FROM j",
    "j_counts": "SELECT source AS focal_repo_id, count(*) AS J_Count FROM j GROUP BY source",
    "actual_i_edges": _OUTSIDE,
    "actual_i_counts": "SELECT focal AS focal_repo_id, count(*) AS \"count\" FROM outside GROUP BY focal",
    "anti_via_null": _OUTSIDE,
    "theta_pair_counts": "SELECT c.focal AS focal_repo_id, count(*) AS pair_count FROM citing c, member m WHERE m.repo_id <> c.source GROUP BY c.focal",
    "theta_reference_counts": """SELECT m.repo_id AS focal_repo_id, CAST(sum(c.n * t.n) AS BIGINT) AS row_count
        FROM member m JOIN (SELECT source, count(*) AS n FROM citing GROUP BY source) c ON c.source <> m.repo_id
        JOIN (SELECT p.actor_id, count(*) AS n FROM reference r JOIN puller p ON p.repo_id = r.destination GROUP BY p.actor_id) t ON t.actor_id = m.actor_id
        GROUP BY m.repo_id""",
    "stage_counts": """SELECT 'normalized_log' AS stage, (SELECT count(*) FROM log) AS "rows"
        UNION ALL SELECT 'core_contributors', (SELECT count(*) FROM member)
        UNION ALL SELECT 'focal_refs', (SELECT count(*) FROM reference)
        UNION ALL SELECT 'distinct_pull_pairs', (SELECT count(*) FROM puller)""",
    "sql_surface": _REFERENCE_COUNTS,
    "scan_log_csv": "FROM raw",
    "scan_drifting_csv": "FROM raw",
    "quarantine_csv": """SELECT 'actor_id' AS reason, CASE WHEN event_id % 2 = 0 THEN concat_ws(',', "Type", created_at, event_id, 'user ' || actor_id, repo_name, repo_id)
          ELSE concat_ws(',', repo_id, repo_name, 'user ' || actor_id, "Type", created_at, event_id) END AS record FROM raw WHERE event_id % 11 = 0
        UNION ALL SELECT 'fields', concat_ws(',', repo_id, repo_name, actor_id, "Type", created_at) FROM raw WHERE event_id % 7 = 0
        UNION ALL SELECT 'no repo_name', concat_ws(',', event_id, repo_id) FROM raw WHERE event_id % 13 = 0""",
    "sql_functions": """SELECT r.focal AS focal_repo_id, count(*) AS "references",
          (SELECT count(DISTINCT source) FROM citing c WHERE c.focal = r.focal) AS citing_sources, (SELECT count(*) FROM outside o WHERE o.focal = r.focal) AS outside
        FROM reference r GROUP BY r.focal""",
    "scan_schema_csv": "SELECT repo_id AS cc_repo_id, actor_id FROM member",
    "roundtrip_edges": _EDGES,
    "few_files_csv": _EDGES,
    "to_width": "FROM puller",
}

_STANDALONE = {
    "left_anti": "FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)",
    "scan_pipe_csv": "FROM customer",
}


def oracle_sql() -> dict[str, str]:
    out = {key: f"WITH {_STAGES.strip()}\n{final}" for key, final in _FINAL.items()} | _STANDALONE
    if llm_queries is not None:
        out.update(llm_queries.ORACLES)
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
