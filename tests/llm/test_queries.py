"""The registered queries and the pipeline on the smallest tables, against SQL or brute force."""

from __future__ import annotations

import zlib

import brute
import pytest
from conftest import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as entry
import corpus_pipeline
from refnet.llm import lengths, packing, secrets
from refnet.llm.queries import ORACLES, QUERIES
from refnet.llm.tokens import Encoder, tokenizer_path


def query(spark, name):
    return next(f for k, f in QUERIES.items() if k.startswith(name + "_"))(spark, SF_SMALL).collect()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text, lang FROM documents").fetchall()


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secrets", "packing"]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_sql(spark, con, key):
    info = compare(spark, con, key, SF_SMALL, QUERIES[key], ORACLES[key])
    assert info["ok"], info


def encoded(documents):
    tokenizer = Encoder.of(tokenizer_path()).tokenizer
    return {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t, *_ in documents}


def check_pieces(pieces, ids):
    """Every id in exactly one piece, sequences gapless, with hardly any padding."""
    ends, sequences = dict.fromkeys(ids, 0), {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        own = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert ends[p["doc_id"]] == p["start"] and p["doc_tokens"] == len(ids[p["doc_id"]])
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own)) == p["ids_crc32"]
        ends[p["doc_id"]] += p["length"]
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert ends == {d: len(x) for d, x in ids.items()}
    for parts in sequences.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= packing.WINDOW and (end == packing.WINDOW or end & (end - 1) == 0)


def test_packing(spark, documents):
    check_pieces(query(spark, "op1"), encoded(documents))


def test_licenses(spark, documents):
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in query(spark, "op2")}
    assert got == {d: brute.phrases(t) for d, t, _ in documents}


def test_lengths(spark, documents):
    sizes = [len(x) - 1 for x in encoded(documents).values()]
    got = {r["length"]: (r["n_docs"], r["docs_over"], r["truncated_tokens"], r["total_tokens"]) for r in query(spark, "op3")}
    assert got == {n: (sizes.count(n), sum(s > n for s in sizes), sum(min(s, n) for s in sizes), sum(sizes)) for n in sizes}


def test_token_length_quantiles(spark):
    rows = sorted((r["length"], r["n_docs"], r["quantile_share"]) for r in query(spark, "op3"))
    total, within = sum(n for _, n, _ in rows), 0
    for _, n, share in rows:
        within += n
        assert share == within / total
    asked = lengths.quantiles(QUERIES["op3_token_length_histogram"](spark, SF_SMALL), [0.5, 0.9, 0.99, 1.0]).collect()
    assert len(asked) == 4 and all(r["length"] == next(x for x, _, share in rows if share >= r["share"]) for r in asked)


def test_secrets(spark, documents):
    got = {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in query(spark, "op6")}
    assert got == {d: brute.secrets(t) for d, t, _ in documents}


def test_language_of_held_out_documents(spark, documents):
    lang = {d: x for d, _, x in documents}
    got = query(spark, "op9")
    assert len(got) == len(documents)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert len(held) > 40 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_near_duplicates_stage_links_from_four_fifths_of_five_words(spark):
    """Copies with 18 to 25 % appended, and with single words changed, go; a copy below 0.8 stays."""
    docs, n = [], 200
    for i, more in enumerate((36, 44, 48, 60)):
        own = [f"d{i}w{j}" for j in range(n)]
        docs += [(10 * i, " ".join(own)), (10 * i + 1, " ".join(own + [f"d{i}x{j}" for j in range(more)]))]
    own = [f"e{j}" for j in range(n)]
    docs += [(90, " ".join(own)), (91, " ".join(f"changed{j}" if j in (20, 70, 120, 170) else w for j, w in enumerate(own)))]
    frame = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame, SF_SMALL).collect()}
    assert kept == {0, 10, 20, 30, 31, 90} == {d for d, _, c in brute.near_components(docs, percent=80, k=5) if d == c}


def test_near_duplicates_stage_keeps_one_of_repeated_and_null_ids(spark):
    own = {x: [f"{x}{j}" for j in range(100)] for x in "abc"}
    near = {x: " ".join([*w, "more"]) for x, w in own.items()}
    text = {x: " ".join(w) for x, w in own.items()}
    docs = [(1, text["a"]), (1, near["a"]), (2, near["a"]), (None, text["b"]), (None, near["b"]), (None, text["c"]), (3, near["c"]), (1, "other words"), (None, None), (None, ""), (None, ""), (4, " ")]
    frame = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, frame, SF_SMALL).collect()]
    assert len(kept) == 7 and {(1, "other words"), (3, near["c"]), (None, None), (None, ""), (4, " ")} <= set(kept)
    assert len({(1, text["a"]), (1, near["a"])} & set(kept)) == 1 == len({(None, text["b"]), (None, near["b"])} & set(kept))


def test_pipeline(spark, con, documents):
    """Each stage against brute force on its own input."""
    docs, before = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, SF_SMALL).cache()
        if name == "packing":
            ids = encoded(before.items())
            check_pieces(docs.collect(), ids)
            continue
        assert docs.columns == corpus_pipeline.COLUMNS
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.count() == len(after)
        if name == "language_id":
            assert set(after) == {d for d, t in before.items() if t and any(c.isalpha() for c in t)}
        elif name == "near_duplicates":
            assert set(after) == {d for d, _, c in brute.near_components(list(before.items())) if d == c}
        elif name == "decontamination":
            items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
            assert set(after) == {d for d, *_, bad in brute.decontaminated(list(before.items()), items) if not bad}
        else:
            assert set(after) == set(before)
            touched = {d for d, t in before.items() if any(brute.secrets(t)[:3])}
            assert touched <= {d for d in before if after[d] != before[d]}
            for d in touched:
                assert not any(m in after[d] for m in [t[0] for t in secrets.HEX.finditer(before[d])])
        if name != "secrets":
            assert all(after[d] == before[d] for d in after)


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0).cache()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0
