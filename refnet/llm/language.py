"""Language identification with hyperdimensional profiles.

Every letter has a fixed pseudo-random vector of +1 and -1. A run of three letters is bound into one vector: the
letters' vectors, permuted (rotated) by their places, multiplied element by element. A text's vector is the bundle (sum)
of those of all its runs, and a language's prototype the bundle of all its training texts. A text has the language whose
prototype has the largest cosine with its vector.

Letters are all Unicode letters, lower-cased; what stands between two words counts as one blank. Training is one pass
that sends one partial sum for each language and task, prediction another; only the prototypes go to the driver, whose
size is bounded by ``max_languages`` times ``dimensions``; more labels are an error.

Defined results: null text or text without letters is ``und`` with score 0, and so is every text if nothing was learned;
of equal cosines the label that sorts first wins; the score is the cosine, 0 if negative; each row has its own result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refnet.llm.common import extended, pieces, utf8
from refnet.llm.words import mix

UND = "und"
DIMENSIONS = 1024
#: What a task works on at once: bytes and rows of a piece, runs whose vectors and counts by text are laid out, different
#: runs and all runs that wait for their bundle.
STEP_BYTES, STEP_ROWS, STEP_RUNS, WAITING, WAITING_ALL = 256 << 10, 1024, 2048, 1 << 17, 1 << 22


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point the lower-cased letter, 0 for what isn't a letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """The +1/-1 vectors of letters (code points; 0: the blank), as a rule of the letter and the dimension."""
    out = np.empty((len(letters), dimensions), np.int8)
    for k in range(0, len(letters), 256):
        seeds = mix(letters[k : k + 256].astype(np.uint64) + np.uint64(0x51))[:, None] + np.arange(dimensions, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
        out[k : k + 256] = np.where(mix(seeds) >> np.uint64(63), np.int8(1), np.int8(-1))
    return out


class Profiler:
    """Runs of three letters of a batch of texts, and their vectors."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions

    def runs(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, run) for every run; a run packs three letters or blanks."""
        parts = [np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le", "replace"), dtype=np.uint32) for t in texts]
        sizes = np.array([len(p) for p in parts])
        letters = _letters()[np.concatenate(parts)] if sizes.sum() else np.zeros(0, np.uint32)
        text = np.repeat(np.arange(len(texts)), sizes)
        keep = letters > 0
        keep[1:] |= (letters[:-1] > 0) & (text[1:] == text[:-1])  # the first place of a gap is its blank
        letters, text = letters[keep].astype(np.uint64), text[keep]
        if not len(letters):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        # A blank before and after every text.
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        letters, owner = np.insert(letters, first, 0), np.insert(text, first, text[first])
        last = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True]) + 1
        letters, owner = np.insert(letters, last, 0), np.insert(owner, last, owner[last - 1])
        run = (letters[:-2] << np.uint64(42)) | (letters[1:-1] << np.uint64(21)) | letters[2:]
        own = owner[:-2] == owner[2:]
        return owner[:-2][own], run[own]

    def vectors(self, runs: np.ndarray) -> np.ndarray:
        d, low = self.dimensions, np.uint64(0x1FFFFF)
        parts = [(runs >> np.uint64(42)) & low, (runs >> np.uint64(21)) & low, runs & low]
        seen, which = np.unique(np.concatenate(parts), return_inverse=True)
        base = _vectors(seen, d)
        a, b, c = np.split(which, 3)
        return np.roll(base, 2, axis=1)[a] * np.roll(base, 1, axis=1)[b] * base[c]


class Bundles:
    """The bundles of labels' runs. Runs wait with their counts, so that one met in many pieces needs its vector once."""

    def __init__(self, profiler: Profiler):
        self.profiler, self.total, self.waiting, self.all = profiler, {}, {}, 0

    def add(self, label: str, runs: np.ndarray) -> None:
        own, counts = np.unique(runs, return_counts=True)
        if label in self.waiting:
            seen, n = self.waiting[label]
            own, which = np.unique(np.r_[seen, own], return_inverse=True)
            counts = np.bincount(which, np.r_[n, counts], len(own))
        self.waiting[label], self.all = (own, counts), self.all + len(runs)
        if self.all >= WAITING_ALL or sum(len(x) for x, _ in self.waiting.values()) >= WAITING:
            self.sums()

    def sums(self) -> dict[str, np.ndarray]:
        """The bundles of all that was added."""
        for label, (own, counts) in self.waiting.items():
            total = self.total.setdefault(label, np.zeros(self.profiler.dimensions))
            for k in range(0, len(own), STEP_RUNS):
                total += counts[k : k + STEP_RUNS].astype(np.float32) @ self.profiler.vectors(own[k : k + STEP_RUNS]).astype(np.float32)
        self.waiting, self.all = {}, 0
        return self.total


def profile_sums(docs: DataFrame, label: Column, dimensions: int = DIMENSIONS) -> DataFrame:
    """(label, sums): the bundles of all texts of each non-null label, one row for each label and task."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler(dimensions)
        bundles = Bundles(profiler)
        for part in pieces(batches, "text", STEP_BYTES):
            labels, of = np.unique(np.array(part.column("label").to_pylist(), dtype=object), return_inverse=True)
            text, run = profiler.runs(part.column("text").to_pylist())
            for i, name in enumerate(labels):
                bundles.add(name, run[of[text] == i])
        total = bundles.sums()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["label", "sums"]
        )

    return docs.select(utf8("text").alias("text"), label.cast("string").alias("label")).filter("label is not null").mapInArrow(sums, "label string, sums array<double>")


def learn(docs: DataFrame, label: Column, dimensions: int = DIMENSIONS, max_languages: int = 4096) -> tuple[list[str], np.ndarray]:
    """The labels, sorted, and their prototypes of length 1. ``label`` is null for rows not to learn from."""
    parts = profile_sums(docs, label, dimensions)
    # Element sums as a plain aggregate: whole numbers below 2^53, so their order does not matter.
    cells = parts.select("label", F.posexplode("sums").alias("at", "value")).groupBy("label", "at").agg(F.sum("value").alias("value"))
    found = cells.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("v")).select("label", F.col("v.value").alias("v")).limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    found = sorted((r["label"], np.array(r["v"])) for r in found)
    kept = [(name, v / n) for name, v in found if (n := np.linalg.norm(v)) > 0]
    return [name for name, _ in kept], np.array([v for _, v in kept]).reshape(len(kept), dimensions)


def predict(docs: DataFrame, names: list[str], prototypes: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row plus lang_pred and score."""
    dimensions = prototypes.shape[1]
    protos = docs.sparkSession.sparkContext.broadcast((names, prototypes.astype(np.float32)))
    schema = extended(docs, keep, "lang_pred string, score double")
    # A kept text goes to the tasks once.
    sent, read = (docs.select(*keep), "text") if "text" in keep and dict(docs.dtypes)["text"] == "string" else (docs.select(*keep, utf8("text").alias("_utf8")), "_utf8")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, (labels, matrix) = Profiler(dimensions), protos.value
        labels = np.array([*labels, UND], dtype=object)
        for part in pieces(batches, read, STEP_BYTES, STEP_ROWS):
            n = part.num_rows
            best, cosine = np.full(n, len(labels) - 1), np.zeros(n)
            text, run = profiler.runs([t or b"" for t in part.column(read).cast(pa.large_binary()).to_pylist()])
            if len(run) and len(matrix):
                own, which = np.unique(run, return_inverse=True)
                order = np.argsort(which, kind="stable")
                text_of, which = text[order], which[order]
                bundle = np.zeros((n, dimensions), np.float32)
                for k in range(0, len(own), STEP_RUNS):
                    block = profiler.vectors(own[k : k + STEP_RUNS]).astype(np.float32)
                    a, b = np.searchsorted(which, [k, k + len(block)])
                    cells = np.bincount(text_of[a:b] * len(block) + which[a:b] - k, minlength=n * len(block)).reshape(n, len(block))
                    bundle += cells.astype(np.float32) @ block
                norm = np.linalg.norm(bundle, axis=1)
                near = bundle @ matrix.T / np.where(norm > 0, norm, 1)[:, None]
                has = norm > 0
                lettered = np.bincount(text, minlength=n) > 0
                best = np.where(lettered, near.argmax(axis=1), best)
                cosine = np.where(has & lettered, np.clip(near.max(axis=1), 0, 1), 0.0)
            arrays = [part.column(c) for c in keep] + [pa.array(labels[best], pa.string()), pa.array(cosine.astype(np.float64))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "lang_pred", "score"])

    return sent.mapInArrow(score, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1 (never for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, keep: list[str], train: DataFrame | None = None, dimensions: int = DIMENSIONS) -> DataFrame:
    """Learn from the labelled rows of ``train`` (``docs`` unless given) that aren't held out, then predict every row of ``docs``."""
    train = docs if train is None else train
    names, prototypes = learn(train, F.when(~held_out(), F.col("lang")), dimensions)
    return predict(docs, names, prototypes, keep)
