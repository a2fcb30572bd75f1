"""Secret scans by a battery of randomness tests, beside three fixed patterns.

Fixed kinds, found in whole texts, leftmost and non-overlapping for each kind: ``assign`` (a password-like name, ``:`` or
``=``, and a value of 8 characters or more; the span is the whole match), ``access`` (``AKIA`` keys of 16 or more) and
``hex`` (32 or more). The battery adds ``random``: every run of 16 or more of ``[A-Za-z0-9+/_-]`` is a candidate. Its
encoding is the smallest alphabet that holds it. Three tests ask whether it is uniformly random over that alphabet:

* chi-squared of the symbol counts against equal counts, upper tail;
* the runs test (Wald-Wolfowitz) of symbols in the upper and the lower half of the alphabet;
* the serial correlation of neighbouring symbols' values, and how often a step between neighbours comes twice in a row
  (``1234567890123456`` is even, and too short for the correlation).

False discoveries are controlled twice by Benjamini and Hochberg's rule within classes of length, over all candidates of
all rows:

1. Three times the smallest of the three p-values is a p-value of "uniformly random", however the tests depend on each
   other. What the rule rejects at ``battery_level`` isn't random.
2. One more test asks how likely a run of ordinary text of the same length looks as random: the lower tail of chi-squared
   under the letter coincidence rate of text, the lower tail of common pairs of letters, and the upper tail of changes
   between lower case, upper case, digits and symbols, joined by Fisher's method. What is left of step 1 and rejected at
   ``rate`` is a secret; what step 1 rejected counts as null cases.

Letters say nothing on runs of digits alone. There the numbers with a shape, card numbers (an issuer's prefix and a right check
digit) and dates, stand for the ordinary ones: as many plain ordinary numbers are expected in a class as shaped ones beyond
those that chance makes. The class's plain runs that step 1 leaves are secrets if that is at most ``rate`` of them; shaped
ones never are. So digits are found in a class of length where hardly any card or account numbers are, and not among them.

One pass counts p-values in bins (a table of fixed size), the next applies the thresholds.

Defined results: null text is empty; offsets are code points, ends exclusive; spans of different kinds may overlap;
each row has its own result. ``redact`` replaces the union of all spans.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refnet.llm.common import carried, extended, pieces, utf8
from refnet.llm.words import buffers

KINDS = ("assign", "access", "hex", "random")
# The fixed patterns; matches that are too short are dropped after matching.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # as dropping shorter runs: a run is taken whole
_NAMES = (b"passw", b"secret", b"token", b"apikey", b"api_key")

MIN_RUN = 16
LENGTHS = (16, 20, 24, 32, 48, 64)  # where classes of length begin
BINS, PER_DECADE = 400, 10  # of -log10 p
BATTERY_BINS = 100
REJECTED, DIGITS, SHAPED = -1, -2, -3  # in place of a bin of the text test
# Digits that card numbers begin with, and the part of random runs that have such a prefix and a right check digit.
ISSUERS = re.compile(r"4|5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720|6011|65|64[4-9]|35|3[0689]")
SHAPED_BY_CHANCE = 0.03
DATED = re.compile(r"(19|20)\d\d(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])")
_RUN = np.array([chr(b).isascii() and (chr(b).isalnum() or chr(b) in "+/_-") for b in range(256)])
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = tuple(
    (name, {c: i for i, c in enumerate(symbols)})
    for name, symbols in (
        ("decimal", _DIGIT),
        ("hex", _DIGIT + "abcdef"),
        ("hex upper", _DIGIT + "ABCDEF"),
        ("base32", _UPPER + "234567"),
        ("base36", _DIGIT + _LOWER),
        ("base36 upper", _DIGIT + _UPPER),
        ("base62", _DIGIT + _UPPER + _LOWER),
        ("base64", _UPPER + _LOWER + _DIGIT + "+/"),
        ("base64url", _UPPER + _LOWER + _DIGIT + "-_"),
        ("any", _UPPER + _LOWER + _DIGIT + "+/-_"),
    )
)
# Of letters of ordinary text: that two are the same, that three are, and that neighbours differ in kind.
SAME_TWO, SAME_THREE, CHANGE = 0.066, 0.006, 0.1
# Pairs of letters that make up at least COMMON of those in words of English, German, French or Spanish.
PAIRS = frozenset(
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma "
    "si om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss so rs un lo wa ge ie wh ee wi em ad ol rt po we na ul ni ts mo "
    "ow pa im mi ai sh ir su id os iv ia am fi ci vi pl ig tu ev ld ry mp fe bl ab gh ty op wo sa ay ex ke ui ei ck au sc ze zu ru eh hr lt ft rd "
    "eu nk nn tt qu ue da do".split()
)
COMMON = 0.7


def _tail(z: float) -> float:
    """The upper tail of the normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def _binomial_sum(k: int, n: int, p: float, step: int) -> float:
    """The terms from k of n on, upwards or downwards, away from the mean, as far as they count."""
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total, odds = 0.0, p / (1 - p)
    while term > 1e-18 * total:
        total += term
        if not 0 <= k + step <= n:
            break
        term *= (n - k) / (k + 1) * odds if step > 0 else k / (n - k + 1) / odds
        k += step
    return total


def _binomial_tail(k: int, n: int, p: float) -> float:
    """At least k of n."""
    if k <= 0:
        return 1.0
    if k > n:
        return 0.0
    return min(1.0, _binomial_sum(k, n, p, 1) if k > n * p else max(0.0, 1 - _binomial_sum(k - 1, n, p, -1)))


def shaped(digits: str) -> bool:
    """Whether a run of digits looks like a card number or begins with a date."""
    if DATED.match(digits) and len(digits) <= 20:
        return True
    if len(digits) > 19 or not ISSUERS.match(digits):
        return False
    twice = [int(c) if i % 2 == 0 else 2 * int(c) - 9 * (c > "4") for i, c in enumerate(reversed(digits))]
    return sum(twice) % 10 == 0


def encoding(run: str) -> tuple[str, dict[str, int]]:
    have = set(run)
    return next((name, order) for name, order in ENCODINGS if have <= order.keys())


def battery(run: str) -> dict[str, float]:
    """p-values: of the three tests under uniform randomness, and under ordinary text."""
    name, order = encoding(run)
    m, n = len(order), len(run)
    values = [order[c] for c in run]
    square = sum(c * c for c in Counter(values).values())
    chi2 = m / n * square - n
    # Wilson and Hilferty's cube root makes chi-squared normal.
    chi = _tail(((max(chi2, 0) / (m - 1)) ** (1 / 3) - (1 - 2 / (9 * (m - 1)))) / math.sqrt(2 / (9 * (m - 1))))
    half = [v >= m / 2 for v in values]
    up = sum(half)
    if 0 < up < n:
        mean = 1 + 2 * up * (n - up) / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs = 1 + sum(a != b for a, b in zip(half, half[1:], strict=False))
        runs_p = 2 * _tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        runs_p = 2.0 ** (1 - n)
    centre = sum(values) / n
    spread = sum((v - centre) ** 2 for v in values)
    serial = sum((a - centre) * (b - centre) for a, b in zip(values, values[1:], strict=False)) / spread if spread else 1.0
    steps = [(b - a) % m for a, b in zip(values, values[1:], strict=False)]
    steps_p = _binomial_tail(sum(a == b for a, b in zip(steps, steps[1:], strict=False)), n - 2, 1 / m)
    serial_p = min(1.0, 2 * min(2 * _tail(abs(serial + 1 / n) * math.sqrt(n)), steps_p))
    # Under text: coincident pairs are many.
    pairs, triples = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
    have = (square - n) / 2
    sd = math.sqrt(pairs * SAME_TWO * (1 - SAME_TWO) + 6 * triples * (SAME_THREE - SAME_TWO**2))
    text_same = _tail((pairs * SAME_TWO - have) / sd)
    kinds = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in run]
    text_change = _binomial_tail(sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)), n - 1, CHANGE)
    low = run.lower()
    letters = [a + b for a, b in zip(low, low[1:], strict=False) if a.isalpha() and b.isalpha()]
    text_pairs = _binomial_tail(sum(p not in PAIRS for p in letters), len(letters), 1 - COMMON) if letters else 1.0
    parts = [text_same, *([text_change] if len(set(kinds)) > 1 else []), *([text_pairs] if letters else [])]  # what can speak
    x = -sum(math.log(max(p, 1e-300)) for p in parts)
    random = min(1.0, 3 * min(chi, runs_p, serial_p))
    fisher = math.exp(-x) * sum(x**i / math.factorial(i) for i in range(len(parts)))
    return {"chi": chi, "runs": runs_p, "serial": serial_p, "random": random, "text": min(1.0, fisher)}


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def p_bin(p: float) -> int:
    """The bin of a p-value; p is at most 10 ** (-bin / PER_DECADE)."""
    return min(BINS - 1, int(-math.log10(max(p, 1e-300)) * PER_DECADE))


def digits_of(run: str) -> int:
    return SHAPED if shaped(run) else DIGITS


def candidates(text: str) -> Iterator[tuple[int, int, int, int, int]]:
    """(start, end, class of length, bin of the battery's p-value, bin of the text test's, DIGITS or SHAPED) of runs in a text."""
    for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}", text):
        found = battery(m[0])
        yield m.start(), m.end(), length_class(m.end() - m.start()), min(BATTERY_BINS - 1, p_bin(found["random"])), digits_of(m[0]) if m[0].isdigit() else p_bin(found["text"])


def base_spans(text: str, named: bool, run: bool) -> list[tuple[int, int, int]]:
    """(start, number of kind, end); ``named`` and ``run`` say whether the text has a name, a run of MIN_RUN."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if named else []
    if run:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return spans


def _texts(part: pa.RecordBatch, column: str) -> Iterator[tuple[str | None, bool, bool]]:
    """Each text, if it can hold any span at all (else None), whether it has a name and whether it has a run."""
    data, at = buffers(part.column(column))
    inside = np.r_[False, _RUN[data], False]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    long = starts[ends - starts >= MIN_RUN]
    # A run over the end of a text counts for every text that it touches: too many is safe, the patterns decide.
    touched = np.zeros(len(at) - 1, bool)
    if len(long):
        stop = ends[ends - starts >= MIN_RUN]
        first, last = np.searchsorted(at, long, side="right") - 1, np.searchsorted(at, stop, side="left")
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            touched[a:b] = True
    for raw, run in zip(part.column(column).to_pylist(), touched.tolist(), strict=True):
        low = raw.lower()
        named = any(n in low for n in _NAMES)
        yield (raw.decode("utf-8", "replace") if named or run else None), named, run


def _histogram(docs: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for part in pieces(batches, "_utf8"):
            for text, _, run in _texts(part, "_utf8"):
                if run:
                    total.update(c[2:] for c in candidates(text))
        columns = [pa.array([k[i] for k in total], pa.int32()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(total.values()), pa.int64())], names=["class", "battery", "bin", "n"])

    found = docs.select(utf8("text").alias("_utf8")).mapInArrow(count, "class int, battery int, bin int, n long")
    return found.groupBy("class", "battery", "bin").agg(F.sum("n").alias("n"))


def thresholds(histogram: dict[tuple[int, int], int], rate: float) -> list[int]:
    """For each class of length the smallest bin that is discovered (BINS: none).

    Candidates that fail the battery are in the class's number, as null cases. A bin counts with its largest p.
    """
    out = []
    for c in range(len(LENGTHS)):
        counts = {b: n for (k, b), n in histogram.items() if k == c}
        number, found, least = sum(counts.values()), 0, BINS
        for b in range(BINS - 1, -1, -1):
            found += counts.get(b, 0)
            if found and 10 ** (-b / PER_DECADE) * number / found <= rate:
                least = b
        out.append(least)
    return out


def digits_found(plain: int, shapes: int, rate: float) -> bool:
    """Whether a class's plain runs of digits are secrets: shaped ones beyond those that chance makes (two standard deviations
    more than their mean) are ``rate`` of them at most."""
    chance = SHAPED_BY_CHANCE * (plain + shapes)
    return shapes - chance - 2 * math.sqrt(chance) <= rate * plain


def both_thresholds(histogram: dict[tuple[int, int, int], int], rate: float, level: float) -> list[tuple[int, int, bool]]:
    """For each class of length the smallest bin that the battery rejects, the smallest that the text test does, and whether
    plain digits are found, from numbers by (class, bin of the battery, bin of the text test, DIGITS or SHAPED)."""
    battery_, text, digits = Counter(), Counter(), Counter()
    for (c, b, _), n in histogram.items():
        battery_[c, b] += n
    out = thresholds(battery_, level)
    for (c, b, t), n in histogram.items():
        if b >= out[c]:
            text[c, REJECTED] += n
        elif t in (DIGITS, SHAPED):
            digits[c, t] += n
        else:
            text[c, t] += n
    found = [digits_found(digits[c, DIGITS], digits[c, SHAPED], rate) for c in range(len(LENGTHS))]
    return list(zip(out, thresholds(text, rate), found, strict=True))


def discovered(least: tuple[int, int, bool], battery_bin: int, text_bin: int) -> bool:
    if battery_bin >= least[0] or text_bin == SHAPED:
        return False
    return least[2] if text_bin == DIGITS else text_bin >= least[1]


def learn_thresholds(docs: DataFrame, rate: float = 0.01, battery_level: float = 0.001) -> list[tuple[int, int, bool]]:
    """Over all rows; at most ``len(LENGTHS) * BATTERY_BINS * (BINS + 2)`` counts go to the driver."""
    return both_thresholds({(r["class"], r["battery"], r["bin"]): r["n"] for r in _histogram(docs).collect()}, rate, battery_level)


def _spans(text: str | None, named: bool, run: bool, least: list[tuple[int, int, bool]]) -> list[tuple[int, int, int]]:
    if text is None:
        return []
    spans = base_spans(text, named, run)
    if run:
        spans += [(a, 3, b) for a, b, c, p, t in candidates(text) if discovered(least[c], p, t)]
    return sorted(spans)


def find_secrets(docs: DataFrame, keep: list[str], rate: float = 0.01, battery_level: float = 0.001) -> DataFrame:
    """``keep`` columns of every row plus spans: array<struct<kind,start,end>> by start, then kind as in KINDS."""
    least = learn_thresholds(docs, rate, battery_level)
    schema = extended(docs, keep, "spans array<struct<kind:string,start:int,end:int>>")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "_utf8"):
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in _spans(*t, least)] for t in _texts(part, "_utf8")]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(found, kind)], names=[*keep, "spans"])

    return docs.select(*keep, utf8("text").alias("_utf8")).mapInArrow(find, schema)


def redact(docs: DataFrame, mark: str = "[SECRET]", rate: float = 0.01, battery_level: float = 0.001) -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced by ``mark`` (overlapping spans by one); null text stays."""
    least = learn_thresholds(docs, rate, battery_level)
    inner, names, back = carried(docs)
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "_utf8"):
            texts = []
            for raw, null, t in zip(part.column("_utf8").to_pylist(), part.column("_null").to_pylist(), _texts(part, "_utf8"), strict=True):
                spans = _spans(*t, least)
                if not spans:
                    texts.append(None if null else raw.decode("utf-8", "replace"))
                    continue
                out, reach, last = [], 0, -1
                for a, _, b in spans:
                    if a >= last:
                        out += [t[0][reach:a], mark]
                    reach = last = max(last, b)
                texts.append("".join([*out, t[0][reach:]]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else part.column(n) for i, n in enumerate(names)], names=names)

    others = [n for i, n in enumerate(names) if i != at]
    schema = inner.select(*names).schema
    return inner.select(*others, utf8("text").alias("_utf8"), F.col("text").isNull().alias("_null")).mapInArrow(clean, schema).select(*back)
