"""Operator 10: secrets by fixed patterns and a character convolutional network.

Three patterns give the base findings, which always stay.  Candidates are all
maximal runs of ``[A-Za-z0-9+/_.-]`` of at least ``LEAST`` characters with a
letter and a digit.  A network scores every candidate: over the characters
before it, its own (all of them) and those after it run ``FILTERS`` one-hot
convolutions of width ``WIDTH``; the largest response of each filter in each
of the three parts and the candidate's length feed a logistic unit.

It is trained on labelled findings: all distinct candidates, positive where a
base finding overlaps them, with long ordinary words as further negatives, both
labels of the same weight.  Every epoch, shards of a bounded number of examples
learn in numpy from one state, and Spark averages what they come to.  The context
of half the examples is blanked, so that the look of a secret counts without a
telling name before it.  On a quarter held back from training, all counted by
their logits on a fixed grid, scores are calibrated (Platt) and the threshold is
the highest of the grid that finds at least ``RECALL`` of the positives.  A candidate above it
that no base finding overlaps is added as kind ``model``.  With fewer than
``FEWEST`` examples of a label there is no model and nothing is added.

Documents are scanned twice without a shuffle (candidates, then spans); only
distinct training windows are shuffled, combined in the map task first.

Null texts are empty and have no spans; offsets count code points, ends are
exclusive; repeated rows stay; clashing columns are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yoyflow.llm.common import map_slices, table, texts
from yoyflow.session import cut_lineage

KINDS = ("assign", "access", "hex", "model")
LEAST = 12
LONG_WORD = 16
BEFORE, AFTER = 24, 12
FILTERS, WIDTH, SYMBOLS = 16, 5, 97
FEWEST = 40
SHARD, SUMS = 8_192, 16  # examples dealt to one shard; rows that their states are summed to
GRID, BINS = 0.01, 6_000  # held-back examples are counted by their logit
RECALL = 0.98
EPOCHS, BATCH, RATE = 6, 128, 0.01

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so the length may stand in the pattern
_RUN = np.zeros(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_HEX_DIGIT = np.zeros(256, bool)
_HEX_DIGIT[list(b"0123456789abcdef")] = True

Span = tuple[str, int, int]
_STATE = pa.list_(pa.float64())


def _runs(member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], member, [False]]).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    long = last - first >= least
    return first[long], last[long]


def base_spans(text: str, has_hex: bool = True) -> list[Span]:
    """The findings of the three patterns, by start, then kind as listed."""
    out: list[Span] = []
    low = text.lower() if "=" in text or ":" in text else ""
    if any(n in low for n in _NAMES):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if has_hex:
        out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


@dataclass
class Found:
    """A slice's base findings and candidates; places in ``data`` are bytes."""

    data: bytes
    base: list[list[Span]]
    text: np.ndarray  # of each candidate
    first: np.ndarray
    last: np.ndarray
    start: np.ndarray  # code points within the text
    end: np.ndarray
    positive: np.ndarray  # a base finding overlaps it
    begin: np.ndarray  # of each text in ``data``
    stop: np.ndarray


def find(given: list[str], words: bool = False) -> Found:
    """``words``: also long runs without a digit, as they teach what is no secret."""
    raw = [t.encode("utf-8", "surrogatepass") for t in given]
    data = b"\n".join([*raw, b""])
    codes = np.frombuffer(data, np.uint8)
    size = np.array([len(r) for r in raw], np.int64)
    stop = np.cumsum(size + 1) - 1
    begin = stop - size
    hex_first, _ = _runs(_HEX_DIGIT[codes], 32)
    with_hex = set((np.searchsorted(begin, hex_first, "right") - 1).tolist())
    base = [base_spans(t, i in with_hex) for i, t in enumerate(given)]
    first, last = _runs(_RUN[codes], LEAST)
    letters, digits = (np.concatenate([[0], np.cumsum(m[codes])]) for m in (_LETTER, _DIGIT))
    has_digit = digits[last] > digits[first]
    ok = (letters[last] > letters[first]) & (has_digit | (words & (last - first >= LONG_WORD)))
    first, last = first[ok], last[ok]
    text = np.searchsorted(begin, first, "right") - 1
    points = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])
    start, end = points[first] - points[begin[text]], points[last] - points[begin[text]]
    positive = np.array([any(s < e2 and s2 < e for _, s, e in base[t]) for t, s2, e2 in zip(text.tolist(), start.tolist(), end.tolist(), strict=True)], bool)
    return Found(data, base, text, first, last, start, end, positive, begin, stop)


def windows(found: Found, which: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """What stands before a candidate, the candidate, what stands after it."""
    out = []
    for i in which.tolist():
        a, b, t = int(found.first[i]), int(found.last[i]), int(found.text[i])
        out.append((found.data[max(int(found.begin[t]), a - BEFORE) : a], found.data[a:b], found.data[b : min(int(found.stop[t]), b + AFTER)]))
    return out


def _symbols(part: bytes) -> np.ndarray:
    c = np.frombuffer(part, np.uint8).astype(np.int64) - 31
    return np.where((c > 0) & (c < SYMBOLS - 1), c, SYMBOLS - 1)


def _layout(examples: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all parts, each with blanks (0) round it, the begin of each part, and log lengths."""
    blank = np.zeros(WIDTH - 1, np.int64)
    flat, begin, at = [], [], 0
    for example in examples:
        for part in example:
            x = np.concatenate([blank, _symbols(part), blank])
            flat.append(x)
            begin.append(at)
            at += len(x)
    sizes = np.log(np.array([len(e[1]) for e in examples]) / 20)
    return np.concatenate(flat), np.array(begin), sizes


@dataclass
class SecretModel:
    kernel: np.ndarray  # WIDTH x SYMBOLS x FILTERS
    bias: np.ndarray
    weight: np.ndarray  # 3 * FILTERS + 1
    offset: float
    platt: tuple[float, float]
    threshold: float

    def _responses(self, flat: np.ndarray) -> np.ndarray:
        out = np.broadcast_to(self.bias, (len(flat), FILTERS)).copy()
        for k in range(WIDTH):
            out[: len(flat) - k] += self.kernel[k, flat[k:]]
        return out

    def logits(self, examples: list[tuple[bytes, bytes, bytes]]) -> np.ndarray:
        out = []
        for i in range(0, len(examples), 512):
            flat, begin, sizes = _layout(examples[i : i + 512])
            top = np.maximum(np.maximum.reduceat(self._responses(flat), begin, axis=0), 0).reshape(len(sizes), -1)
            out.append(top @ self.weight[:-1] + sizes * self.weight[-1] + self.offset)
        return np.concatenate(out) if out else np.zeros(0)

    def probabilities(self, examples: list[tuple[bytes, bytes, bytes]]) -> np.ndarray:
        a, b = self.platt
        return 1 / (1 + np.exp(-np.clip(a * self.logits(examples) + b, -30, 30)))


def _step(model: SecretModel, examples: list, y: np.ndarray, weights: np.ndarray | float = 1.0) -> list[np.ndarray]:
    """Gradients of the mean (weighted) log loss; a maximum passes its gradient to its first place."""
    flat, begin, sizes = _layout(examples)
    r = model._responses(flat)
    top = np.maximum.reduceat(r, begin, axis=0)
    lengths = np.diff(np.append(begin, len(flat)))
    place = np.where(r == np.repeat(top, lengths, axis=0), np.arange(len(flat))[:, None], len(flat))
    place = np.minimum.reduceat(place, begin, axis=0)
    h = np.maximum(top, 0).reshape(len(sizes), -1)
    z = h @ model.weight[:-1] + sizes * model.weight[-1] + model.offset
    g = weights * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
    weight = np.append(h.T @ g, sizes @ g)
    through = (g[:, None] * model.weight[:-1] * (h > 0)).reshape(-1, FILTERS)
    kernel = np.zeros_like(model.kernel)
    filters = np.broadcast_to(np.arange(FILTERS), place.shape)
    for k in range(WIDTH):
        at = place + k
        inside = at < len(flat)
        np.add.at(kernel[k], (flat[at[inside]], filters[inside]), through[inside])
    return [kernel, through.sum(0), weight, np.array(g.sum())]


def _start(seed: int) -> np.ndarray:
    """Parameters in one row, then their first and second moments (0)."""
    rng = np.random.default_rng(seed)
    kernel, weight = rng.normal(0, 0.15, (WIDTH, SYMBOLS, FILTERS)), rng.normal(0, 0.2, 3 * FILTERS + 1)
    flat = np.concatenate([kernel.ravel(), np.zeros(FILTERS), weight, [0.0]])
    return np.concatenate([flat, np.zeros(2 * len(flat))])


def _model(state: np.ndarray) -> SecretModel:
    flat = state[: len(state) // 3]
    kernel, bias, weight, offset = np.split(flat, np.cumsum([WIDTH * SYMBOLS * FILTERS, FILTERS, 3 * FILTERS + 1]))
    return SecretModel(kernel.reshape(WIDTH, SYMBOLS, FILTERS), bias, weight, float(offset[0]), (1.0, 0.0), 0.5)


def _epoch(state: np.ndarray, steps: int, examples: list[tuple[bytes, bytes, bytes]], labels: np.ndarray, weights: np.ndarray, seed: list[int]) -> np.ndarray:
    """``state`` after one pass over ``examples`` by Adam, which made ``steps`` steps before."""
    rng = np.random.default_rng(seed)
    values, first, second = np.split(state.copy(), 3)
    order = rng.permutation(len(examples))
    for i in range(0, len(order), BATCH):
        part = order[i : i + BATCH]
        blank = rng.random(len(part)) < 0.5
        shown = [(b"", examples[j][1], b"") if x else examples[j] for j, x in zip(part.tolist(), blank.tolist(), strict=True)]
        g = np.concatenate([np.ravel(x) for x in _step(_model(np.concatenate([values, first, second])), shown, labels[part].astype(float), weights[part])])
        steps += 1
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        values = values - RATE * (first / (1 - 0.9**steps)) / (np.sqrt(second / (1 - 0.999**steps)) + 1e-8)
    return np.concatenate([values, first, second])


def _platt(z: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic fit of y on z, each counted n times, with Platt's softened targets, by gradient descent."""
    n1, n0 = float(n[y > 0].sum()), float(n[y <= 0].sum())
    target, share = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2)), n / max(n.sum(), 1)
    scale = max(float(np.abs(z).max(initial=0)), 1e-9)
    x, a, b = z / scale, 1.0, 0.0
    for _ in range(2000):
        g = share * (1 / (1 + np.exp(-np.clip(a * x + b, -30, 30))) - target)
        a, b = a - 2.0 * float((g * x).sum()), b - 2.0 * float(g.sum())
    return a / scale, b


def calibrate(model: SecretModel, bins: np.ndarray, positive: np.ndarray, n: np.ndarray, recall: float = RECALL) -> SecretModel:
    """The model with its calibration and threshold, from counts of the held-back
    examples by label and by logit in steps of ``GRID``."""
    z = bins * GRID
    model.platt = _platt(z + GRID / 2, positive.astype(float), n)
    order = np.argsort(bins[positive])
    edges, below = z[positive][order], np.cumsum(n[positive][order])
    if not len(edges):
        model.threshold = 1.0
        return model
    place = int(np.searchsorted(below, int((1 - recall) * below[-1]), "right"))
    a, b = model.platt
    lowest = bins[positive][order][place] <= -BINS or a <= 0
    model.threshold = 0.0 if lowest else float(1 / (1 + np.exp(-np.clip(a * edges[place] + b, -30, 30))))
    return model


def _examples(rows: pa.Table | pa.RecordBatch) -> list[tuple[bytes, bytes, bytes]]:
    return list(zip(*(rows.column(c).to_pylist() for c in ("before", "token", "after")), strict=True))


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct tokens of all rows (``h``), whether a base finding overlaps them, and one context of each."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = find(texts(batch, "_text"), words=True)
        rows = windows(found, np.arange(len(found.first)))
        parts = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.record_batch({n: pa.array(p, pa.binary()) for n, p in zip(("before", "token", "after"), parts, strict=True)} | {"positive": pa.array(found.positive)})

    names = ["before", "token", "after"]
    seen = map_slices(docs.select(F.col(text).alias("_text")), run, "before binary, token binary, after binary, positive boolean", "_text")
    # a token is one example, whatever texts it stands in; long tokens count by their digest
    distinct = seen.groupBy(F.xxhash64("token").alias("h")).agg(F.max("positive").alias("positive"), F.min_by(F.struct(*names), F.struct(F.xxhash64(*names), *names)).alias("x"))
    return distinct.select("h", "positive", "x.*")


def _learner(state: np.ndarray, steps: int, epoch: int, weight: dict[bool, float], seed: int):
    """What an epoch does with a shard: its new state, times its number of examples."""

    def learn(key, rows):
        rows = rows.sort_by("h")
        labels = np.array(rows.column("positive").to_pylist(), bool)
        shard = key[0].as_py()
        new = _epoch(state, steps, _examples(rows), labels, np.where(labels, weight[True], weight[False]), [seed, epoch, shard])
        return pa.table({"shard": pa.array([shard], pa.int64()), "n": pa.array([float(len(labels))]), "state": pa.array([new * len(labels)], _STATE)})

    return learn


def _add(key, rows):
    rows = rows.sort_by("shard")
    summed = sum(np.array(x.values) for x in rows.column("state"))
    return pa.table({"n": pa.array([sum(rows.column("n").to_pylist())]), "state": pa.array([summed], _STATE)})


def fit(docs: DataFrame, text: str = "text", seed: int = 7) -> SecretModel | None:
    """Train on the distinct candidates of all rows; None with fewer than ``FEWEST`` of a label.

    An epoch deals the examples to shards of about ``SHARD``, each of which goes on
    from the same state, and the mean of their states is the next one."""
    held = F.pmod(F.xxhash64("h", F.lit("held")), F.lit(4)) == 0
    all_rows = cut_lineage(candidates(docs, text).withColumn("held", held))  # read once per epoch
    counts = {True: 0, False: 0} | {r.positive: r.n for r in all_rows.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(counts.values()) < FEWEST:
        return None
    total = sum(counts.values())
    weight = {label: total / (2 * n) for label, n in counts.items()}  # labels weigh the same, however rare
    shards = -(-total // SHARD)
    used = all_rows.where(~F.col("held"))
    state, steps = _start(seed), 0
    for epoch in range(EPOCHS):
        learn = _learner(state, steps, epoch, weight, seed)
        dealt = used.withColumn("shard", F.pmod(F.xxhash64("h", F.lit(epoch)), F.lit(shards)).cast("long"))
        learnt = dealt.groupBy("shard").applyInArrow(learn, "shard long, n double, state array<double>")
        sums = learnt.groupBy(F.col("shard") % SUMS).applyInArrow(_add, "n double, state array<double>").collect()  # at most SUMS rows
        n = sum(r.n for r in sums)
        state = sum(np.array(r.state) for r in sorted(sums, key=lambda r: (r.n, r.state[0]))) / n
        steps += -(-int(n / shards) // BATCH)

    model = _model(state)

    def score(batches):
        for batch in batches:
            shown = [(b"", x[1], b"") if h % 2 else x for x, h in zip(_examples(batch), batch.column("h").to_pylist(), strict=True)]
            bins = np.clip(np.floor(model.logits(shown) / GRID), -BINS, BINS)
            yield pa.record_batch({"bin": pa.array(bins.astype(np.int64)), "positive": batch.column("positive")})

    scored = all_rows.where("held").select("h", "positive", "before", "token", "after").mapInArrow(score, "bin long, positive boolean")
    rows = scored.groupBy("bin", "positive").agg(F.count(F.lit(1)).alias("n")).orderBy("bin", "positive").collect()  # at most 4 * BINS + 2 rows
    return calibrate(model, *(np.array([r[c] for r in rows], t) for c, t in (("bin", np.int64), ("positive", bool), ("n", float))))


def _spans_of(found: Found, model: SecretModel | None) -> list[list[Span]]:
    spans = [list(b) for b in found.base]
    which = np.flatnonzero(~found.positive)
    if model is not None and len(which):
        for i in which[model.probabilities(windows(found, which)) >= model.threshold].tolist():
            spans[found.text[i]].append(("model", int(found.start[i]), int(found.end[i])))
    return [sorted(s, key=lambda x: (x[1], KINDS.index(x[0]))) for s in spans]


def scan(docs: DataFrame, model: SecretModel | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with ``spans``, an array of (kind, start, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    kept = docs.select(*names, F.col(text).alias("_text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = _spans_of(find(texts(batch, "_text")), shared.value)
        column = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], kind)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), column], names=[*names, "spans"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "_text"), "spans array<struct<kind: string, start: bigint, end: bigint>>"])
    return map_slices(kept, run, schema, "_text")


def redact_text(text: str, spans: list[Span], mark: str) -> str:
    """``text`` with each stretch of touching or overlapping spans replaced by ``mark``."""
    out, at, open_until = [], 0, -1
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if s > open_until:
            out += [text[at:s], mark]
        open_until = max(open_until, e)
        at = open_until
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SecretModel | None, text: str = "text", mark: str = "[SECRET]", changed: str | None = None) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark``; null stays null.
    ``changed`` names a further column that says whether a text had findings."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        given = texts(batch, text)
        valid = batch.column(at).is_valid().to_pylist()
        spans = _spans_of(find(given), shared.value)
        clean = [redact_text(t, s, mark) if v else None for t, s, v in zip(given, spans, valid, strict=True)]
        columns = [pa.array(clean, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
        if changed is None:
            return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
        return pa.RecordBatch.from_arrays([*columns, pa.array([bool(s) for s in spans])], names=[*batch.schema.names, changed])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_slices(docs, run, schema if changed is None else f"{schema}, `{changed}` boolean", text)


def listed(spans: str, kinds: tuple[str, ...]) -> Column:
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in all ``documents``, the model trained on theirs."""
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, fit(docs), keep=["doc_id"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(listed("spans", KINDS[:3]).cast("binary"), 256).alias("base_sha256"), listed("spans", KINDS).alias("spans"))
