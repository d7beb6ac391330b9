"""Toxicity by maximum-scoring segments of token log-odds.

Each token's score is the log-odds ratio of its use in toxic and in clean labelled texts under an
informative Dirichlet prior (Monroe et al., 2008); tokens whose use doesn't differ significantly share
one slightly negative score, and a token too rare for a score of its own takes its stem's. All maximal scoring segments of a text are found in linear time (Ruzzo
and Tompa, 1999). Under chance segment scores follow an extreme-value law (Karlin and Altschul, 1990),
whose parameters make texts of any length comparable; the sum statistic of the best segments (Karlin
and Altschul, 1993) joins several passages of a text to one p-value. A logistic fit turns its negative
logarithm into a probability. The fit sees segments of texts whose own labels had no part in the
token scores: the sample is cut into FOLDS parts, near copies in one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm import hashing
from cadastra.llm.common import discard, labelled_sample, stored, unused

#: Labelled rows of each class that the fit may use.
PER_CLASS = 4000
#: The Dirichlet prior of a token is FLOOR plus its share of PRIOR.
FLOOR = 0.5
PRIOR = 500.0
#: Tokens that chance alone may call significant, over the whole vocabulary.
FALSE_TOKENS = 0.05
FOLDS = 4
#: Bytes of the stems that stand in for a token too rare to have a score of its own, longest first.
STEMS = (8, 6, 5, 4)
#: Best segments of a text that are joined to one p-value, and the chance at which a passage is reported.
JOINED = 5
CHANCE = 0.05
#: A text's vote, in whole numbers so that sums do not depend on their order.
_VOTE = 720_720


def token_spans(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece of the text: tokens' hashes, starts and ends (bytes in the text).

    A token is a lower-cased run of ASCII letters, digits and non-ASCII characters. The first row holds
    the hashes of whole tokens, the others those of their first STEMS bytes (0 for tokens no longer).
    """
    at = 0
    for piece in hashing.pieces(text):
        b = hashing.LOWER[np.frombuffer(piece, dtype=np.uint8)]
        starts, ends = hashing.words(b, hashing.WORDLIKE)
        if len(starts):
            sums = hashing.prefix(b)
            rows = [hashing.substring_hashes(sums, starts, ends)]
            for n in STEMS:
                stem = hashing.mix(hashing.substring_hashes(sums, starts, np.minimum(starts + n, ends)) + np.uint64(n))
                rows.append(np.where(ends - starts > n, stem, np.uint64(0)))
            yield np.stack(rows), starts + at, ends + at
        at += len(piece)


def tokens(text: bytes) -> np.ndarray:
    """Hashes of a text's tokens and their stems, one column for each token."""
    parts = [h for h, _, _ in token_spans(text)]
    return np.concatenate(parts, axis=1) if parts else np.zeros((1 + len(STEMS), 0), dtype=np.uint64)


def token_scores(hashes: np.ndarray, model: dict) -> np.ndarray:
    """Score of each token: its own, else that of its longest stem with one, else that of all the rest."""
    out = np.full(hashes.shape[1], model["rest"])
    if len(model["tokens"]):
        for row in hashes[::-1]:
            at = np.minimum(np.searchsorted(model["tokens"], row), len(model["tokens"]) - 1)
            hit = model["tokens"][at] == row
            out[hit] = model["scores"][at[hit]]
    return out


def best_segment(scores: np.ndarray) -> float:
    """Largest sum of consecutive scores, 0 for none."""
    if not len(scores):
        return 0.0
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    return float((sums - np.minimum.accumulate(sums)).max())


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time.

    Runs of scores with the same sign are merged first; they never fall apart in a maximal segment.
    """
    if not len(scores):
        return []
    sign = scores > 0
    cuts = np.concatenate([[0], np.flatnonzero(sign[1:] != sign[:-1]) + 1])
    sums = np.add.reduceat(scores, cuts).tolist()
    bounds = [*cuts.tolist(), len(scores)]
    total, found = 0.0, []  # found: (start, end, sum before, sum after, index of the nearest with a smaller sum before)
    for k, value in enumerate(sums):
        if value <= 0:
            total += value
            continue
        start, end, left, right = bounds[k], bounds[k + 1], total, total + value
        total = right
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append((start, end, left, right, j))
                break
            start, left, before = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = before
    return [(s, e, r - l) for s, e, l, r, _ in found]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, least, text): near copies mostly agree in the least hash of their word triples."""
    for batch in batches:
        least = np.zeros(batch.num_rows, dtype=np.uint64)
        for k, text in enumerate(batch.column(1).cast(pa.large_binary())):
            found = tokens(text.as_py() or b"")[0]
            triples = found[:-2] * np.uint64(9) + found[1:-1] * np.uint64(3) + found[2:]
            least[k] = hashing.mix(triples).min() if len(triples) else found.sum(dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(least.view(np.int64)), batch.column(1)], ["label", "least", "text"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, fold, toxic, clean, clean_uses): votes of texts of either label, and votes times uses in clean ones."""
    for batch in batches:
        parts = []
        for label, vote, fold, text in zip(*(batch.column(k) for k in range(4))):
            found = tokens(text.as_py() or b"")
            ids, counts = np.unique(found[found > 0], return_counts=True)
            y, v = label.as_py(), vote.as_py()
            columns = (np.full(len(ids), v * y), np.full(len(ids), v * (1 - y)), counts * (v * (1 - y)))
            parts.append((ids, np.full(len(ids), fold.as_py(), dtype=np.int32), *(c.astype(np.int64) for c in columns)))
        if parts:
            ids, fold, *sums = (np.concatenate(c) for c in zip(*parts))
            arrays = [pa.array(ids.view(np.int64)), pa.array(fold), *(pa.array(x) for x in sums)]
            yield pa.RecordBatch.from_arrays(arrays, ["token", "fold", "toxic", "clean", "clean_uses"])


def _decay(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share * exp(lambda * score)) = 1, or 1 where there is none."""
    if not (scores > 0).any() or share @ scores >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while share @ np.exp(np.minimum(high * scores, 700)) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if share @ np.exp(np.minimum(mid * scores, 700)) < 1 else (low, mid)
    return (low + high) / 2


def significant(stats: DataFrame, models: int = FOLDS) -> list[dict]:
    """Token scores of each model from rows (token, fold, toxic, clean, clean_uses).

    Model k < ``models`` leaves out fold k, the last one uses all. A token is significant if the signed
    root of its likelihood ratio is beyond the normal quantile at which FALSE_TOKENS of the whole
    vocabulary are expected by chance.
    """
    names = ("toxic", "clean", "clean_uses")
    part = lambda c, k: F.sum(F.when(F.col("fold") != k, F.col(c)).otherwise(0))
    sums = [part(c, k).alias(f"{c}{k}") for k in range(models + 1) for c in names]
    wide = stats.groupBy("token").agg(*sums)
    # no fold has the number ``models``, so that the last model holds all texts
    totals = wide.agg(F.count("*").alias("n"), *[F.sum(f"{c}{k}").alias(f"{c}{k}") for k in range(models + 1) for c in names]).first()
    if not totals["n"]:
        return [_model()] * (models + 1)
    limit = NormalDist().inv_cdf(1 - FALSE_TOKENS / (2 * totals["n"] + 2))
    rows = []
    for k in range(models + 1):
        n1, n0 = (max(totals[f"{c}{k}"], 1) / _VOTE for c in ("toxic", "clean"))
        t, c = F.col(f"toxic{k}") / _VOTE, F.col(f"clean{k}") / _VOTE
        prior = F.lit(FLOOR) + F.lit(PRIOR) * (t + c) / F.lit(n1 + n0)
        m1, m0 = (F.lit(n + FLOOR * totals["n"] + PRIOR) for n in (n1, n0))
        log_odds = F.ln((t + prior) / (m1 - t - prior)) - F.ln((c + prior) / (m0 - c - prior))
        expected = (t + c) * F.lit(n1 / (n1 + n0))
        half = lambda seen, want: F.when(seen > 0, seen * F.ln(seen / want)).otherwise(0.0)
        ratio = 2 * (half(t, expected) + half(c, t + c - expected))
        rows.append(F.struct(F.lit(k).alias("model"), log_odds.alias("score"), F.sqrt(F.greatest(ratio, F.lit(0.0))).alias("root"), t.alias("t"), c.alias("c"), (F.col(f"clean_uses{k}") / _VOTE).alias("uses")))
    found = wide.select("token", F.explode(F.array(*rows)).alias("r")).select("token", "r.*").where((F.col("root") >= limit) & (F.abs("score") > 0.0))
    table = found.orderBy("model", "token").toArrow()
    out = []
    for k in range(models + 1):
        own = table.filter(pa.compute.equal(table["model"], k))
        ids = np.asarray(own["token"]).view(np.uint64)
        order = np.argsort(ids)
        score, t, c, uses = (np.asarray(own[x], dtype=np.float64)[order] for x in ("score", "t", "c", "uses"))
        n1, n0, all_uses = (totals[f"{x}{k}"] / _VOTE for x in names)
        # what all other tokens say together
        rest = min(float(np.log((n1 - t.sum() + 1) / (n1 + 1)) - np.log((n0 - c.sum() + 1) / (n0 + 1))), -0.01)
        share = np.append(uses, max(all_uses - uses.sum(), 1.0))
        model = _model() | {"tokens": ids[order], "scores": score, "rest": rest}
        model["decay"] = _decay(np.append(score, rest), share / share.sum())
        out.append(model)
    return out


def _model(base_rate: float = 0.5) -> dict:
    """A model without tokens: every text scores the base rate."""
    return {"tokens": np.zeros(0, dtype=np.uint64), "scores": np.zeros(0), "rest": -0.01, "decay": 1.0, "log_k": 0.0, "slope": 0.0, "shift": _logit(base_rate)}


def best_segments(scores: np.ndarray) -> list[float]:
    """Scores of the JOINED best maximal segments, descending."""
    return sorted((v for _, _, v in maximal_segments(scores)), reverse=True)[:JOINED]


def evidence(best: list[float], length: int, model: dict) -> float:
    """-ln(p) of a text's best segments under chance, the smallest over how many of them are joined.

    One segment has the extreme-value p-value; the sum of r normalised scores has the tail
    e^-T T^(r-1) / (r! (r-1)!). Trying further segments costs ln 2 each.
    """
    top, total = 0.0, 0.0
    space = model["log_k"] + np.log(length + 1)
    for r, value in enumerate(best, 1):
        total += model["decay"] * value - space
        if r == 1:
            x = -np.log(-np.expm1(-np.exp(-total))) if total < 30 else total
        elif total <= r:
            break
        else:
            x = total - (r - 1) * np.log(total) + lgamma(r + 1) + lgamma(r)
        top = max(top, float(x) - (r - 1) * np.log(2))
    return top


def _segments(batches: Iterator[pa.RecordBatch], models: list[dict]) -> Iterator[pa.RecordBatch]:
    """(label, vote, fold, length, best) of each text, by the model that leaves out its fold."""
    for batch in batches:
        lengths, best = [], []
        for fold, text in zip(batch.column(2), batch.column(3)):
            scores = token_scores(tokens(text.as_py() or b""), models[fold.as_py()])
            lengths.append(len(scores))
            best.append(best_segments(scores))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lengths, pa.int64()), pa.array(best, pa.list_(pa.float64()))], ["label", "vote", "fold", "length", "best"])


def calibrate(rows: list[dict], models: list[dict], base_rate: float) -> dict:
    """The last model with log_k, slope and shift fitted on segments of texts left out of their model.

    log_k places the extreme-value law: as many clean texts as seen reach the least positive token
    score. ``rows``: label, vote, fold, length, best.
    """
    labels, votes = (np.array([r[c] for r in rows], dtype=np.float64) for c in ("label", "vote"))
    seen, space = 0.5, 0.0
    for r, vote in zip(rows, votes / _VOTE):
        own = models[r["fold"]]
        positive = own["scores"][own["scores"] > 0]
        if r["label"] == 0 and len(positive):
            least = float(positive.min())
            seen += vote * bool(r["best"] and r["best"][0] >= least)
            space += vote * (r["length"] + 1) * np.exp(-own["decay"] * least)
    log_k = float(np.clip(np.log(seen / space), -20, 5)) if space else 0.0
    for m in models:
        m["log_k"] = log_k
    x = np.array([evidence(r["best"], r["length"], models[r["fold"]]) for r in rows])
    slope, shift = _logistic(x, labels, votes / _VOTE)
    # from equal classes in the fit to the labels' own base rate
    return models[-1] | {"slope": slope, "shift": shift + _logit(base_rate)}


def _logistic(x: np.ndarray, labels: np.ndarray, votes: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic fit with both classes weighing the same."""
    weight = votes * np.where(labels == 1, 1 / max(votes[labels == 1].sum(), 1e-9), 1 / max(votes[labels == 0].sum(), 1e-9))
    a, b = 0.1, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(weight * (p - labels) * x).sum() + 1e-3 * a, (weight * (p - labels)).sum()])
        w = weight * p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        a, b = a - step[0], b - step[1]
    return max(float(a), 0.0), float(b)


def _logit(p: float) -> float:
    p = min(max(p, 1e-3), 1 - 1e-3)
    return float(np.log(p / (1 - p)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, seed: int = 5) -> dict:
    """A model from at most ``per_class`` labelled rows of each class (0 and 1), whole texts.

    ``labels`` holds doc_id and the label, only rows that may be learned from. Null labels and ids
    are ignored. With no row, or one class only, every text scores the base rate. Texts that agree in
    the least hash of their word triples, as near copies mostly do, share one vote. Tokens are counted
    and segments are scored on the executors; the driver sees the significant tokens and a few numbers
    of each text of the sample.
    """
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    n, ones = known.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        return _model(ones / n if n else 0.1)
    chosen = labelled_sample(known, "label", per_class, seed)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id").select("label", "text")
    sample = stored(rows.mapInArrow(_sketch, "label int, least bigint, text binary"))
    shares = sample.groupBy("label", "least").agg(F.expr(f"cast({_VOTE} div count(*) as bigint)").alias("vote"))
    voted = sample.join(F.broadcast(shares), ["label", "least"]).select("label", "vote", F.pmod("least", F.lit(FOLDS)).cast("int").alias("fold"), "text")
    stats = stored(
        voted.mapInArrow(_count, "token bigint, fold int, toxic bigint, clean bigint, clean_uses bigint")
        .groupBy("token", "fold")
        .agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "clean_uses")])
    )
    models = significant(stats)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    found = voted.mapInArrow(lambda batches: _segments(batches, shared.value), "label int, vote bigint, fold int, length bigint, best array<double>").toArrow().to_pylist()
    discard(sample, stats)
    found.sort(key=lambda r: (r["label"], r["fold"], r["vote"], r["length"], r["best"]))
    if len({r["label"] for r in found}) < 2:
        return _model(ones / n)
    return calibrate(found, models, ones / n)


def score_text(text: bytes, model: dict) -> tuple[float, list[tuple[int, int, float]]]:
    """Probability of label 1, and the text's maximal segments that chance does not explain.

    A segment is (start, end, score) with byte positions; it is kept if fewer than CHANCE segments of
    its score are expected in a clean text of that length.
    """
    parts = list(token_spans(text))
    scores = token_scores(np.concatenate([x[0] for x in parts], axis=1), model) if parts else np.zeros(0)
    found = maximal_segments(scores) if (scores > 0).any() else []
    best = sorted((v for _, _, v in found), reverse=True)[:JOINED]
    z = model["slope"] * evidence(best, len(scores), model) + model["shift"]
    p = float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    limit = (model["log_k"] + np.log(len(scores) + 1) - np.log(CHANCE)) / model["decay"]
    spans: list[tuple[int, int, float]] = []
    if best and best[0] >= limit:
        starts = np.concatenate([x[1] for x in parts])
        ends = np.concatenate([x[2] for x in parts])
        spans = [(int(starts[s]), int(ends[e - 1]), v) for s, e, v in found if v >= limit]
    return p, spans


RESULT = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("value", T.DoubleType())]))),
    ]
)


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column, the last, named toxicity (with underscores if taken).

    It holds the score and the significant passages. Null texts count as empty; other columns and
    repeated rows pass through untouched.
    """
    place = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(unused("toxicity", docs), RESULT)])
    names = schema.names
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(place).cast(pa.large_binary()):
                p, spans = score_text(x.as_py() or b"", shared.value)
                out.append({"score": p, "spans": [{"start": s, "end": e, "value": v} for s, e, v in spans]})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names)

    return docs.mapInArrow(run, schema)
