"""Toxic spans by a linear-chain conditional random field.

Labels are given for documents. Tokens get theirs from them: in a toxic document, a
token is labelled toxic if one of its features (the word, its beginnings, its end)
is tied to toxic documents beyond chance (G squared). The field has two states, one
weight for each feature of a toxic token and weights for the steps between states.
Forward-backward gives each token's marginal; a document's score is a logistic
function of the largest marginal, their sum and the length, and tokens with a
marginal of one half or more are its spans.

The field is fitted on the driver to a bounded sample of labelled documents (the
bound is a parameter). Scoring covers every text as a whole: it is cut into segments,
whose transfer matrices are multiplied over the document, so that marginals are those
of the uncut chain while the work for long texts stays in arrays of fixed length.
"""

from __future__ import annotations

import math
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navrecon.llm.common import SMALL_BATCH, carried, importable, leave_room, text_of
from navrecon.llm.near_dedup import shingles, sketches, word_hashes

SEGMENT = 128
#: Segments that fitting works on at a time.
CHAINS = 2048
#: Words whose emission a worker keeps; beyond, it starts anew.
CACHED = 400_000
#: Code points that are scored at a time, unless one text alone is longer.
CHARS_AT_ONCE = 1 << 21
#: A feature's tie to toxic documents counts from here (chi square of one degree of freedom).
TIED = 16.0
#: And so many times as often must toxic documents hold it.
RATIO = 8.0
EDGES = ".,;:!?\"'()[]{}<>*_~"


#: Features of a word at most.
WIDTH = 8


def features(word: str) -> list[int]:
    """Hashes (not 0) of the word without punctuation, its beginnings and its end."""
    w = word.strip(EDGES) or word
    n = len(w)
    names = ["=" + w, "$" + w[-4:], *["^" + w[:k] for k in (3, 4, 5, 6, 7, 9) if n >= k]]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) or 1 for x in names]


# ---- the chain -------------------------------------------------------------

def segments(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, tokens, document) of each segment of texts laid end to end."""
    parts = -(-lengths // SEGMENT)
    doc = np.repeat(np.arange(len(lengths)), parts)
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(np.cumsum(lengths) - lengths, parts) + number * SEGMENT
    size = np.minimum(SEGMENT, np.repeat(lengths, parts) - number * SEGMENT)
    return start, size, doc


def laid_out(emission: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(SEGMENT, segments) arrays: exp(emission), and where a token is."""
    at = start[None, :] + np.arange(SEGMENT)[:, None]
    here = np.arange(SEGMENT)[:, None] < size[None, :]
    factor = np.ones(at.shape)
    factor[here] = np.exp(np.clip(emission[at[here]], -30, 30))
    return factor, here


def transfer(factor: np.ndarray, here: np.ndarray, step: np.ndarray) -> np.ndarray:
    """(2, 2, segments): the product of a segment's steps, up to a factor."""
    m = np.zeros((2, 2, factor.shape[1]))
    m[0, 0] = m[1, 1] = 1.0
    for t in range(SEGMENT):
        new = np.stack([m[:, 0] * step[0, 0] + m[:, 1] * step[1, 0],
                        (m[:, 0] * step[0, 1] + m[:, 1] * step[1, 1]) * factor[t]], axis=1)
        m = np.where(here[t], new / new.max(axis=(0, 1)), m)
    return m


def ends(products: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages (2, segments) that enter each segment from the left and from the right of its document."""
    n = products.shape[2]
    first = np.concatenate([[True], doc[1:] != doc[:-1]]) if n else np.empty(0, bool)
    place = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    by_place = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[by_place], np.arange(place.max(initial=0) + 2))
    left, right = np.tile(start[:, None], n), np.ones((2, n))
    for k in range(1, len(cuts) - 1):
        own = by_place[cuts[k]:cuts[k + 1]]
        new = np.einsum("in,ijn->jn", left[:, own - 1], products[:, :, own - 1])
        left[:, own] = new / new.sum(axis=0)
    for k in range(len(cuts) - 2, 0, -1):
        own = by_place[cuts[k]:cuts[k + 1]]
        new = np.einsum("ijn,jn->in", products[:, :, own], right[:, own])
        right[:, own - 1] = new / new.sum(axis=0)
    return left, right


def marginals(factor, here, step, left, right, pairs: bool = False):
    """Chance of the toxic state of each token, (SEGMENT, segments), and expected steps if asked for.

    left is a segment's message before its first step, right the one after its last.
    """
    n = factor.shape[1]
    alpha = np.empty((SEGMENT, 2, n))
    a = left
    for t in range(SEGMENT):
        zero = a[0] * step[0, 0] + a[1] * step[1, 0]
        one = (a[0] * step[0, 1] + a[1] * step[1, 1]) * factor[t]
        total = zero + one
        a = np.where(here[t], np.stack([zero / total, one / total]), a)
        alpha[t] = a
    out, b, counts = np.zeros((SEGMENT, n)), right, np.zeros((2, 2))
    for t in range(SEGMENT - 1, -1, -1):
        one = alpha[t, 1] * b[1]
        out[t] = np.where(here[t], one / (alpha[t, 0] * b[0] + one), 0.0)
        before = alpha[t - 1] if t else left
        zero, up = b[0], b[1] * factor[t]
        if pairs:
            joint = np.stack([before[0] * step[0, 0] * zero, before[0] * step[0, 1] * up,
                              before[1] * step[1, 0] * zero, before[1] * step[1, 1] * up])
            counts += (joint / joint.sum(axis=0))[:, here[t]].sum(axis=1).reshape(2, 2)
        new = np.stack([step[0, 0] * zero + step[0, 1] * up, step[1, 0] * zero + step[1, 1] * up])
        b = np.where(here[t], new / new.sum(axis=0), b)
    return out, counts


BEGIN = np.array([1.0, 0.0])  # a text begins as if a harmless token came before it


def token_marginals(emission: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The toxic marginal of every token of texts laid end to end."""
    if not lengths.sum():
        return np.empty(0)
    start, size, doc = segments(lengths)
    factor, here = laid_out(emission, start, size)
    left, right = ends(transfer(factor, here, step), doc, BEGIN)
    found, _ = marginals(factor, here, step, left, right)
    return found.T[here.T]  # segments are in the order of the tokens


def document_facts(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(documents, 4): 1, log odds of the largest marginal, log of 1 + their sum, log of 1 + tokens."""
    stops = np.cumsum(lengths)
    sums = np.concatenate([[0.0], np.cumsum(p)])
    total = sums[stops] - sums[stops - lengths]
    top = np.zeros(len(lengths))
    full = lengths > 0
    if full.any():
        top[full] = np.maximum.reduceat(p, (stops - lengths)[full])
    top = np.clip(top, 1e-9, 1 - 1e-9)
    return np.stack([np.ones(len(lengths)), np.log(top / (1 - top)) / 10, np.log1p(np.maximum(total, 0)),
                     np.log1p(lengths) / 10], axis=1)


# ---- fitting ---------------------------------------------------------------

def tied(a: np.ndarray, b: np.ndarray, toxic: int, other: int) -> np.ndarray:
    """Is a feature that `a` of the toxic and `b` of the other documents hold tied to the toxic ones?"""
    n, g = toxic + other, np.zeros(len(a))
    for seen, held, size in ((a, a + b, toxic), (b, a + b, other), (toxic - a, n - a - b, toxic), (other - b, n - a - b, other)):
        expected = held * size / n
        full = (seen > 0) & (expected > 0)
        g[full] += 2 * seen[full] * np.log(seen[full] / expected[full])
    return (g >= TIED) & (a * other >= RATIO * b * toxic) & (a > 0)


def distinct(texts: list[str]) -> list[int]:
    """Numbers of the texts that are no near copies of an earlier one: copies would tie any of their words to a label."""
    seen: set[tuple[int, int]] = set()
    out = []
    for i, t in enumerate(texts):
        own = set(enumerate(sketches(shingles(word_hashes(t)), 4, 1)))
        if not own & seen:
            out.append(i)
        seen |= own
    return out


def fit(texts: list[str], toxic: list[int], prior: float, rounds: int = 30) -> dict | None:
    """Weights of the field and of the score from labelled texts; None without both labels."""
    kept = distinct(texts)
    texts, y = [texts[i] for i in kept], np.array([toxic[i] for i in kept], bool)
    if y.all() or not y.any():
        return None
    # Words become numbers at once; a word's features are a row of a table of numbers.
    vocabulary: dict[str, int] = {}
    docs = []
    for t in texts:
        own = t.lower().split()
        docs.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in own), np.int32, len(own)))
    flat = (f for w in vocabulary for f in (features(w) + [0] * WIDTH)[:WIDTH])
    table = np.fromiter(flat, np.uint32, WIDTH * len(vocabulary))
    del vocabulary
    values, table = np.unique(table, return_inverse=True)
    table = table.astype(np.int32).reshape(-1, WIDTH)
    held = np.zeros((2, len(values)), np.int32)
    for own, bad in zip(docs, y.tolist(), strict=True):
        held[int(bad), np.unique(table[np.unique(own)])] += 1
    known = tied(held[1].astype(float), held[0].astype(float), int(y.sum()), int((~y).sum())) & (values != 0)
    lengths = np.array([len(d) for d in docs])
    words = np.concatenate(docs) if docs else np.empty(0, np.int32)
    marked = known[table].any(axis=1)
    labels = marked[words] & np.repeat(y, lengths)
    # Weights only for features of labelled tokens and those that several words share.
    used = np.bincount(table.ravel(), minlength=len(values)) >= 5
    used[table[np.unique(words[labels])].ravel()] = True
    used[values == 0] = False
    size = int(used.sum())
    place = np.full(len(values), size, np.int32)  # what has no weight of its own
    place[used] = np.arange(size)
    table, names = place[table], values[used]

    # Adam on the likelihood of segments as chains; a bias and the steps in logarithms are learned beside the features.
    weights, moves = np.zeros(size + 2), np.array([[0.0, -2.0], [-1.0, -1.0]])
    weights[-1] = -2.0
    start, count, _ = segments(lengths)
    m1 = m2 = np.zeros(size + 6)
    for turn in range(1, rounds + 1):
        emission = weights[table].sum(axis=1) + weights[-1]
        error, gained = np.zeros(len(table)), np.zeros((2, 2))
        for i in range(0, len(start), CHAINS):  # a few segments at a time bound the memory
            at = start[i:i + CHAINS][None, :] + np.arange(SEGMENT)[:, None]
            factor, here = laid_out(emission[words], start[i:i + CHAINS], count[i:i + CHAINS])
            n = factor.shape[1]
            p, expected = marginals(factor, here, np.exp(moves), np.tile(BEGIN[:, None], n), np.ones((2, n)), pairs=True)
            own = np.zeros(here.shape, bool)
            own[here] = labels[at[here]]
            before = np.vstack([np.zeros((1, n), bool), own[:-1]])
            seen = [[(here & (before == s) & (own == t)).sum() for t in (False, True)] for s in (False, True)]
            gained += np.array(seen) - expected
            error += np.bincount(words[at[here]], weights=(own - p)[here], minlength=len(table))
        slope = np.concatenate([np.bincount(table.ravel(), weights=np.repeat(error, WIDTH), minlength=size + 1)[:size],
                                [0.0, error.sum()], gained.ravel()])
        slope[:size + 2] -= 0.1 * weights
        slope[size + 2:] -= 0.1 * moves.ravel()
        m1, m2 = 0.8 * m1 + 0.2 * slope, 0.95 * m2 + 0.05 * slope * slope
        move = 0.3 * (m1 / (1 - 0.8 ** turn)) / (np.sqrt(m2 / (1 - 0.95 ** turn)) + 1e-8)
        weights, moves = weights + move[:size + 2], moves + move[size + 2:].reshape(2, 2)
        weights[size] = 0.0
    step = np.exp(moves)
    emission = weights[table].sum(axis=1) + weights[-1]
    stops = np.cumsum(lengths)
    facts = np.concatenate([document_facts(token_marginals(
        emission[words[stops[i] - lengths[i]:stops[min(i + 128, len(stops)) - 1]]], lengths[i:i + 128], step), lengths[i:i + 128])
        for i in range(0, len(lengths), 128)])
    score = logistic(facts, y.astype(float))
    share = y.mean()
    score[0] += math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    strong = np.flatnonzero(np.abs(weights[:size]) > 1e-3)
    return {"weights": dict(zip(names[strong].tolist(), weights[strong].tolist(), strict=True)),
            "bias": float(weights[-1]), "step": step.tolist(), "score": score.tolist()}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights by Newton's method; the constant is not shrunk."""
    w, shrink = np.zeros(x.shape[1]), ridge * np.array([1e-3, *[1.0] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink)
        w = w + np.linalg.solve(h, x.T @ (y - p) - shrink * w)
    return w


# ---- scoring ---------------------------------------------------------------

class Scorer:
    def __init__(self, model: dict):
        self.weights, self.bias = model["weights"], model["bias"]
        self.step, self.score = np.array(model["step"]), np.array(model["score"])
        self.known: dict[str, float] = {}

    def emission(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            found = self.known[word] = self.bias + sum(self.weights.get(f, 0.0) for f in features(word))
        return found

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """Scores, and the spans (code points, end exclusive) of toxic tokens."""
        split = [t.lower().split() for t in texts]
        lengths = np.array([len(d) for d in split], np.int64)
        emission = np.fromiter((self.emission(w) for d in split for w in d), float, int(lengths.sum()))
        p = token_marginals(emission, lengths, self.step)
        score = 1 / (1 + np.exp(-np.clip(document_facts(p, lengths) @ self.score, -500, 500)))
        spans, begins = [], np.cumsum(lengths) - lengths
        for text, begin, n in zip(texts, begins.tolist(), lengths.tolist(), strict=True):
            hits = np.flatnonzero(p[begin:begin + n] >= 0.5)
            found: list[tuple[int, int]] = []
            if len(hits):
                # Lower-casing may lengthen a letter but never makes or ends a word.
                wanted = set(hits.tolist())
                found = [m.span() for i, m in enumerate(re.finditer(r"\S+", text)) if i in wanted]
            spans.append(found)
        return score, spans


@lru_cache(maxsize=1)
def _scorer(blob: bytes) -> Scorer:
    import pickle
    return Scorer(pickle.loads(blob))


def portions(texts: pa.Array, most: int = 512, chars: int = CHARS_AT_ONCE):
    """The texts in order, at most `most` at a time, and together of about chars code points unless one alone is longer."""
    part, held = [], 0
    for t in texts:
        t = t.as_py()
        if part and (len(part) == most or held + len(t) > chars):
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          sample: int = 1000, max_chars: int = 50_000) -> dict | None:
    """The model from labelled documents that are not held out.

    At most `sample` toxic and twice as many other documents are used, those with the
    smallest hashes of their ids, and of those the ones of at most max_chars code points. Rows
    without label or id are passed over; an id with several labels is toxic if one is.
    """
    allowed = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
               .where(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0)
               .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label)).alias("__toxic")))
    counts = {r.t: r.n for r in allowed.groupBy((F.col("__toxic") > 0).cast("int").alias("t"))
              .agg(F.count("*").alias("n")).collect()}
    chosen = None
    for value in (0, 1):
        part = allowed.where((F.col("__toxic") > 0).cast("int") == value).orderBy(F.xxhash64("__id"), "__id").limit(
            sample * (2 - value))
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most three times the sample: a bounded broadcast.
    held = (docs.select(F.col(f"`{id_col}`").alias("__id"), text_of(text_col).alias("__text"))
            .where(F.char_length("__text") <= max_chars).join(F.broadcast(chosen), "__id")
            .groupBy("__id").agg(F.max("__toxic").alias("toxic"), F.min("__text").alias("text"))
            .orderBy("__id").collect())
    total = sum(counts.values())
    if not held or not total:
        return None
    prior = min(max(counts.get(1, 0) / total, 1e-3), 1 - 1e-3)
    return fit([r.text for r in held], [int(r.toxic > 0) for r in held], prior)


def score_documents(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of docs with toxic_score (double, 0 to 1) and toxic_spans (array of start, end).

    Null or empty texts are scored as texts without tokens; without a model every
    score is 0. Columns of these two names are replaced; repeated rows and null ids
    are scored like others.
    """
    import pickle
    importable(docs.sparkSession, SMALL_BATCH)
    rest = carried(docs, "toxic_score", "toxic_spans")
    if model is None:
        return docs.select(rest, text_of(text_col)).select(
            "__doc.*", F.lit(0.0).alias("toxic_score"),
            F.array().cast("array<struct<start:int,end:int>>").alias("toxic_spans"))
    blob = pickle.dumps(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf("struct<score:double,spans:array<struct<start:int,end:int>>>")
    def judged(texts: pa.Array) -> pa.Array:
        leave_room("toxicity")
        own, scores, spans = _scorer(blob), [], []
        for part in portions(texts):
            s, found = own(part)
            scores += s.tolist()
            spans += [[{"start": a, "end": b} for a, b in f] for f in found]
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(spans, kind)], ["score", "spans"])

    told = docs.select(rest, judged(text_of(text_col)).alias("__judged"))
    return told.select("__doc.*", F.col("__judged.score").alias("toxic_score"), F.col("__judged.spans").alias("toxic_spans"))
