"""Language identification by interpolated Kneser-Ney models of characters.

Letters fold to 63 symbols, everything between words to one space, so that a sequence
of four symbols is a number of 24 bits. All texts of the languages learned are counted
on Spark; lower orders count the distinct symbols that stand before a sequence. Each
language's model is a few sorted arrays: sequences with their interpolated
probability, contexts with their back-off weight. A text gets the language with the
least cross-entropy for each symbol. The learning texts are two halves; each is scored by a
model of the other, and these scores of all of them, gathered on Spark, calibrate the score
and the entropy above which a text is rejected.

A language has at most 64 + 64^2 + 64^3 + 64^4 sequences and 64^3 + 64^2 + 65 contexts of
8 bytes each (138 MB; natural languages fill about one in a hundred): this bounds what
is collected and sent to the tasks, whatever the size of the corpus.
"""

from __future__ import annotations

import math
import pickle
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navrecon.llm.common import carried, importable, staged, text_of

ORDER, BITS = 4, 6
SYMBOLS = 1 << BITS
#: Code points of a piece of a long text, which is read as a text of its own; code points worked on at a time.
PIECE, TURN = 1 << 19, 1 << 21
UNKNOWN = "und"


# ---- symbols ---------------------------------------------------------------

@lru_cache(maxsize=1)
def alphabet() -> np.ndarray:
    """Symbol of each code point: 0 for what is no letter or mark, 1 to 26 for a to z, 27 to 63 for others in turn."""
    points = range(0x110000)
    word = np.fromiter((chr(p).isalpha() for p in points), bool, len(points))
    # Vowel signs and accents of their own continue a word.
    for first, last in ((0x300, 0x36F), (0x483, 0x487), (0x591, 0x5C7), (0x610, 0x61A), (0x64B, 0x65F), (0x900, 0xDFF),
                        (0xE31, 0xEFF), (0x102B, 0x103E), (0x17B4, 0x17D3)):
        word[first:last + 1] = True
    own = np.arange(len(word))
    table = np.where(word, 27 + own % 37, 0).astype(np.uint8)
    table[97:123] = np.arange(1, 27)
    return table


def sequences(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sequences of four symbols ending at each symbol and at each end, how many each piece has).

    Words are parted by one space; a piece begins and ends like a word. One without letters has none.
    """
    low = [p.lower() for p in pieces]
    flat = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(p) + 1 for p in low]) - 1
    symbols, last = alphabet()[flat], np.zeros(len(flat), bool)
    last[ends] = True
    # A space stays only behind a letter of its piece, and the end of a piece takes its place.
    space = symbols == 0
    keep = np.ones(len(flat), bool)
    keep[0] = not space[0]
    keep[1:] = ~(space[1:] & space[:-1])
    first = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    keep[first[space[first]]] = False
    # Of a run of spaces that ends a piece the end stays, if the piece has a letter.
    letters = np.add.reduceat(~space, first)
    spaces_at_end = np.zeros(len(flat), bool)
    kept_space = np.flatnonzero(keep & space & ~last)
    if len(kept_space):
        follower = np.searchsorted(np.flatnonzero(~space), kept_space)
        letter_places = np.append(np.flatnonzero(~space), len(flat))
        spaces_at_end[kept_space[letter_places[follower] > ends[np.searchsorted(ends, kept_space)]]] = True
    keep &= ~spaces_at_end
    keep[ends] = letters > 0
    symbols, last = symbols[keep].astype(np.uint32), last[keep]
    counts = np.add.reduceat(keep.astype(np.int64), first)
    out, seen = symbols.copy(), np.zeros(len(symbols), bool)
    for back in range(1, ORDER):
        # What lies before the piece counts as spaces.
        before = np.concatenate([np.zeros(min(back, len(last)), bool), last[:-back] if back < len(last) else []]).astype(bool)
        seen |= before
        earlier = np.concatenate([np.zeros(min(back, len(symbols)), np.uint32), symbols[:-back] if back < len(symbols) else []])
        out |= np.where(seen, 0, earlier).astype(np.uint32) << np.uint32(BITS * back)
    return out, counts


@lru_cache(maxsize=1)
def _scratch() -> tuple[np.ndarray, np.ndarray]:
    """A worker's marks and places of all sequences, 84 MB; the marks are cleared after use."""
    return np.zeros(1 << BITS * ORDER, bool), np.zeros(1 << BITS * ORDER, np.int32)


def distinct(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct sequences, ascending; the place of each of g among them)."""
    marks, places = _scratch()
    marks[g] = True
    known = np.flatnonzero(marks)
    marks[known] = False
    places[known] = np.arange(len(known), dtype=np.int32)
    return known.astype(np.uint32), places[g]


def turns(texts: list[str | None]):
    """(pieces, their texts' numbers) of at most about TURN code points at a time; every text is read to its end."""
    pieces, owners, size = [], [], 0
    for i, t in enumerate(texts):
        for k in range(0, len(t or ""), PIECE):
            pieces.append(t[k:k + PIECE])
            owners.append(i)
            size += len(pieces[-1])
            if size >= TURN:
                yield pieces, owners
                pieces, owners, size = [], [], 0
    if pieces:
        yield pieces, owners


# ---- counting and smoothing, on Spark --------------------------------------

def _counted(batches):
    """(lang, fit, g, n): sequences of the texts of each language, counted."""
    for batch in batches:
        langs, fits, texts = (batch.column(c) for c in ("lang", "fit", "text"))
        kinds = {}
        number = np.array([kinds.setdefault(k, len(kinds)) for k in zip(langs.to_pylist(), fits.to_pylist(), strict=True)], int)
        for kind, k in kinds.items():
            for pieces, _ in turns(texts.take(pa.array(np.flatnonzero(number == k))).to_pylist()):
                g, place = distinct(sequences(pieces)[0])
                n = np.bincount(place, minlength=len(g))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind[0]] * len(g)), pa.array([kind[1]] * len(g), pa.bool_()), pa.array(g.astype(np.int64)),
                     pa.array(n.astype(np.int64))], ["lang", "fit", "g", "n"])


def counted(texts: DataFrame) -> DataFrame:
    """(lang, g, fit, all): how often each sequence stands in the fitting and in all texts of (lang, fit, text)."""
    importable(texts.sparkSession)
    parts = texts.mapInArrow(_counted, "lang string, fit boolean, g long, n long")
    return staged(parts.groupBy("lang", "g").agg(
        F.coalesce(F.sum(F.when(F.col("fit"), F.col("n"))), F.lit(0)).alias("fit"), F.sum("n").alias("all")), "sequences")


def last_symbols(g: Column, n: int) -> Column:
    return g.bitwiseAND(F.lit((1 << BITS * n) - 1))


def smoothed(counts: DataFrame) -> DataFrame:
    """(lang, n, g, p, back) of (lang, g, c): p for sequences of n symbols, back for their contexts (the other null)."""
    orders = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        orders[n] = staged(orders[n + 1].groupBy("lang", last_symbols(F.col("g"), n).alias("g")).agg(F.count("*").alias("c")), "order")
    out, lower = None, None
    for n in range(1, ORDER + 1):
        own = orders[n].withColumn("h", F.shiftright("g", BITS))
        one, two = F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
        discounts = own.groupBy("lang").agg(F.least(F.lit(0.95), F.greatest(F.lit(0.05), F.coalesce(
            F.try_divide(one, one + 2 * two), F.lit(0.5)))).alias("d"))
        contexts = staged(own.groupBy("lang", "h").agg(F.sum("c").alias("s"), F.count("*").alias("t")).join(discounts, "lang")
                          .withColumn("back", F.col("d") * F.col("t") / F.col("s")), "contexts")
        told = own.join(contexts, ["lang", "h"])
        if lower is None:
            told = told.withColumn("below", F.lit(1.0 / SYMBOLS))
        else:
            told = told.withColumn("g_low", last_symbols(F.col("g"), n - 1)).join(lower, ["lang", "g_low"])
        told = staged(told.select("lang", "g", ((F.col("c") - F.col("d")) / F.col("s") + F.col("back") * F.col("below")).alias("p")),
                      "probabilities")
        lower = told.select("lang", F.col("g").alias("g_low"), F.col("p").alias("below"))
        none = F.lit(None).cast("double")
        rows = told.select("lang", F.lit(n).alias("n"), "g", "p", none.alias("back")).unionByName(
            contexts.select("lang", F.lit(n).alias("n"), F.col("h").alias("g"), none.alias("p"), "back"))
        out = rows if out is None else out.unionByName(rows)
    return out


def arrays_of(model: DataFrame) -> dict[str, dict]:
    """For each language (n, what): sorted sequences or contexts and the logarithms beside them."""
    found = model.toArrow()
    langs, g = np.array(found["lang"].to_pylist(), object), found["g"].to_numpy()
    n, p, back = (found[c].to_numpy() for c in ("n", "p", "back"))
    out: dict[str, dict] = {}
    for lang in sorted(set(langs)):
        own = langs == lang
        for k in range(1, ORDER + 1):
            for what, value in (("p", p), ("back", back)):
                here = np.flatnonzero(own & (n == k) & ~np.isnan(value))
                here = here[np.argsort(g[here], kind="stable")]
                out.setdefault(lang, {})[k, what] = (g[here].astype(np.uint32), np.log(value[here]).astype(np.float32))
    return out


# ---- scoring ---------------------------------------------------------------

def look_up(keys: np.ndarray, sorted_keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is each key there, its value or 0)."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    there = sorted_keys[at] == keys
    return there, np.where(there, values[at], np.float32(0))


def log_probabilities(g: np.ndarray, arrays: dict) -> np.ndarray:
    """log P of the last symbol of each sequence after the others: the longest known one, else backed off."""
    out = np.full(len(g), -np.log(SYMBOLS))
    for n in range(1, ORDER + 1):
        own = g & np.uint32((1 << BITS * n) - 1)
        there, p = look_up(own, *arrays[n, "p"])
        _, back = look_up(own >> np.uint32(BITS), *arrays[n, "back"])
        out = np.where(there, p, out + back)
    return out


def entropies(texts: list[str | None], languages: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of each text, cross-entropy of each text in each language; 0 for a text without letters)."""
    size, total = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(languages)))
    for pieces, owners in turns(texts):
        g, counts = sequences(pieces)
        owners = np.array(owners)
        np.add.at(size, owners, counts)
        if not len(g):
            continue
        known, place = distinct(g)
        full = np.flatnonzero(counts)
        begins = (np.cumsum(counts) - counts)[full]
        for k, arrays in enumerate(languages):
            np.add.at(total[:, k], owners[full], -np.add.reduceat(log_probabilities(known, arrays)[place], begins))
    return size, total / np.maximum(size, 1)[:, None]


def chances(size: np.ndarray, entropy: np.ndarray, sharp: float) -> np.ndarray:
    """Chance of each language: softmax of -sharp * sqrt(symbols) * entropy."""
    x = -sharp * np.sqrt(size)[:, None] * entropy
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def judge(texts: list[str | None], model: dict) -> tuple[list[str], list[float], list[float], list[bool]]:
    """(language, score, entropy, rejected) of each text."""
    names = model["names"]
    size, entropy = entropies(texts, [model["arrays"][n] for n in names])
    if not names:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts), [True] * len(texts)
    chance, best = chances(size, entropy, model["sharp"]), entropy.argmin(axis=1)
    own = np.arange(len(texts))
    mean, limit = np.array([model["limits"][n] for n in names])[best].T
    said = [names[b] if s else UNKNOWN for b, s in zip(best.tolist(), size.tolist(), strict=True)]
    return (said, np.where(size > 0, chance[own, best], 0.0).tolist(), entropy[own, best].tolist(),
            ((size == 0) | ((entropy[own, best] - mean) * np.sqrt(size) > limit)).tolist())


# ---- calibration, on Spark -------------------------------------------------

#: Sharpnesses that are tried; losses are added up as whole numbers of 1 / FINE, excesses counted as ones of 1 / UNIT.
SHARP, FINE, UNIT = [2.0 ** (k / 2) for k in range(-12, 13)], 1 << 40, 1 << 20
#: Bits by which each pass over the excesses narrows a limit down, beginning with the leading ones.
STEPS = (40, 30, 20, 10, 0)


def seen_apart(rows: DataFrame, arrays: dict[str, dict]) -> DataFrame:
    """(lang, size, entropy, losses) of rows (lang, text) by a model that has not seen them.

    There is a row for each text with letters whose language the model has: its symbols and their entropy
    in that language. losses, minus the logarithm of that language's chance for each of SHARP,
    are added up for a batch, whose last row has them.
    """
    names, blob = sorted(arrays), pickle.dumps([arrays[n] for n in sorted(arrays)])

    def scored(batches):
        place = {n: k for k, n in enumerate(names)}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            size, entropy = entropies(batch.column("text").to_pylist(), _unpacked(blob))
            known = np.array([i for i, n in enumerate(langs) if n in place and size[i] > 0], int)
            if not len(known):
                continue
            own, size, entropy = np.array([place[langs[i]] for i in known]), size[known], entropy[known]
            at = np.arange(len(known))
            sums = [int(np.rint(-np.log(np.maximum(chances(size, entropy, s)[at, own], 1e-12)) * FINE).sum()) for s in SHARP]
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[i] for i in known], pa.string()), pa.array(size, pa.int64()), pa.array(entropy[at, own]),
                 pa.array([None] * (len(known) - 1) + [sums], pa.list_(pa.int64()))], ["lang", "size", "entropy", "losses"])

    return rows.select("lang", "text").mapInArrow(scored, "lang string, size long, entropy double, losses array<long>")


def limits_of(told: DataFrame, ranks: dict[str, int]) -> dict[str, int]:
    """For each language the value of its rank, from 0, among the values of told (lang, x): exact, for any number of values.

    Each pass counts the values of the range that the one before has left, by their next
    bits: at most 2,048 counts for each language and pass, whatever the number of texts.
    """
    spark, left = told.sparkSession, dict(ranks)
    bound, before = {n: 0 for n in ranks}, None
    for bits in STEPS:
        rows = told
        if before is not None:
            now = spark.createDataFrame(list(bound.items()), "lang string, range long")
            rows = told.join(F.broadcast(now), "lang").where(F.shiftright("x", before) == F.col("range"))
        counts = rows.groupBy("lang", F.shiftright("x", bits).alias("range")).agg(F.count("*").alias("n")).collect()
        for lang in ranks:
            for r in sorted((r for r in counts if r.lang == lang), key=lambda r: r.range):
                bound[lang] = r.range
                if left[lang] < r.n:
                    break
                left[lang] -= r.n
        before = bits
    return bound


def calibrated(told: DataFrame, spare: float) -> tuple[float, dict]:
    """(sharpness of the score, mean entropy and limit of each language) from told (lang, size, entropy, losses).

    The sharpness is the one of SHARP with the greatest likelihood over all texts. The excess over
    the mean entropy, times the root of a text's symbols, lies at or below the limit for all but
    a share `spare` of a language's texts.
    """
    losses = told.select(*[F.sum(F.col("losses")[k].cast("decimal(28,0)")).alias(f"s{k}") for k in range(len(SHARP))]).first()
    if losses[0] is None:
        return 1.0, {}
    sharp = SHARP[min(range(len(SHARP)), key=lambda k: losses[k])]
    total = F.sum((F.col("entropy") * F.col("size")).cast("decimal(28,9)"))
    facts = {r.lang: r for r in told.groupBy("lang").agg(
        total.alias("total"), F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    means = {n: float(r.total) / r["size"] for n, r in facts.items()}
    mean = told.sparkSession.createDataFrame(list(means.items()), "lang string, mean double")
    excess = (F.col("entropy") - F.col("mean")) * F.sqrt("size") * F.lit(UNIT)
    excesses = staged(told.join(F.broadcast(mean), "lang").select("lang", F.ceil(excess).alias("x")), "excesses")
    found = limits_of(excesses, {n: max(0, math.ceil(r.n * (1 - spare)) - 1) for n, r in facts.items()})
    return sharp, {n: (means[n], x / UNIT) for n, x in found.items()}


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          spare: float = 0.01) -> dict:
    """The models of all languages of the rows for which learn is true and that have a language and an id.

    All these texts are counted, and all of them calibrate: they are halved by a hash of the id,
    and each half is scored by a model of the other. A language whose texts are all in one half
    has no limit. Null texts and texts without letters teach nothing.
    """
    held = F.col(f"`{id_col}`").cast("string")
    rows = docs.where(learn & F.col(f"`{lang_col}`").isNotNull() & held.isNotNull()).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), (F.xxhash64(held, F.lit(12)) % 2 == 0).alias("fit"),
        text_of(text_col).alias("text"))
    counts = counted(rows)
    # Rows stay where they are: each half is scored in place by one half's model at a time.
    told = None
    for own, other in (("fit", F.col("all") - F.col("fit")), ("not fit", F.col("fit"))):
        arrays = arrays_of(smoothed(counts.select("lang", "g", other.alias("c")).where("c > 0")))
        part = staged(seen_apart(rows.where(own), arrays), "calibration")
        told = part if told is None else told.unionByName(part)
    sharp, limits = calibrated(told, spare)
    whole = arrays_of(smoothed(counts.select("lang", "g", F.col("all").alias("c"))))
    return {"names": sorted(whole), "arrays": whole, "sharp": sharp,
            "limits": {n: limits.get(n, (0.0, float("inf"))) for n in whole}}


@lru_cache(maxsize=2)
def _unpacked(blob: bytes):
    return pickle.loads(blob)


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The columns of docs with lang_pred, lang_score (0 to 1), lang_entropy and lang_rejected.

    lang_pred is the language with the least cross-entropy for each symbol, ties to the
    smaller name; `und` with score 0 for null texts, texts without letters and models
    without languages. lang_rejected is true there and where the entropy exceeds the
    language's limit for a text of that length. Long texts are read to the end in pieces of PIECE code points.
    Columns of these names are replaced; repeated rows are judged like others.
    """
    importable(docs.sparkSession)
    made = ("lang_pred", "lang_score", "lang_entropy", "lang_rejected")
    blob = pickle.dumps(model)

    @F.arrow_udf("struct<lang:string,score:double,entropy:double,rejected:boolean>")
    def judged(texts: pa.Array) -> pa.Array:
        columns = judge(texts.to_pylist(), _unpacked(blob))
        kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          ["lang", "score", "entropy", "rejected"])

    told = docs.select(carried(docs, *made), judged(text_of(text_col)).alias("__judged"))
    return told.select("__doc.*", *[F.col(f"__judged.{m.removeprefix('lang_').replace('pred', 'lang')}").alias(m) for m in made])
