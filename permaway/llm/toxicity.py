"""Toxicity: noisy-channel restoration of disguised words, then a learned lexicon."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permaway.llm.batches import text_batches
from permaway.llm.decontaminate import FOLD
from permaway.llm.quality import fold_of

#: Labelled training rows of a kind that the driver holds, as lists of their distinct words.
TOXIC_SAMPLE, CLEAN_SAMPLE = 2_000, 4_000
#: Alphabet of the character model: 0 for what ends a word, 1-26 letters, 27 any byte of other characters.
SIZE = 28
#: Signs that stand for letters.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "#": "h"}
#: Signs that may end a word as punctuation or stand for its last letters.
PUNCTUATION = "!|$+"
TRIPLE = re.compile(r"([a-z])\1\1")
#: Letters of a spaced run that are read at once.
SPACED = 16
#: Signs put between the letters of one word.
GAPS = " ._-*"
#: Log probability that a letter is written as a sign, is repeated, or is followed by a gap.
SIGN_COST, REPEAT_COST, GAP_COST = -1.0, -0.5, -0.2

SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[128:] = 27
_LETTER = np.isin(np.arange(256), [*range(97, 123), *range(65, 91)])
_SIGN = np.isin(np.arange(256), [ord(c) for c in LEET])
_GAP = np.isin(np.arange(256), [ord(c) for c in GAPS])
_DIGIT = np.isin(np.arange(256), [ord(c) for c in "0123456789" if c not in LEET])
#: 1 letter, 2 sign, 4 gap, 8 digits that are no signs, 0 others.
CLASS = (_LETTER * 1 + _SIGN * 2 + _GAP * 4 + _DIGIT * 8).astype(np.uint8)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of symbol triples over every whole text of docs. At most SIZE^3 sums reach the driver."""
    docs = text_batches(docs)

    def run(batches):
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                raw = text.as_py()
                if raw:
                    s = SYMBOL[np.frombuffer(b" " + raw + b"  ", np.uint8)]
                    total += np.bincount((s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:], minlength=SIZE**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    rows = docs.select(F.col("text").cast("binary")).mapInArrow(run, "at bigint, n bigint")
    out = np.zeros(SIZE**3)
    for at, n in rows.groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[at] = n
    return out


def log_model(counts: np.ndarray) -> list[float]:
    """log p(c | a, b), smoothed by pairs and single symbols."""
    tri = counts.reshape(SIZE, SIZE, SIZE)
    two, one = tri.sum(0), tri.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)
    return np.log(p3).ravel().tolist()


def restore(token: str, model: list[float]) -> str:
    """The likeliest word behind a token of letters, signs and gaps, by Viterbi search. Runs are
    folded by the lattice itself, so the work grows with a token's length, not its square.

    The lattice: at each place a run of one sign or letter is read as one or two copies
    of each letter it may stand for, and a gap as nothing. A state is a place and the
    last two symbols; a path's worth is its character-model probability and the
    channel's costs. A token that no path fits comes back as it is.
    """
    n = len(token)
    best: list[dict] = [{} for _ in range(n + 1)]
    best[0][(0, 0)] = (0.0, "")
    for i in range(n):
        if not best[i]:
            continue
        c = token[i]
        run = i + 1
        while run < n and token[run] == c:
            run += 1
        if "a" <= c <= "z":
            choices, cost = c, 0.0
        elif c in LEET:
            choices, cost = LEET[c], SIGN_COST
        else:
            choices, cost = "", 0.0
        steps = [(x, 1, i + 1, cost) for x in choices] if run == i + 1 else [(x, k, run, cost + REPEAT_COST * (run - i - k > 0)) for x in choices for k in (1, 2)]
        if c in GAPS:
            steps.append(("", 0, run, GAP_COST))
        for (a, b), (worth, word) in best[i].items():
            for x, k, stop, price in steps:
                p, q, w = a, b, worth + price
                if k:
                    s = ord(x) - 96
                    for _ in range(k):
                        w += model[(p * SIZE + q) * SIZE + s]
                        p, q = q, s
                old = best[stop].get((p, q))
                if old is None or w > old[0]:
                    best[stop][(p, q)] = (w, word + x * k)
    ends = [(w + model[(p * SIZE + q) * SIZE], word) for (p, q), (w, word) in best[n].items()]
    return max(ends)[1] if ends else token


def disguised(raw: bytes) -> list[str]:
    """Tokens of a text that may hide a word: a letter and a sign side by side in one run, three
    of a letter in a row, or three or more single letters with one gap between. Tokens of any
    length are taken; signs at an end are tried as letters and as punctuation."""
    low = raw.translate(LOWER)
    text = np.frombuffer(b"\n\n" + low + b"\n\n\n\n", np.uint8)
    kind = CLASS[text]
    letter, word = kind == 1, (kind & 3) > 0
    hits = ((kind[:-1] == 2) & letter[1:]) | (letter[:-1] & (kind[1:] == 2))
    hits[:-1] |= letter[:-2] & (text[:-2] == text[1:-1]) & (text[1:-1] == text[2:])
    out, done = [], 0
    for i in np.flatnonzero(hits).tolist():
        if i < done:
            continue
        a, b = i, i + 1
        while word[a - 1]:
            a -= 1
        while word[b]:
            b += 1
        done = b
        token = bytes(text[a:b]).decode("ascii")
        bare = token.rstrip(PUNCTUATION)
        if not bare.isalpha() or TRIPLE.search(bare):
            out.append(bare)
        # A word that ends in nothing but exclamation marks is no disguise by them.
        if set(token[len(bare) :]) - {"!"}:
            out.append(token)
    # A sign at the end of a word is punctuation, so that a letter before it may stand alone.
    solid = (letter | (kind == 8)) | (word & np.append(word[1:], False))
    alone = word[1:-1] & ~solid[:-2] & ~solid[2:]
    # two single letters with one gap between, at i and i + 2 of the padded text
    pair = np.zeros(len(text), bool)
    pair[1:-3] = alone[:-2] & alone[2:] & ((kind[2:-2] & 4) > 0)
    done = 0
    for i in np.flatnonzero(pair[:-4] & pair[2:-2]).tolist():
        if i < done or text[i + 1] != text[i + 3]:
            continue
        b = i + 2
        while b < len(text) - 2 and pair[b] and text[b + 1] == text[i + 1]:
            b += 2
        done = b
        found = bytes(text[i : b + 1]).decode("ascii")
        # The first may be a word by itself; a long run is read from each of its letters on,
        # by as many as a word has, so that a word in its midst is met.
        out += [found, found[2:]] if len(found) <= 2 * SPACED else [found[j : j + 2 * SPACED - 1] for j in range(0, len(found) - 4, 2)]
    return [t for t in out if t]


class Restorer:
    """Distinct words of a text with the restored ones; keeps what it has decoded, up to a bound."""

    def __init__(self, model: list[float], memory: int = 50_000):
        self.model, self.memory, self.seen = model, memory, {}

    def words(self, raw: bytes | None) -> set[bytes]:
        if not raw:
            return set()
        out = set(raw.translate(FOLD).split())
        for t in set(disguised(raw)):
            w = self.seen.get(t)
            if w is None:
                if len(self.seen) >= self.memory:
                    self.seen.clear()
                w = self.seen[t] = restore(t, self.model).encode()
            out.add(w)
        return out


def keys_of(word: bytes) -> list[bytes]:
    """A word itself and its beginnings, which tell inflected and compound forms."""
    return [b"=" + word, *(word[:n] for n in (4, 5, 6, 7) if len(word) >= n)]


def learn_lexicon(toxic: list[tuple[bytes, ...]], clean: list[tuple[bytes, ...]], least: float = 1.5) -> dict[bytes, float]:
    """Keys that mark toxic texts, with the lower bound of their log odds ratio."""
    if not toxic or not clean:
        return {}
    pos: Counter = Counter()
    for words in toxic:
        pos.update({k for w in words if len(w) > 2 for k in keys_of(w)})
    need = max(2, math.ceil(0.004 * len(toxic)))
    pos = Counter({k: n for k, n in pos.items() if n >= need})
    neg: Counter = Counter()
    for words in clean:
        neg.update({k for w in words for k in keys_of(w) if k in pos})
    out = {}
    for k, a in pos.items():
        b = neg[k]
        odds = math.log((a + 0.5) / (len(toxic) + 1)) - math.log((b + 0.5) / (len(clean) + 1))
        if (low := odds - math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))) >= least:
            out[k] = low
    return out


def toxic_features(words, lexicon: dict[bytes, float], known: dict[bytes, float] | None = None) -> list[float]:
    """Count, largest and summed weights of the distinct words that the lexicon marks."""
    found = []
    known = {} if known is None else known
    for w in words:
        x = known.get(w)
        if x is None:
            if len(known) > 100_000:
                known.clear()
            x = known[w] = max((lexicon[k] for k in keys_of(w) if k in lexicon), default=0.0)
        if x:
            found.append(x)
    found.sort(reverse=True)
    top = found[:4] + [0.0] * (4 - len(found[:4]))
    return [1.0, *top, min(len(found), 10) / 3, sum(found[:10]) / 10, len(found) / (len(words) + 20) * 20, math.log1p(len(words)) / 5]


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05, steps: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        d = np.linalg.solve(h, g)
        w -= d * min(1, 2 / (np.abs(d).max() + 1e-9))
        if np.abs(d).max() < 1e-6:
            break
    return w


def _fresh(rows: list[tuple[bytes, ...]]) -> list[tuple[bytes, ...]]:
    """Texts less those that share a band of smallest word hashes with one before:
    copies would lend their rare words false weight."""
    seen, out = set(), []
    for words in rows:
        h = sorted(zlib.crc32(w) for w in words)[:9]
        bands = [(i, *h[i : i + 3]) for i in (0, 3, 6) if len(h) >= i + 3] or [(-1, *h)]
        if not any(b in seen for b in bands):
            out.append(words)
        seen.update(bands)
    return out


def train_toxicity(docs: DataFrame, labels: DataFrame, fold: int = 5, held: int = 0):
    """(character model, lexicon, weights): what score_toxicity needs.

    The character model counts all texts. Lexicon and weights come from at most
    TOXIC_SAMPLE and CLEAN_SAMPLE labelled training texts, drawn by a hash of the id; the
    weights are fitted on features that a lexicon of the other half of the texts gave.
    """
    model = log_model(trigram_counts(docs))
    kept = F.pmod(fold_of(F.col("doc_id")), F.lit(fold)) != held
    lab = labels.where(kept & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    counts = {int(r[0] == 1): r[1] for r in lab.groupBy("_toxic").count().collect()}

    def run(batches):
        r = Restorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(r.words(t.as_py())) for t in batch.column(0)], pa.list_(pa.binary()))], ["words"])

    def drawn(value: int, most: int) -> list[tuple[bytes, ...]]:
        which = lab.where("_toxic = 1" if value else "_toxic <> 1")
        share = most / max(counts.get(value, 0), 1)
        if share < 1:
            which = which.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
        text = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(which.select("doc_id"), "doc_id", "left_semi")
        words = text.select("text").mapInArrow(run, "words array<binary>")
        return [tuple(known.setdefault(w, w) for w in map(bytes, row[0])) for row in words.toLocalIterator()]

    known: dict[bytes, bytes] = {}
    toxic, clean = (_fresh(sorted(drawn(v, m))) for v, m in ((1, TOXIC_SAMPLE), (0, CLEAN_SAMPLE)))
    if not toxic or not clean:
        base = np.zeros(9)
        base[0] = -5.0 if clean or not toxic else 5.0
        return model, {}, base
    rows, y = [], []
    for half in (0, 1):
        lexicon = learn_lexicon(toxic[1 - half :: 2] or toxic, clean[1 - half :: 2] or clean)
        for value, texts in ((1, toxic[half::2]), (0, clean[half::2])):
            rows += [toxic_features(t, lexicon) for t in texts]
            y += [value] * len(texts)
    y = np.array(y, float)
    share = min(max(counts.get(1, 0) / max(sum(counts.values()), 1), 0.01), 0.99)
    weight = np.where(y == 1, share * len(y) / max(y.sum(), 1), (1 - share) * len(y) / max((1 - y).sum(), 1))
    return model, learn_lexicon(toxic, clean), fit_logistic(np.array(rows), y, weight)


def with_toxicity(docs: DataFrame, trained, name: str = "score") -> DataFrame:
    """docs with a column of scores from 0 to 1, in one narrow pass over whole texts.
    Null and empty texts have no words and get the score of a text in which nothing is found."""
    docs = text_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(trained)
    at = docs.columns.index("text")

    def run(batches):
        model, lexicon, weights = sent.value
        r, known = Restorer(model), {}
        for batch in batches:
            x = np.array([toxic_features(r.words(None if (s := t.as_py()) is None else s.encode()), lexicon, known) for t in batch.column(at)]).reshape(-1, len(weights))
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, name])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{name}` double")


def score_toxicity(docs: DataFrame, labels: DataFrame, fold: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    scored = with_toxicity(docs.select("doc_id", "text"), train_toxicity(docs, labels, fold, held))
    return scored.select("doc_id", (F.pmod(fold_of(F.col("doc_id")), F.lit(fold)) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, bar: float = 0.5) -> DataFrame:
    """docs whose score is under the bar, with their own columns, whatever their names. Null and
    empty texts score like a text in which nothing is found, and stay unless that is toxic;
    repeated rows score alike; an empty table gives none."""
    name = "_toxicity"
    while name in docs.columns:
        name = "_" + name
    scored = with_toxicity(docs, train_toxicity(docs, labels), name)
    return scored.where(F.col(name) < bar).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
