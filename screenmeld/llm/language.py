"""Language identification by a linear-chain conditional random field over words.

Emission features of a word are its byte 2- and 3-grams with boundary marks, prefixes and suffixes of two to four bytes,
and the word itself (lexicon), hashed into ``SLOTS`` weights per language. Learned transitions tie neighbouring words, and
forward-backward gives each word its marginal probabilities, so code-switched text is labelled word by word. A document
gets the language with the largest mean marginal over its words that hold a letter; that mean is the score.

Training reads text and lang of at most ``SAMPLE_DOCS`` documents (lowest hash of doc_id first), ``SAMPLE_WORDS`` words in a
row of each; predictions read the whole text and nothing else. Chains are computed in blocks: products of
transition matrices inside all blocks at once, then one pass over the blocks, so a long text costs time in proportion.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0; a NULL doc_id is neither held out nor learned
from; without any training row everything is ``und``; rows are judged one by one, so ties and repeated rows need no
rule; an empty table gives no rows; extra columns pass through ``identified`` and are ignored otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmeld.llm.text import SPACE, SPACES, lowest_hashes, map_values

SLOTS = 1 << 17
SAMPLE_DOCS, SAMPLE_WORDS = 2000, 150
EPOCHS, DOCS_PER_STEP, RATE, RIDGE = 3, 100, 0.5, 1e-5
BATCH_WORDS = 200_000
UNKNOWN = "und"
LETTER = re.compile(rb"[A-Za-z]")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _slot(code: np.ndarray, kind: int) -> np.ndarray:
    code = (code + np.uint64(kind + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) % SLOTS


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of word number and weight slot for a list of distinct words."""
    buffer = np.frombuffer(b"".join([b"\x02" + w + b"\x03" for w in words]), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    starts, owner, all_ = ends - sizes, np.repeat(np.arange(len(words)), sizes), np.arange(len(words))
    position = np.arange(len(buffer))
    who, slots = [all_], [_slot(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), 0)]
    for n in (2, 3):
        at = position[:max(0, len(buffer) - n + 1)]
        at = at[at + n <= ends[owner[at]]]
        code = np.zeros(len(at), np.uint64)
        for k in range(n):
            code = code << np.uint64(8) | buffer[at + k]
        who.append(owner[at])
        slots.append(_slot(code, n))
    for n in (2, 3, 4):
        long = all_[sizes >= n + 2]
        for kind, base in ((10, starts[long] + 1), (20, ends[long] - 1 - n)):
            code = np.zeros(len(long), np.uint64)
            for k in range(n):
                code = code << np.uint64(8) | buffer[base + k]
            who.append(long)
            slots.append(_slot(code, kind + n))
    return np.concatenate(who), np.concatenate(slots)


def emissions(who: np.ndarray, slots: np.ndarray, words: int, weights: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(who, weights[k][slots], words) for k in range(len(weights))], axis=1)


def marginals(scores: np.ndarray, first: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Word marginals of chains laid end to end; ``first`` marks the first word of each chain.

    With ``pairs`` also the expected transitions inside chains.
    """
    n, k = scores.shape
    width = max(1, int(n ** 0.5))
    blocks = -(-n // width)
    emit = np.ones((blocks * width, k))
    emit[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    start = np.zeros(blocks * width, bool)
    start[:n], start[n:] = first, True
    emit, start = emit.reshape(blocks, width, k), start.reshape(blocks, width)
    step = np.exp(trans)
    flat = np.full((k, k), 1.0 / k)
    inner = np.broadcast_to(np.eye(k), (blocks, k, k))
    for t in range(width):
        moved = inner @ step
        if start[:, t].any():
            moved[start[:, t]] = inner[start[:, t]] @ flat
        inner = moved * emit[:, t, None, :]
        inner = inner / inner.max(axis=(1, 2), keepdims=True)
    ahead, behind = np.empty((blocks, k)), np.empty((blocks, k))
    v = np.full(k, 1.0 / k)
    for b in range(blocks):
        ahead[b] = v
        v = v @ inner[b]
        v = v / v.sum()
    v = np.ones(k)
    for b in range(blocks - 1, -1, -1):
        behind[b] = v
        v = inner[b] @ v
        v = v / v.sum()
    alpha, beta = np.empty_like(emit), np.empty_like(emit)
    v = ahead
    for t in range(width):
        moved = v @ step
        moved[start[:, t]] = v[start[:, t]] @ flat
        v = moved * emit[:, t]
        v = v / v.sum(axis=1, keepdims=True)
        alpha[:, t] = v
    v = behind
    for t in range(width - 1, -1, -1):
        beta[:, t] = v
        w = v * emit[:, t]
        moved = w @ step.T
        moved[start[:, t]] = w[start[:, t]] @ flat.T
        v = moved / moved.sum(axis=1, keepdims=True)
    alpha, beta, emit = (x.reshape(-1, k)[:n] for x in (alpha, beta, emit))
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    if not pairs:
        return gamma, None
    inside = ~first[1:]
    both = alpha[:-1][inside][:, :, None] * step * (emit[1:] * beta[1:])[inside][:, None, :]
    return gamma, (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


class Model:
    def __init__(self, labels: list[str], weights: np.ndarray, trans: np.ndarray) -> None:
        self.labels, self.weights, self.trans = labels, weights, trans

    def word_marginals(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all words of some texts, one after another, and which words hold a letter."""
        seen: dict[bytes, int] = {}
        ids = np.array([seen.setdefault(w, len(seen)) for words in texts for w in words], np.int64)
        kinds = [w.lower() for w in seen]
        letters = np.fromiter((bool(LETTER.search(w)) or any(c.isalpha() for c in w.decode("utf-8", "ignore"))
                               for w in kinds), bool, len(kinds))
        first = np.zeros(len(ids), bool)
        first[np.cumsum([0, *map(len, texts)])[:-1][[len(t) > 0 for t in texts]]] = True
        scores = emissions(*word_features(kinds), len(kinds), self.weights)[ids]
        return marginals(scores, first, self.trans)[0], letters[ids]

    def documents(self, texts: list[list[bytes]]) -> list[tuple[str, float, int, int]]:
        """Language, score, words and language switches of each text."""
        if not self.labels or not any(texts):
            return [(UNKNOWN, 0.0, len(t), 0) for t in texts]
        gamma, letters = self.word_marginals(texts)
        best = gamma.argmax(axis=1)
        out, at = [], 0
        for words in texts:
            end = at + len(words)
            use = letters[at:end]
            if not use.any():
                out.append((UNKNOWN, 0.0, len(words), 0))
            else:
                mean = gamma[at:end][use].mean(axis=0)
                switches = int((np.diff(best[at:end][use]) != 0).sum())
                out.append((self.labels[int(mean.argmax())], float(min(1.0, mean.max())), len(words), switches))
            at = end
        return out


def train(docs: DataFrame, sample: int = SAMPLE_DOCS, words: int = SAMPLE_WORDS, seed: int = 42) -> Model:
    """Fit on rows that are not held out and have a lang; at most ``sample`` rows are collected."""
    usable = docs.select("doc_id", "lang", "text").filter(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    trimmed = F.btrim("text", F.lit(SPACE))
    parts = lowest_hashes(usable, "doc_id", seed, sample).filter(F.length(trimmed) > 0).select(
        "lang", "at", F.split(trimmed, SPACES).alias("parts"))
    begin = (1 + F.pmod("at", F.greatest(F.size("parts") - words + 1, F.lit(1)))).cast("int")
    cut = parts.select("at", "lang", F.slice("parts", begin, words).alias("words")).limit(2 * sample).collect()
    cut = sorted(cut, key=lambda r: (r["at"], r["lang"], r["words"]))[:sample]
    labels = sorted({r["lang"] for r in cut})
    texts = [[w.encode().lower() for w in r["words"]] for r in cut]
    gold = [labels.index(r["lang"]) for r in cut]
    k = len(labels)
    weights, trans = np.zeros((k, SLOTS)), np.zeros((k, k))
    power, power_t = np.full((k, SLOTS), 1e-3), np.full((k, k), 1e-3)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), DOCS_PER_STEP):
            chosen = order[a:a + DOCS_PER_STEP]
            # texts follow each other in one chain, so switches between languages are seen as well
            seen: dict[bytes, int] = {}
            ids = np.array([seen.setdefault(w, len(seen)) for d in chosen for w in texts[d]], np.int64)
            truth = np.repeat([gold[d] for d in chosen], [len(texts[d]) for d in chosen])
            who, slots = word_features(list(seen))
            first = np.zeros(len(ids), bool)
            first[0] = True
            gamma, expected = marginals(emissions(who, slots, len(seen), weights)[ids], first, trans, pairs=True)
            for label in range(k):
                gap = np.bincount(ids, (truth == label) - gamma[:, label], len(seen))
                slope = np.bincount(slots, gap[who], SLOTS) / len(ids) - RIDGE * weights[label]
                power[label] += slope * slope
                weights[label] += RATE * 0.1 * slope / np.sqrt(power[label])
            real = np.zeros((k, k))
            np.add.at(real, (truth[:-1], truth[1:]), 1.0)
            slope = (real - expected) / len(ids) - 1e-4 * trans
            power_t += slope * slope
            trans += RATE * slope / np.sqrt(power_t)
    return Model(labels, weights.astype(np.float32), trans)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``lang_pred, score, n_words, n_switches`` of every row."""
    # of fixed size: labels x SLOTS weights
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, model.weights, model.trans))

    def batched(raws: list[bytes | None]) -> Iterator[list[list[bytes]]]:
        texts, size = [], 0
        for raw in raws:
            texts.append((raw or b"").split())
            size += len(texts[-1])
            if size >= BATCH_WORDS:
                yield texts
                texts, size = [], 0
        yield texts

    def prepare():
        own = Model(*shared.value)
        return lambda raws: [row for part in batched(raws) for row in own.documents(part)]

    return map_values(docs.select(*keep, "text"), "text", prepare,
                      "lang_pred string, score double, n_words long, n_switches long", keep_column=True)


def language_id(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` and counts for every row, by a model trained on ``docs``."""
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return predict(rows, train(docs, **settings), ["doc_id", "held_out"]).drop("text")


def identified(docs: DataFrame, least: float = 0.5, **settings) -> DataFrame:
    """The rows of ``docs`` with a language of at least ``least`` score; columns as they are."""
    model = train(docs, **settings)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("_doc"), "text")
    kept = predict(rows, model, ["_doc"]).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.select(*["text" if c == "text" else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
