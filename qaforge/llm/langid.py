"""Missing or wrong document language labels.

A multinomial logistic regression on hashed TF-IDF character n-grams (two and three letters) tells the language of each
sentence. It is trained sentence by sentence with follow-the-regularised-leader and elastic-net penalties (so most weights
are exactly 0) on a bounded sample of labelled documents, and its temperature is calibrated on held-out ones. Labels of the
sample may be wrong: sentences whose label the model rejects after a round over the sample are left out of the next ones.

Sentences are then labelled in every document; neighbouring sentences of one language form a segment, and a document's
language is that of most of its text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bags
from .bags import chunks as _chunks
from .leakage import plain

LANGUAGES = ("en", "zh", "de", "fr", "es", "pt")
#: Codes that name a language; ISO 639-1, 639-2/T and 639-2/B.
CODES = {"en": "en", "eng": "en", "zh": "zh", "zho": "zh", "chi": "zh", "cmn": "zh", "de": "de", "deu": "de", "ger": "de", "fr": "fr", "fra": "fr", "fre": "fr", "es": "es", "spa": "es", "pt": "pt", "por": "pt"}
SAMPLE_DOCS = 1500  # labelled documents to train on, about
DIM = 1 << 16
MIN_LETTERS = 12  # a shorter sentence has no language of its own
SURE = 0.6
LEAST = 3  # sentences from which a language counts as one of the document
REJECTED = (0.15, 0.35, 0.5)  # a label that the model gives less than this after 1, 2, more rounds is taken for wrong

_LINE = re.compile(r"[\r\n]+")
_BREAK = re.compile(r"</?(?:p|br|hr|div|li|ul|ol|dl|dt|dd|tr|table|thead|tbody|caption|h[1-6]|section|article|blockquote|pre)\b[^<>]{0,60}>", re.I)
_CELL = re.compile(r"<t[dh]\b[^<>]{0,60}>", re.I)
_SENTENCE = re.compile(r"(?<=[。！？｡])|(?<=[.!?…])[\"”’»)\]]*\s+(?=[^\Wa-zß-öø-ÿ_]|[\"“„«¿¡'(])|(?<=[!?])(?=[一-鿿])")


def named_language(lang: Column) -> Column:
    """Two-letter code that a label names, or NULL; labels are codes of two or three letters in any case, with or without a
    region."""
    code = F.element_at(F.split(F.lower(F.trim(lang)), "[-_]"), 1)
    out = F.lit(None).cast("string")
    for k, v in CODES.items():
        out = F.when(code == k, v).otherwise(out)
    return out


_FINISHED = re.compile(r"[.!?…。！？｡][\"”’»)\]]*$")
_LABEL = re.compile(r"(?<=[.!?…])[\"”’»)\]]*\s+")
_WORD = re.compile(r"[㐀-䶿一-鿿]|[^\W\d_㐀-䶿一-鿿]+")
RUNNING = (5, 10)  # words, or CJK characters, of a finished sentence that is no entry of a table


def _split(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text.strip()) if s and s.strip()]


def _runs(sentence: str) -> bool:
    if not _FINISHED.search(sentence.rstrip()):
        return False
    ws = _WORD.findall(sentence)
    cjk = sum(len(w) == 1 and w >= "㐀" for w in ws)
    return cjk >= RUNNING[1] or len(ws) - cjk >= RUNNING[0]


def _beside_table(line: str) -> list[str]:
    """Sentences of running text that stand in one line with a row of a table: before it, after it or, if there are at
    least two, between rows. What is left of a cell before the next one is the label of the row."""
    out, cells = [], line.split("|")
    for k, cell in enumerate(cells):
        if not _FINISHED.search(cell.rstrip()) and len(cell) < 24:
            continue
        parts = _split(cell)
        if k < len(cells) - 1 and parts and not _FINISHED.search(parts[-1].rstrip()):
            ends = [m.start() for m in _LABEL.finditer(parts[-1])]
            parts[-1:] = [parts[-1][: ends[-1]]] if ends else []
        if sum(map(_runs, parts)) >= (1 if k in (0, len(cells) - 1) else 2):
            out.extend(parts)
    return out


def sentences(text: str | None) -> list[str]:
    """Sentences of running text; tables, tags and blank lines give none."""
    out = []
    if text and "<" in text:
        text = _BREAK.sub("\n", _CELL.sub(" | ", text))
    for line in _LINE.split(plain(text)):
        out.extend(_beside_table(line) if "|" in line else _split(line))
    return out


def _table() -> np.ndarray:
    """Class of every code point: 0 for what is no letter, 1 for CJK, else a number per (lower-case) letter."""
    t = np.zeros(0x3000, dtype=np.uint32)
    for c in range(0x3000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            t[c] = ord(low) if len(low) == 1 else c
    return t


_LETTERS = _table()


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter classes of all texts in one run, each text between two zeros, and the length of each text's run."""
    joined = "\n" + "\n\n".join(texts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
    small = cp < 0x3000
    out = np.where(small, _LETTERS[np.where(small, cp, 0)], 0)
    cjk = ((cp >= 0x3400) & (cp <= 0x9FFF)) | ((cp >= 0xF900) & (cp <= 0xFAFF))
    out = np.where(cjk, np.uint32(1), out)
    return out.astype(np.uint32), np.array([len(t) + 2 for t in texts], dtype=np.int64)


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, owner, letters per text) of all n-grams of two and three characters; spaces stand for all that is no
    letter, n-grams of spaces alone are left out."""
    c, n = letters(texts)
    owner = np.repeat(np.arange(len(n)), n)
    a = c.astype(np.uint64)
    with np.errstate(over="ignore"):
        h2 = (a[:-1] * bags.U(0x9E3779B97F4A7C15) + a[1:]) * bags.U(0xBF58476D1CE4E5B9)
        h3 = (h2[:-1] + a[2:]) * bags.U(0x94D049BB133111EB)
    ok2 = (owner[:-1] == owner[1:]) & ((c[:-1] > 0) | (c[1:] > 0))
    ok3 = (owner[:-2] == owner[2:]) & (c[1:-1] > 0)
    b = np.concatenate([(h2[ok2] >> bags.U(48)).astype(np.int32), (h3[ok3] >> bags.U(48)).astype(np.int32)])
    o = np.concatenate([owner[:-1][ok2], owner[:-2][ok3]])
    weight = np.where(c == 1, 3, (c > 0).astype(np.int64))  # a CJK character says as much as three letters
    return b, o, np.bincount(owner, weights=weight, minlength=len(n)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray  # (DIM, languages), idf included
    bias: np.ndarray
    temperature: float

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        b, o, size = ngrams(texts)
        out = np.zeros((len(texts), len(LANGUAGES)))
        for k in range(len(LANGUAGES)):
            out[:, k] = np.bincount(o, weights=self.weights[b, k], minlength=len(texts))
        n = np.bincount(o, minlength=len(texts))
        return out / np.sqrt(np.maximum(n, 1))[:, None] + self.bias, size

    def probabilities(self, texts: list[str], characters: int = 400_000) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each language per text, and the letters of each text; so many characters at a time."""
        parts = [self.logits(texts[a:z]) for a, z in _chunks([texts], characters)]
        if not parts:
            return np.zeros((0, len(LANGUAGES))), np.zeros(0, dtype=np.int64)
        return softmax(np.concatenate([p for p, _ in parts]) / self.temperature), np.concatenate([n for _, n in parts])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[int], alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.05, epochs: int = 5, batch: int = 128, seed: int = 1) -> Model:
    """Follow-the-regularised-leader with per-coordinate rates; a tenth of the sentences is held out for the temperature."""
    y = np.array(labels)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    held, order = order[: len(order) // 10], order[len(order) // 10 :]
    b, o, _ = ngrams(texts)
    srt = np.argsort(o, kind="stable")
    b, o = b[srt], o[srt]
    ptr = np.searchsorted(o, np.arange(len(texts) + 1))
    # document frequency of each bucket among the training sentences
    df = np.bincount(np.unique(o.astype(np.int64) * DIM + b) % DIM, minlength=DIM)
    idf = np.log((1 + len(texts)) / (1 + df)).clip(0) + 0.1
    k = len(LANGUAGES)
    z, n2, w = np.zeros((DIM, k)), np.zeros((DIM, k)), np.zeros((DIM, k))
    zb, nb, wb = np.zeros(k), np.zeros(k), np.zeros(k)
    for epoch in range(epochs):
        if epoch:
            p = softmax(Model(w * idf[:, None], wb, 1.0).logits([texts[i] for i in order])[0])
            order = order[p[np.arange(len(order)), y[order]] > REJECTED[min(epoch, len(REJECTED)) - 1]]
        rng.shuffle(order)
        for a in range(0, len(order), batch):
            rows = order[a : a + batch]
            idx = np.concatenate([b[ptr[i] : ptr[i + 1]] for i in rows])
            own = np.repeat(np.arange(len(rows)), ptr[rows + 1] - ptr[rows])
            cnt = np.maximum(np.bincount(own, minlength=len(rows)), 1)
            x = idf[idx] / np.sqrt(cnt)[own]
            u, inv = np.unique(idx, return_inverse=True)
            logit = np.stack([np.bincount(own, weights=x * w[idx, j], minlength=len(rows)) for j in range(k)], 1) + wb
            g = softmax(logit)
            g[np.arange(len(rows)), y[rows]] -= 1
            g /= len(rows)
            gw = np.stack([np.bincount(inv, weights=x * g[own, j], minlength=len(u)) for j in range(k)], 1) * 8
            s = (np.sqrt(n2[u] + gw * gw) - np.sqrt(n2[u])) / alpha
            z[u] += gw - s * w[u]
            n2[u] += gw * gw
            zu = z[u]
            w[u] = np.where(np.abs(zu) <= l1, 0.0, -(zu - np.sign(zu) * l1) / ((beta + np.sqrt(n2[u])) / alpha + l2))
            gb = g.sum(axis=0)
            sb = (np.sqrt(nb + gb * gb) - np.sqrt(nb)) / alpha
            zb += gb - sb * wb
            nb += gb * gb
            wb = -zb / ((beta + np.sqrt(nb)) / alpha + l2)
    model = Model((w * idf[:, None]).astype(np.float32), wb, 1.0)
    if len(held):
        lg, t = model.logits([texts[i] for i in held])[0], y[held]
        share = np.bincount(t, minlength=k) / len(t)
        wrong = float((lg.argmax(axis=1) != t).mean())  # a wrong label is no evidence of doubt: labels are taken for a mixture
        grid = np.exp(np.linspace(math.log(0.3), math.log(20), 61))
        loss = [-np.log((1 - wrong) * softmax(lg / c)[np.arange(len(t)), t] + wrong * share[t] + 1e-12).mean() for c in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 42) -> Model:
    """Model trained on about sample_docs labelled documents, chosen evenly by a hash of their key (evening out the languages
    would blow up the share of wrong labels among those of rare ones). Documents without a known label or without text are
    not used. With no labelled document the model knows nothing (all languages equally likely)."""
    lab = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), named_language(F.col("lang")).alias("label"), "text").where("label is not null and text is not null")
    n = lab.count()
    u = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000)) / F.lit(1e6)
    rows = lab.where(u < min(1.0, sample_docs / max(n, 1))).orderBy("doc_id").limit(2 * sample_docs).collect()
    texts, labels = [], []
    for r in rows:
        for s in sentences(r["text"]):
            if len(s) >= 8:
                texts.append(s)
                labels.append(LANGUAGES.index(r["label"]))
    if not texts:
        return Model(np.zeros((DIM, len(LANGUAGES)), np.float32), np.zeros(len(LANGUAGES)), 1.0)
    return train(texts, labels)


_SEG = "doc_id bigint, segment int, lang_found string, confidence double, sentences int, characters int"


def _label(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for a, z in _chunks([texts], 400_000):
                flat, owner = [], []
                for i in range(a, z):
                    ss = sentences(texts[i])
                    flat.extend(ss)
                    owner.extend([i] * len(ss))
                if not flat:
                    continue
                p, size = model.probabilities(flat)
                best = p.argmax(axis=1)
                conf = p[np.arange(len(flat)), best]
                out: list[list] = []
                for s, i, lang, c, n in zip(flat, owner, best.tolist(), conf.tolist(), size.tolist()):
                    sure = n >= MIN_LETTERS and c >= SURE
                    if out and out[-1][0] == ids[i] and (not sure or out[-1][2] == lang or out[-1][2] is None):
                        seg = out[-1]
                        if sure:
                            seg[2] = lang
                            seg[3] += c * len(s)
                            seg[4] += 1
                            seg[6] += len(s)
                        seg[5] += len(s)
                    else:
                        k = out[-1][1] + 1 if out and out[-1][0] == ids[i] else 0
                        out.append([ids[i], k, lang if sure else None, c * len(s) if sure else 0.0, int(sure), len(s), len(s) if sure else 0])
                out = [o for o in out if o[2] is not None]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()), pa.array([LANGUAGES[o[2]] for o in out], pa.string()),
                        pa.array([o[3] / max(o[6], 1) for o in out], pa.float64()), pa.array([o[4] for o in out], pa.int32()), pa.array([o[5] for o in out], pa.int32()),
                    ],
                    ["doc_id", "segment", "lang_found", "confidence", "sentences", "characters"],
                )

    return run


def segments(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, segment, lang_found, confidence, sentences, characters): runs of neighbouring sentences of one language, in
    order; sentences too short or unsure to tell belong to the segment they stand in and are not counted.

    docs: (doc_id, text, lang). NULL and blank texts, tables and figures have no segment. An empty docs gives no rows.
    """
    model = model or fit(docs)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_label(model), _SEG)


def labels(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, language, confidence, languages), one row per row of docs with running text: the language of most of its
    text, how sure that is, and all languages of at least three sentences."""
    s = segments(docs, model).groupBy("doc_id", "lang_found").agg(F.sum("characters").alias("n"), F.sum(F.col("confidence") * F.col("characters")).alias("c"), F.sum("sentences").alias("k"))
    return s.groupBy("doc_id").agg(
        F.max_by("lang_found", F.struct("n", "lang_found")).alias("language"),
        (F.max("c") / F.sum("n")).alias("confidence"),
        F.array_sort(F.collect_set(F.when(F.col("k") >= 3, F.col("lang_found")))).alias("languages"),
    )


def _count(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, named, texts = (c.to_pylist() for c in batch.columns)
            for a, z in _chunks([texts], 400_000):
                flat, owner = [], []
                for i in range(a, z):
                    ss = sentences(texts[i])
                    flat.extend(ss)
                    owner.extend([i - a] * len(ss))
                if not flat:
                    continue
                p, size = model.probabilities(flat)
                best = p.argmax(axis=1)
                sure = (size >= MIN_LETTERS) & (p[np.arange(len(flat)), best] >= SURE)
                n = np.bincount(np.array(owner)[sure] * len(LANGUAGES) + best[sure], minlength=(z - a) * len(LANGUAGES)).reshape(-1, len(LANGUAGES))
                doc, lang = np.nonzero(n >= LEAST)
                got = [(ids[a + d], LANGUAGES[k]) for d, k in zip(doc.tolist(), lang.tolist()) if named[a + d] != LANGUAGES[k]]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in got], pa.int64()), pa.array([k for _, k in got], pa.string())], ["doc_id", "lang_found"])

    return run


def unnamed_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, lang_found): languages of at least LEAST sentences that the document's label does not name. All of a document
    stands in one row, so nothing is shuffled; rows that repeat a doc_id count each for itself."""
    model = model or fit(docs)
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), named_language(F.col("lang")).alias("named"), "text")
    return src.mapInArrow(_count(model), "doc_id bigint, lang_found string")
