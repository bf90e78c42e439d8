"""Text cut off by field limits or in transfer.

Every value gets an *ending class* from its last characters (``ending``). Per source and field the lengths of whole prose
are a log-normal distribution, of which cut values show only a lower bound: they are right-censored. ``fit_lengths`` fits
it by maximum likelihood over a histogram of lengths and ending classes, by an EM whose hidden variable is whether a value was
cut: the M-step fits the censored lengths, the hazard of being cut at each candidate limit (lengths at which values without a
closed ending pile up), the rate of values that lost their end at any length, and how often cut and whole values show each
ending; the E-step gives the posterior of each length and ending, from hazard times survival against the density of whole
values of that length, and from the ratio of the two ending rates. The posterior decides open ends, abbreviations and list-like
lines. Fixed beforehand is only what is proof by itself: a mark left by a cut inside a sentence; on the other side a closed
sentence, and labels and figures, which have no end to lose.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bags
from ..session import materialise

FIELDS = ("model_reasoning", "model_answer")
EMPTY, MARK, OPEN, DOUBT, CLOSED, WHOLE, LINE = range(7)
#: Pseudo-counts of the ending classes among cut and among whole values. A class without one is never cut inside a sentence; a mark is proof of a cut.
CUT_ENDINGS = {MARK: 1.0, OPEN: 1.0, DOUBT: 0.05, LINE: 0.05}
WHOLE_ENDINGS = {MARK: 0.001, OPEN: 0.005, DOUBT: 0.1, LINE: 1.0}
MOST_LOST = 0.2  # share of a source's values that the fit starts with as having lost their end at any length

_MARK = re.compile(
    r"(?:\s*+(?:\[\s*(?:output |text |response )?(?:truncated|cut|cut off)\b[^\]\n]{0,20}\]?|\(\s*(?:output |text )?(?:truncated|cut off)\s*\)?|"
    r"<\s*truncated\s*/?>?|\[?(?:已截断|内容截断|截断)\]?|�++|…++|\.{3,}+|-{3,}+)\s*+)++$",
    re.I,
)
_FIGURES = re.compile(r"(?:EUR|USD|CNY|RMB|million|billion|percent|[\W\d_万亿元百分点个])++")
_CLOSE = "\"'”’»)]}）】」』*_`"
_STOP = re.compile(r"[.。!！?？;；｡]+$")
_BULLET = re.compile(r"^\s*(?:[-*•·–]\s+|\(?\d{1,2}[.)、]\s*|[A-Ha-h][.)、．]\s*)")
_RESULT = re.compile(r"^\s*(?:conclusion|answer|final answer|result|结论|答案|最终答案|答)\s*[:：]\s*\S", re.I)
_CHOICE = re.compile(r"(?:选择|选|答案为|答案是|choose|select)\s*(?:选择|选项|option)?\s*[（(]?[A-Ha-h][）)]?\.?$")
_ABBREVIATION = re.compile(r"(?:^|\s)(?:approx|incl|excl|e\.g|i\.e|vs|No|Nos|Mr|Mrs|Dr|St|Fig|Sec|Art)\.$")
_LEAD = re.compile(r"^\s*(?:question|问题|answer|答案|答)\s*[:：]\s*", re.I)
_TAIL = re.compile(r"\s*(?:answer|答案|答)\s*[:：]\s*$", re.I)
_CJK = re.compile(f"[{bags.CJK}]")


def copied(text: str, question: str | None, least: float = 0.8) -> bool:
    """Whether text is the question itself, but for a lead-in or tail and small changes."""
    if not question:
        return False
    a = bags.words(_TAIL.sub("", _LEAD.sub("", text)))
    q = bags.words(question)
    return bool(a) and bags.likeness(a, q) >= least


def _unbalanced_json(t: str) -> bool:
    if t[0] not in "{[":
        return False
    try:
        json.loads(t)
        return False
    except ValueError:
        return t.count("{") > t.count("}") or t.count("[") > t.count("]") or t.count('"') % 2 == 1


def ending(text: str | None, question: str | None = None) -> int:
    """Ending class of a text: EMPTY, MARK (a mark left by a cut, inside a sentence), OPEN (stops inside a sentence), DOUBT (an
    abbreviation that may or may not end the sentence), CLOSED (ends with a sentence), WHOLE (a figure, label, option or copied
    question, which need no stop), LINE (stops in a list item, conclusion line, choice, table row or bracket, which need none
    either but can be cut)."""
    t = (text or "").rstrip(" \t\r\n　​﻿\xa0")
    if not t.strip("​﻿ "):
        return EMPTY
    body = _MARK.sub("", t).rstrip()
    if body != t:
        if not body or not bags.words(body):
            return WHOLE
        return CLOSED if _STOP.search(body.rstrip(_CLOSE)) and t[len(body):].strip()[:1] not in "…." else MARK
    if _unbalanced_json(t.lstrip()):
        return OPEN
    core = t.rstrip(_CLOSE) or t
    if _STOP.search(core):
        return DOUBT if _ABBREVIATION.search(core) else CLOSED
    line = t.rsplit("\n", 1)[-1]
    n = len(bags.words(t))
    if _BULLET.match(line) or _RESULT.match(line) or _CHOICE.search(line) or t[-1] in "}>" or "|" in line and "\n" in t or line.count("|") >= 2:
        return LINE if n > 5 else WHOLE
    if copied(t, question):
        return WHOLE
    prose = re.search(r"[.!?]\s|[。！？]", t)
    if not prose and n <= (24 if _CJK.search(t) else 10):
        return WHOLE
    if _FIGURES.fullmatch(t):
        return WHOLE
    return OPEN


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, src, q, *texts = (c.to_pylist() for c in batch.columns)
        for field, col in zip(FIELDS, texts):
            at = [i for i, t in enumerate(col) if t is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in at], pa.string()), pa.array([src[i] for i in at], pa.string()), pa.array([field] * len(at), pa.string()),
                    pa.array([len(col[i]) for i in at], pa.int32()), pa.array([ending(col[i], q[i]) for i in at], pa.int32()),
                ],
                ["id", "source", "field_name", "length", "ending"],
            )


def endings(df: DataFrame) -> DataFrame:
    """(id, source, field_name, length, ending), one row per row of df and field that is not NULL. Whole texts are read."""
    src = df.where("id is not null").select(F.col("id").cast("string"), F.lower(F.trim("source")).alias("source"), "question", *FIELDS)
    return src.mapInArrow(_endings, "id string, source string, field_name string, length int, ending int")


def censored_lognormal(x: np.ndarray, w: np.ndarray, cx: np.ndarray, cw: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Maximum-likelihood (mu, sigma) of log lengths x (weights w) with right-censored ones cx (weights cw), by EM."""
    total = w.sum() + cw.sum()
    if w.sum() == 0 or total == 0:
        return (math.log(200.0), 1.0) if total == 0 else (float(np.average(cx, weights=cw)), 1.0)
    mu = float(np.average(x, weights=w))
    sd = max(0.05, math.sqrt(float(np.average((x - mu) ** 2, weights=w))))
    if not cw.sum():
        return mu, sd
    erfc = np.vectorize(math.erfc, otypes=[float])
    for _ in range(rounds):
        z = (cx - mu) / sd
        lam = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) / np.maximum(erfc(z / math.sqrt(2)) / 2, 1e-12)
        m1 = mu + sd * lam
        m2 = mu * mu + sd * sd + sd * lam * (cx + mu)
        new = float((w @ x + cw @ m1) / total)
        var = float((w @ (x * x) + cw @ m2) / total - new * new)
        done = abs(new - mu) < 1e-7
        mu, sd = new, max(0.05, math.sqrt(max(var, 1e-6)))
        if done:
            break
    return mu, sd


FIT = "source string, field_name string, at int, ending int, mu double, sigma double, prior double, post double"
_erfc = np.vectorize(math.erfc, otypes=[float])


def _near(length: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Mean number of values of the ten lengths on either side of each."""
    lo, hi = np.searchsorted(length, length - 10), np.searchsorted(length, length + 10, side="right")
    total = np.concatenate([[0.0], np.cumsum(n)])
    return (total[hi] - total[lo] - n) / 20


def _limits(length: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which lengths are candidate limits: those with far more values (n, without closed endings) than their neighbours."""
    near = _near(length, n)
    return n - near >= np.maximum(3.0, 4 * np.sqrt(near + 0.25))


def fit_lengths(hist: pd.DataFrame, limits: bool = True, rounds: int = 12) -> pd.DataFrame:
    """Fit of one source and field. hist: (source, field_name, length, ending, n).

    One row per length and ending that occur: prior, the log odds that a value of that length is cut, before its ending is
    seen, and post, the probability that one of that length and ending is. limits=False leaves the candidate limits out.
    """
    src, field = hist.source.iloc[0], hist.field_name.iloc[0]
    length, ending, n = (hist[c].to_numpy() for c in ("length", "ending", "n"))
    at, k = np.unique(length, return_inverse=True)
    x, wide = np.log(np.maximum(at, 1).astype(float)), np.maximum(at, 1).astype(float)
    n = n.astype(float)
    n_all = max(float(n[ending != EMPTY].sum()), 1.0)
    may, prose = np.isin(ending, list(CUT_ENDINGS)), np.isin(ending, [CLOSED, DOUBT, OPEN, MARK])
    limit = _limits(at, np.bincount(k, n * may, len(at))) & limits
    lines = _near(at, np.bincount(k, n * (ending == LINE), len(at)))
    open_ = np.isin(ending, [OPEN, MARK])
    lost = n[open_ & ~limit[k]].sum()
    post = np.where(open_, np.where(limit[k] | (ending == MARK), 1.0, min(1.0, (MOST_LOST * n_all + 5) / max(lost, 1.0))), np.where(may, 0.02, 0.0))
    for _ in range(rounds):
        cut = np.bincount(k, n * post, len(at))
        whole = np.bincount(k, n * (1 - post) * prose, len(at))
        mu, sd = censored_lognormal(x, whole, x, cut)
        z = (x - mu) / sd
        survive, density = np.maximum(_erfc(z / math.sqrt(2)) / 2, 1e-9), np.maximum(np.exp(-z * z / 2) / (wide * sd * math.sqrt(2 * math.pi)), 1e-9)
        hazard = np.where(limit, np.minimum(0.9, cut / np.maximum(n_all * survive, 1.0)), 0.0)  # of the values that would be longer, the share that ends here
        loose = (cut[~limit].sum() + 0.5) / (n_all + 1) / np.maximum(wide, 50)  # lost ends may fall on any length
        prior = np.log((hazard * survive + loose) / (density * (1 - hazard)))
        sums = {c: (float((n * post)[ending == c].sum()), float((n * (1 - post))[ending == c].sum())) for c in CUT_ENDINGS}
        n_cut, n_whole = sum(v for v, _ in sums.values()) + sum(CUT_ENDINGS.values()), n_all - sum(v for v, _ in sums.values()) + sum(WHOLE_ENDINGS.values()) + 1
        odds = np.full(len(n), -np.inf)
        for c, (a, b) in sums.items():
            own = ending == c
            if c == MARK:
                odds[own] = np.inf
                continue
            of_cut = math.log((a + CUT_ENDINGS[c]) / n_cut)
            if c == LINE:  # such lines have lengths of their own, so only more of them at a limit than beside it tell of cuts
                odds[own] = (of_cut + np.log(np.maximum(hazard * survive, 1e-12)) - np.log((lines + 0.5) / n_all))[k[own]]
            else:
                odds[own] = prior[k[own]] + of_cut - math.log((b + WHOLE_ENDINGS[c]) / n_whole)
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        done = np.abs(new - post).max(initial=0) < 1e-6
        post = new
        if done:
            break
    return pd.DataFrame({"source": src, "field_name": field, "at": length.astype(np.int32), "ending": ending.astype(np.int32), "mu": mu, "sigma": sd, "prior": prior[k], "post": np.where(np.isneginf(odds), 0.0, post)})


def score(df: DataFrame) -> DataFrame:
    """(id, source, field_name, length, ending, posterior, cut): one row per record and field that is not NULL.

    df: (id, source, question, model_reasoning, model_answer). Rows with a NULL id are ignored, rows that repeat an id count
    once; a NULL source is a source of its own. Empty texts are never cut. An empty df gives no rows.
    """
    e = materialise(endings(df).withColumn("source", F.coalesce("source", F.lit(""))).dropDuplicates(["id", "field_name"]))
    hist = e.groupBy("source", "field_name", "length", "ending").agg(F.count("*").alias("n"))
    fit = hist.groupBy("source", "field_name").applyInPandas(lambda h: fit_lengths(h), FIT)
    return (
        e.join(fit.select("source", "field_name", F.col("at").alias("length"), "ending", F.col("post").alias("posterior")), ["source", "field_name", "length", "ending"])
        .select("id", "source", "field_name", "length", "ending", "posterior", (F.col("posterior") > 0.5).alias("cut"))
    )


def cut_values(df: DataFrame) -> DataFrame:
    """(id, field_name) of the values that were cut inside a sentence."""
    return score(df).where("cut").select("id", "field_name")


def report(df: DataFrame) -> DataFrame:
    """Per source: records with any output, records with a cut value, and their share."""
    s = score(df).groupBy("source", "id").agg(F.max("cut").alias("cut"))
    return s.groupBy("source").agg(F.count("*").alias("records"), F.count_if("cut").alias("cut_records")).withColumn("cut_share", F.col("cut_records") / F.col("records"))
