"""Mixing sources to target weights.

Sizes are tokens of a public tokenizer. Each source first gives as many complete epochs as its share allows (at most its cap
of repeats); what is left of its share comes from a weighted sample without replacement (Efraimidis and Spirakis): every
document has the key u ** (1 / weight), documents are taken by falling key, and their running token count must stay within
what is left. Keys are ordered within narrow ranges (see ``strata``), so no source is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import strata
from ..session import materialise

#: A file of byte-pair ranks, present on every executor.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How the tokenizer splits text into pieces (public pattern of byte-level BPE vocabularies).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoder(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text")).to_pylist()
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in texts]
            chars = [len(t) if t else 0 for t in texts]
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(chars, pa.int64()), pa.array(n, pa.int64())], [*(batch.schema.names[i] for i in keep), "chars", "tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, chars, tokens): source trimmed and lower-cased; NULL texts have 0 tokens. Whole texts are counted."""
    src = docs.select(F.col("doc_id").cast("bigint"), F.lower(F.trim("source")).alias("source"), "text")
    return src.mapInArrow(_count(tokenizer), "doc_id bigint, source string, chars bigint, tokens bigint")


LIGHTEST = 0.1  # smallest weight of a document


def quality(chars: Column, tokens: Column) -> Column:
    """Weight in [LIGHTEST, 1]: running text has more characters per token than tables and markup; very short texts count less."""
    return F.greatest(F.lit(LIGHTEST), F.least(F.lit(1.0), chars / (tokens * 4.0)) * F.least(F.lit(1.0), tokens / 100.0))


def mix(docs: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(drawn, report).

    drawn: (mix_id, source, doc_id, tokens, repeats), repeats >= 1 copies of each document. report: one row per mix and
    source with target_share, max_repeats, total_tokens (of the mix), source_tokens, wanted_tokens, drawn_tokens,
    actual_share (of all drawn tokens of the mix) and reachable (source_tokens * max_repeats >= wanted_tokens).

    docs: (doc_id, source, text); targets: (mix_id, source, target_share, max_repeats, budget_share), a short list. The total
    of a mix is budget_share times the tokens of all docs. Texts that are NULL or empty have no tokens and are never drawn; a
    source without documents has 0 tokens. With empty docs all counts are 0.
    """
    tok = materialise(token_counts(docs, tokenizer))
    all_tokens = int(tok.agg(F.sum("tokens").alias("n")).first()["n"] or 0)
    want = targets.select("mix_id", F.lower(F.trim("source")).alias("source"), "target_share", "max_repeats", "budget_share")
    per = tok.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    t, g = F.col("source_tokens"), F.col("wanted_tokens")
    plan = (
        want.join(per, "source", "left").fillna(0, ["source_tokens"])
        .withColumn("total_tokens", F.col("budget_share") * F.lit(all_tokens))
        .withColumn("wanted_tokens", F.col("target_share") * F.col("total_tokens"))
        .withColumn("epochs", F.when(t > 0, F.least(F.col("max_repeats"), F.floor(g / t).cast("int"))).otherwise(0))
        .withColumn("budget", F.when(F.col("epochs") < F.col("max_repeats"), g - F.col("epochs") * t).otherwise(0.0))
    )
    plan = materialise(plan)  # one row per mix and source
    rows = tok.where("tokens > 0").join(F.broadcast(plan.select("mix_id", "source", "epochs", "budget")), "source")
    # u ** (LIGHTEST / w) orders as u ** (1 / w) does, but spreads the keys of light documents over all ranges
    key = F.pow(strata.uniform("mix_id", "doc_id", seed=seed), LIGHTEST / quality(F.col("chars"), F.col("tokens")))
    part = strata.take(rows.where("budget > 0").select("mix_id", "source", "doc_id", "tokens", (1 - key).alias("u")), plan.where("budget > 0"), ["mix_id", "source"], "u", "tokens", "doc_id")
    whole = rows.where("epochs > 0").select("mix_id", "source", "doc_id", "tokens", F.col("epochs").alias("repeats"))
    drawn = whole.unionByName(part.select("mix_id", "source", "doc_id", "tokens", F.lit(1).alias("repeats"))).groupBy("mix_id", "source", "doc_id", "tokens").agg(F.sum("repeats").alias("repeats"))
    got = drawn.groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("drawn_tokens"))
    both = plan.join(got, ["mix_id", "source"], "left").fillna(0, ["drawn_tokens"])
    sums = both.groupBy("mix_id").agg(F.sum("drawn_tokens").alias("mix_tokens"))
    report = both.join(sums, "mix_id").select(
        "mix_id", "source", "target_share", "max_repeats", "total_tokens", "source_tokens", "wanted_tokens", "drawn_tokens",
        F.when(F.col("mix_tokens") > 0, F.col("drawn_tokens") / F.col("mix_tokens")).otherwise(0.0).alias("actual_share"),
        (t * F.col("max_repeats") >= g).alias("reachable"),
    )
    return drawn, report
