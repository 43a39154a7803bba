"""Language-model scores by deleted interpolation.

P(w | v) = weight(bucket of c(v)) * c(v w) / c(v) + (1 - weight) * base(w), where v is the token before w, c counts in the
training texts and base is the add-half unigram estimate. The weights, one for each power of two of c(v), are learned by
expectation-maximisation: one fold of the training texts is held out, the counts come from the others, and the weights
maximise the likelihood of the held-out tokens. Scores then use the counts of all training texts.

Tokens are runs of bytes that are no ASCII white space, A-Z as a-z, then one end for each text. Counts are kept by 64-bit
hash (see ``text``). Texts stay in blocks; distinct tokens and pairs of a block are counted over the corpus by key range and
the counts return to the block, so no task or driver ever holds a vocabulary.

Null texts are empty (the end alone). A null doc_id belongs to the training texts outside the held-out fold. Repeated rows
are scored and counted each. An empty table gives an empty result; without training texts every token is unknown.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm import exchange as ex
from heliovent.llm import storage
from heliovent.llm.text import U64, Words, column, mix, text_bytes

END, BEGIN = U64(0x5DEECE66D), U64(0xB5297A4D3F84D5B5)
BUCKETS = 48  # by power of two of the context's count
STEPS = 16  # bins for each doubling of the ratio of the two estimates
SPAN = 64 * STEPS  # ratios beyond 2 ** +-64 share the last bin
TEST, TUNE = 1, 0  # folds: not learned from; held out for the weights

_SCORE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_HISTOGRAM = pa.schema([("bucket", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())])


def _tokens(table: pa.Table):
    """Token hashes text after text, pair hashes (token before, token), tokens of each text."""
    words = Words(*text_bytes(column(table, "text")))
    n = words.counts() + 1
    last = np.cumsum(n) - 1
    tokens = np.empty(int(n.sum()), U64)
    inner = np.ones(len(tokens), bool)
    inner[last] = False
    tokens[inner] = words.hashes()
    tokens[last] = END
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[last - n + 1] = BEGIN
    return tokens, mix(before * U64(3) + tokens * U64(0xD1342543DE82EF95)), n


def _count_requests(parts: int):
    def make(table: pa.Table) -> pa.Table:
        tokens, pairs, n = _tokens(table)
        fold = np.repeat(column(table, "fold").to_numpy(), n)
        rows, block = [], table["block_id"][0].as_py()
        for kind, keys in ((1, tokens), (2, pairs)):
            keys, which = np.unique(keys, return_inverse=True)
            main = np.bincount(which[(fold != TEST) & (fold != TUNE)], minlength=len(keys))
            tune = np.bincount(which[fold == TUNE], minlength=len(keys))
            rows += ex.requests(block, kind, keys, parts, lambda a, b: ex.pack(ex.pack_counts(main[a:b]), ex.pack_counts(tune[a:b])))  # noqa: B023
        return ex.rows_table(rows, ex.REQUEST_ARROW)

    return make


_COUNTS = pa.schema([*ex.ANSWER_ARROW, *((x, pa.int64()) for x in ("n_main", "v_main", "n_all", "v_all"))])


def _count(table: pa.Table) -> pa.Table:
    part, kind = table["part"][0].as_py(), table["kind"][0].as_py()
    asked = ex.Asked(table)
    main, tune = (asked.total(np.concatenate([ex.unpack_counts(ex.unpack(x)[i]) for x in asked.payloads])) for i in (0, 1))
    rows = asked.answers(part, kind, lambda at: ex.pack(ex.pack_counts(main[at]), ex.pack_counts(tune[at])))
    if kind == 1:
        every = main + tune
        rows.append({"part": part, "kind": 0, "n_main": main.sum(), "v_main": np.count_nonzero(main), "n_all": every.sum(), "v_all": np.count_nonzero(every)})
    return ex.rows_table(rows, _COUNTS)


def _estimates(table: pa.Table, answers: pa.Table, totals: dict, use: str):
    """Of each token: base estimate, bucket of its context (-1: never seen), pair estimate, count."""
    tokens, pairs, n = _tokens(table)

    def counts(kind: int, keys: np.ndarray):
        got = [ex.unpack(x) for x in ex.in_order(answers, kind)]
        main, tune = (np.concatenate([ex.unpack_counts(x[i]) for x in got]) for i in (0, 1))
        which = np.unique(keys, return_inverse=True)[1]
        return which, main if use == "main" else main + tune

    which, count = counts(1, tokens)
    token = count[which]
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[np.cumsum(n) - n] = totals[f"texts_{use}"]
    which, count = counts(2, pairs)
    pair = count[which]
    base = (token + 0.5) / (totals[f"n_{use}"] + 0.5 * (totals[f"v_{use}"] + 1))
    bucket = np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64), BUCKETS - 1), -1)
    return base, bucket, pair / np.maximum(context, 1), token, n


def _tune_histogram(totals: dict):
    def make(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return ex.rows_table([], _HISTOGRAM)
        base, bucket, pair, _, n = _estimates(table, answers, totals, "main")
        fold = np.repeat(column(table, "fold").to_numpy(), n)
        keep = (bucket >= 0) & (fold == TUNE)
        ratio = pair[keep] / base[keep]
        bins = np.where(ratio > 0, np.clip(np.rint(np.log2(np.maximum(ratio, 2.0**-64)) * STEPS) + SPAN + 1, 1, 2 * SPAN + 1), 0).astype(np.int64)
        codes, n = np.unique(bucket[keep] * (2 * SPAN + 2) + bins, return_counts=True)
        return pa.table([pa.array(codes // (2 * SPAN + 2), pa.int32()), pa.array(codes % (2 * SPAN + 2), pa.int32()), pa.array(n, pa.int64())], schema=_HISTOGRAM)

    return make


def learn_weights(histogram: list[tuple[int, int, int]], rounds: int = 500) -> list[float]:
    """Weights by expectation-maximisation; histogram: (bucket, bin of pair / base estimate, held-out tokens).

    A bucket without held-out tokens takes the weight of the next smaller one that has some.
    """
    weights, last = [], 0.0
    for bucket in range(BUCKETS):
        rows = [(b, n) for k, b, n in histogram if k == bucket]
        if rows:
            bins, n = np.array(rows, np.float64).T
            ratio = np.where(bins > 0, 2.0 ** ((bins - SPAN - 1) / STEPS), 0.0)
            weight = 0.5
            for _ in range(rounds):
                was, weight = weight, float(np.sum(n * weight * ratio / (weight * ratio + 1 - weight)) / n.sum())
                weight = min(weight, 1 - 1e-6)
                if abs(weight - was) < 1e-10:
                    break
            last = weight
        weights.append(last)
    return weights


def _scores(totals: dict, weights: list[float]):
    weight = np.array([*weights, 0.0])  # the last is for bucket -1

    def make(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ex.rows_table([], _SCORE)
        base, bucket, pair, token, n = _estimates(table, answers, totals, "all")
        at = np.cumsum(n) - n
        mixed = weight[bucket] * pair + (1 - weight[bucket]) * base
        score, plain = (np.add.reduceat(np.log10(x), at) for x in (mixed, base))
        known = np.add.reduceat((token > 0).astype(np.int64), at)
        held = column(table, "fold").to_numpy() == TEST
        return pa.table([column(table, "doc_id"), pa.array(held), pa.array(n), pa.array(known), pa.array(plain), pa.array(score)], schema=_SCORE)

    return make


def score_texts(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Score every text; learn from texts whose crc32(doc_id) mod ``folds`` is not 1.

    Returns doc_id, held_out (that remainder is 1), n_tokens, n_known (tokens seen in training), train_tokens,
    base_score (unigrams) and score, both sums of log10 probabilities.
    """
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds, F.lit(2)).cast("int")
    blocks = storage.Blocks(storage.clean_text(docs).withColumn("fold", fold))
    requests = blocks.ask(_count_requests(blocks.parts), ex.REQUEST)
    counted = storage.stored(requests.groupBy("part", "kind").applyInArrow(_count, ex.ANSWER + ", n_main long, v_main long, n_all long, v_all long"))
    names = ("n_main", "v_main", "n_all", "v_all")
    row = counted.where("kind = 0").agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in names)).first()
    texts = blocks.table.agg(F.count_if(~F.col("fold").isin(TEST, TUNE)).alias("main"), F.count_if(F.col("fold") != TEST).alias("all")).first()
    totals = row.asDict() | {"texts_main": texts["main"], "texts_all": texts["all"]}
    answers = counted.where("kind in (1, 2)").select("part", "kind", "block_id", "payload")
    histogram = blocks.with_answers(answers, _tune_histogram(totals), "bucket int, bin int, n long")
    histogram = [tuple(x) for x in histogram.groupBy("bucket", "bin").agg(F.sum("n").alias("n")).collect()]  # at most BUCKETS x bins
    scored = blocks.with_answers(answers, _scores(totals, learn_weights(histogram)), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals["n_all"]).cast("long").alias("train_tokens"), "base_score", "score")
