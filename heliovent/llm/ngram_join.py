"""Jaccard self-join of documents on word n-grams, as a blocked sparse product of document by n-gram incidence.

Linked documents share at least ``least = ceil(threshold * n)`` of the n n-grams of either one. So:

1. Every n-gram learns how many documents have it and the smallest of them, its head (``exchange``: distinct n-grams of a
   block, by key range). Documents with fewer than ``least`` n-grams that any other document has are out: they keep their
   row and link with nothing.
2. Documents with equal sets become one.
3. Of s shared n-grams, ordered from rare to frequent, linked documents have one in common among the first s - least + 1.
   A document joins the blocks of the heads of these n-grams; two linked documents meet in one.
4. A block multiplies rows by the block's incidence matrix: overlaps with all its documents accumulate in one pass over
   its columns; pairs outside the size bounds or below the overlap bound are discarded. Rows already connected to all
   others need no further product, and a block gives a spanning forest of its links, not all pairs.
5. A block of over ``FAMILY`` documents is cut into chunks by size of the set (bands of ``RATIO``) and within them by hash, each with the
   block's first document where the bounds admit it. Documents not linked to it then visit the other chunks, but only those
   whose sizes and shared n-grams can reach the overlap that a link asks for; visitors of a chunk come in tiles of ``FAMILY``. So the
   bounds prune before the product, no group of rows that are multiplied exceeds two tiles, and no pair is left out.

Words are runs of bytes that are no ASCII white space, A-Z as a-z; a text of fewer than n words is one n-gram, a text
without words has none and links with nothing. Null text: no words. A null doc_id stands for a number after all others
(its component is null if nothing smaller is linked). Rows with the same doc_id are one node. An empty table gives an
empty result. n-grams are compared by 64-bit hash (see ``text``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm import exchange as ex
from heliovent.llm import storage
from heliovent.llm.components import components
from heliovent.llm.text import U64, Words, column, gather, gram_hashes, mix, text_bytes

FAMILY = 2048
RATIO = 1.05
NO_ID = (1 << 63) - 1
WHOLE = -1  # the chunk of a family that has no others

_ROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sig_a", pa.int64()), ("sig_b", pa.int64()), ("heads", pa.list_(pa.int64())), ("grams", pa.binary())])
_ROW_DDL = "doc_id long, n_shingles long, sig_a long, sig_b long, heads array<long>, grams binary"
_EDGE = pa.schema([("head", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word n-grams and the text of each; a short text is one n-gram."""
    words = Words(data, offsets)
    hashes, docs, counts = words.hashes(), words.docs(), words.counts()
    grams = gram_hashes(hashes, n)
    inside = docs[: len(grams)] == docs[len(docs) - len(grams) :]
    short = np.flatnonzero((counts > 0) & (counts < n))
    whole = np.empty(len(short), U64)
    for k in range(1, n):
        at = np.flatnonzero(counts[short] == k)
        first = words.first[short[at]]
        whole[at] = mix(sum((hashes[first + i] * U64(2 * i + 3) for i in range(k)), U64(k)))
    return np.concatenate([grams[inside], mix(whole ^ U64(0xA5A5A5A5A5A5A5A5))]), np.concatenate([docs[: len(grams)][inside], short])


class _Sets:
    """Distinct n-grams of each text of a block; texts in the order of their ids."""

    def __init__(self, table: pa.Table, n: int):
        ids = column(table, "doc_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        grams, docs = shingles(*text_bytes(column(table, "text").take(pa.array(order))), n)
        self.keys, codes = np.unique(grams, return_inverse=True)
        pairs = np.unique(docs * max(1, len(self.keys)) + codes)
        self.docs, self.codes = pairs // max(1, len(self.keys)), pairs % max(1, len(self.keys))
        self.sizes = np.bincount(self.docs, minlength=len(ids))


def _requests(parts: int, n: int):
    def make(table: pa.Table) -> pa.Table:
        sets = _Sets(table, n)
        count = np.bincount(sets.codes, minlength=len(sets.keys))
        first = np.zeros(len(sets.keys), np.int64)
        first[sets.codes[::-1]] = sets.ids[sets.docs[::-1]]
        rows = ex.requests(table["block_id"][0].as_py(), 0, sets.keys, parts, lambda a, b: ex.pack(ex.pack_counts(count[a:b]), ex.pack_ints(first[a:b])))
        return ex.rows_table(rows, ex.REQUEST_ARROW)

    return make


def _count(table: pa.Table) -> pa.Table:
    asked = ex.Asked(table)
    got = [ex.unpack(x) for x in asked.payloads]
    count = np.minimum(asked.total(np.concatenate([ex.unpack_counts(x[0]) for x in got])), 255)
    head = asked.least(np.concatenate([ex.unpack_ints(x[1]) for x in got]).astype(np.int64))

    def payload(at: np.ndarray) -> bytes:
        return ex.pack(count[at].astype(np.uint8).tobytes(), ex.pack_ints(head[at][count[at] > 1]))

    return ex.rows_table(asked.answers(table["part"][0].as_py(), 0, payload), ex.ANSWER_ARROW)


def _candidates(n: int, percent: int):
    def make(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ex.rows_table([], _ROW)
        sets = _Sets(table, n)
        got = [ex.unpack(x) for x in ex.in_order(answers, 0)]
        count = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x[0], np.uint8) for x in got)])
        head = np.zeros(len(count), np.int64)
        head[count > 1] = np.concatenate([np.zeros(0, U64), *(ex.unpack_ints(x[1]) for x in got)]).astype(np.int64)
        shared = count[sets.codes] > 1
        docs, codes = sets.docs[shared], sets.codes[shared]
        least = -(-percent * sets.sizes // 100)
        have = np.bincount(docs, minlength=len(sets.ids))
        stays = (sets.sizes > 0) & (have >= least)
        keep = stays[docs]
        docs, codes = docs[keep], codes[keep]
        have = np.where(stays, have, 0)
        begin = np.cumsum(have) - have
        order = np.lexsort((codes, count[codes], docs))  # by text, then from rare to frequent
        prefix = gather(np.where(stays, have - least + 1, 0), begin)
        rows, seen = [], set()
        keys = sets.keys[codes]
        whole = sets.keys[sets.codes]
        at = np.cumsum(sets.sizes) - sets.sizes
        full = np.flatnonzero(sets.sizes)
        sums = np.zeros((2, len(sets.sizes)), U64)  # of whole sets, for equality
        if len(full):
            sums[0, full] = np.add.reduceat(whole, at[full])
            sums[1, full] = np.add.reduceat(mix(whole ^ U64(0x1F83D9ABFB41BD6B)), at[full])
        sums = sums.view(np.int64)
        for i, (id_, size) in enumerate(zip(sets.ids.tolist(), sets.sizes.tolist())):
            row = {"doc_id": id_, "n_shingles": size}
            if stays[i]:
                a, b = begin[i], begin[i] + have[i]
                one, two = sums[:, i].tolist()
                row |= {"sig_a": one, "sig_b": two}
                if (size, one, two) not in seen:
                    seen.add((size, one, two))
                    row["grams"] = keys[a:b].tobytes()
                    at = order[prefix[np.searchsorted(prefix, a) : np.searchsorted(prefix, b)]]
                    row["heads"] = np.unique(head[codes[at]]).tolist()
            rows.append(row)
        return ex.rows_table(rows, _ROW)

    return make


class _Matrix:
    """Rows of documents of a family over its n-grams; products of one row with all rows."""

    def __init__(self, ids: list[int], sizes: np.ndarray, grams: list[np.ndarray], percent: int):
        self.ids, self.sizes, self.percent = ids, sizes, percent
        lengths = np.array([len(x) for x in grams])
        self.begin = np.cumsum(lengths) - lengths
        self.lengths = lengths
        columns, self.codes = np.unique(np.concatenate(grams), return_inverse=True)
        self.mark = np.zeros(len(columns), np.int32)

    def linked(self, i: int) -> np.ndarray:
        """Whether each row reaches the overlap that its size and row i's ask for."""
        row = self.codes[self.begin[i] : self.begin[i] + self.lengths[i]]
        self.mark[row] = 1
        overlap = np.add.reduceat(self.mark[self.codes], self.begin)
        self.mark[row] = 0
        return 100 * overlap >= self.percent * (self.sizes + self.sizes[i] - overlap)


def _forest(matrix: _Matrix, start: int, rows=None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Edges that connect what links connect, and whether each row is linked to row ``start``.

    rows: multiply these only, else all that may still connect something.
    """
    group = np.arange(len(matrix.ids))
    edges, used = [], np.zeros(len(group), bool)

    def product(i: int) -> np.ndarray:
        used[i] = True
        linked = matrix.linked(i)
        for g in np.setdiff1d(group[linked], group[i]):
            edges.append((i, int(np.flatnonzero(linked & (group == g))[0])))
            group[group == g] = group[i]
        return linked

    to_start = product(start)
    if rows is not None:
        for i in rows:
            product(i)
        return edges, to_start
    done = to_start.copy()  # linked to a row that was multiplied
    for i in range(len(group)):
        if not done[i]:
            done |= product(i)
            done[i] = True
    for i in range(len(group)):
        if (group == group[0]).all():
            break
        if not used[i]:
            product(i)
    return edges, to_start


def _multiply(percent: int, again: bool):
    """A task's families. again: multiply the rows marked ``rest`` only; else mark them where a family has chunks."""

    def make(table: pa.Table) -> pa.Table:
        table = table.sort_by([("head", "ascending"), ("chunk", "ascending"), ("tile", "ascending"), ("doc_id", "ascending")])
        names = {x: column(table, x) for x in table.schema.names}
        head, chunk, tile, ids, size, first = (names[x].to_numpy() for x in ("head", "chunk", "tile", "doc_id", "n_shingles", "first"))
        grams, rest = names["grams"], names["rest"].to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.r_[True, (np.diff(head) != 0) | (np.diff(chunk) != 0) | (np.diff(tile) != 0)])
        out = []
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(head)]):
            own, has_first = ids[a:b], bool((ids[a:b] == first[a]).any())
            to_start = np.zeros(b - a, bool)
            if b - a > 1:
                matrix = _Matrix(own.tolist(), size[a:b], [np.frombuffer(grams[i].as_buffer(), U64) for i in range(a, b)], percent)
                start = int(np.argmax(own == first[a])) if has_first else 0
                edges, to_start = _forest(matrix, start, np.flatnonzero(rest[a:b]).tolist() if again else None)
                out += [{"head": int(head[a]), "a": matrix.ids[i], "b": matrix.ids[j]} for i, j in edges]
            if chunk[a] != WHOLE and not again:
                apart = ~to_start if has_first else np.ones(b - a, bool)
                out += [{"head": int(head[a]), "a": i} for i in own[apart & (own != first[a])].tolist()]
        return ex.rows_table(out, _EDGE)

    return make


def _may_link(percent: int) -> F.Column:
    """Whether a document (n_shingles, have) can link with one of a band (low, high: sizes; most: shared n-grams of one)."""
    n, low = F.col("n_shingles"), F.col("low")
    sizes = (F.col("high") * 100 >= percent * n) & (n * 100 >= percent * low)
    return sizes & (F.least("have", "most") * (100 + percent) >= percent * (n + low))


def _links(rows: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between representatives that connect all that links connect."""
    spark = rows.sparkSession
    docs = rows.where("grams is not null").join(reps.select(F.col("rep").alias("doc_id"), "sig_a", "sig_b", "n_shingles"), ["doc_id", "sig_a", "sig_b", "n_shingles"], "left_semi")
    # stored, so that what follows reads of it what it needs and does not bring the n-grams along again and again
    docs = storage.stored(docs.select("doc_id", "n_shingles", (F.octet_length("grams") / 8).cast("long").alias("have"), "heads", "grams"))
    member = docs.select("doc_id", "n_shingles", "have", F.explode("heads").alias("head"))
    family = member.groupBy("head").agg(F.count("*").alias("size"), F.min("doc_id").alias("first")).where("size > 1")
    member = storage.stored(member.join(family, "head"))
    small = member.where(F.col("size") <= FAMILY).select("doc_id", "head", "first", F.lit(WHOLE).alias("chunk"))
    large = member.where(F.col("size") > FAMILY).withColumn("band", F.floor(F.log("n_shingles") / F.log(F.lit(RATIO))))
    bands = large.groupBy("head", "first", "band").agg(F.count("*").alias("size"), F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"), F.max("have").alias("most"))
    bands = bands.withColumn("subs", F.ceil(F.col("size") / FAMILY)).drop("size")
    every_sub = F.explode(F.expr("sequence(0L, subs - 1)")).alias("sub")
    chunk = (F.shiftleft(F.col("band").cast("long"), 40) + F.col("sub")).alias("chunk")
    dealt = large.join(bands.select("head", "band", "subs"), ["head", "band"]).withColumn("sub", F.pmod(F.xxhash64("doc_id"), "subs"))
    dealt = dealt.select("doc_id", "n_shingles", "have", "head", "first", chunk)
    # the first document goes to all chunks that can hold a link of it
    firsts = dealt.where("doc_id = first").select("doc_id", "n_shingles", "have", "head").join(bands, "head").where(_may_link(percent))
    firsts = firsts.select("doc_id", "head", "first", "band", every_sub).select("doc_id", "head", "first", chunk)
    grams = docs.select("doc_id", "n_shingles", "grams")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def multiplied(placed: DataFrame, again: bool) -> DataFrame:
        part = placed.join(grams, "doc_id").withColumn("part", F.pmod(F.xxhash64("head", "chunk", "tile"), F.lit(8 * parts)))
        return part.groupBy("part").applyInArrow(_multiply(percent, again), "head long, a long, b long")

    natives = dealt.where("doc_id <> first").select("doc_id", "head", "first", "chunk")
    once = small.union(natives).union(firsts).select("*", F.lit(0).cast("long").alias("tile"), F.lit(False).alias("rest"))
    edges = storage.stored(multiplied(once, False))
    rest = edges.where("b is null").select("head", F.col("a").alias("doc_id")).distinct()
    if not rest.isEmpty():
        own = rest.join(dealt, ["head", "doc_id"]).withColumnRenamed("chunk", "own")
        visits = own.drop("first").join(bands, "head").where(_may_link(percent)).select("doc_id", "head", "first", "own", "band", every_sub)
        visits = visits.select("doc_id", "head", "first", "own", chunk).where("chunk <> own").drop("own")
        visited = visits.groupBy("head", "chunk").agg(F.ceil(F.count("*") / FAMILY).alias("tiles"))
        guests = visits.join(visited, ["head", "chunk"]).select("doc_id", "head", "first", "chunk", F.pmod(F.xxhash64("doc_id"), "tiles").alias("tile"), F.lit(True).alias("rest"))
        hosts = natives.join(visited, ["head", "chunk"]).select("doc_id", "head", "first", "chunk", F.explode(F.expr("sequence(0L, tiles - 1)")).alias("tile"), F.lit(False).alias("rest"))
        second = multiplied(guests.unionByName(hosts), True)
        edges = storage.stored(edges.union(second))
    return edges.where("b is not null").select("a", "b")


def join_documents(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """Documents whose sets of word n-grams have a Jaccard similarity of at least percent / 100 link.

    Returns doc_id, n_shingles (size of the set), component_id (smallest doc_id reachable by links, itself included).
    """
    docs = docs.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    blocks = storage.Blocks(storage.clean_text(docs))
    answers = blocks.ask(_requests(blocks.parts, n), ex.REQUEST).groupBy("part").applyInArrow(_count, ex.ANSWER)
    rows = storage.stored(blocks.with_answers(answers, _candidates(n, percent), _ROW_DDL))
    blocks.drop()
    sig = ["sig_a", "sig_b", "n_shingles"]
    reps = rows.where("sig_a is not null").groupBy(*sig).agg(F.min("doc_id").alias("rep"))
    # texts under one doc_id are one node
    again = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    same = rows.join(again, "doc_id", "left_semi").join(reps, sig).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = storage.stored(components(_links(rows, reps, percent).union(same)))
    label = reps.join(found, reps["rep"] == found["node"], "left").select(*sig, F.coalesce("component", "rep").alias("label"))
    own = found.select(F.col("node").alias("doc_id"), "component")
    out = rows.select("doc_id", *sig).join(label, sig, "left").join(own, "doc_id", "left")
    id_, label = F.col("doc_id"), F.coalesce("label", "component", "doc_id")
    return out.select(F.nullif(id_, F.lit(NO_ID)).alias("doc_id"), "n_shingles", F.nullif(label, F.lit(NO_ID)).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """The rows, as they are, whose doc_id is the smallest of its component; rows with one doc_id stay or go together."""
    out = join_documents(docs, n, percent).where("doc_id <=> component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(out, F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")), "left_semi")
