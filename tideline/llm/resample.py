"""Draws documents whose words are spread like those of a target text collection.

Features are all runs of 1 to `longest` consecutive words, put into buckets by the checksum
(CRC-32) of their UTF-8 bytes. A bucket's gain is the log ratio of its share in the target
to its share in the documents, a document's weight is the sum over its features, and the
highest weights with Gumbel noise, which depends on the document's id alone, are drawn.

Method. A checksum can be carried on: that of "a b" is that of "a" continued by " b". The
most frequent words and pairs of the documents, counted over all of them, are the head: the
checksum of each, up to its last byte, is broadcast once (`HEAD` words and pairs of at most
`HEAD_BYTES` bytes each, so a few megabytes whatever the corpus). Every other feature takes
its checksum directly. Both give the same numbers, so the totals of all buckets are exact.

Three passes read the texts: for the head, for the buckets' totals (a row for each bucket and
task) and for the weights. Only counts are shuffled. Ranks come from one range partitioning
of rows of a few numbers.

Defined results. A null or empty text, or one without words, has no features and weight 0;
texts of any length are read in pieces of whole words. Rows that repeat are rows of their own.
Equal scores go by the smaller id, nulls last, then by features; a null id has the noise of an
empty one. Empty tables give no rows, and an empty target a gain by the documents' shares
alone. Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.storage import stored

#: Words and pairs in the head, and bytes of the longest that may be in it.
HEAD, HEAD_BYTES = 65_536, 64
#: Bytes of text whose words are listed at once; distinct words a task counts at once.
PIECE, COUNTED = 4_000_000, 300_000
#: Rows of a partition while ranks are given.
RANKED_ROWS = 1_000_000
#: Words in the UTF-8 bytes of a text in lower case: digits, letters and all that is not ASCII.
WORD, BREAK = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")


def word_lists(text: str | None, carried: int = 0) -> Iterator[list[bytes]]:
    """Words of the text, in lists of about `PIECE` bytes of it; each but the first begins
    with the last `carried` words of those before."""
    data, at, last = (text or "").encode("utf-8", "replace").lower(), 0, []
    while at < len(data):
        end = len(data)
        if end - at > PIECE and (found := BREAK.search(data, at + PIECE)):
            end = found.end()
        words = last + WORD.findall(data if at == 0 and end == len(data) else data[at:end])
        yield words
        last, at = words[len(words) - min(carried, len(words)) :], end


class States(dict):
    """Checksums of words: the head's by lookup, others directly."""

    def __missing__(self, word: bytes) -> int:
        return crc32(word)


class PairStates(dict):
    """Checksums of pairs: the head's by lookup, others carried on from the first word's."""

    def __init__(self, pairs: dict[tuple[bytes, bytes], int], states: States):
        super().__init__(pairs)
        self.states = states

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        return crc32(b" " + pair[1], self.states[pair[0]])


@dataclass
class Head:
    words: States
    pairs: PairStates

    @classmethod
    def of(cls, words: Iterable[bytes], pairs: Iterable[bytes]) -> Head:
        """Pairs are given as the two words with a space between them."""
        states = States((w, crc32(w)) for w in words)
        return cls(states, PairStates({tuple(p.split(b" ")): crc32(p) for p in pairs}, states))

    def __reduce__(self):
        return Head.of, (list(self.words), [b" ".join(p) for p in self.pairs])


def checksums(head: Head, words: list[bytes], fresh: int, longest: int) -> np.ndarray:
    """Checksums of all runs of 1 to `longest` words that end at or after word `fresh`."""
    found = list(map(head.words.__getitem__, words))
    out = [found[fresh:]]
    for n in range(2, longest + 1):
        if n == 2:
            found = list(map(head.pairs.__getitem__, zip(words, words[1:])))
        else:
            found = [crc32(b" " + w, s) for s, w in zip(found, words[n - 1 :])]
        out.append(found[max(0, fresh - n + 1) :])
    return np.fromiter((s for part in out for s in part), np.int64, sum(map(len, out)))


def buckets_of(head: Head, text: str | None, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of each piece of the text, how many words are new and the buckets of its features."""
    fresh = 0
    for words in word_lists(text, longest - 1):
        yield len(words) - fresh, checksums(head, words, fresh, longest) % buckets
        fresh = min(longest - 1, len(words))


def frequent(texts: DataFrame, text: str, n: int, most: int) -> list[bytes]:
    """The commonest runs of `n` words in all texts: those that occur twice and more, and as
    often as it takes for there to be no more than `most` of them. The bound is found from how
    many runs there are at each eighth of a doubling of the count, so that no more than these
    numbers and then the runs themselves come to the driver."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            runs = pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())
            return pa.RecordBatch.from_arrays(list(runs), ["run", "n"])

        total: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                for words in word_lists(value.as_py(), n - 1):
                    runs = words if n == 1 else map(b" ".join, zip(*(words[k:] for k in range(n))))
                    total.update([r for r in runs if len(r) <= HEAD_BYTES])
                    if len(total) > COUNTED:
                        yield made()
                        total.clear()
        yield made()

    sums = texts.select(text).mapInArrow(counted, "run binary, n long").groupBy("run").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n") * 8).alias("level")
    levels = stored(sums.where("n > 1").select("run", level), "runs")
    held, least = 0, None
    for row in sorted(levels.groupBy("level").count().collect(), reverse=True):
        held += row["count"]
        if held <= most:
            least = row.level
    if least is None:
        return []
    return [bytes(r.run) for r in levels.where(F.col("level") >= least).collect()]


def head_of(docs: DataFrame, text: str = "text", longest: int = 1, most: int = HEAD) -> Broadcast[Head]:
    words = frequent(docs, text, 1, most)
    pairs = frequent(docs, text, 2, most) if longest > 1 else []
    return docs.sparkSession.sparkContext.broadcast(Head.of(words, pairs))


def bucket_totals(
    texts: DataFrame, head: Broadcast[Head], text: str = "text", longest: int = 1, buckets: int = 10_000
) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for _, found in buckets_of(head.value, value.as_py(), longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    sums = texts.select(text).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():  # a row for each bucket at most
        out[row.bucket] = row.n
    return out


def gains_of(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in the target to that in
    the corpus, rounded down."""
    size, all_target, all_corpus = len(corpus), int(target.sum()), int(corpus.sum())
    pairs = zip(target.tolist(), corpus.tolist())
    ratios = [(t + 1) * (all_corpus + size) / ((s + 1) * (all_target + size)) for t, s in pairs]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


@dataclass
class Model:
    """What is needed to weigh a text: a few megabytes, whatever the corpus."""

    head: Broadcast[Head]
    gains: np.ndarray
    longest: int


def fit(docs: DataFrame, target: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000) -> Model:
    head = head_of(docs, text, longest)
    totals = [bucket_totals(t, head, text, longest, buckets) for t in (target, docs)]
    return Model(head, gains_of(*totals), longest)


def importance(text: str | Column, model: Model) -> Column:
    """Words, features and weight of the text, as a struct of longs."""
    head, gains, longest = model.head, model.gains, model.longest

    @F.arrow_udf("struct<n_words: long, n_features: long, weight: long>")
    def weigh(column: pa.Array) -> pa.Array:
        out = np.zeros((3, len(column)), np.int64)
        for n, value in enumerate(column):
            for words, found in buckets_of(head.value, value.as_py(), longest, len(gains)):
                out[:, n] += words, len(found), gains[found].sum()
        return pa.StructArray.from_arrays([pa.array(x) for x in out], ["n_words", "n_features", "weight"])

    return weigh.asNondeterministic()(text)


def noisy(weight: Column, id: Column, seed: int) -> Column:
    """The weight plus Gumbel noise in thousandths, from a digest of seed and id."""
    digest = F.sha2(F.concat_ws("", F.lit(f"{seed}:"), id.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    drawn = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weight + drawn.cast("long")


def ranked(rows: DataFrame, eligible: str, order: list[Column], percent: int) -> DataFrame:
    """Adds `rank`, from 1, to the first `percent` in a hundred of the eligible rows.

    Rows are range partitioned in that order; each partition numbers its own as they pass,
    and starts at the number of eligible rows in the partitions before.
    """
    spark = rows.sparkSession
    parts = 1 + rows.count() // RANKED_ROWS
    keys = [F.col(eligible).desc(), *order]

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = np.arange(at + 1, at + batch.num_rows + 1)
            at += batch.num_rows
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "place"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    sorted_rows = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = stored(sorted_rows.mapInArrow(numbered, f"{fields}, part int, place long"), "ranked")
    sizes = dict(placed.where(F.col(eligible)).groupBy("part").count().collect())  # a row a partition
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    begun = F.broadcast(spark.createDataFrame(starts, "part int, begun long"))
    place = F.col("begun") + F.col("place")
    drawn = F.col(eligible) & (place <= total * percent // 100)
    return placed.join(begun, "part", "left").withColumn("rank", F.when(drawn, place)).select(*rows.columns, "rank")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document: of those with at
    least `least_words` words, `percent` in a hundred with the highest scores have a rank."""
    model = fit(docs, target, text, longest, buckets)
    weighed = docs.select(F.col(id).alias("id"), importance(F.col(text), model).alias("found"))
    rows = weighed.select("id", "found.*").withColumn("score", noisy(F.col("weight"), F.col("id"), seed))
    rows = stored(rows.withColumn("eligible", F.col("n_words") >= least_words), "weights")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("n_words")]
    return ranked(rows, "eligible", order, percent).drop("eligible")
