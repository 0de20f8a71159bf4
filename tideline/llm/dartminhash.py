"""Near-duplicate classes by DartMinHash signatures and banded joining.

Signature. A text is a set of word shingles, each with a weight (1, or how often it
occurs). Every shingle has a strip of the dart board as wide as its weight, and darts
with hashed positions hit the board at one a unit of area, the height being the dart's
rank. Each dart belongs to one of k coordinates, also by hash; a coordinate keeps its
lowest dart. Two texts keep the same dart in a coordinate with the probability of their
weighted Jaccard similarity. Only the board up to the rank that about k ln k + 2 k darts
reach is looked at, and higher only for texts with empty coordinates, so the cost is one
hash a shingle and height band plus the darts, not shingles times k.

Joining. Texts equal byte by byte are one class before anything is compared. Of the
others, texts that share a band of coordinates are in a bucket. First every member is
compared with the bucket's least id. Only buckets whose members are then not all in one
class are looked at again, in blocks of about `BLOCK` members against each other, and only
members that are in different classes by then are compared. Pairs whose signatures agree
enough are checked on their shingle sets; links make classes. So a bucket of any size is
worked off in bounded groups that return fewer links than they have members, no bucket is
skipped, and copies are never paired with each other.

Defined results. Null and empty texts are equal to one another; texts without a word have no
signature and only exact copies. Long texts are signed whole. Rows with the same id are one
document, with the links of all its texts. A class and a group of copies are named after
their least id, so ties cannot arise. Empty tables give no rows; further columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import chunks, list_array, strings
from tideline.llm.components import components
from tideline.llm.hashing import GOLDEN, MIX_A, distinct_shingles, mix, step
from tideline.llm.storage import sized, stored

WIDTH = 5  # words in a shingle
SIMILARITY = 0.8
BANDS, ROWS = 32, 8  # a pair at 0.8 is missed with a chance of 0.003, at 0.85 of 0.00004
AGREE = 0.68  # least share of equal signature bytes for a check: 0.8 less 4.8 deviations
BLOCK = 64  # members of a bucket in a block

#: Lower ends of the height bands of the dart board, then their heights.
LOWS = np.r_[0, 1 / 64, 1 / 8, 1 / 2, 1, 2, 3, np.outer(2 ** np.arange(2, 15), [1, 1.5]).ravel()]


def _poisson(mean: float) -> np.ndarray:
    """Cumulated chances of 0, 1, 2 ... darts in a cell of this height and width 1."""
    count = np.arange(int(mean + 12 * np.sqrt(mean) + 12))
    logs = count * np.log(mean) - mean - np.cumsum(np.log(np.maximum(count, 1)))
    return np.cumsum(np.exp(logs))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(
    element: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int, k: int
) -> np.ndarray:
    """texts x k lowest darts (0 in rows of texts without elements)."""
    out = np.zeros(texts * k, np.uint64)
    filled = np.zeros(texts * k, bool)
    total = np.bincount(owner, weight, minlength=texts)
    whole = np.ceil(weight).astype(np.int64)  # cells of width 1 that the weight covers
    cell = np.arange(int(whole.sum())) - np.repeat(np.cumsum(whole) - whole, whole)
    seed = mix(np.repeat(element, whole) + cell.astype(np.uint64) * GOLDEN)
    room = np.minimum(np.repeat(weight, whole) - cell, 1.0)
    owner = np.repeat(owner, whole)
    goal = np.zeros(texts)
    has = total > 0
    goal[has] = k * (np.log(k) + 2) / total[has]
    open_text = has.copy()
    for band, low in enumerate(LOWS):
        open_text &= (low < goal) | ~filled.reshape(texts, k).all(axis=1)
        if not open_text.any():
            break
        keep = open_text[owner]
        if not keep.all():
            seed, room, owner = seed[keep], room[keep], owner[keep]
        height = (LOWS[band + 1] if band + 1 < len(LOWS) else 2 * low) - low
        chances = _poisson(height)
        draw = _uniform(mix(seed + step(band + 1)))
        some = np.flatnonzero(draw >= chances[0])
        darts = np.searchsorted(chances, draw[some], side="right")
        cell = np.repeat(some, darts)
        nth = np.arange(len(cell)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(seed[cell] + step(band + 1) + (nth + 1).astype(np.uint64) * MIX_A)
        rank = _uniform(dart)
        place = mix(dart ^ GOLDEN)
        inside = _uniform(mix(place)) < room[cell]
        key = owner[cell] * k + ((place >> np.uint64(33)) % np.uint64(k)).astype(np.int64)
        inside &= ~filled[key]
        key, rank, dart = key[inside], rank[inside], dart[inside]
        order = np.argsort(-rank, kind="stable")  # the lowest is written last and stays
        out[key[order]] = dart[order]
        filled[key] = True
    return out.reshape(texts, k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """texts x bands keys, equal where all rows of a band are."""
    turns = mix((np.arange(bands * rows) + 1).astype(np.uint64) * GOLDEN) | np.uint64(1)
    summed = (signature * turns).reshape(len(signature), bands, rows).sum(axis=2, dtype=np.uint64)
    return mix(summed + turns[:bands]).view(np.int64)


def _signed(texts: list[str], weighted: bool):
    """Distinct shingles, their text numbers, and the texts' signatures."""
    element, owner, count = distinct_shingles(texts, WIDTH)
    weight = count.astype(float) if weighted else np.ones(len(count))
    return element, owner, signatures(element, owner, weight, len(texts), BANDS * ROWS)


def _band_rows(weighted: bool):
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in chunks(strings(batch.column("text"))):
                _, owner, signature = _signed(texts, weighted)
                has = np.bincount(owner, minlength=len(texts)) > 0
                keys = list_array(band_keys(signature, BANDS, ROWS)[has].ravel(), has * BANDS)
                rows = batch.slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("digest"), keys], ["id", "digest", "bands"]
                )

    return make


def _set_rows(weighted: bool):
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in chunks(strings(batch.column("text"))):
                element, owner, signature = _signed(texts, weighted)
                short = [s.tobytes() for s in (signature & np.uint64(255)).astype(np.uint8)]
                sets = list_array(element.view(np.int64), np.bincount(owner, minlength=len(texts)))
                ids = batch.column("id").slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(short, pa.binary()), sets], ["id", "signature", "shingles"]
                )

    return make


def _block_links(similarity: float):
    """Links between two blocks of a bucket (or inside one) that join different classes;
    a pair that earlier links of the group have joined already is not needed."""

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        block = table.column("own").to_numpy()
        joined = np.unique(table.column("class").to_numpy(), return_inverse=True)[1]
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8)
        signature = signature.reshape(len(ids), -1)
        sets = table.column("shingles").combine_chunks()
        flat, ends = sets.values.to_numpy(), sets.offsets.to_numpy()
        first, second = key[1].as_py(), key[2].as_py()
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        links = []
        for i in left.tolist():
            against = right[right > i] if first == second else right
            against = against[joined[against] != joined[i]]
            agree = (signature[against] == signature[i]).mean(axis=1) if len(against) else np.zeros(0)
            order = np.argsort(-agree, kind="stable")
            for j in against[order[: int((agree >= AGREE).sum())]].tolist():
                if joined[i] == joined[j]:
                    continue
                mine, other = flat[ends[i] : ends[i + 1]], flat[ends[j] : ends[j + 1]]
                common = len(np.intersect1d(mine, other, assume_unique=True))
                if common >= similarity * (len(mine) + len(other) - common):
                    links.append((ids[i], ids[j]))
                    joined[joined == joined[j]] = joined[i]
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return compare


def near_classes(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    weighted: bool = False,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(id, class_id, copy_of) of every row: `class_id` is the least id among the texts
    linked directly or through others, `copy_of` the least id with exactly this text."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digested = rows.withColumn("digest", F.unhex(F.md5("text")))
    sketched = stored(
        digested.mapInArrow(_band_rows(weighted), "id long, digest binary, bands array<long>"), "sketches"
    )
    copies = stored(
        sketched.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "copies",
    )
    texts = stored(
        sketched.join(sized(copies), "digest", "left").select("id", F.coalesce("first", "id").alias("copy_of"), "bands"),
        "texts",
    )
    banded = texts.where("id = copy_of").select("id", F.explode("bands").alias("bucket"))
    hubs = stored(
        banded.groupBy("bucket")
        .agg(F.min("id").alias("hub"), F.max("id").alias("other"))
        .where("hub < other")
        .drop("other"),
        "hubs",
    )
    members = stored(banded.join(sized(hubs), "bucket").select("bucket", "id", "hub"), "members")
    wanted = stored(members.select("id").distinct(), "wanted")
    sets = stored(
        rows.join(sized(wanted), "id", "left_semi").mapInArrow(
            _set_rows(weighted), "id long, signature binary, shingles array<long>"
        ),
        "sets",
    )
    spokes = members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    alike = common >= similarity * (F.size("x") + F.size("y") - common)
    links = stored(
        stored(spokes, "pairs").join(left, "a").join(right, "b").where(alike).select("a", "b"), "links"
    )
    found = components(links)
    classed = stored(
        members.join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("class")),
        "classed",
    )
    mixed = stored(
        classed.groupBy("bucket")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n"))
        .where("low < high and n > 2")
        .select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")),
        "mixed",
    )
    blocked = (
        classed.join(mixed, "bucket")
        .join(sets, "id")
        .withColumn("own", F.pmod(F.xxhash64("id", "bucket"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("own", "other"))
        .withColumn("second", F.greatest("own", "other"))
        .select("bucket", "first", "second", "own", "id", "class", "signature", "shingles")
    )
    more = stored(
        blocked.groupBy("bucket", "first", "second")
        .applyInArrow(_block_links(similarity), "a long, b long")
        .distinct(),
        "links",
    )
    if not more.isEmpty():
        found = components(links.union(more))
    return (
        texts.select("id", "copy_of")
        .join(found.withColumnRenamed("id", "copy_of"), "copy_of", "left")
        .select(F.col("id").alias(id), F.coalesce("component", "copy_of").alias("class_id"), "copy_of")
    )

