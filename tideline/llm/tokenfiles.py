"""Token ids of documents in binary files, and back.

Ids are numbered by falling frequency over the whole corpus, so that most numbers fit one
byte, and written in byte-aligned variable length: numbers take one to four bytes, and a
separate run of control bytes holds the lengths, two bits each, four to a byte. Decoding
looks the lengths up by control byte in a table and gathers the bytes as arrays.

Writing. Texts become ids once, in a written table. One pass over it counts ids (one row
for each id and task, so at most the vocabulary's size from every task); one range
partitioning by document id, sized to `FILE_IDS`, gives each task a run of the documents
in order, which it streams into files of blocks of about `BLOCK_IDS` ids. Only files of
tasks that finished are in the list of files.

A file is a sequence of blocks. Fixed layout, little-endian: the magic, number of
documents (u32), number of ids and of data bytes (u64); then of the documents the ids
(i64), whether each is null (u8), and lengths (u64); control bytes; data bytes. The file
`vocabulary.ids` holds the ids (u32) by number.

Defined results. Documents are in ascending id, nulls first, and by digest of the tokens where
ids are equal; rows that repeat are documents of their own. A null or empty text is the end id
alone. Long texts are written whole, in one block however many ids they have. An empty table
has no documents in its files; further columns are not looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.batches import in_batches, ranges
from tideline.llm.files import file_name, new_file
from tideline.llm.pieces import Numbered
from tideline.llm.storage import shared_folder, stored

MAGIC = b"TLIDS001"
HEAD = np.dtype([("magic", "S8"), ("documents", "<u4"), ("ids", "<u8"), ("bytes", "<u8")])
FILE_IDS = 4_000_000
BLOCK_IDS = 500_000
CHUNK_BYTES = 4_000_000
CACHED_WORDS, CACHED_RUNS = 400_000, 400_000
#: How the tokenizer splits, and words for which runs of letters and of signs, and
#: single digits, are that: no apostrophes (endings) or angle brackets (special tokens).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = r"0-9A-Za-zÀ-ÖØ-öø-ÿ!\"#$%&()*+,\-./:;=?@\[\]^_`{|}~"
SIMPLE, SIMPLE_TEXT = re.compile(f"[{LATIN}]+"), f"^[{LATIN} \t-\r]*$"
RUNS = re.compile("[a-zß-öø-ÿ]+|[0-9 ]|[^0-9a-zß-öø-ÿ \t-\r]+")
END_OF_WORD = "</w>"
#: How the tokenizer writes bytes for its merges: signs as they are, others from 256 on.
SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
SPELLING = np.arange(256, dtype="<u4")
SPELLING[[b for b in range(256) if b not in SHOWN]] = 256 + np.arange(256 - len(SHOWN))
SPELLING[ord(" ")] = ord(" ")
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


class Coded:
    """Strings that were looked up, numbered, and the ids of each, flat."""

    def __init__(self):
        self.known = Numbered()
        self.starts = self.lengths = self.uses = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def __len__(self) -> int:
        return len(self.known)

    def thin(self, most: int):
        """Above `most` strings, keeps the half of it that was looked up most, later uses counting more."""
        if len(self.known) <= most:
            return
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: most // 2])
        names = list(self.known)
        self.known = Numbered((names[k], n) for n, k in enumerate(kept.tolist()))
        self.flat = self.flat[ranges(self.starts[kept], self.lengths[kept])]
        self.lengths, self.uses = self.lengths[kept], self.uses[kept] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths

    def numbers(self, names: list[str]) -> np.ndarray:
        """The numbers of strings; the ids of new ones are found at once."""
        known, before = self.known, len(self.known)
        found = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        if len(known) > before:
            flat, starts, lengths = self._ids(list(islice(known, before, None)))
            self.starts = np.r_[self.starts, len(self.flat) + starts]
            self.lengths = np.r_[self.lengths, lengths]
            self.flat = np.r_[self.flat, flat]
            self.uses = np.r_[self.uses, np.zeros(len(lengths), np.int64)]
        return found

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the strings with these numbers, flat, and how many each has."""
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        lengths = self.lengths[numbers]
        return self.flat[ranges(self.starts[numbers], lengths)], lengths

    def _ids(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of strings, flat, where those of each begin, and how many it has."""
        raise NotImplementedError


class Runs(Coded):
    """Runs of simple letters or signs, or a blank, which has no ids.

    The library merges many at once, given as words parted by blanks: the last id of a
    run, and no other, is one that ends a word; names without `<` cannot hold that mark."""

    def __init__(self, model):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        super().__init__()
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = WhitespaceSplit()
        spelled = self.tokenizer.get_vocab()
        self.last = np.zeros(max(spelled.values()) + 1, bool)
        self.last[[i for token, i in spelled.items() if token.endswith(END_OF_WORD)]] = True
        if model.end_of_word_suffix != END_OF_WORD:
            raise ValueError("a tokenizer that marks the ends of words in another way")

    def _ids(self, new):
        runs = [run for run in new if run != " "]
        joined = [_spelled(" ".join(runs[at : at + 200])) for at in range(0, len(runs), 200)]
        found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        flat = np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32)
        lengths = np.zeros(len(new), np.int64)
        lengths[[run != " " for run in new]] = np.diff(np.flatnonzero(self.last[flat]), prepend=-1)
        return flat, np.cumsum(lengths) - lengths, lengths


class Words(Coded):
    """Ids of texts by the tokenizers library, each distinct word encoded once.

    The tokenizer must lower letters, and split at white space, which it drops, and
    between letters and signs; that is checked. So a text's ids are those of its words
    one after another, and where a word has only Latin letters and simple signs (`SIMPLE`),
    those of its runs of either, of which there are far fewer. Words are parted at
    ASCII white space and looked up whole; only new ones are split into runs, all of a chunk
    at once, which go straight to the library's merges, or through the whole library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        splits = form["pre_tokenizer"].get("pretokenizers", [form["pre_tokenizer"]])
        lowers = [n["type"] for n in (form["normalizer"] or {}).get("normalizers", [])]
        if splits[0].get("pattern", {}).get("Regex") != SPLIT or lowers != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("a tokenizer that splits or normalises in another way")
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.runs = Runs(self.tokenizer.model)

    def _ids(self, new):
        simple = np.fromiter((SIMPLE.fullmatch(word) is not None for word in new), bool, len(new))
        plain = [word for word, given in zip(new, simple.tolist()) if given]
        odd = [word for word, given in zip(new, simple.tolist()) if not given]
        lengths = np.zeros(len(new), np.int64)
        flat = np.zeros(0, np.uint32)
        if plain:
            self.runs.thin(CACHED_RUNS)
            flat, sizes = self.runs.ids(self.runs.numbers(RUNS.findall(" ".join(plain).lower())))
            # Only the blanks between words have no ids.
            ends = np.cumsum(sizes)[np.r_[np.flatnonzero(sizes == 0), len(sizes) - 1]]
            lengths[simple] = np.diff(ends, prepend=0)
        others = []
        for at in range(0, len(odd), 10_000):
            found = self.tokenizer.encode_batch_fast(odd[at : at + 10_000], add_special_tokens=False)
            others += [encoding.ids for encoding in found]
        lengths[~simple] = list(map(len, others))
        order = np.r_[np.flatnonzero(simple), np.flatnonzero(~simple)]
        starts = np.zeros(len(new), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return np.r_[flat, np.fromiter(chain.from_iterable(others), np.uint32)], starts, lengths

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each has."""
        self.thin(CACHED_WORDS)
        words = _split(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
        distinct = words.flatten().dictionary_encode()
        names = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids, lengths = self.ids(self.numbers(names)[distinct.indices.to_numpy()])
        upto = np.r_[0, np.cumsum(lengths)]
        ends = np.cumsum(pc.list_value_length(words).to_numpy(), dtype=np.int64)
        return ids, np.diff(upto[ends], prepend=0)


def _spelled(runs: str) -> str:
    """Runs as the tokenizer writes their bytes for its merges, parted by blanks."""
    return runs if runs.isascii() else SPELLING[np.frombuffer(runs.encode(), np.uint8)].tobytes().decode("utf-32-le")


def _split(texts: pa.Array) -> pa.Array:
    """Words of texts, parted at ASCII white space only; lowered in simple texts, so that
    fewer differ. There is an empty word before or after white space at an end."""
    simple = pc.match_substring_regex(texts, SIMPLE_TEXT)
    return pc.ascii_split_whitespace(pc.if_else(simple, pc.utf8_lower(texts), texts))


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in slices of about `CHUNK_BYTES`; a longer text is alone."""
    upto, at = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
    while at < len(texts):
        done = int(upto[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + CHUNK_BYTES, "right")))
        yield texts.slice(at, end - at)
        at = end


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def _encoded(column: pa.Array, tokenizer: str, end: int | None) -> Iterator[np.ndarray]:
    """Ids of each text, `end` after them."""
    for texts in _parts(column.fill_null("")):
        ids, lengths = _words(tokenizer).encode(texts)
        if end is not None:
            ids = np.insert(ids, np.cumsum(lengths), end)
            lengths = lengths + 1
        upto = np.r_[0, np.cumsum(lengths)].tolist()
        yield from (ids[a:b] for a, b in zip(upto[:-1], upto[1:]))


def token_bytes(text: str | Column, tokenizer: str, end: int | None = None) -> Column:
    """Ids of the text in the tokenizer file, `end` after them, as little-endian u32."""

    @F.arrow_udf("binary")
    def encode(column: pa.Array) -> pa.Array:
        found = (ids.astype("<u4").tobytes() for ids in _encoded(column, tokenizer, end))
        return pa.array(found, pa.binary())

    return encode.asNondeterministic()(text)


def packed(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of the numbers (u32)."""
    numbers = numbers.astype("<u4")
    extra, width = np.zeros(-(-len(numbers) // 4) * 4, np.uint8), 1
    for n in (1, 2, 3):
        if (longer := numbers >= 1 << 8 * n).any():
            extra[: len(numbers)] += longer
            width = n + 1
    control = extra[0::4] | extra[1::4] << 2 | extra[2::4] << 4 | extra[3::4] << 6
    kept = np.arange(width, dtype=np.uint8) <= extra[: len(numbers), None]
    data = numbers.view(np.uint8).reshape(-1, 4)[:, :width][kept]
    return control.tobytes(), data.tobytes()


def unpacked(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """The numbers that `packed` wrote."""
    lengths = LENGTHS[control].ravel()[:count]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    padded = np.r_[data, np.zeros(4, np.uint8)]
    out = padded[starts].astype(np.uint32)
    for n in (1, 2, 3):
        longer = np.flatnonzero(lengths > n)
        if len(longer):
            out[longer] |= padded[starts[longer] + n].astype(np.uint32) << np.uint32(8 * n)
    return out


def block_bytes(ids: list[int | None], lengths: list[int], numbers: np.ndarray) -> bytes:
    control, data = packed(numbers)
    head = np.array([(MAGIC, len(ids), len(numbers), len(data))], HEAD)
    keys = np.array([0 if i is None else i for i in ids], "<i8")
    absent = np.array([i is None for i in ids], np.uint8)
    return b"".join(
        [head.tobytes(), keys.tobytes(), absent.tobytes(), np.array(lengths, "<u8").tobytes(), control, data]
    )


def blocks_of(content: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Document ids, lengths and numbers of every block of a file."""
    whole, at = np.frombuffer(content, np.uint8), 0

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return whole[at - size : at]

    while at < len(whole):
        head = take(HEAD.itemsize).view(HEAD)[0]
        if head["magic"] != MAGIC:
            raise ValueError("not a block of token ids")
        documents, count = int(head["documents"]), int(head["ids"])
        keys, absent = take(8 * documents).copy().view("<i8").tolist(), take(documents).tolist()
        lengths = take(8 * documents).copy().view("<u8").astype(np.int64)
        control = take(-(-count // 4))
        numbers = unpacked(control, take(int(head["bytes"])), count)
        yield [None if gone else k for k, gone in zip(keys, absent)], lengths, numbers


@dataclass
class TokenFiles:
    """A written corpus: its folder, the ids by number, and (name, start, ids, documents) of its
    files in order, `start` being the ids in the files before."""

    folder: str
    vocabulary: np.ndarray
    listed: DataFrame


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in in_batches(batches, 1000):
        rows = zip(batch.column("wide").to_pylist(), batch.column("tokens"))
        found = np.bincount(np.concatenate([_read(*row) for row in rows]))
        if len(found) > len(total):
            total, found = found, total
        total[: len(found)] += found
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])


def _file_writer(folder: str, vocabulary: np.ndarray):
    number = np.zeros(int(vocabulary.max()) + 1 if len(vocabulary) else 1, np.uint32)
    number[vocabulary] = np.arange(len(vocabulary), dtype=np.uint32)

    def rows(batches):
        for batch in batches:
            wide = batch.column("wide").to_pylist()
            for key, far, tokens in zip(batch.column("id").to_pylist(), wide, batch.column("tokens")):
                yield key, _read(far, tokens)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, files = None, 0
        left = rows(batches)
        row = next(left, None)
        while row is not None:
            name = file_name(files, ".ids")
            documents = total = 0
            with new_file(folder, name) as out:
                while row is not None and total < FILE_IDS:
                    ids, lengths, parts, held = [], [], [], 0
                    while row is not None and held < BLOCK_IDS:
                        part = row[1]
                        ids.append(row[0])
                        lengths.append(len(part))
                        parts.append(number[part])
                        held += len(part)
                        row = next(left, None)
                    out.write(block_bytes(ids, lengths, np.concatenate(parts)))
                    documents += len(ids)
                    total += held
            files += 1
            yield pa.RecordBatch.from_pylist([{"name": name, "ids": total, "documents": documents}])

    return write


def _coder(tokenizer: str, end: int | None):
    """Ids of texts, in two bytes, with a mark, for documents that have none above 65,535."""

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, wide = [], []
            for ids in _encoded(batch.column("text"), tokenizer, end):
                wide.append(bool(len(ids)) and int(ids.max()) > 0xFFFF)
                out.append(ids.astype("<u4" if wide[-1] else "<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(wide, pa.bool_()), pa.array(out, pa.binary())], ["id", "wide", "tokens"]
            )

    return code


def _read(wide: bool, tokens: pa.Scalar) -> np.ndarray:
    return np.frombuffer(tokens.as_buffer(), "<u4" if wide else "<u2")


def write_tokens(
    docs: DataFrame, tokenizer: str, end: int | None = None, id: str = "doc_id", text: str = "text"
) -> TokenFiles:
    """Writes the ids of all documents to a new shared folder."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    tokens = texts.mapInArrow(_coder(tokenizer, end), "id long, wide boolean, tokens binary")
    coded = stored(tokens.withColumn("digest", F.xxhash64("tokens")), "tokens", compression="zstd")
    counted = coded.select("wide", "tokens").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = sorted(((-r.n, r.id) for r in counted.collect()))  # at most the vocabulary's size
    vocabulary = np.array([i for _, i in counts], np.uint32)
    total = -sum(n for n, _ in counts)
    folder = shared_folder(spark, "token-files")
    with new_file(folder, "vocabulary.ids") as out:
        out.write(vocabulary.astype("<u4").tobytes())
    order = F.col("id").asc_nulls_first(), F.col("digest")
    ordered = coded.repartitionByRange(1 + total // FILE_IDS, *order).sortWithinPartitions(*order)
    files = stored(
        ordered.mapInArrow(_file_writer(folder, vocabulary), "name string, ids long, documents long"), "file-list"
    )
    found = sorted(tuple(r) for r in files.collect())  # a row for each file, as in a folder listing
    starts = np.r_[0, np.cumsum([r[1] for r in found])].tolist()
    rows = [(r[0], starts[n], r[1], r[2]) for n, r in enumerate(found)]
    listed = spark.createDataFrame(rows, "name string, start long, ids long, documents long")
    return TokenFiles(folder, vocabulary, listed)


def read_tokens(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(id, start, tokens) of every document from the files: `tokens` are the ids as
    little-endian u32 and `start` is the number of ids before them in the corpus."""
    vocabulary = files.vocabulary.astype("<u4")

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column("start").to_pylist(), batch.column("content")):
                for keys, lengths, numbers in blocks_of(content.as_buffer()):
                    upto = np.r_[0, np.cumsum(lengths)]
                    found = vocabulary[numbers]
                    tokens = [found[a:b].tobytes() for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(start + upto[:-1]), pa.array(tokens, pa.binary())],
                        ["id", "start", "tokens"],
                    )
                    start += int(upto[-1])

    if files.listed.isEmpty():
        return spark.createDataFrame([], "id long, start long, tokens binary")
    contents = spark.read.format("binaryFile").option("pathGlobFilter", "*-*.ids").load(files.folder)
    named = contents.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    # A row a file. Without the hint the contents are shuffled before the list is seen to be small.
    wanted = named.join(F.broadcast(files.listed.select("name", "start")), "name")
    return wanted.select("start", "content").mapInArrow(decode, "id long, start long, tokens binary")

