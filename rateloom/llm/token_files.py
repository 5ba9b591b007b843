"""Token ids in Parquet list columns.

File format: a folder of Parquet parts, in ascending order of doc_id (missing ids first, then by the text's hash), columns

* ``part`` int, ``row_start`` long: the part's number, and the ids of the part's earlier documents,
* ``doc_id`` long, ``n_tokens`` long,
* ``token_ids`` array<int>: the document's ids with the end id behind them.

Ids are dictionary encoded (a vocabulary fits into one dictionary page, so an id takes its 16 bits or less); the ascending
columns are delta encoded. Row groups and pages are small and bounded, and Parquet's page indexes hold each page's least and
largest doc_id: a read of some documents, or of the metadata columns alone, touches only those pages.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateloom.llm.shared import held, lists, map_batches

END_ID = 0
FILE_SCHEMA = "part int, row_start long, doc_id long, n_tokens long, token_ids array<int>"
#: Parquet's own settings: bytes of a row group, of a page and of a dictionary page; rows of a page.
LAYOUT = {
    "parquet.block.size": str(16 << 20), "parquet.page.size": str(256 << 10), "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20), "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#row_start": "false",
}
#: Length of words that are remembered, and how many a worker keeps; as many older ones may still be around.
REMEMBERED_CHARS, REMEMBERED_WORDS = 40, 250_000
#: New words that the library splits in one go.
WORDS_AT_ONCE = 5000
#: Texts that are encoded at once.
TEXTS_AT_ONCE = 2000

#: GPT-2's way to write bytes as characters, and its pattern of words, here as far as plain texts need it.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _PRINTED]
_BYTE_CHARS = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}
_PLAIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\n"
_MARK = "\x01"
#: What makes a text other than plain: control characters but line ends, white space beyond ASCII, letters for which libraries'
#: Unicode tables may differ, several spaces or three line ends together, spaces and line ends together or at the end.
_UNUSUAL = r"[\x00-\x09\x0b-\x1f\x7f-\x{a0}\x{250}-\x{10ffff}]|  |\n | \n|\n\n\n| \z|\n\n\z"


class WordEncoder:
    """Encodes by words: the library's model splits each distinct word once, later places look its ids up.

    Only for byte-level BPE files with the usual pattern of words and no other added text than special tokens. A text
    that holds such a token's string, letters of other scripts or unusual white space goes through the library whole.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(file)
        self.model = self.whole.model
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.odd = "|".join([_UNUSUAL, *(re.escape(x) for x in self.added)])
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(_BYTE_CHARS))]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words. Those with a space before them are given to the library in one text, which it cuts at just
        these spaces."""
        spaced = [w for w in words if w[0] == " "]
        found = {w: self._word(w) for w in words if w[0] != " "}
        for k in range(0, len(spaced), WORDS_AT_ONCE):
            part = spaced[k:k + WORDS_AT_ONCE]
            coded = self.whole.encode("".join(part), add_special_tokens=False)
            word = np.array(coded.word_ids, np.int64)
            ends = np.append(np.flatnonzero(np.diff(word)) + 1, len(word)) * 4
            raw = np.array(coded.ids, np.uint32).tobytes()
            found |= zip(part, [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], strict=True)
        return found

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known, self.older = {"": b""}, self.known
        out = list(map(self.known.get, words))
        new = [w for w, ids in zip(words, out, strict=True) if ids is None]
        if not new:
            return out
        found = {w: self.older[w] for w in new if w in self.older}
        found |= self._learn([w for w in new if w not in found] if found else new)
        self.known.update((w, ids) for w, ids in found.items() if len(w) <= REMEMBERED_CHARS)
        return [found[w] if ids is None else ids for w, ids in zip(words, out, strict=True)]

    def encode_all(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, the end id behind each text's, and how many each has. Missing texts are empty.

        Plain texts are cut at spaces all at once, the distinct chunks among them into words, and the distinct words are looked
        up; their ids are put in place by array operations.
        """
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, self.odd)
        others = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        cut = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        flat, starts = cut.flatten(), np.asarray(cut.offsets)
        coded = flat.dictionary_encode()
        code, n = np.array(coded.indices), len(coded.dictionary)
        # a text's first chunk has no space before it, so it is an entry of its own
        chunks = pa.concat_arrays([pc.binary_join_element_wise(" ", coded.dictionary, ""), flat.take(pa.array(starts[:-1]))])
        code[starts[:-1]] = n + np.arange(len(texts))
        words = pc.split_pattern(pc.replace_substring_regex(chunks, _PLAIN_WORDS, r"\0" + _MARK), _MARK)
        known = words.flatten().dictionary_encode()
        ids = self._ids(known.dictionary.to_numpy(zero_copy_only=False).tolist())
        by_chunk, sizes = _put(_entries(ids), np.asarray(known.indices), np.asarray(words.offsets))
        # texts that are not plain, and the end id, are entries too
        more = [np.frombuffer(self._whole(texts[k].as_py()), np.uint32) for k in others.tolist()] + [np.array([end_id], np.uint32)]
        code[starts[others]] = len(chunks) + np.arange(len(others))
        code = np.insert(code, starts[1:], len(chunks) + len(others))
        entries = np.concatenate([by_chunk, *more]), np.concatenate([sizes, [len(x) for x in more]])
        return _put(entries, code, starts + np.arange(len(starts)))


def _entries(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def _put(entries: tuple[np.ndarray, np.ndarray], code: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the entries ``code`` in a row, and how many those between two of ``starts`` have together."""
    flat, size = entries
    first = np.cumsum(size) - size
    sizes = size[code]
    ends = np.cumsum(sizes)
    places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[code] - ends + sizes, sizes)
    return flat[places], np.diff(np.append(0, ends)[starts])


def encoder(file: str) -> WordEncoder:
    """One encoder for a worker's life."""
    return held("token_files", file, lambda: WordEncoder(file))


def write_tokens(df: DataFrame, path: str, tokenizer_file: str, id_column: str = "doc_id", text_column: str = "text",
                 end_id: int = END_ID) -> None:
    """Encode every whole text and write the files described above.

    Missing texts are empty: the end id alone. Repeated rows are all written. An empty table makes an empty folder.
    The texts meet in one shuffle, by ranges of (id, hash of the text), so repeated ids spread over parts as well.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, total = encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, counts = own.encode_all(batch.column(1), end_id)
            starts = total + np.cumsum(counts) - counts
            total += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(counts), part, np.int32)), pa.array(starts), batch.column(0), pa.array(counts),
                 lists(ids.astype(np.int32), counts, pa.int32())],
                names=["part", "row_start", "doc_id", "n_tokens", "token_ids"])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    map_batches(ordered, encode, FILE_SCHEMA, TEXTS_AT_ONCE).write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows; select columns and filter on doc_id to read only what is needed."""
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, row_start, n_tokens and ``start``: the ids of all documents before it. Reads no token.

    The running sum over parts works on one row per part file; within a part the files hold it.
    """
    rows = read_tokens(spark, path).select("part", "row_start", "doc_id", "n_tokens")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("offset"))
    return rows.join(offsets, "part").withColumn("start", F.col("offset") + F.col("row_start")).drop("offset")


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32 bits)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(3)
            flat = np.asarray(tokens.flatten()).astype("<u4").tobytes()
            offsets = np.asarray(tokens.offsets, np.int64) * 4
            offsets -= offsets[0]
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(offsets) // 4), pa.array(sums, pa.int64())],
                names=["part", "row_start", "doc_id", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path)
    sums = map_batches(rows.select("part", "row_start", "doc_id", "token_ids"), digest,
                       "part int, row_start long, doc_id long, n_tokens long, ids_crc32 long")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("offset"))
    return sums.join(offsets, "part").select(
        "doc_id", (F.col("offset") + F.col("row_start")).alias("start"), "n_tokens", "ids_crc32")
