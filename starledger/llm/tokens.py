"""Token counts and ids of whole texts, in bounded memory.

A tokenizer file is opened once per Python worker. Texts are cut into words where the
tokenizer cuts for sure, and words repeat a lot, so their ids are remembered; unknown words
of many texts are encoded together. Huge texts are encoded in overlapping chunks on
different tasks and spliced.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import map_slices
from starledger.session import stage

#: Bytes of text whose words are numbered together, so that each is looked up once.
SLICE_BYTES = 4 << 20
#: Words remembered per worker, some 80 MB, their ids as bytes, which take a third of what
#: small arrays do. The first met are kept, which are nearly all the frequent ones.
REMEMBERED = 400_000
ID_BYTES = np.dtype(np.uint32).itemsize
#: Texts of more characters than this are encoded in chunks of it.
CHUNK_CHARS = 32_768
#: Characters that neighbouring chunks share at first. Where no common boundary lies in
#: them, they are widened by WIDEN, up to the whole text.
OVERLAP_CHARS = 256
WIDEN = 8

_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
#: Two spaces together, a space at an end, or a space that is neither a blank nor a line break.
_UNEVEN = r"[ \n][ \n]|^[ \n]|[ \n]$|[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class Encoder:
    """Ids as the library gives them, special strings inside texts as its default has it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.normalizer is not None or type(self.tokenizer.pre_tokenizer).__name__ != "ByteLevel":
            raise ValueError("cutting texts is proven for byte-level BPE without a normalizer only")
        self.longest_special = max((len(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()), default=0)
        self.known: dict[str, bytes] = {}
        self.marks = {mark: self.whole(mark).tobytes() for mark in ".,"}

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _together(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of many words encoded as one text, told apart by their places. ``lead`` is put
        before each; a line break there is a token by itself and is left out."""
        e = self.tokenizer.encode("".join([lead + w for w in words]), add_special_tokens=False)
        ids = np.asarray(e.ids, np.uint32)
        starts = np.fromiter((a for a, _ in e.offsets), np.int64, len(e))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + len(lead))
        cuts = [0, *np.searchsorted(starts, ends).tolist()]
        return [ids[x + len(lead) : y].tobytes() for x, y in zip(cuts, cuts[1:])]

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct pieces of text, four bytes each. What ends in a stop or comma behind a letter or digit
        is the rest and the mark."""
        known, out, later = self.known, {}, ([], [])
        found = list(map(known.get, words))
        for word in [w for w, x in zip(words, found) if x is None]:
            mark = self.marks.get(word[-1:])
            if mark is not None and word[-2:-1].isalnum() and (bare := known.get(word[:-1])) is not None:
                out[word] = bare + mark
            elif not word.strip() or word[-1].isspace() or word[1:2].isspace() or (word[0] != " " and word[0].isspace()):
                out[word] = self.whole(word).tobytes()
            else:
                later[word[0] == " "].append(word)
        for words_, lead in zip(later, ("\n", "")):
            if words_:
                out.update(zip(words_, self._together(words_, lead)))
        if len(known) < REMEMBERED:
            known.update(out)
        return [out[w] if x is None else x for w, x in zip(words, found)]

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        """Texts as lists of pieces that byte-level BPE encodes each by itself.

        A lone blank between non-space characters starts a word; a lone line break between
        them is a word by itself. A text with other spaces is cut at lone blanks only, and
        one with a NUL, which marks the cuts, not at all.
        """
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        even = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        if pc.any(uneven).as_py():
            own = [_LONE_BLANK.sub("\0 ", t) for t in texts.filter(uneven).to_pylist()]
            even = pc.replace_with_mask(even, uneven, pa.array(own, even.type))
        return pc.split_pattern(even, "\0")

    def encode(self, texts: pa.Array, counts_only: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """(where each text's ids end, the ids of all texts) of a column without nulls."""
        with_nul = pc.match_substring(texts, "\0")
        lists = self._cut(pc.if_else(with_nul, "", texts))
        numbered = lists.flatten().dictionary_encode()
        if isinstance(numbered, pa.ChunkedArray):
            numbered = numbered.combine_chunks()
        codes = numbered.indices.to_numpy(zero_copy_only=False)
        ids = self.ids_of(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // ID_BYTES
        begin = np.concatenate(([0], np.cumsum(size)))[:-1]
        upto = np.concatenate(([0], np.cumsum(size[codes])))
        ends = upto[np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()]
        flat = None
        if not counts_only:
            pool = np.frombuffer(b"".join(ids), np.uint32)
            flat = pool[np.repeat(begin[codes] - upto[:-1], size[codes]) + np.arange(upto[-1])]
        for i in np.flatnonzero(with_nul.to_numpy(zero_copy_only=False)):
            own = self.whole(texts[i].as_py())
            if flat is not None:
                flat = np.concatenate((flat[: ends[i]], own, flat[ends[i] :]))
            ends[i:] += len(own)
        return ends, flat


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def _boundaries(encoding, start: int, length: int, low: int, high: int) -> tuple[list[int], list[int]]:
    """Word boundaries of a chunk between two places of its document, and the tokens before each."""
    places, counts, last = [], [], None
    for i, (word, (a, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        # An added token has no word before it to belong to; it starts one of its own.
        if word != last or word is None:
            if low <= start + a <= high:
                places.append(start + a)
                counts.append(i)
            last = word
    return places, counts


def _spliced(chunks: DataFrame, path: str) -> DataFrame:
    """(key, n_tokens) from chunks (key, no, last, start, text, shared); n_tokens is null where
    two chunks have no boundary in common.

    Word splitting goes from left to right and looks back at nothing. A boundary that both
    chunks have is therefore one of the whole text: up to it the left chunk is right, from it
    on the right chunk is. The left chunk's end is kept clear of by the longest special
    string, since only there may a cut-off one look like ordinary text.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path)
        rows = batch.to_pydict()
        out = {"key": rows["key"], "no": rows["no"], "last": rows["last"], "n": [], "left": [], "left_n": [], "right": [], "right_n": []}
        encodings = own.tokenizer.encode_batch(rows["text"], add_special_tokens=False)
        for e, start, text, shared in zip(encodings, rows["start"], rows["text"], rows["shared"]):
            end = start + len(text)
            left = _boundaries(e, start, len(text), start, start + shared)
            right = _boundaries(e, start, len(text), end - shared, end - own.longest_special - 2)
            out["n"].append(len(e))
            for name, value in zip(("left", "left_n", "right", "right_n"), (*left, *right)):
                out[name].append(value)
        return pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("key", pa.string()), ("no", pa.int32()), ("last", pa.bool_()), ("n", pa.int64())]
            + [(c, pa.list_(pa.int64())) for c in ("left", "left_n", "right", "right_n")]
        ))

    encoded = map_slices(
        chunks, run, "key string, no int, last boolean, n bigint, left array<bigint>, left_n array<bigint>, right array<bigint>, right_n array<bigint>"
    )
    order = Window.partitionBy("key").orderBy("no")  # the chunks of one text, some thousands at most
    paired = encoded.withColumn("_next", F.lead(F.struct("left", "left_n")).over(order))
    common = F.array_max(F.array_intersect("right", "_next.left"))
    before = F.get("right_n", (F.array_position("right", common) - 1).cast("int"))
    after = F.get("_next.left_n", (F.array_position("_next.left", common) - 1).cast("int"))
    part = F.when(F.col("last"), F.col("n")).otherwise(before - after)
    return paired.groupBy("key").agg(F.when(F.count(part) == F.count(F.lit(1)), F.sum(part)).alias("n_tokens"))


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Overlapping chunks of (key, text), dealt out so that one text keeps many tasks busy."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                start = no = 0
                while True:
                    last = start + chunk + overlap >= len(text)
                    piece = text[start:] if last else text[start : start + chunk + overlap]
                    yield pa.RecordBatch.from_pydict(
                        {"key": [key], "no": [no], "last": [last], "start": [start], "text": [piece], "shared": [overlap]},
                        schema=pa.schema([("key", pa.string()), ("no", pa.int32()), ("last", pa.bool_()), ("start", pa.int64()), ("text", pa.string()), ("shared", pa.int64())]),
                    )
                    if last:
                        break
                    start, no = start + chunk, no + 1

    cut = texts.mapInArrow(run, "key string, no int, last boolean, start bigint, text string, shared bigint")
    return cut.repartition("key", "no")


def _huge_counts(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of huge texts (key, text), each key once."""
    longest = texts.agg(F.max(F.char_length("text"))).first()[0] or 0
    done, left = [], texts
    while True:
        counts = stage(_spliced(_chunks(left, chunk, overlap), path), "splices")
        done.append(counts.filter(F.col("n_tokens").isNotNull()))
        open_ = counts.filter(F.col("n_tokens").isNull()).select("key")
        # An overlap of the whole text leaves one chunk, which cannot fail.
        if overlap >= longest or open_.isEmpty():
            break
        overlap *= WIDEN
        left = texts.join(open_, "key", "left_semi")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def count_tokens(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row of ``docs``; null texts count as empty.

    ``path`` is a byte-level BPE file of the tokenizers library, the same on all machines.
    Copies of a huge text are encoded once. No other column is read; rows with equal ids
    are counted each for itself.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), t.alias("text"), F.octet_length(t).cast("long").alias("n_bytes"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    short = rows.filter(F.char_length("text") <= chunk)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ends, _ = encoder(path).encode(batch.column("text"), counts_only=True)
        counts = pa.array(np.diff(ends, prepend=0), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), counts], names=["doc_id", "n_bytes", "n_tokens"])

    counted = map_slices(short, run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint", limit=SLICE_BYTES)
    huge = rows.filter(F.char_length("text") > chunk).withColumn("key", F.sha2("text", 256))
    unique = huge.groupBy("key").agg(F.any_value("text").alias("text"))
    counts = _huge_counts(stage(unique, "huge-texts"), path, chunk, overlap)
    return counted.unionByName(huge.drop("text").join(counts, "key").select("doc_id", "n_bytes", "n_tokens"))


def bound_batches(spark, rows: int = 1000) -> None:
    """Rows per Arrow batch: keeps a batch of very long texts within a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
