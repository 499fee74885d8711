"""Removal of word passages that an earlier document has, by recompression.

Each document's words are replaced by symbols in rounds: a run of two equal words gets a
name, then pairs of neighbours get names, where a symbol of one half of the alphabet is
followed by one of the other half. Names and halves are hashes of what a symbol stands
for, so all tasks name alike with no exchange, and equal passages get equal symbols except
within a few words of their ends.

Why nothing is lost: whether a boundary between symbols survives the rounds depends on at
most EDGE words on either side. So all symbols that lie EDGE words inside a passage are the
passage's own, wherever it occurs.

Repeats are revealed by shared symbols. A window of WINDOW words ranks the boundaries that
lie REACH + EDGE words inside it by the symbols they part, and picks one, its anchor, the
same one wherever the window occurs. An anchor's name is the row of symbols within REACH
words of it; documents that share a window share a name.

Repeats are verified by symbols too. A span is written as its symbols, and the
words at either end, fewer than EDGE + LONGEST, whose symbols depend on what is outside. Spans are equal where these are, as
a symbol's name stands for its words. First the spans of all windows of an anchor are compared, name and span being 64 bits each,
made from different halves of the words' digests. Only where one name has several spans, at the edges of passages, are windows listed
one by one, each span in its first document alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import having_ids, is_small, lacking_ids, map_slices, text_bytes
from starledger.llm.hashing import mix, stretch_prints, word_hashes
from starledger.llm.tokens import bound_batches
from starledger.operators.joins import salted_join
from starledger.session import stage

WINDOW = 50
#: Rounds of pair naming after the naming of runs, and the most words that a symbol then holds.
PAIRS = 2
LONGEST = 2 << PAIRS
#: Words on either side that a boundary depends on. Whether two words are a run depends on the
#: next word too, so the run or word beside a boundary is known from 3 words; the first round
#: asks for that. The second asks whether it was joined with the one before it, which has 2
#: words at most and is known from 3 in the same way: 2 + 3.
EDGE = 5
#: Words on either side of an anchor whose symbols make its name, and rank it.
REACH = LONGEST
CONTEXT = EDGE + REACH
_SEED = 0x2545F4914F6CDD1D


def recompress(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word of each symbol, its two names), from the two numbers of every
    word. ``first`` marks words that begin a document; nothing is joined across them."""
    at, symbols = np.arange(len(words)), words

    def joined(join: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after joining those where ``join`` says so with their left neighbours."""
        own, tail = np.flatnonzero(~join), np.flatnonzero(join)
        names = symbols[own].copy()
        names[np.searchsorted(own, tail) - 1] = mix(mix(symbols[tail - 1] + np.uint64(seed)) + symbols[tail])
        return at[own], names

    same = np.concatenate(([False], (symbols[1:] == symbols[:-1]).all(axis=1))) & ~first
    before = np.concatenate(([False], same[:-1]))
    after = np.concatenate((same[1:], [False]))
    at, symbols = joined(same & ~before & ~after, 11)  # runs of exactly two
    for r in range(PAIRS):
        right = (mix(symbols[:, 0] ^ np.uint64(_SEED + r)) >> np.uint64(63)).astype(bool)
        join = np.concatenate(([False], right[1:] & ~right[:-1])) & ~first[at]
        at, symbols = joined(join, 13 + r)
    return at, symbols


class Anchors:
    """The anchors of some documents' windows, and prints of any stretch of their words."""

    def __init__(self, texts: list[bytes], window: int = WINDOW):
        self.window = window
        self.lanes, self.counts = word_hashes(texts)
        self.words = self.lanes[:, 0]
        n = len(self.words)
        self.begins = np.concatenate(([0], np.cumsum(self.counts)))
        first = np.zeros(n + 1, bool)
        first[self.begins[:-1]] = True
        first = first[:n]
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        starts = np.arange(max(n - window + 1, 0))
        starts = starts[self.doc[starts] == self.doc[starts + window - 1]] if len(starts) else starts
        self.starts = starts
        if not len(starts):
            self.anchor = self.low = self.high = self.group = np.empty(0, np.int64)
            return
        self.at, self.symbols = recompress(self.lanes, first)
        # A boundary ranks by the symbols that it parts. Any LONGEST places in a row hold one.
        names = self.symbols[:, 0]
        rank = np.zeros(n, np.uint64)
        rank[self.at] = mix(names + mix(np.concatenate((names[-1:], names[:-1])))) | np.uint64(1)
        free = window - 2 * CONTEXT + 1
        inner = np.lib.stride_tricks.sliding_window_view(rank, free)
        picked = np.empty(len(starts), np.int64)
        for i in range(0, len(starts), 1 << 14):
            s = starts[i : i + (1 << 14)]
            picked[i : i + (1 << 14)] = s + CONTEXT + inner[s + CONTEXT].argmax(axis=1)
        # Windows with one anchor lie side by side. A group is an anchor with its windows.
        new = np.concatenate(([True], (picked[1:] != picked[:-1]) | (starts[1:] != starts[:-1] + 1)))
        self.group = np.cumsum(new) - 1
        self.anchor = picked[new]
        self.low = starts[new]
        self.high = starts[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))]

    def _within(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and the end of the symbols that lie wholly within stretches of words."""
        low = np.searchsorted(self.at, first)
        return low, np.maximum(np.searchsorted(self.at, end, "right") - 1, low)

    def _prints(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of stretches of a window or more: their own symbols, and the words at both ends."""
        low, high = self._within(first + EDGE, end - EDGE)
        (middle,) = stretch_prints(self.symbols[:, 1], [(low, high)])
        left, right = stretch_prints(self.lanes[:, 1], [(first, self.at[low]), (self.at[high], end)])
        return mix(mix(mix(left) + middle) + right).view(np.int64)

    def names(self) -> np.ndarray:
        """From one half of each word's digest; prints come from the other."""
        return stretch_prints(self.symbols[:, 0], [self._within(self.anchor - REACH, self.anchor + REACH)])[0].view(np.int64)

    def spans(self) -> np.ndarray:
        return self._prints(self.low, self.high + self.window)

    def windows(self, starts: np.ndarray) -> np.ndarray:
        return self._prints(starts, starts + self.window)


_PAIR = pa.struct([("name", pa.int64()), ("print", pa.int64())])
_PAIRS_TYPE = "array<struct<name:bigint,print:bigint>>"


def _pair_lists(doc: np.ndarray, n_docs: int, names: np.ndarray, prints: np.ndarray) -> pa.Array:
    """Per document its distinct (name, print)."""
    order = np.lexsort((prints, names, doc))
    doc, names, prints = doc[order], names[order], prints[order]
    if len(doc):
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (names[1:] != names[:-1]) | (prints[1:] != prints[:-1])))
        doc, names, prints = doc[new], names[new], prints[new]
    offsets = np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(names), pa.array(prints)], fields=list(_PAIR))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _digest(text: bytes) -> bytes:
    """128 bits of a text's sequence of words."""
    return hashlib.blake2b(b" ".join(text.split()), digest_size=16).digest()


def _prints(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, digest, spans) per row of docs (doc_id, text)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_bytes(batch.column("text"))
        a = Anchors(texts, window)
        digest = [_digest(t) for t in texts]
        spans = _pair_lists(a.doc[a.low], len(texts), a.names(), a.spans()) if len(a.low) else pa.array([[]] * len(texts), pa.list_(_PAIR))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(a.counts), pa.array(digest, pa.binary()), spans], names=["doc_id", "n_words", "digest", "spans"]
        )

    return map_slices(docs, run, f"doc_id {id_type}, n_words bigint, digest binary, spans {_PAIRS_TYPE}")


def _edge_windows(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, name, print) of all windows of the wanted spans; docs (doc_id, text, wanted)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a = Anchors(text_bytes(batch.column("text")), window)
        own = a.names()
        chosen = _members(a, batch.column("wanted"), own, a.spans(), a.doc[a.low])
        starts = a.starts[chosen[a.group]] if len(a.starts) else a.starts
        names = own[a.group[chosen[a.group]]] if len(a.starts) else a.starts
        lists = _pair_lists(a.doc[starts], batch.num_rows, names, a.windows(starts))
        doc = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
        flat = lists.flatten()
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), flat.field(0), flat.field(1)], names=["doc_id", "name", "print"])

    return map_slices(docs, run, f"doc_id {id_type}, name bigint, print bigint")


def _members(a: Anchors, wanted: pa.Array, names: np.ndarray, prints: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which (name, print) of a document its row of ``wanted`` lists."""
    lists = [{(x["name"], x["print"]) for x in w or ()} for w in wanted.to_pylist()]
    return np.fromiter(((n, p) in lists[d] for n, p, d in zip(names.tolist(), prints.tolist(), doc.tolist())), bool, len(names))


def _result(docs: DataFrame, window: int) -> DataFrame:
    """The kept words; docs (doc_id, text, whole, spans, windows)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_bytes(batch.column("text"))
        hit = [i for i, x in enumerate(zip(batch.column("spans").is_valid().to_pylist(), batch.column("windows").is_valid().to_pylist())) if any(x)]
        kept = [t.split() for t in texts]
        n_words = [len(k) for k in kept]
        if hit:
            part = batch.take(pa.array(hit))
            a = Anchors([texts[i] for i in hit], window)
            if len(a.starts):
                names = a.names()
                spans = _members(a, part.column("spans"), names, a.spans(), a.doc[a.low])
                copied = spans[a.group]
                copied |= _members(a, part.column("windows"), names[a.group], a.windows(a.starts), a.doc[a.starts])
                change = np.zeros(len(a.words) + 1, np.int64)
                np.add.at(change, a.starts[copied], 1)
                np.add.at(change, a.starts[copied] + window, -1)
                free = np.cumsum(change)[:-1] == 0
                for k, i in enumerate(hit):
                    kept[i] = [w for w, x in zip(kept[i], free[a.begins[k] : a.begins[k + 1]].tolist()) if x]
        for i, digests in enumerate(batch.column("whole").to_pylist()):
            if digests and _digest(texts[i]) in digests:
                kept[i] = []
        joined = [b" ".join(k) for k in kept]
        removed = [n - len(k) for n, k in zip(n_words, kept)]
        sums = [hashlib.sha256(j).hexdigest() for j in joined]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(joined, pa.binary()).cast(pa.string()), pa.array(sums, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
        )

    return map_slices(docs, run, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, kept_sha256) per row of ``docs``.

    A word goes when a window of ``window`` consecutive words (33 or more) that covers it also
    starts in a document with a smaller id; all windows are judged on the input. Kept words are joined
    by one blank. Null and wordless texts keep nothing. Rows with equal ids are not earlier
    than each other; a null id is neither earlier nor later than any. No other column is
    read, and an empty table gives an empty result.
    """
    if window < 2 * CONTEXT + LONGEST - 1:
        raise ValueError(f"a window needs {2 * CONTEXT + LONGEST - 1} words or more")
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stage(_prints(docs, window).filter(F.col("n_words") >= window).filter("doc_id IS NOT NULL"), "prints")

    # Documents whose words are, as a whole, those of an earlier one lose all of them. A text,
    # name or span that very many documents have is cut into slices when they are joined.
    count = F.count(F.lit(1)).alias("n")
    first = stage(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), count).filter("n > 1"), "first-copies")
    several = salted_join(rows.select("doc_id", "digest"), first.drop("n"), "digest", "inner", first.select("digest", "n"))
    copies = stage(several.filter("doc_id > first").select("doc_id", "digest"), "copies")
    heads = rows.join(copies, ["doc_id", "digest"], "left_anti")

    spans = heads.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.name", "s.print")
    # Counts alone: names that only one document has, but twice, go on and find nothing earlier.
    common = stage(spans.groupBy("name").agg(count).filter("n > 1"), "common-names")
    shared = salted_join(spans, common.select("name"), "name", "inner", common)
    shared = stage(shared.select("doc_id", F.struct("name", "print").alias("span")), "shared-spans")
    kinds = stage(shared.groupBy("span").agg(F.min("doc_id").alias("least"), count), "span-kinds")
    later = salted_join(shared, kinds.select("span", "least"), "span", "inner", kinds.select("span", "n")).filter("doc_id > least")
    later = later.select("doc_id", "span.name", "span.print")
    kinds = kinds.select("span.name", "span.print", "least")
    span_hits = later.groupBy("doc_id").agg(F.collect_list(F.struct("name", "print")).alias("spans"))

    several = stage(kinds.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "span-names")
    mixed = salted_join(kinds, several.select("name"), "name", "inner", several)
    wanted = stage(mixed.groupBy(F.col("least").alias("doc_id")).agg(F.collect_list(F.struct("name", "print")).alias("wanted")), "wanted-spans")
    ids = wanted.select("doc_id")
    texts = having_ids(docs, ids, "doc_id", is_small(ids)).join(wanted, "doc_id")
    windows = stage(_edge_windows(texts, window), "edge-windows")
    early = windows.groupBy("name", "print").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    window_hits = windows.join(early.drop("most"), ["name", "print"]).filter("doc_id > least").select("doc_id", "name", "print").distinct()
    window_hits = window_hits.groupBy("doc_id").agg(F.collect_list(F.struct("name", "print")).alias("windows"))

    hits = stage(span_hits.join(window_hits, "doc_id", "full_outer"), "hits")
    return _result(_with_hits(docs, hits, copies), window)


def _with_hits(docs: DataFrame, hits: DataFrame, copies: DataFrame) -> DataFrame:
    """docs with ``whole`` (digests of rows to empty), ``spans`` and ``windows``. Texts are
    shuffled only where an id is listed."""
    whole = copies.groupBy("doc_id").agg(F.collect_set("digest").alias("whole"))
    marks = stage(whole.join(hits, "doc_id", "full_outer"), "marks")
    ids = marks.select("doc_id")
    small = is_small(ids)
    nothing = [F.lit(None).cast(marks.schema[c].dataType).alias(c) for c in ("whole", "spans", "windows")]
    none = lacking_ids(docs, ids, "doc_id", small).select("doc_id", "text", *nothing)
    some = having_ids(docs, ids, "doc_id", small).join(marks, "doc_id")
    return none.unionByName(some.select("doc_id", "text", "whole", "spans", "windows"))
