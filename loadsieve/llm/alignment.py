"""Cross-tokenizer alignment by pointer jumping, and how often the corpus links each pair of ids.

Two tokenizers cut the same bytes (a space and the text) into tokens. Tokens of one side that overlap tokens of the other make groups. Every token points to the token of the other
side that reaches farthest to the right among those it overlaps; pointers are doubled (each successor takes its successor's successor) for all tokens of a batch at once until
nothing moves, and then each token points at the last token of its group, which is the group's label.

Neither tokenizer has a token that goes on from a character that is no white space to a space, so both cut there whatever follows. The runs between such places (a word with what
sticks to it) are tokenised and aligned once each and looked up afterwards; a text's tokens, groups and links are those of its runs in a row.

Corpus counts, without holding them anywhere: documents are taken in chunks of about chunk_chars characters. A chunk lists its distinct id pairs with their counts, its runs as places in that
list, and its documents as places in its runs. Pairs are counted over the corpus, the highest count of each id of the second side (a table no longer than its vocabulary) marks the best
ones, and the values go back to the chunks that hold the pair. A pair is one row per chunk however often it occurs, so no key is hot, and a task holds single chunks.

Null and empty texts, and texts whose tokens don't give back their bytes, have no tokens. Repeated rows count each. A very long text is a chunk of its own, whole. Empty tables give empty
results. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loadsieve.llm.common import slices, small_batches, table, unused
from loadsieve.session import saved

CHUNK_CHARS = 8_000_000
KNOWN_RUNS = 300_000
#: The printable stand-ins of byte-level vocabularies are the bytes themselves in these ranges; the rest count up from 256.
PRINTABLE = ((33, 126), (161, 172), (174, 255))
SPACE = "▁"
#: Both sides cut before a space that follows no white space; one that ends a text stays with its run.
RUNS = re.compile(r"(?<=\S) (?!\Z)")
#: Texts without this have single spaces between their runs and nothing else there.
LOOSE = re.compile(r"\s |\A | \Z")


def byte_stand_ins() -> dict[str, int]:
    plain = [b for a, z in PRINTABLE for b in range(a, z + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer file; strings of special tokens in a text are plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        stands = byte_stand_ins()
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(stands[c] for c in token)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text."""
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which adds the space itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces that go on from a character to a space can't be aligned run by run")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last token (as a place in b) of each token's group, for the tokens of a and of b; both tile the same bytes.

    Every token points to the token of the other side over its own last byte, the farthest right that it overlaps; where both end there, the token of b is the last.
    """
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends, side="left") + n
    over_b = np.searchsorted(a_ends, b_ends, side="left")
    successor = np.concatenate([over_a, np.where(a_ends[over_b] > b_ends, over_b, np.arange(len(b_ends)) + n)]) if n else np.empty(0, np.int64)
    while True:
        farther = successor[successor]
        if np.array_equal(farther, successor):
            return successor[:n] - n, successor[n:] - n
        successor = farther


@dataclass
class Aligned:
    """Runs or texts aligned: per item its numbers of tokens, groups and links, and for all items in a row the groups of tokens and the linked tokens."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(a_sizes: np.ndarray, b_sizes: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray) -> Aligned:
    """Groups and links of items whose tokens lie in a row: bytes of each token, and tokens of each item."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_last, b_last = terminals(a_ends, b_ends)
    labels, b_group = np.unique(b_last, return_inverse=True)
    a_group = np.searchsorted(labels, a_last)
    # between two neighbouring ends lies one token of each side, and every overlap is such a stretch
    ends = np.union1d(a_ends, b_ends)
    item_ends = np.r_[0, a_ends][np.cumsum(a_counts)]
    upto = lambda at: np.diff(np.r_[0, np.searchsorted(at, item_ends, side="right")])
    return Aligned(
        a_counts,
        b_counts,
        upto(b_ends[labels]) if len(labels) else np.zeros(len(a_counts), np.int64),
        upto(ends),
        a_group,
        b_group,
        np.searchsorted(a_ends, ends),
        np.searchsorted(b_ends, ends),
    )


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts


class Vocabulary:
    """The bytes of all tokens of a side in a row, and its ids as they are written: before a comma, and as the last of their group."""

    def __init__(self, tokens: list[bytes], last: str) -> None:
        self.sizes = np.array([len(t) for t in tokens])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)
        self.written = [f"{i},".encode() for i in range(len(tokens))] + [f"{i}{last}".encode() for i in range(len(tokens))]

    def gives_back(self, ids: np.ndarray, counts: np.ndarray, items: list[bytes]) -> np.ndarray:
        """Which items the tokens' bytes are."""
        sizes = self.sizes[ids]
        found = self.raw[np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        ends = np.r_[0, np.cumsum(sizes)][np.cumsum(counts)]
        lengths = np.fromiter(map(len, items), np.int64, len(items))
        same = np.diff(np.r_[0, ends]) == lengths
        if same.all() and np.array_equal(found, np.frombuffer(b"".join(items), np.uint8)):
            return same
        return np.array([found[e - n : e].tobytes() == x if ok else False for e, n, x, ok in zip(ends.tolist(), lengths.tolist(), items, same, strict=True)], bool)


class Runs:
    """Runs met so far, numbered as they come: their counts, links (a * 2^32 + b) and written groups. KNOWN_RUNS at most between chunks, then begun anew."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.of_a, self.of_b = Vocabulary(self.a.bytes, "|"), Vocabulary(self.b.bytes, ";")
        self.written_ids = self.of_a.written + self.of_b.written
        self.forget()

    def bound(self) -> None:
        """Begin anew when too many are known; not while a chunk refers to them."""
        if len(self.numbers) > KNOWN_RUNS:
            self.forget()

    def forget(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__  # a new run takes the next number
        self.whole = np.empty(0, bool)  # whether the tokens give back the bytes
        self.counts = np.empty((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.starts = np.empty(0, np.int64)
        self.links = np.empty(0, np.int64)
        self.written: list[bytes] = []  # groups, each with a semicolon

    def learn(self, runs: list[str]) -> None:
        raw = [(" " + r).encode() for r in runs]
        (a, a_counts), (b, b_counts) = flat(self.a.encode(runs)), flat(self.b.encode(runs))
        whole = self.of_a.gives_back(a, a_counts, raw) & self.of_b.gives_back(b, b_counts, raw)
        if not whole.all():
            a, b = a[np.repeat(whole, a_counts)], b[np.repeat(whole, b_counts)]
            a_counts, b_counts = a_counts * whole, b_counts * whole
        got = align(self.of_a.sizes[a], self.of_b.sizes[b], a_counts, b_counts)
        counts = np.stack([got.n_a, got.n_b, got.n_groups, got.n_links], axis=1)
        self.starts = np.r_[self.starts, len(self.links) + np.cumsum(counts[:, 3]) - counts[:, 3]]
        self.links = np.r_[self.links, (a[got.link_a] << 32) + b[got.link_b]]
        self.counts = np.concatenate([self.counts, counts])
        self.whole = np.r_[self.whole, whole]
        # a group's tokens of a, then those of b; the last of each side is followed by its sign
        side = np.r_[2 * got.a_group, 2 * got.b_group + 1]
        order = np.argsort(side, kind="stable")
        last = np.r_[side[order][1:] != side[order][:-1], True] if len(side) else side
        sizes = [len(v.sizes) for v in (self.of_a, self.of_b)]
        places = np.r_[a, b + 2 * sizes[0]][order] + last * np.where(side[order] % 2, sizes[1], sizes[0])
        texts = list(map(self.written_ids.__getitem__, places.tolist()))
        ends = np.cumsum(got.n_a + got.n_b).tolist()
        self.written += [b"".join(texts[i:j]) for i, j in zip([0, *ends], ends)]

    def numbered(self, texts: list[str | None]) -> list[np.ndarray]:
        """The runs of each text."""
        number, known = self.numbers.__getitem__, len(self.numbers)
        found = [np.array(list(map(number, runs_of(t))) if t else [], np.int64) for t in texts]
        if len(self.numbers) > known:
            self.learn(list(islice(self.numbers, known, None)))
        # a literal stand-in for the space reads back as a space, so its text has no tokens
        return [f if self.whole[f].all() else f[:0] for f in found]


def runs_of(text: str) -> list[str]:
    return RUNS.split(text) if LOOSE.search(text) else text.split(" ")


@functools.cache
def known_runs(a_path: str | None, b_path: str | None) -> Runs:
    import public_tokenizers

    return Runs(a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model"))


def chunk_schema(doc_id: T.DataType) -> T.StructType:
    """Rows of three kinds: a document, a chunk's runs, and a pair of a chunk."""
    longs = ["n_a", "n_b", "n_groups", "n_links"]
    kinds = [("kind", T.StringType()), ("chunk", T.LongType()), ("doc_id", doc_id), *((n, T.LongType()) for n in longs), ("groups_sha256", T.StringType())]
    binaries = [(n, T.BinaryType()) for n in ("runs", "sizes", "slots")]
    return T.StructType([T.StructField(*f) for f in [*kinds, *binaries, ("slot", T.IntegerType()), ("pair", T.LongType()), ("times", T.LongType())]])


def filled(schema: pa.Schema, rows: int, columns: dict) -> pa.RecordBatch:
    """A batch with these columns; the others are null."""
    arrays = [columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class Chunk:
    """Documents as places in the chunk's distinct runs, and those runs as places in its distinct pairs."""

    def __init__(self, number: int) -> None:
        self.number, self.chars = number, 0
        self.ids: list[pa.Array] = []
        self.runs: list[np.ndarray] = []
        self.digests: list[str] = []

    def take(self, known: Runs, doc_ids: pa.Array, texts: list[str | None]) -> None:
        self.ids.append(doc_ids)
        self.chars += sum(len(t or "") for t in texts)
        for f in known.numbered(texts):
            self.runs.append(f.astype(np.int32))
            self.digests.append(hashlib.sha256(b"".join([known.written[i] for i in f.tolist()])[:-1]).hexdigest() if len(f) else "")

    def batches(self, known: Runs, schema: pa.Schema, at_once: int = 2048) -> Iterator[pa.RecordBatch]:
        runs, places = np.unique(np.concatenate([np.empty(0, np.int32), *self.runs]), return_inverse=True)
        sizes = known.counts[runs, 3]
        at = np.repeat(known.starts[runs] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        pairs, slots = np.unique(known.links[at], return_inverse=True)
        seen = np.repeat(np.bincount(places, minlength=len(runs)), sizes)
        times = np.bincount(slots, weights=seen, minlength=len(pairs)).astype(np.int64)
        yield filled(schema, 1, {"kind": ["runs"], "chunk": [self.number], "sizes": [sizes.astype("<i4").tobytes()], "slots": [slots.astype("<i4").tobytes()]})
        for i in range(0, len(pairs), 50_000):
            n = len(pairs[i : i + 50_000])
            slot = np.arange(i, i + n, dtype=np.int32)
            yield filled(schema, n, {"kind": ["pair"] * n, "chunk": np.full(n, self.number), "slot": slot, "pair": pairs[i : i + n], "times": times[i : i + n]})
        ids, start = pa.concat_arrays(self.ids), 0
        for i in range(0, len(self.runs), at_once):
            own, n = self.runs[i : i + at_once], len(self.runs[i : i + at_once])
            ends = start + np.cumsum([len(f) for f in own])
            mine = [places[e - len(f) : e].astype("<i4").tobytes() for e, f in zip(ends, own, strict=True)]
            sums = np.array([known.counts[f].sum(0) for f in own]).T
            start = int(ends[-1])
            columns = dict(zip(("n_a", "n_b", "n_groups", "n_links"), sums, strict=True))
            yield filled(schema, n, {"kind": ["doc"] * n, "chunk": np.full(n, self.number), "doc_id": ids.slice(i, n), "groups_sha256": self.digests[i : i + n], "runs": mine} | columns)


def chunked(docs: DataFrame, chunk_chars: int, a_path: str | None, b_path: str | None) -> DataFrame:
    """Documents, runs and pairs of all chunks (chunk_schema)."""
    schema = chunk_schema(docs.schema["doc_id"].dataType)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, arrow, number = known_runs(a_path, b_path), to_arrow_schema(schema), TaskContext.get().partitionId() << 32
        chunk = Chunk(number)
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            for i, j in slices(texts, chunk_chars // 8):
                chunk.take(known, batch.column(0).slice(i, j - i), texts[i:j])
                if chunk.chars >= chunk_chars:
                    yield from chunk.batches(known, arrow)
                    number += 1
                    chunk = Chunk(number)
                    known.bound()
        if chunk.ids:
            yield from chunk.batches(known, arrow)
        known.bound()

    return docs.select("doc_id", "text").mapInArrow(made, schema)


def corpus_counts(pairs: DataFrame) -> DataFrame:
    """pair, links (how many the corpus holds) and best, whether no other pair of the same b has more. pairs: pair, times."""
    counts = saved(pairs.groupBy("pair").agg(F.sum("times").alias("links")), "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    # one row for each id of b's vocabulary at most
    highest = counts.groupBy(b.alias("b")).agg(F.max("links").alias("highest"))
    return counts.withColumn("b", b).join(F.broadcast(highest), "b").select("pair", "links", (F.col("links") == F.col("highest")).alias("best"))


RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def aligned(docs: DataFrame, chunk_chars: int = CHUNK_CHARS, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of docs (doc_id, text).

    a_path, b_path: files of a byte-level tokenizer and a sentencepiece model that every executor has; None for the installed ones.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = saved(chunked(docs, chunk_chars, a_path, b_path), "alignment-chunks")
    pairs = parts.where("kind = 'pair'").select("chunk", "slot", "pair", "times")
    values = pairs.drop("times").join(corpus_counts(pairs.select("pair", "times")), "pair").select(F.col("chunk").alias("of"), "slot", "links", "best")

    def summed(rows: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        mine = rows[rows.kind == "doc"]
        runs = rows[rows.kind == "runs"].iloc[0]
        sizes, slots = (np.frombuffer(runs[c], "<i4") for c in ("sizes", "slots"))
        by_slot = values.sort_values("slot")
        ends = np.cumsum(sizes)
        upto = [np.r_[0, np.cumsum(by_slot[c].to_numpy(np.int64)[slots])] for c in ("best", "links")]
        per_run = [u[ends] - u[ends - sizes] for u in upto]
        own = [np.frombuffer(r, "<i4") for r in mine.runs]
        sums = {n: np.array([int(v[o].sum()) for o in own], np.int64) for n, v in zip(("n_best", "count_sum"), per_run, strict=True)}
        return mine.assign(**sums)[["doc_id", *RESULT, "groups_sha256"]]

    schema = ", ".join([f"doc_id {kind}", *(f"{n} long" for n in RESULT), "groups_sha256 string"])
    rows = parts.where("kind <> 'pair'").select("kind", "chunk", "doc_id", *RESULT[:4], "groups_sha256", "runs", "sizes", "slots")
    return rows.groupBy("chunk").cogroup(values.groupBy("of")).applyInPandas(summed, schema)


GROUPS = "array<struct<a:array<int>,b:array<int>>>"


def with_groups(docs: DataFrame, text: str = "text", name: str = "groups", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """docs with the groups of each text's tokens in place of a column of that name; an empty list without tokens."""
    rest = [c for c in docs.columns if c.lower() != name.lower()]
    schema = T.StructType([f for f in docs.schema if f.name in rest]).add(name, T.DataType.fromDDL(GROUPS))
    kind = to_arrow_schema(schema).field(len(rest)).type

    def grouped_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_runs(a_path, b_path)
        for batch in small_batches(batches):
            texts, found = batch.column(len(rest)).to_pylist(), []
            for i, j in slices(texts, 1_000_000):
                for runs in known.numbered(texts[i:j]):
                    groups = [g.split(b"|") for r in runs.tolist() for g in known.written[r][:-1].split(b";")]
                    found.append([{side: [int(i) for i in ids.split(b",")] for side, ids in zip("ab", g, strict=True)} for g in groups])
                known.bound()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(found, kind)], names=[*rest, name])

    columns = [F.col(f"`{c}`") for c in rest]
    return docs.select(*columns, F.col(f"`{text}`").alias(unused(docs.columns, "whole"))).mapInArrow(grouped_texts, schema)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"))
