"""Best-fit packing of tokenised documents by bin completion.

Tokens: no token crosses white space or the end of a run of letters, so the parts between are tokenised once each and looked up afterwards; the ids are
those of the tokenizer over the whole text. A document ends with id 0 and is cut only where it is longer than a sequence.

Packing: pieces are dealt evenly into blocks of about block_pieces, and every block is packed by itself, so no task grows with the input; a block wastes less
than one sequence against a packing of everything at once. In a block, best-fit decreasing gives the first incumbent. Unless that meets the lower bound,
a branch and bound goes on: take the largest piece left, list the undominated fillings of the room beside it, best first, and follow those whose waste still
allows a better packing than the incumbent. The search stops after a given number of steps and then keeps its incumbent; every piece is packed either way.

Null texts count as empty: one piece of length 1 (id 0). Repeated rows are packed each. A very long text is cut into pieces, whole. Empty tables give empty results. Only doc_id and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.llm.common import slices, small_batches, table
from loadsieve.session import saved

CAPACITY = 2048
KNOWN_WORDS = 600_000
#: Parts of plain letters (they stay letters in lower case and in any normal form) that are encoded as one text.
TOGETHER = 1000
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: No token goes on from an ASCII letter to an ASCII character that is none. By byte: is it a lower-case letter, and may it follow one without being its token's?
LETTERS = np.array([97 <= b <= 122 for b in range(256)])
ENDS = np.array([b < 128 and not 97 <= b <= 122 and b not in (32, 9, 10, 11, 12, 13) for b in range(256)])


def parted(text: str | None) -> bytes:
    """The text with white space between the parts whose ids can be had one by one. The tokenizer lower-cases, but for its special tokens: a text that may
    hold one is only split at white space."""
    raw = (text or "").encode()
    if b"<|" in raw:
        return raw
    raw = raw.lower()
    codes = np.frombuffer(raw, np.uint8)
    ends = np.flatnonzero(LETTERS[codes[:-1]] & ENDS[codes[1:]]) + 1
    return np.insert(codes, ends, 32).tobytes() if len(ends) else raw


class WordEncoder:
    """Ids of texts by way of the ids of their parts, which are kept (KNOWN_WORDS at most, then begun anew)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.marked = bool(mark)  # a tokenizer without that mark gets every part by itself
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if mark and token.endswith(mark)]] = True
        self.forget()

    def forget(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__  # a new part takes the next number
        self.ids = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)

    def learn(self, words: list[str]) -> None:
        """Adds the ids of new parts, those of plain letters first. Such a part is one word of the tokenizer, which marks the last token of a word, so
        many are encoded as one text and told apart by that mark: an encoding of its own costs a short part more than its tokens do."""
        plain = np.fromiter(map(bool, map(PLAIN, words)), bool, len(words)) & self.marked
        letters, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        texts = ["\n".join([words[i] for i in letters[at : at + TOGETHER].tolist()]) for at in range(0, len(letters), TOGETHER)]
        ids, _ = self.encoded(texts)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(letters):  # another kind of tokenizer, whose words are not runs of letters
            self.marked = False
            return self.learn(words)
        more, sizes_of_others = self.encoded([words[i] for i in others.tolist()])
        sizes = np.empty(len(words), np.int64)
        sizes[letters], sizes[others] = np.diff(ends, prepend=0), sizes_of_others
        starts = np.empty(len(words), np.int64)
        starts[letters] = ends - sizes[letters]
        starts[others] = len(ids) + np.cumsum(sizes_of_others) - sizes_of_others
        self.starts = np.r_[self.starts, len(self.ids) + starts]
        self.sizes = np.r_[self.sizes, sizes]
        self.ids = np.r_[self.ids, ids, more]

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin (with the end of the last)."""
        if len(self.numbers) > KNOWN_WORDS:
            self.forget()
        split = pc.ascii_split_whitespace(pa.array([parted(t) for t in texts], pa.binary()).cast(pa.string()))
        words = split.flatten().dictionary_encode()  # only the distinct parts of a call become Python's
        known, distinct = len(self.numbers), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        if len(self.numbers) > known:
            self.learn(list(islice(self.numbers, known, None)))
        found = numbers[words.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[found]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[found] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.r_[0, ends][split.offsets.to_numpy()]


@functools.cache
def encoder(path: str | None) -> WordEncoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return WordEncoder(path)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    tokenizer: path of a tokenizer file that every executor has; None for the installed word_bpe_49k.json.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 2_000_000):
                ids, firsts = encode(texts[a:b])
                rows: list[tuple] = []
                for row, (first, last) in enumerate(zip(firsts[:-1], firsts[1:], strict=True), a):
                    own = np.zeros(last - first + 1, "<u4")
                    own[:-1] = ids[first:last]
                    rows += [(row, p, at, own[at : at + capacity]) for p, at in enumerate(range(0, len(own), capacity))]
                columns = [
                    batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([len(r[3]) for r in rows], pa.int64()),
                    pa.array([zlib.crc32(r[3].tobytes()) for r in rows], pa.int64()),
                ] + [pa.array([r[3].astype(np.int32) for r in rows], pa.list_(pa.int32()))] * with_ids
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes where the least room is left. lengths: in decreasing order."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r: some bin has room r
    for x in lengths:
        fitting = rooms >> x
        if fitting:
            room = x + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, len(bins)
            bins.append([])
        bins[at].append(x)
        if room > x:
            by_room[room - x].append(at)
            rooms |= 1 << (room - x)
    return bins


def dominated(filling: tuple[int, ...], room: int, left: np.ndarray) -> bool:
    """Whether a piece that is left over could stand for one or two of the filling's pieces and fill the room better or with fewer pieces."""
    spare, used = room - sum(filling), Counter(filling)
    for x in used:
        above = np.flatnonzero(left[x + 1 : x + spare + 1]) + x + 1
        if any(left[y] > used[int(y)] for y in above):
            return True
    for i, x in enumerate(filling):
        for y in filling[:i]:
            if any(left[z] > used[int(z)] for z in np.flatnonzero(left[x + y : x + y + spare + 1]) + x + y):
                return True
    return False


def exact_pairs(room: int, left: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of lengths (larger first) that are left and add up to room, those with the largest piece first."""
    there = left[: room + 1] > 0
    larger = np.flatnonzero(there & there[::-1])[::-1]
    return [(int(x), room - int(x)) for x in larger[: (len(larger) + 1) // 2] if 2 * x > room or left[x] > 1]


def fillings(room: int, left: np.ndarray, width: int) -> list[tuple[int, ...]]:
    """The undominated fillings of a room from what is left (counts by length), least waste first, width of them at most."""
    room = min(room, len(left) - 1)
    if room <= 0:
        return [()]
    if left[room]:
        return [(room,)]  # a single piece that fills the room dominates all else
    have = np.flatnonzero(left[: room + 1])[::-1]
    full = exact_pairs(room, left)
    for x in have[: 8 * width]:
        if full:
            break
        full = [(int(x), y, z) for y, z in exact_pairs(room - int(x), left) if y <= x and left[x] > (x == y) + (x == z)]
    if full:
        return full[:width]  # nothing is wasted, and none of these could be had with fewer pieces
    numbers = np.arange(room + 1)
    floor = np.maximum.accumulate(np.where(left[: room + 1] > 0, numbers, 0))
    if not floor[room]:
        return [()]

    def completed(start: tuple[int, ...]) -> tuple[int, ...] | None:
        """start with the largest pieces that still fit; None if start uses more of a length than is left."""
        used = Counter(start)
        if any(left[x] < k for x, k in used.items()):
            return None
        chosen, free = list(start), room - sum(start)
        x = int(floor[free]) if free > 0 else 0
        while x:
            if left[x] > used[x]:
                chosen.append(x)
                used[x] += 1
                free -= x
                x = int(floor[min(free, x)]) if free > 0 else 0
            else:
                x = int(floor[x - 1])
        return tuple(sorted(chosen, reverse=True))

    found = {completed((int(have[0]),))}

    def pairs(free: int, prefix: tuple[int, ...]) -> bool:
        """Adds the best pairs for the free room; True if some fill it."""
        firsts = have[have <= free]
        seconds = floor[free - firsts]
        seconds = np.where((seconds == firsts) & (left[firsts] < 2), floor[np.maximum(seconds - 1, 0)], seconds)
        best = np.argsort(-(firsts + seconds), kind="stable")[: 2 * width]
        for i in best:
            found.add(completed((*prefix, *(int(v) for v in (firsts[i], seconds[i]) if v))))
        return bool(len(best)) and firsts[best[0]] + seconds[best[0]] == free

    if not pairs(room, ()):
        for x in have[: 4 * width]:
            if pairs(room - int(x), (int(x),)):
                break
    found.discard(None)
    ordered = sorted(found, key=lambda f: (-sum(f), len(f), tuple(-x for x in f)))
    return [f for f in ordered if not dominated(f, room, left)][:width] or ordered[:1]


def complete_bins(lengths: list[int], capacity: int = CAPACITY, width: int = 3, more_nodes: int = 500, widest: int = 96) -> list[list[int]]:
    """A packing of the lengths as lists of lengths. more_nodes: steps of the search beyond one for each sequence.

    A node follows `width` fillings at most. A search that ends without meeting the bound is begun again with twice as many, up to `widest`, while steps remain.
    """
    lengths = sorted(lengths, reverse=True)
    best = best_fit(lengths, capacity)
    bound = -(-sum(lengths) // capacity)
    nodes, max_nodes = 0, len(best) + more_nodes
    while len(best) > bound and nodes < max_nodes and width <= widest:
        best, nodes = searched(lengths, best, bound, capacity, width, nodes, max_nodes)
        width *= 2
    return best


def searched(lengths: list[int], best: list[list[int]], bound: int, capacity: int, width: int, nodes: int, max_nodes: int) -> tuple[list[list[int]], int]:
    """The better of `best` and what a search of this width finds, and the steps taken so far."""
    total = sum(lengths)
    left = np.bincount(lengths, minlength=capacity + 1)
    path: list[tuple[int, ...]] = []
    wasted = [0]
    waiting: list[list[tuple[int, ...]]] = []
    while len(best) > bound and nodes < max_nodes:
        nodes += 1
        rest = np.flatnonzero(left)
        if not len(rest):
            if len(path) < len(best):
                best = [list(p) for p in path]
        else:
            largest = int(rest[-1])
            left[largest] -= 1
            options = [(largest, *f) for f in fillings(capacity - largest, left, width)]
            left[largest] += 1
            waiting.append(options[::-1])
        allowed = (len(best) - 1) * capacity - total
        while waiting:  # on to the next filling that may still lead to a better packing
            if len(path) == len(waiting):
                np.add.at(left, list(path.pop()), 1)
                wasted.pop()
            if waiting[-1]:
                chosen = waiting[-1].pop()
                waste = wasted[-1] + capacity - sum(chosen)
                if waste <= allowed:
                    np.subtract.at(left, list(chosen), 1)
                    path.append(chosen)
                    wasted.append(waste)
                    break
            else:
                waiting.pop()
        else:
            break
    return best, nodes


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, block_pieces: int = 4096) -> DataFrame:
    """Adds sequence_id and offset. pieces: rows with a length of at most capacity, read from a written table."""
    dealt = saved(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    blocks = max(1, -(-dealt.count() // block_pieces))
    schema = f"{pieces.schema.simpleString()[7:-1]},sequence_id:bigint,offset:bigint"

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_row", ignore_index=True)
        waiting: dict[int, list[int]] = defaultdict(list)
        for row, x in enumerate(block.length):
            waiting[x].append(row)
        at = np.zeros(len(block), np.int64)
        where = np.zeros(len(block), np.int64)
        for number, chosen in enumerate(complete_bins(block.length.tolist(), capacity)):
            offset = 0
            for x in chosen:
                row = waiting[x].pop()
                at[row], where[row] = number, offset
                offset += x
        return block.assign(sequence_id=block._block.astype("int64") * (1 << 32) + at, offset=where).drop(columns=["_row", "_block"])

    # the block of a row follows from its place in the written table, so that repeated rows spread as well
    placed = dealt.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    return placed.repartition(blocks, "_block").groupBy("_block").applyInPandas(pack, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids (column ids of pieces made with_ids): sequence_id, ids. A sequence holds capacity ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op5_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_pieces(token_pieces(table(spark, sf_dir, "documents")))
