import random
import zlib
from itertools import count

import numpy as np
import pytest

from loadsieve.llm import QUERIES
from loadsieve.llm.packing import WordEncoder, best_fit, complete_bins, encoder, fillings, pack_pieces, sequences, token_pieces


def expected(doc_ids_texts):
    tokenizer = encoder(None).tokenizer
    rows = []
    for doc_id, text in doc_ids_texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            rows.append((doc_id, p, at, len(part), zlib.crc32(part.tobytes())))
    return rows


def check_packing(rows):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_sequence)


def test_ids_are_those_of_the_tokenizer():
    draw = random.Random(4)
    letters = " \n\t'sdtrevl,.$A1é́Σß<|>%中ﬁ\x85\xa0\x1c…’İ"
    texts = ["", None, "a<|endoftext|>b", "<|ENDOFTEXT|>x", "we'll WE'LL 's", *("".join(draw.choice(letters) for _ in range(draw.randrange(50))) for _ in range(3000))]
    own = encoder(None)
    ids, firsts = own.encode(texts)
    for i, t in enumerate(texts):
        assert ids[firsts[i] : firsts[i + 1]].tolist() == own.tokenizer.encode(t or "", add_special_tokens=False).ids, t


def smallest(lengths, capacity):
    """Fewest bins, by trying all ways."""

    def fits(left, bins):
        if not left:
            return True
        seen = set()
        for i, room in enumerate(bins):
            if room >= left[0] and room not in seen:
                seen.add(room)
                if fits(left[1:], [*bins[:i], room - left[0], *bins[i + 1 :]]):
                    return True
        return False

    return next(n for n in count(max(1, -(-sum(lengths) // capacity))) if fits(sorted(lengths, reverse=True), [capacity] * n))


def test_small_packings_are_the_smallest():
    draw = random.Random(7)
    for turn in range(300):  # with the settings of the query
        capacity = (60, 2048)[turn % 2]
        lengths = [draw.randrange(1, capacity // (1 + turn % 3)) for _ in range(draw.randrange(1, 14))]
        got = complete_bins(lengths, capacity)
        assert sorted(x for b in got for x in b) == sorted(lengths) and all(sum(b) <= capacity for b in got)
        assert len(got) == smallest(lengths, capacity)


def test_completion_beats_or_equals_best_fit():
    draw, better = random.Random(8), 0
    for n in (50, 300, 1200):
        lengths = [draw.randrange(300, 1200) for _ in range(n)]
        got, start = complete_bins(lengths), best_fit(sorted(lengths, reverse=True), 2048)
        assert sorted(x for b in got for x in b) == sorted(lengths) and all(sum(b) <= 2048 for b in got)
        assert len(got) <= len(start)
        better += len(got) < len(start)
    assert better


@pytest.mark.parametrize("room,left,want", [(10, {10: 1, 6: 1, 4: 1}, [(10,)]), (10, {6: 1, 4: 1, 3: 1}, [(6, 4)]), (10, {5: 1, 3: 1}, [(5, 3)]), (2, {3: 1}, [()]), (9, {3: 3}, [(3, 3, 3)])])
def test_fillings(room, left, want):
    counts = np.zeros(12, np.int64)
    for x, n in left.items():
        counts[x] = n
    assert fillings(room, counts, 1) == want


def test_query(spark, sf_dir, docs):
    got = QUERIES["op5_bin_completion"](spark, sf_dir)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert check_packing(rows) <= -(-sum(w[3] for w in want) // 2048) + 1


def test_edges_and_sequences(edge, nothing):
    packed = pack_pieces(token_pieces(edge, with_ids=True), block_pieces=5)
    rows = packed.collect()
    want = expected([(r.doc_id, r.text) for r in edge.collect()])
    assert sorted(map(str, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows))) == sorted(map(str, want))
    check_packing(rows)
    whole = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == list(r.ids)
    assert pack_pieces(token_pieces(nothing)).count() == 0


def test_plain_words_are_learned_together():
    import public_tokenizers

    own = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer, asked = own.tokenizer, []

    class Asked:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    own.tokenizer = Asked()
    draw = random.Random(7)
    words = ["".join(draw.choice("abcdeéñß") for _ in range(draw.randrange(1, 12))) for _ in range(5000)]
    texts = [" ".join(words[:3000]) + " 12.5 İx ", None, " ".join(words)]
    for _ in range(2):
        ids, firsts = own.encode(texts)
        for i, t in enumerate(texts):
            assert ids[firsts[i] : firsts[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids
    assert len(asked) < 20
    # a mark that does not tell words apart: every part by itself, same ids
    own.forget()
    own.last[:] = True
    assert own.encode(texts)[0].tolist() == ids.tolist()
